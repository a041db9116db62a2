"""Record shapes and fixed domains. Shapes are DDL text, so no session is needed to import."""

from __future__ import annotations

# -- messages: fixed field names and types -------------------------------------
ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)

LINE_ITEM = (
    "product_id string, product_name string, category string, "
    "unit_price double, quantity int, item_total double"
)

ORDER = (
    "order_id string, customer_id string, customer_name string, customer_email string, "
    "customer_phone string, region string, city string, address string, num_items int, "
    "subtotal double, discount double, final_amount double, device string, status string, "
    f"timestamp string, date string, hour int, items array<struct<{LINE_ITEM}>>"
)

PAYMENT = (
    "payment_id string, order_id string, customer_id string, amount double, "
    "payment_method string, status string, gateway string, transaction_id string, "
    "timestamp string, date string"
)

USER_EVENT = (
    "event_id string, customer_id string, event_type string, product_id string, "
    "product_name string, category string, search_query string, device string, "
    "session_id string, page_url string, timestamp string, date string"
)

KAFKA_COLUMNS = (
    "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp"
)

AUDIT_COLUMNS = "processed_at timestamp, pipeline_version string"

# -- curated layers: what cleaning adds to, or drops from, the message --------
CURATED_ORDERS = (
    "order_id string, customer_id string, customer_name string, customer_email string, "
    "region string, city string, num_items int, subtotal double, discount double, "
    "final_amount double, device string, status string, timestamp string, date string, "
    f"hour int, items array<struct<{LINE_ITEM}>>, "
    f"{KAFKA_COLUMNS}, event_timestamp timestamp, is_high_value boolean, "
    "is_discounted boolean, order_day_of_week int, order_hour int, value_segment string, "
    f"{AUDIT_COLUMNS}"
)
CURATED_PAYMENTS = (
    f"{PAYMENT}, {KAFKA_COLUMNS}, is_successful boolean, event_timestamp timestamp, "
    f"payment_hour int, {AUDIT_COLUMNS}"
)
CURATED_EVENTS = (
    f"{USER_EVENT}, {KAFKA_COLUMNS}, is_product_event boolean, is_search_event boolean, "
    f"event_timestamp timestamp, event_hour int, {AUDIT_COLUMNS}"
)

# -- fixed values of the shop's domain ----------------------------------------
TOPICS = ("orders", "payments", "user_events")
PIPELINE_VERSION = "v2.0"

CITIES_BY_REGION = {
    "North": ["Delhi", "Chandigarh", "Lucknow", "Jaipur"],
    "South": ["Chennai", "Bangalore", "Hyderabad", "Kochi"],
    "East": ["Kolkata", "Bhubaneswar", "Patna", "Guwahati"],
    "West": ["Mumbai", "Pune", "Ahmedabad", "Surat"],
    "Central": ["Bhopal", "Nagpur", "Indore", "Raipur"],
}
PAYMENT_METHODS = ["UPI", "Credit Card", "Debit Card", "Net Banking", "Cash on Delivery", "Wallet"]
PAYMENT_STATUSES = ["SUCCESS", "FAILED"]
GATEWAYS = ["Razorpay", "Paytm", "PayU", "CCAvenue"]
DEVICES = ["Mobile", "Desktop", "Tablet"]
ORDER_STATUSES = ["PLACED", "CONFIRMED", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED"]
EVENT_TYPES = [
    "PAGE_VIEW", "PRODUCT_CLICK", "ADD_TO_CART", "REMOVE_FROM_CART",
    "WISHLIST_ADD", "SEARCH", "CHECKOUT_START", "COUPON_APPLIED",
]
# product_id, name, category, unit price
PRODUCTS = [
    ("P001", "iPhone 15 Pro", "Electronics", 134900.0),
    ("P002", 'Samsung 65" QLED TV', "Electronics", 89999.0),
    ("P003", "Nike Air Max", "Footwear", 9995.0),
    ("P004", "Levi's 511 Jeans", "Clothing", 3999.0),
    ("P005", "Harry Potter Box Set", "Books", 2499.0),
    ("P006", "Instant Pot Duo", "Kitchen", 7999.0),
    ("P007", "Yoga Mat Premium", "Sports", 1299.0),
    ("P008", "MacBook Air M2", "Electronics", 114900.0),
    ("P009", "Boat Airdopes 141", "Electronics", 1299.0),
    ("P010", "Prestige Cooker 5L", "Kitchen", 1850.0),
    ("P011", "Adidas Running Shoes", "Footwear", 6999.0),
    ("P012", "Atomic Habits Book", "Books", 499.0),
    ("P013", "Campus T-Shirt Pack", "Clothing", 899.0),
    ("P014", "OnePlus 12", "Electronics", 64999.0),
    ("P015", "Whey Protein 2kg", "Sports", 3499.0),
]

# -- fixed thresholds, highest first ------------------------------------------
HIGH_VALUE_FROM = 50_000
VALUE_BANDS = [(100_000, "PREMIUM"), (50_000, "HIGH"), (10_000, "MEDIUM")]
VALUE_SEGMENTS = ["PREMIUM", "HIGH", "MEDIUM", "LOW"]
RFM_BANDS = [
    (13, "CHAMPIONS"), (10, "LOYAL_CUSTOMERS"), (7, "POTENTIAL_LOYALISTS"), (5, "AT_RISK"),
]
RFM_SEGMENTS = [
    "CHAMPIONS", "LOYAL_CUSTOMERS", "POTENTIAL_LOYALISTS", "AT_RISK", "LOST_CUSTOMERS",
]
CHURN_BANDS = [(90, "HIGH"), (60, "MEDIUM"), (30, "LOW")]
SUCCESS_BANDS = [(90, "green"), (80, "amber")]
WEEKEND = [1, 7]
DAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
EVENING_HOURS = [19, 20, 21, 22]
CELL_LIMIT = 32_767
# cents of larger amounts do not fit 64 bits
AMOUNT_BELOW = 9e16
