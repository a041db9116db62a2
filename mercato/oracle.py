"""Independent DuckDB SQL for the registered queries.

One shared prefix restates the message shapes and the cleaning rules; each query is then
plain SQL over it. Money is summed as DECIMAL here and as cents in Spark, and ratios are
rounded half up in whole numbers on both sides, so equal results are equal bit by bit.
"""

from __future__ import annotations

from mercato.workspace import AS_OF


# -- SQL fragments ------------------------------------------------------------
def _cents(x: str) -> str:
    return f"CAST(ROUND({x} * 100) AS BIGINT)"


def _sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def _half_up(n: str, d: str) -> str:
    return f"((2 * ({n}) + ({d})) // NULLIF(2 * ({d}), 0))"


def _avg(x: str) -> str:
    return f"CAST({_half_up(f'SUM({_cents(x)})', f'COUNT({x})')} AS DOUBLE) / 100"


def _avg_count(x: str) -> str:
    return f"CAST({_half_up(f'100 * SUM({x})', f'COUNT({x})')} AS DOUBLE) / 100"


def _percent(part: str, whole: str, decimals: int = 2) -> str:
    scale = 10**decimals
    return f"CAST({_half_up(f'{100 * scale} * CAST({part} AS HUGEINT)', whole)} AS DOUBLE) / {scale}"


def _share(count: str, decimals: int = 2) -> str:
    return _percent(count, f"SUM({count}) OVER ()", decimals)


def _if(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def _lakh(x: str) -> str:
    tenths = _half_up(_cents(x), "1000000")
    return f"'₹' || ({tenths} // 10) || '.' || ({tenths} % 10) || 'L'"


def _rupees(x: str) -> str:
    return f"'₹' || format('{{:,}}', {_half_up(_cents(x), '100')})"


def _rupees_cents(x: str) -> str:
    size = f"abs({_cents(x)})"
    return (
        f"'₹' || CASE WHEN {_cents(x)} < 0 THEN '-' ELSE '' END || format('{{:,}}', {size} // 100) || '.' || "
        f"lpad(CAST({size} % 100 AS VARCHAR), 2, '0')"
    )


def _pad(side: str, x: str, width: int) -> str:
    return f"{side}({x}, CAST(greatest({width}, length({x})) AS INTEGER), ' ')"


def _rank(column: str, values: list[str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(values)) + " END"


def _pick(number: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    at = f"CAST(({number}) % {len(values)} + 1 AS INTEGER)"
    return f"CASE WHEN ({number}) IS NOT NULL THEN ([{listed}])[{at}] END"


def _delivery(topic: str, key: str, at: str) -> str:
    return (
        f"'{topic}' AS kafka_topic, CAST({key} % 4 AS INTEGER) AS kafka_partition, "
        f"{key} // 4 AS kafka_offset, {at} AS kafka_timestamp"
    )


# Fixed values, restated here so that the SQL does not depend on the code it checks.
_DEVICES = ["Mobile", "Desktop", "Tablet"]
_METHODS = ["UPI", "Credit Card", "Debit Card", "Net Banking", "Cash on Delivery", "Wallet"]
_GATEWAYS = ["Razorpay", "Paytm", "PayU", "CCAvenue"]
_SEGMENTS = ["CHAMPIONS", "LOYAL_CUSTOMERS", "POTENTIAL_LOYALISTS", "AT_RISK", "LOST_CUSTOMERS"]
_BANDS = ["PREMIUM", "HIGH", "MEDIUM", "LOW"]
_ORDER_TIME = "o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))"

# -- message shapes and cleaning ----------------------------------------------
_RAW_ORDERS = f"""
line_totals AS (
  SELECT l_orderkey, CAST(COUNT(*) AS INTEGER) AS num_items, {_sum('l_extendedprice')} AS subtotal
  FROM lineitem GROUP BY l_orderkey),
raw_orders AS (
  SELECT ' ord' || o_orderkey || ' ' AS order_id, 'CUST' || o_custkey AS customer_id,
    ' ' || c_name || ' ' AS customer_name, 'c' || o_custkey || '@example.com' AS customer_email,
    '0000000000' AS customer_phone, ' ' || lower(r_name) AS region, n_name || ' ' AS city,
    'unlisted' AS address, num_items, subtotal,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 IN (1, 2, 3) THEN 0.0::DOUBLE
         ELSE CAST(o_orderkey % 5000 AS DOUBLE) END AS discount,
    o_totalprice AS final_amount, {_pick('o_orderkey', _DEVICES)} AS device,
    CASE WHEN o_orderkey % 20 = 0 THEN 'CANCELLED' WHEN o_orderstatus = 'F' THEN 'DELIVERED'
         WHEN o_orderstatus = 'O' THEN 'PLACED' ELSE 'PROCESSING' END AS status,
    strftime({_ORDER_TIME}, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
    strftime({_ORDER_TIME}, '%Y-%m-%d') AS "date", CAST(o_orderkey % 24 AS INTEGER) AS "hour",
    {_delivery('orders', 'o_orderkey', _ORDER_TIME)}
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN line_totals ON o_orderkey = l_orderkey)"""

_RAW_PAYMENTS = f"""
raw_payments AS (
  SELECT ' pay' || o_orderkey AS payment_id, ' ord' || o_orderkey || ' ' AS order_id,
    'CUST' || o_custkey AS customer_id, o_totalprice AS amount,
    {_pick('o_orderkey // 3', _METHODS)} AS payment_method,
    CASE WHEN o_orderstatus IS NULL THEN NULL WHEN (o_orderkey // 7) % 10 = 0 THEN 'FAILED'
      ELSE 'success' END AS status,
    {_pick('o_orderkey', _GATEWAYS)} AS gateway, 'TXN' || o_orderkey AS transaction_id,
    strftime({_ORDER_TIME}, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
    strftime({_ORDER_TIME}, '%Y-%m-%d') AS "date",
    {_delivery('payments', 'o_orderkey', _ORDER_TIME)}
  FROM orders)"""

_RAW_EVENTS = f"""
numbered_events AS (
  SELECT *, json_extract_string(props, '$.k') AS k, event_type = 'signup' AS searching FROM events),
raw_user_events AS (
  SELECT 'evt' || event_id AS event_id, 'CUST' || user_id AS customer_id,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_click'
      WHEN 'purchase' THEN 'checkout_start' WHEN 'signup' THEN 'search'
      WHEN 'error' THEN 'remove_from_cart' END AS event_type,
    CASE WHEN NOT searching THEN 'P' || k END AS product_id,
    CASE WHEN NOT searching THEN 'product ' || k END AS product_name,
    CASE WHEN NOT searching THEN 'category ' || (CAST(k AS INTEGER) % 6) END AS category,
    CASE WHEN searching THEN 'q' || k END AS search_query,
    {_pick('event_id', _DEVICES)} AS device, 'SES' || user_id AS session_id,
    '/product/p' || k AS page_url, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
    strftime(ts, '%Y-%m-%d') AS "date", {_delivery('user_events', 'event_id', 'ts')}
  FROM numbered_events)"""

_ORDERS_VALID = """order_id IS NOT NULL AND trim(order_id) <> '' AND customer_id IS NOT NULL
    AND trim(customer_id) <> '' AND final_amount > 0 AND final_amount < 9e16 AND num_items > 0"""
_PAYMENTS_VALID = """payment_id IS NOT NULL AND trim(payment_id) <> '' AND order_id IS NOT NULL
    AND trim(order_id) <> '' AND amount > 0 AND amount < 9e16"""
_EVENTS_VALID = """event_id IS NOT NULL AND trim(event_id) <> '' AND customer_id IS NOT NULL
    AND trim(customer_id) <> '' AND event_type IS NOT NULL AND trim(event_type) <> ''"""

_KAFKA = "kafka_topic, kafka_partition, kafka_offset, kafka_timestamp"

_CURATED = f"""
c_orders AS (
  SELECT upper(trim(order_id)) AS order_id, customer_id, trim(customer_name) AS customer_name,
    customer_email, upper(trim(region)) AS region, trim(city) AS city, num_items, subtotal,
    ROUND(COALESCE(CASE WHEN abs(discount) < 9e16 THEN discount END, 0.0), 2) AS discount, ROUND(final_amount, 2) AS final_amount,
    device, status, "timestamp", "date", "hour", {_KAFKA},
    CAST("timestamp" AS TIMESTAMP) AS event_timestamp,
    ROUND(final_amount, 2) >= 50000 AS is_high_value,
    ROUND(COALESCE(CASE WHEN abs(discount) < 9e16 THEN discount END, 0.0), 2) > 0 AS is_discounted,
    CAST(dayofweek(CAST("timestamp" AS TIMESTAMP)) + 1 AS INTEGER) AS order_day_of_week,
    CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS order_hour,
    CASE WHEN ROUND(final_amount, 2) >= 100000 THEN 'PREMIUM' WHEN ROUND(final_amount, 2) >= 50000
      THEN 'HIGH' WHEN ROUND(final_amount, 2) >= 10000 THEN 'MEDIUM' ELSE 'LOW' END AS value_segment,
    'v2.0' AS pipeline_version
  FROM raw_orders WHERE {_ORDERS_VALID}),
c_payments AS (
  SELECT upper(trim(payment_id)) AS payment_id, upper(trim(order_id)) AS order_id, customer_id,
    ROUND(amount, 2) AS amount, upper(trim(payment_method)) AS payment_method,
    upper(trim(status)) AS status, gateway, transaction_id, "timestamp", "date", {_KAFKA},
    COALESCE(upper(trim(status)) = 'SUCCESS', FALSE) AS is_successful,
    CAST("timestamp" AS TIMESTAMP) AS event_timestamp,
    CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS payment_hour,
    'v2.0' AS pipeline_version
  FROM raw_payments WHERE {_PAYMENTS_VALID}),
c_user_events AS (
  SELECT upper(trim(event_id)) AS event_id, customer_id, upper(trim(event_type)) AS event_type,
    product_id, product_name, category, search_query, upper(trim(device)) AS device, session_id,
    page_url, "timestamp", "date", {_KAFKA}, product_id IS NOT NULL AS is_product_event,
    upper(trim(event_type)) = 'SEARCH' AS is_search_event,
    CAST("timestamp" AS TIMESTAMP) AS event_timestamp,
    CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS event_hour,
    'v2.0' AS pipeline_version
  FROM raw_user_events WHERE {_EVENTS_VALID})"""


# -- customers ----------------------------------------------------------------
def _latest(x: str) -> str:
    """Value on the last order; orders without a time come before all others."""
    return f"first({x} ORDER BY event_timestamp DESC NULLS LAST, order_id DESC, customer_name DESC, customer_email DESC)"


_METRICS = f"""
metrics AS (
  SELECT customer_id, {_latest('customer_name')} AS customer_name,
    {_latest('customer_email')} AS customer_email, MAX("date") AS last_order_date,
    CAST(date_diff('day', CAST(MAX("date") AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_order,
    COUNT(order_id) AS total_orders, {_sum('final_amount')} AS total_revenue,
    {_avg('final_amount')} AS avg_order_value
  FROM c_orders GROUP BY customer_id)"""


def _rfm(name: str, recency: str, undated: str) -> str:
    def tile(order: str) -> str:
        return f"ntile(5) OVER (ORDER BY {order}, customer_id)"

    return f"""
{name}_scored AS (
  SELECT *, CAST({recency.format(tile=tile('days_since_order DESC NULLS ' + undated))} AS INTEGER) AS recency_score,
    CAST({tile('total_orders')} AS INTEGER) AS frequency_score,
    CAST({tile('total_revenue')} AS INTEGER) AS monetary_score
  FROM metrics),
{name} AS (
  SELECT *, CASE WHEN recency_score + frequency_score + monetary_score >= 13 THEN 'CHAMPIONS'
      WHEN recency_score + frequency_score + monetary_score >= 10 THEN 'LOYAL_CUSTOMERS'
      WHEN recency_score + frequency_score + monetary_score >= 7 THEN 'POTENTIAL_LOYALISTS'
      WHEN recency_score + frequency_score + monetary_score >= 5 THEN 'AT_RISK'
      ELSE 'LOST_CUSTOMERS' END AS rfm_segment, '{AS_OF}' AS computed_date
  FROM {name}_scored)"""


_CHURN = f"""
churn AS (
  SELECT customer_id, customer_name, customer_email, last_order_date, total_orders,
    total_revenue AS total_lifetime_value, days_since_order,
    CASE WHEN days_since_order >= 90 THEN 'HIGH' WHEN days_since_order >= 60 THEN 'MEDIUM'
      ELSE 'LOW' END AS churn_risk, '{AS_OF}' AS computed_date
  FROM metrics WHERE days_since_order >= 30)"""

_LINES = """
order_lines AS (
  SELECT 'ORD' || l_orderkey AS order_id, 'P' || l_partkey AS product_id, p_name AS product_name,
    p_type AS category,
    CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) // NULLIF(CAST(l_quantity AS BIGINT), 0) AS DOUBLE) / 100 AS unit_price,
    CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS item_total
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

_SHARED = ",".join(
    [
        _RAW_ORDERS, _RAW_PAYMENTS, _RAW_EVENTS, _CURATED, _METRICS,
        _rfm("rfm", "{tile}", "FIRST"), _rfm("rfm_compat", "6 - {tile}", "LAST"), _CHURN, _LINES,
    ]
)


def _sql(body: str, extra: str = "") -> str:
    """A query over the shared prefix."""
    return f"WITH {_SHARED}{',' + extra if extra else ''}\n{body}"


# -- parts of the queries -----------------------------------------------------
_MEASURES = {
    "total_orders": "COUNT(order_id)",
    "orders": "COUNT(order_id)",
    "total_revenue": _sum("final_amount"),
    "revenue": _sum("final_amount"),
    "daily_revenue": _sum("final_amount"),
    "avg_order_value": _avg("final_amount"),
    "total_discount": _sum("discount"),
    "high_value_orders": _if("is_high_value"),
    "discounted_orders": _if("discount > 0"),
    "avg_items": _avg_count("num_items"),
    "avg_items_per_order": _avg_count("num_items"),
    "weekend_orders": _if("order_day_of_week IN (1, 7)"),
    "weekday_orders": _if("order_day_of_week NOT IN (1, 7)"),
}


def _orders_by(keys: list[str], *measures: str, tail: str = "", more: str = "") -> str:
    listed = ", ".join([*keys, *[f"{_MEASURES[m]} AS {m}" for m in measures]])
    grouped = ", ".join(k.split(" AS ")[0] for k in keys)
    return f"SELECT {listed}{more} FROM c_orders GROUP BY {grouped} {tail}"


_BY_METHOD = f"""
by_method AS (
  SELECT payment_method, COUNT(payment_id) AS total_transactions,
    {_if('is_successful')} AS successful, {_if('NOT is_successful')} AS failed,
    {_percent(_if('is_successful'), 'COUNT(payment_id)')} AS success_rate,
    {_sum('amount')} AS total_amount, {_avg('amount')} AS avg_transaction
  FROM c_payments GROUP BY payment_method)"""

_BY_SEGMENT = f"""
by_segment AS (
  SELECT rfm_segment, COUNT(customer_id) AS customer_count,
    {_avg('total_revenue')} AS avg_lifetime_value, {_avg_count('total_orders')} AS avg_orders,
    {_avg_count('days_since_order')} AS avg_days_inactive
  FROM rfm GROUP BY rfm_segment)"""

_TOP_CITIES = "ORDER BY total_revenue DESC, city, region LIMIT "


def _daily_sales(device: str) -> str:
    return f"""SELECT "date", region, COUNT(order_id) AS total_orders, {_sum('final_amount')} AS total_revenue,
      {_avg('final_amount')} AS avg_order_value, {_sum('discount')} AS total_discount,
      {_if('is_high_value')} AS high_value_orders, {_if("status = 'CANCELLED'")} AS cancelled_orders,
      {_if(f"{device} = 'MOBILE'")} AS mobile_orders, {_if(f"{device} = 'DESKTOP'")} AS desktop_orders,
      '{AS_OF}' AS computed_at FROM c_orders GROUP BY "date", region"""


def _rejects(topic: str, raw: str, valid: str) -> str:
    return f"""SELECT '{topic}' AS topic, COUNT(*) AS received, {_if(valid)} AS clean,
      COUNT(*) - {_if(valid)} AS dropped FROM {raw}"""


def _blank(c: str) -> str:
    return f"{c} IS NULL OR trim({c}) = ''"


def _not_positive(c: str) -> str:
    return f"{c} IS NULL OR NOT ({c} > 0 AND {c} < 9e16)"


def _reasons(raw: str, rules: list[tuple[str, str]]) -> str:
    arms = " ".join(f"WHEN {bad} THEN '{column}'" for column, bad in rules)
    return f"""SELECT failed_rule, COUNT(*) AS dropped
      FROM (SELECT CASE {arms} END AS failed_rule FROM {raw}) WHERE failed_rule IS NOT NULL
      GROUP BY failed_rule"""


def _envelope(raw: str, key: str, topic: str) -> str:
    return f"""SELECT {key} AS "key", '{topic}' AS topic, kafka_partition AS "partition",
      kafka_offset AS "offset", "date" AS message_date FROM {raw}"""


def _domains(table: str, topic: str, domains: dict[str, list[str]]) -> str:
    parts = []
    for column, values in domains.items():
        listed = ", ".join(f"'{v.upper()}'" for v in values)
        value = f"upper(trim({column}))"
        parts.append(
            f"""SELECT '{topic}.{column}' AS field, {value} AS "value",
              COALESCE({value} IN ({listed}), FALSE) AS known, COUNT(*) AS "rows"
              FROM {table} GROUP BY ALL"""
        )
    return " UNION ALL ".join(parts)


_LINE_CHECKS = f"""
line_checks AS (
  SELECT o.order_id, COALESCE(lines, 0) AS lines, COALESCE(bad_lines, 0) AS bad_lines,
    CASE WHEN lines IS NULL THEN 'NO_LINES'
      WHEN num_items IS NULL OR lines <> num_items THEN 'COUNT_MISMATCH'
      WHEN line_cents <> {_cents('subtotal')} THEN 'SUBTOTAL_MISMATCH'
      WHEN bad_lines > 0 THEN 'LINE_TOTAL_MISMATCH' ELSE 'OK' END AS status
  FROM (SELECT upper(trim(order_id)) AS order_id, num_items, subtotal FROM raw_orders) o
  LEFT JOIN (
    SELECT order_id, COUNT(*) AS lines, SUM({_cents('item_total')}) AS line_cents,
      {_if(f"{_cents('item_total')} <> {_cents('unit_price')} * quantity")} AS bad_lines
    FROM order_lines GROUP BY order_id) l ON o.order_id = l.order_id)"""


def _side(table: str, amount: str, prefix: str) -> str:
    return f"""SELECT order_id, COUNT(*) AS {prefix}_rows, MIN({_cents(amount)}) AS {prefix}_low,
      MAX({_cents(amount)}) AS {prefix}_high, MIN(customer_id) AS {prefix}_c1,
      MAX(customer_id) AS {prefix}_c2 FROM {table} GROUP BY order_id"""


_RECONCILED = f"""
reconciled AS (
  SELECT order_id, COALESCE(o_rows, 0) AS order_rows, COALESCE(p_rows, 0) AS payment_rows,
    CASE WHEN o_rows IS NULL THEN 'PAYMENT_WITHOUT_ORDER'
      WHEN p_rows IS NULL THEN 'ORDER_WITHOUT_PAYMENT'
      WHEN o_low <> p_low OR o_high <> p_high THEN 'AMOUNT_MISMATCH'
      WHEN o_c1 IS DISTINCT FROM p_c1 OR o_c2 IS DISTINCT FROM p_c2 THEN 'CUSTOMER_MISMATCH'
      WHEN o_rows > 1 OR p_rows > 1 THEN 'REPEATED' ELSE 'OK' END AS status
  FROM ({_side('c_orders', 'final_amount', 'o')}) FULL JOIN ({_side('c_payments', 'amount', 'p')})
    USING (order_id))"""

_AMOUNT_STATUS = f"""CASE WHEN subtotal IS NULL THEN 'NO_SUBTOTAL'
  WHEN {_cents('final_amount')} = {_cents('subtotal')} - {_cents('discount')} THEN 'OK'
  ELSE 'AMOUNT_MISMATCH' END"""

_SEARCH_STATUS = """CASE WHEN is_search_event AND product_id IS NOT NULL THEN 'SEARCH_WITH_PRODUCT'
  WHEN is_search_event AND search_query IS NULL THEN 'SEARCH_WITHOUT_QUERY'
  WHEN NOT is_search_event AND search_query IS NOT NULL THEN 'QUERY_OUTSIDE_SEARCH'
  WHEN NOT is_search_event AND product_id IS NULL THEN 'PRODUCT_MISSING' ELSE 'OK' END"""

# Fixed values.
_SHOP_CITIES = """(VALUES ('NORTH','Delhi'),('NORTH','Chandigarh'),('NORTH','Lucknow'),('NORTH','Jaipur'),
 ('SOUTH','Chennai'),('SOUTH','Bangalore'),('SOUTH','Hyderabad'),('SOUTH','Kochi'),
 ('EAST','Kolkata'),('EAST','Bhubaneswar'),('EAST','Patna'),('EAST','Guwahati'),
 ('WEST','Mumbai'),('WEST','Pune'),('WEST','Ahmedabad'),('WEST','Surat'),
 ('CENTRAL','Bhopal'),('CENTRAL','Nagpur'),('CENTRAL','Indore'),('CENTRAL','Raipur'))"""

_CATALOGUE_STATUS = f"""CASE WHEN p.p_name IS NULL THEN 'UNKNOWN_PRODUCT'
  WHEN product_name IS DISTINCT FROM p.p_name THEN 'NAME_MISMATCH'
  WHEN category IS DISTINCT FROM p.p_type THEN 'CATEGORY_MISMATCH'
  WHEN {_cents('unit_price')} IS DISTINCT FROM {_cents('p.p_retailprice')} THEN 'PRICE_MISMATCH'
  ELSE 'OK' END"""

_DELIVERED_TWICE = """
delivered AS (SELECT * FROM c_payments UNION ALL SELECT * FROM c_payments WHERE NOT is_successful)"""


_NUMBER = "CAST(substr(order_id, 4) AS BIGINT)"
# each id once, then what never comes, comes late or is one unit off
_MET = f"""
one_order AS (
  SELECT order_id, customer_id, {_cents('final_amount')} AS o_cents, event_timestamp AS o_at FROM c_orders
  WHERE {_NUMBER} % 19 <> 0 QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY kafka_timestamp NULLS FIRST,
    customer_id NULLS FIRST, final_amount, num_items, "timestamp" NULLS FIRST, "date" NULLS FIRST) = 1),
one_payment AS (
  SELECT payment_id, order_id, customer_id,
    {_cents('amount')} + CASE WHEN {_NUMBER} % 17 = 0 THEN 100 ELSE 0 END AS p_cents,
    event_timestamp + CASE WHEN {_NUMBER} % 13 = 0 THEN INTERVAL 3 DAYS ELSE INTERVAL 0 DAYS END AS p_at FROM c_payments
  WHERE {_NUMBER} % 11 <> 0 QUALIFY ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY kafka_timestamp NULLS FIRST,
    order_id, customer_id NULLS FIRST, amount, payment_method NULLS FIRST, status NULLS FIRST, gateway NULLS FIRST,
    transaction_id NULLS FIRST, "timestamp" NULLS FIRST, "date" NULLS FIRST) = 1),
met AS (
  SELECT o.order_id, payment_id, o.customer_id, o_at, p_at, o_cents, p_cents, CASE WHEN o_cents <> p_cents THEN 'AMOUNT_MISMATCH'
    WHEN o.customer_id IS DISTINCT FROM p.customer_id THEN 'CUSTOMER_MISMATCH' ELSE 'OK' END AS status
  FROM one_order o JOIN one_payment p ON o.order_id = p.order_id
    AND p_at >= o_at - INTERVAL 1 HOUR AND p_at <= o_at + INTERVAL 2 DAYS),
all_met AS (
  SELECT * FROM met
  UNION ALL SELECT order_id, NULL, customer_id, o_at, NULL, o_cents, NULL,
    CASE WHEN o_at IS NULL THEN 'NO_TIME' ELSE 'ORDER_WITHOUT_PAYMENT' END
  FROM one_order o WHERE NOT EXISTS (SELECT 1 FROM met m WHERE m.order_id = o.order_id)
  UNION ALL SELECT order_id, payment_id, customer_id, NULL, p_at, NULL, p_cents,
    CASE WHEN p_at IS NULL THEN 'NO_TIME' ELSE 'PAYMENT_WITHOUT_ORDER' END
  FROM one_payment p WHERE NOT EXISTS (SELECT 1 FROM met m WHERE m.payment_id = p.payment_id))"""


def _last_touched(table: str) -> str:
    """Per day the date of the last of four nightly runs that had new rows of it."""
    return f"""
last_touched AS (
  SELECT "date", MAX(CASE WHEN CAST(substr(order_id, 4) AS BIGINT) % 97 = 0 THEN '{AS_OF}'
    WHEN kafka_timestamp >= TIMESTAMP '2001-01-01' THEN '{AS_OF}' WHEN kafka_timestamp >= TIMESTAMP '1999-01-01' THEN '2001-01-01'
    WHEN kafka_timestamp >= TIMESTAMP '1997-01-01' THEN '1999-01-01' ELSE '1997-01-01' END) AS as_of
  FROM {table} GROUP BY "date")"""


# the messages of which some carry more than is declared, with the landing they came in
_DRIFTING = """
numbered AS (
  SELECT *, CAST(substr(trim(order_id), 4) AS BIGINT) AS k,
    CASE WHEN kafka_timestamp >= TIMESTAMP '2001-01-01' THEN 3 WHEN kafka_timestamp >= TIMESTAMP '1999-01-01' THEN 2
      WHEN kafka_timestamp >= TIMESTAMP '1997-01-01' THEN 1 ELSE 0 END AS landing FROM raw_orders),
drifting AS (
  SELECT order_id, landing,
    CASE WHEN k % 31 = 0 AND landing >= 1 THEN k + 3000000000 ELSE num_items END AS num_items,
    CASE WHEN k % 29 = 0 AND landing >= 1 THEN 'C' || k END AS coupon,
    CASE WHEN k % 37 = 0 AND landing >= 2 THEN 'n' || k END AS gift_note,
    CASE WHEN k % 37 = 0 AND landing >= 2 THEN k % 2 = 0 END AS gift_wrap FROM numbered)"""


def _as_text(table: str, times: list[str]) -> str:
    replaced = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in times)
    return f"SELECT * REPLACE ({replaced}) FROM {table}"


_TABLE_ROWS = [
    ("orders", "curated", "Orders_Raw", "c_orders", 28),
    ("payments", "curated", "Payments_Raw", "c_payments", 19),
    ("user_events", "curated", "User_Events_Raw", "c_user_events", 22),
    ("customer_rfm", "summaries", "Customer_RFM_Raw", "rfm", 13),
    ("churn_candidates", "summaries", "Churn_Candidates_Raw", "churn", 9),
]

_SHEET_ROWS = {
    "Orders": "SELECT LEAST(COUNT(*), 1000) FROM c_orders",
    "Revenue by Region": "SELECT COUNT(*) FROM (SELECT DISTINCT region FROM c_orders)",
    "Daily Sales Trend": 'SELECT COUNT(*) FROM (SELECT DISTINCT "date" FROM c_orders)',
    "Payment Analysis": "SELECT COUNT(*) FROM (SELECT DISTINCT payment_method FROM c_payments)",
    "Value Segments": "SELECT COUNT(*) FROM (SELECT DISTINCT value_segment FROM c_orders)",
    "Peak Hours": "SELECT COUNT(*) FROM (SELECT DISTINCT order_hour FROM c_orders)",
    "Top Cities": "SELECT LEAST(COUNT(*), 20) FROM (SELECT DISTINCT city, region FROM c_orders)",
    "User Event Funnel": "SELECT COUNT(*) FROM (SELECT DISTINCT event_type FROM c_user_events)",
    "Customer RFM": "SELECT COUNT(*) FROM rfm",
    "Payments Sample": "SELECT LEAST(COUNT(*), 1000) FROM c_payments",
}


def build_oracle() -> dict[str, str]:
    q: dict[str, str] = {}

    # parsing and cleaning
    for label, topic, raw, curated, key, valid, rules in (
        ("orders", "orders", "raw_orders", "c_orders", "order_id", _ORDERS_VALID,
         [("order_id", _blank("order_id")), ("customer_id", _blank("customer_id")),
          ("final_amount", _not_positive("final_amount")), ("num_items", _not_positive("num_items"))]),
        ("payments", "payments", "raw_payments", "c_payments", "payment_id", _PAYMENTS_VALID,
         [("payment_id", _blank("payment_id")), ("order_id", _blank("order_id")),
          ("amount", _not_positive("amount"))]),
        ("events", "user_events", "raw_user_events", "c_user_events", "event_id", _EVENTS_VALID,
         [("event_id", _blank("event_id")), ("customer_id", _blank("customer_id")),
          ("event_type", _blank("event_type"))]),
    ):
        q[f"envelope_{label}"] = _sql(_envelope(raw, key, topic))
        q[f"parse_{label}"] = _sql(f"SELECT * FROM {raw}")
        q[f"clean_{label}"] = _sql(f"SELECT * FROM {curated}")
        q[f"reject_summary_{label}"] = _sql(_rejects(topic, raw, valid))
        q[f"reject_reasons_{label}"] = _sql(_reasons(raw, rules))
        q[f"stream_raw_{label}"] = q[f"parse_{label}"]
        q[f"stream_curated_{label}"] = q[f"clean_{label}"]
    for label in ("orders", "payments", "events"):
        q[f"stream_compacted_{label}"] = q[f"clean_{label}"]
    q["stream_all_topics"] = _sql(
        " UNION ALL ".join(
            (
                _rejects("orders", "raw_orders", _ORDERS_VALID),
                _rejects("payments", "raw_payments", _PAYMENTS_VALID),
                _rejects("user_events", "raw_user_events", _EVENTS_VALID),
            )
        )
    )
    q["stream_topic_counts"] = (
        "SELECT 'orders' AS topic, COUNT(*) AS messages FROM orders UNION ALL "
        "SELECT 'payments', COUNT(*) FROM orders UNION ALL SELECT 'user_events', COUNT(*) FROM events"
    )

    # nightly summaries
    q["daily_sales"] = _sql(_daily_sales("upper(trim(device))"))
    q["daily_sales_compat"] = _sql(_daily_sales("device"))
    q["nightly_snapshot"] = q["daily_sales"]
    q["customer_metrics"] = _sql("SELECT * FROM metrics")
    q["rfm_scores"] = _sql("SELECT * FROM rfm")
    q["rfm_scores_compat"] = _sql("SELECT * FROM rfm_compat")
    q["rfm_segment_counts"] = _sql(
        "SELECT rfm_segment, COUNT(*) AS customers FROM rfm GROUP BY rfm_segment ORDER BY customers DESC"
    )
    q["churn_candidates"] = q["churn_candidates_compat"] = _sql("SELECT * FROM churn")
    q["churn_risk_counts"] = _sql(
        "SELECT churn_risk, COUNT(*) AS customers FROM churn GROUP BY churn_risk ORDER BY customers DESC"
    )
    per_method = (
        f"""SELECT "date", payment_method, COUNT(payment_id) AS total_transactions,
          {_if('is_successful')} AS successful, {_if('NOT is_successful')} AS failed,
          {_sum('amount')} AS total_amount,
          {_percent(_if('is_successful'), 'COUNT(payment_id)')} AS success_rate,
          '{AS_OF}' AS computed_date FROM c_payments GROUP BY "date", payment_method"""
    )
    q["payment_analysis"] = _sql(per_method)
    q["customer_metrics_folded"], q["rfm_scores_folded"] = q["customer_metrics"], q["rfm_scores"]
    q["churn_candidates_folded"] = q["churn_candidates"]
    for name, table, stamp, body in (
        ("daily_sales", "c_orders", "computed_at", _daily_sales("upper(trim(device))")),
        ("payment_analysis", "c_payments", "computed_date", per_method),
    ):  # stamped by the last run that had rows of the day
        q[f"{name}_refreshed"] = _sql(
            f"""SELECT b.* REPLACE (t.as_of AS {stamp}) FROM ({body}) b
              JOIN last_touched t ON b."date" IS NOT DISTINCT FROM t."date" """,
            _last_touched(table),
        )
    q["nightly_manifest"] = _sql(
        f"""SELECT 'daily_sales' AS summary, 'written' AS status,
            (SELECT COUNT(*) FROM (SELECT DISTINCT "date", region FROM c_orders)) AS "rows", '{AS_OF}' AS as_of
          UNION ALL SELECT 'customer_rfm', 'written', (SELECT COUNT(*) FROM rfm), '{AS_OF}'
          UNION ALL SELECT 'churn_candidates', 'written', (SELECT COUNT(*) FROM churn), '{AS_OF}'
          UNION ALL SELECT 'payment_analysis', 'written',
            (SELECT COUNT(*) FROM (SELECT DISTINCT "date", payment_method FROM c_payments)), '{AS_OF}'"""
    )

    # analyses
    by_revenue = "ORDER BY total_revenue DESC, region"
    q["revenue_by_region"] = _sql(
        _orders_by(["region"], "total_orders", "total_revenue", "avg_order_value",
                   "high_value_orders", "total_discount", tail=by_revenue)
    )
    q["region_chart"] = _sql(
        f"""SELECT region, total_revenue, {_lakh('total_revenue')} AS revenue_label
          FROM ({_orders_by(['region'], 'total_revenue')})"""
    )
    trend = _orders_by(['"date"'], "total_orders", "daily_revenue", "avg_order_value",
                       "discounted_orders", tail='ORDER BY "date"')
    q["sales_trend"] = q["warehouse_daily_revenue"] = _sql(trend)
    q["sales_trend_axis"] = _sql(
        f"""SELECT CAST("date" AS DATE) AS "day", daily_revenue, {_lakh('daily_revenue')} AS revenue_label
          FROM ({trend})"""
    )
    q["peak_hours"] = _sql(
        _orders_by(["order_hour", "order_day_of_week"], "total_orders", "total_revenue",
                   tail="ORDER BY order_day_of_week, order_hour")
    )
    days = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
    counted = ", ".join(f'{_if(f"order_day_of_week = {i}")} AS "{d}"' for i, d in enumerate(days, 1))
    q["peak_hours_heatmap"] = _sql(
        f"SELECT order_hour, {counted} FROM c_orders WHERE order_hour IS NOT NULL GROUP BY order_hour"
    )
    q["peak_days"] = _sql(
        f"""SELECT {_pick('order_day_of_week - 1', days)} AS day_name, order_day_of_week,
          COUNT(order_id) AS total_orders FROM c_orders GROUP BY order_day_of_week"""
    )
    q["hourly_orders"] = _sql(
        _orders_by(["order_hour"], "total_orders", more=", order_hour IN (19, 20, 21, 22) AS is_evening")
    )
    q["value_segments"] = _sql(
        _orders_by(["value_segment"], "total_orders", "total_revenue", "avg_order_value", "avg_items",
                   tail=f"ORDER BY {_rank('value_segment', _BANDS)}")
    )
    methods = "payment_method, total_transactions, successful, failed"
    q["payment_methods"] = _sql(
        f"SELECT {methods}, success_rate, avg_transaction FROM by_method", _BY_METHOD
    )
    q["payment_success_band"] = _sql(
        f"""SELECT payment_method, success_rate, CASE WHEN success_rate >= 90 THEN 'green'
            WHEN success_rate >= 80 THEN 'amber' ELSE 'red' END AS band,
          {_rupees('avg_transaction')} AS avg_label FROM by_method""",
        _BY_METHOD,
    )
    q["rfm_distribution"] = _sql(
        f"SELECT * FROM by_segment ORDER BY {_rank('rfm_segment', _SEGMENTS)}", _BY_SEGMENT
    )
    q["rfm_chart"] = _sql(
        f"""SELECT replace(rfm_segment, '_', chr(10)) AS segment_label, avg_lifetime_value,
          {_rupees('avg_lifetime_value')} AS value_label FROM by_segment""",
        _BY_SEGMENT,
    )
    q["device_breakdown"] = _sql(
        _orders_by(["device"], "total_orders", "total_revenue", "avg_order_value",
                   tail="ORDER BY total_orders DESC, device")
    )
    q["top_cities"] = _sql(
        _orders_by(["city", "region"], "total_orders", "total_revenue", "avg_order_value",
                   tail=_TOP_CITIES + "10")
    )
    q["top_cities_bubbles"] = _sql(
        f"""SELECT city || ' (' || region || ')' AS place, total_orders, avg_order_value,
          total_revenue / 5000 AS bubble_size, {_lakh('total_revenue')} AS revenue_label
          FROM ({_orders_by(['city', 'region'], 'total_orders', 'total_revenue', 'avg_order_value',
                            tail=_TOP_CITIES + '10')})"""
    )
    for name, column, source, count in (
        ("segment_share", "value_segment", "c_orders", "total_orders"),
        ("device_share", "device", "c_orders", "total_orders"),
        ("rfm_share", "rfm_segment", "rfm", "customer_count"),
    ):
        q[name] = _sql(
            f"""SELECT {column}, {count}, {_share(count, 1)} AS share_pct
              FROM (SELECT {column}, COUNT(*) AS {count} FROM {source} GROUP BY {column})"""
        )

    # report sheets
    q["sheet_orders_sample"] = _sql(
        """SELECT order_id, customer_name, customer_email, city, region, final_amount, num_items,
          device, value_segment, is_high_value, is_discounted, discount, order_hour, "date"
          FROM c_orders ORDER BY "date" DESC, final_amount DESC, order_id LIMIT 1000"""
    )
    q["sheet_revenue_by_region"] = _sql(
        _orders_by(["region"], "total_orders", "total_revenue", "avg_order_value",
                   "total_discount", "high_value_orders", tail=by_revenue)
    )
    q["sheet_daily_sales"] = _sql(
        _orders_by(['"date"'], "total_orders", "daily_revenue", "avg_order_value",
                   "discounted_orders", "high_value_orders", tail='ORDER BY "date"')
    )
    q["sheet_payment_analysis"] = _sql(
        f"SELECT {methods}, success_rate AS success_rate_pct, avg_transaction FROM by_method", _BY_METHOD
    )
    q["sheet_value_segments"] = _sql(
        _orders_by(["value_segment"], "total_orders", "total_revenue", "avg_order_value",
                   "avg_items_per_order", "total_discount")
    )
    q["sheet_peak_hours"] = _sql(
        _orders_by(["order_hour AS hour_of_day"], "total_orders", "total_revenue", "avg_order_value",
                   "weekend_orders", "weekday_orders")
    )
    q["sheet_top_cities"] = _sql(
        _orders_by(["city", "region"], "total_orders", "total_revenue", "avg_order_value",
                   "high_value_orders", tail=_TOP_CITIES + "20")
    )
    funnel = "event_type, COUNT(event_id) AS total_events, COUNT(DISTINCT customer_id) AS unique_customers"
    per_device = ", ".join(
        _if(f"device = '{d.upper()}'") + f" AS {d.lower()}_events" for d in _DEVICES
    )
    q["sheet_event_funnel"] = _sql(f"SELECT {funnel}, {per_device} FROM c_user_events GROUP BY event_type")
    q["event_funnel_all_days"] = _sql(f"SELECT {funnel}, {per_device} FROM c_user_events GROUP BY event_type ")
    q["event_funnel_range"] = _sql(
        f"""SELECT {funnel}, {per_device} FROM c_user_events WHERE "date" BETWEEN '2024-01-05' AND '2024-01-20' GROUP BY event_type"""
    )
    q["sheet_customer_rfm"] = _sql("SELECT * FROM rfm ORDER BY total_revenue DESC, customer_id")
    q["sheet_payments_sample"] = _sql(
        """SELECT payment_id, order_id, customer_id, amount, payment_method, status, gateway,
          is_successful, payment_hour, "date" FROM c_payments ORDER BY "date" DESC, payment_id LIMIT 1000"""
    )

    # warehouse queries
    q["warehouse_region_revenue"] = _sql(
        _orders_by(["region"], "total_orders", "total_revenue", "avg_order_value", "high_value_orders")
    )
    q["warehouse_orders_by_hour"] = _sql(
        _orders_by(["order_hour"], "total_orders", "total_revenue", "avg_order_value")
    )
    q["warehouse_device_share"] = _sql(
        f"""SELECT *, {_share('total_orders')} AS percentage
          FROM ({_orders_by(['device'], 'total_orders', 'total_revenue')})"""
    )
    q["warehouse_value_segments"] = _sql(
        _orders_by(["value_segment"], "total_orders", "total_revenue", "avg_order_value")
    )
    q["warehouse_payment_success"] = _sql(
        f"SELECT {methods}, success_rate AS success_rate_pct, total_amount FROM by_method", _BY_METHOD
    )
    q["warehouse_event_funnel"] = _sql(
        f"""SELECT *, {_share('total_events')} AS event_share_pct
          FROM (SELECT {funnel} FROM c_user_events GROUP BY event_type)"""
    )
    q["warehouse_top_cities"] = _sql(
        _orders_by(["city", "region"], "total_orders", "total_revenue", tail=_TOP_CITIES + "10")
    )
    day_type = "CASE WHEN order_day_of_week IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END"
    q["warehouse_weekend_split"] = _sql(
        _orders_by([f"{day_type} AS day_type"], "total_orders", "total_revenue", "avg_order_value")
    )
    q["warehouse_rfm_segments"] = _sql(
        """SELECT rfm_segment, customer_count, avg_lifetime_value,
          avg_orders AS avg_orders_per_customer FROM by_segment""",
        _BY_SEGMENT,
    )
    q["warehouse_region_orders"] = _sql(_orders_by(["region"], "orders", "revenue"))

    # checks and findings
    for name, column, source in (
        ("check_value_segments", "value_segment", "c_orders"),
        ("check_payment_methods", "payment_method", "c_payments"),
        ("check_event_types", "event_type", "c_user_events"),
    ):
        q[name] = _sql(
            f"""SELECT {column}, COUNT(*) AS "count" FROM {source} GROUP BY {column}
              ORDER BY "count" DESC, {column} LIMIT 10"""
        )
    for name, columns, source, key in (
        ("check_orders_sample", "order_id, customer_name, city, region, final_amount, value_segment, "
         "is_high_value, order_hour", "c_orders", "order_id"),
        ("check_payments_sample", "payment_id, order_id, amount, payment_method, status, is_successful",
         "c_payments", "payment_id"),
        ("check_events_sample", "event_id, customer_id, event_type, device, is_search_event",
         "c_user_events", "event_id"),
    ):
        q[name] = _sql(f"SELECT {columns} FROM {source} ORDER BY {key} LIMIT 5")
    q["finding_top_region"] = _sql(_orders_by(["region"], "total_revenue", tail=by_revenue + " LIMIT 1"))
    q["finding_biggest_segment"] = _sql(
        f"""SELECT *, {_share('total_orders')} AS share_pct
          FROM ({_orders_by(['value_segment'], 'total_orders', 'avg_order_value')})
          ORDER BY total_orders DESC, value_segment LIMIT 1"""
    )
    q["finding_best_payment_method"] = _sql(
        """SELECT payment_method, success_rate FROM by_method
          ORDER BY success_rate DESC, payment_method LIMIT 1""",
        _BY_METHOD,
    )
    q["finding_top_city"] = _sql(
        _orders_by(["city"], "total_revenue", tail="ORDER BY total_revenue DESC, city LIMIT 1")
    )
    q["finding_device_split"] = _sql(
        f"""SELECT device, {_share('total_orders')} AS share_pct
          FROM ({_orders_by(['device'], 'total_orders')})"""
    )
    q["finding_peak_hour"] = _sql(
        _orders_by(["order_hour"], "total_orders", tail="ORDER BY total_orders DESC, order_hour LIMIT 1")
    )
    volumes = [
        f"SELECT '{view}' AS table_name, COUNT(*) AS \"rows\" FROM {cte}"
        for view, layer, _, cte, _ in _TABLE_ROWS
        if layer == "curated"
    ]
    q["finding_data_volume"] = _sql(" UNION ALL ".join(volumes))

    # loading and exporting
    q["table_counts"] = _sql(
        " UNION ALL ".join(
            f"""SELECT '{view}' AS table_name, '{layer}' AS layer, TRUE AS available,
              COUNT(*) AS row_count FROM {cte}"""
            for view, layer, _, cte, _ in _TABLE_ROWS
        )
    )
    q["table_index"] = _sql(
        " UNION ALL ".join(
            f"""SELECT '{sheet}' AS sheet, '{layer}' AS layer, '{view}' AS table_name, TRUE AS available,
              COUNT(*) AS row_count, CAST({columns} AS INTEGER) AS column_count FROM {cte}"""
            for view, layer, sheet, cte, columns in _TABLE_ROWS
        )
    )
    total = " + ".join(f"(SELECT COUNT(*) FROM {cte})" for *_, cte, _ in _TABLE_ROWS)
    q["exported_rows"] = _sql(f"SELECT CAST(5 AS BIGINT) AS tables, {total} AS total_rows")
    q["report_manifest"] = _sql(
        " UNION ALL ".join(
            f"SELECT '{sheet}' AS sheet, ({rows}) AS \"rows\", 'written' AS status"
            for sheet, rows in _SHEET_ROWS.items()
        )
    )
    times = ["kafka_timestamp", "event_timestamp"]
    q["export_orders"] = _sql(_as_text("c_orders", times))
    q["export_payments"] = _sql(_as_text("c_payments", times))
    q["export_events"] = _sql(_as_text("c_user_events", times))
    q["export_lines_json"] = _sql(
        """SELECT order_id, '[{"product_id":"' || product_id || '","quantity":' || quantity || '}]' AS items
          FROM order_lines"""
    )

    # quality
    q["quality_line_checks"] = _sql("SELECT * FROM line_checks", _LINE_CHECKS)
    q["quality_line_totals"] = _sql(
        "SELECT status, COUNT(*) AS orders FROM line_checks GROUP BY status", _LINE_CHECKS
    )
    q["quality_amounts"] = _sql(
        f"SELECT {_AMOUNT_STATUS} AS status, COUNT(*) AS orders FROM c_orders GROUP BY 1"
    )
    q["quality_payment_reconciliation"] = _sql("SELECT * FROM reconciled", _RECONCILED)
    q["quality_payment_reconciliation_counts"] = _sql(
        "SELECT status, COUNT(*) AS order_ids FROM reconciled GROUP BY status", _RECONCILED
    )
    q["quality_payment_reconciliation_stored"] = q["quality_payment_reconciliation"]
    q["quality_line_checks_stored"] = q["quality_line_checks"]
    q["quality_search_events"] = _sql(
        f"SELECT {_SEARCH_STATUS} AS status, COUNT(*) AS events FROM c_user_events GROUP BY 1"
    )
    q["quality_unknown_places"] = _sql(
        f"""SELECT region, city, COUNT(*) AS orders FROM c_orders
          WHERE NOT EXISTS (SELECT 1 FROM {_SHOP_CITIES} AS s(r, c) WHERE s.r = region AND s.c = city)
          GROUP BY region, city"""
    )
    q["quality_unlisted_places"] = _sql(
        """SELECT region, city, COUNT(*) AS orders FROM c_orders
          WHERE NOT EXISTS (SELECT 1 FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
            WHERE r.r_name = 'ASIA' AND upper(trim(r.r_name)) = c_orders.region
              AND trim(n.n_name) = c_orders.city)
          GROUP BY region, city"""
    )
    q["quality_domains_orders"] = _sql(
        _domains("c_orders", "orders", {
            "status": ["PLACED", "CONFIRMED", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED"],
            "device": _DEVICES,
        })
    )
    q["quality_domains_payments"] = _sql(
        _domains("c_payments", "payments", {
            "status": ["SUCCESS", "FAILED"], "payment_method": _METHODS, "gateway": _GATEWAYS,
        })
    )
    q["quality_domains_events"] = _sql(
        _domains("c_user_events", "user_events", {
            "event_type": ["PAGE_VIEW", "PRODUCT_CLICK", "ADD_TO_CART", "REMOVE_FROM_CART",
                           "WISHLIST_ADD", "SEARCH", "CHECKOUT_START", "COUPON_APPLIED"],
            "device": _DEVICES,
        })
    )
    q["quality_duplicate_ids"] = _sql(
        "SELECT payment_id, COUNT(*) AS copies FROM delivered GROUP BY payment_id HAVING COUNT(*) > 1",
        _DELIVERED_TWICE,
    )
    columns = (
        "kafka_timestamp, order_id, customer_id, amount, payment_method, status, gateway, "
        'transaction_id, "timestamp", "date", kafka_topic, kafka_partition, kafka_offset'
    )
    q["quality_deduplicated"] = _sql(
        f"""SELECT * FROM delivered QUALIFY ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY
          {columns.replace(',', ' NULLS FIRST,')} NULLS FIRST) = 1""",
        _DELIVERED_TWICE,
    )
    q["stream_deduplicated_payments"] = _sql(
        f"""SELECT * EXCLUDE (kafka_topic, kafka_partition, kafka_offset, kafka_timestamp) FROM c_payments
          QUALIFY ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY {columns.replace(',', ' NULLS FIRST,')} NULLS FIRST) = 1"""
    )
    q["stream_reconciled_payments"] = _sql(
        """SELECT order_id, payment_id, customer_id, o_at AS ordered_at, p_at AS paid_at,
          o_cents / 100 AS order_amount, p_cents / 100 AS paid_amount, status FROM all_met""",
        _MET,
    )
    q["drift_orders"] = _sql("SELECT * EXCLUDE (landing) FROM drifting", _DRIFTING)
    q["drift_report_orders"] = _sql(
        " UNION ALL ".join(
            f"""SELECT '{field}' AS field, {declared} AS declared, '{found}' AS found, CAST(MIN(landing) AS BIGINT) AS first_batch
              FROM drifting WHERE {having} HAVING COUNT(*) > 0"""
            for field, declared, found, having in (
                ("coupon", "CAST(NULL AS VARCHAR)", "string", "coupon IS NOT NULL"),
                ("gift.note", "NULL", "string", "gift_note IS NOT NULL"),
                ("gift.wrap", "NULL", "boolean", "gift_note IS NOT NULL"),
                ("num_items", "'int'", "bigint", "num_items > 2147483647"),
            )
        ),
        _DRIFTING,
    )
    q["quality_catalogue"] = _sql(
        f"""SELECT {_CATALOGUE_STATUS} AS status, COUNT(*) AS lines
          FROM order_lines LEFT JOIN part p ON product_id = 'P' || p.p_partkey GROUP BY 1"""
    )
    q["quality_shop_catalogue"] = _sql(
        """SELECT 'UNKNOWN_PRODUCT' AS status, COUNT(*) AS lines FROM order_lines
          WHERE product_id NOT IN ('P001','P002','P003','P004','P005','P006','P007','P008','P009',
            'P010','P011','P012','P013','P014','P015') HAVING COUNT(*) > 0"""
    )

    # live views
    where = "kafka_partition, kafka_offset"
    q["watch_orders"] = _sql(
        f"""SELECT {where}, order_id, customer_name || ' (' || customer_email || ')' AS customer,
          city || ' (' || region || ')' AS place, {_rupees_cents('final_amount')} AS amount,
          {_rupees_cents('COALESCE(discount, 0.0)')} AS discount, num_items, device, '' AS products,
          'ORDER | ' || order_id || ' | ' || {_pad('rpad', 'customer_name', 20)} || ' | ' ||
          {_pad('lpad', f"({_rupees_cents('final_amount')})", 11)} || ' | ' || city AS line
          FROM raw_orders"""
    )
    q["watch_payments"] = _sql(
        f"""SELECT {where}, payment_id, order_id, {_rupees_cents('amount')} AS amount,
          payment_method || ' via ' || gateway AS method, status,
          'PAYMENT | ' || payment_id || ' | ' || {_pad('rpad', 'payment_method', 15)} || ' | ' ||
          {_pad('lpad', f"({_rupees_cents('amount')})", 11)} || ' | ' || status AS line
          FROM raw_payments"""
    )
    q["watch_events"] = _sql(
        f"""SELECT {where}, event_id, event_type, customer_id, COALESCE(product_name, 'N/A') AS product,
          device, 'USER EVENT | ' || event_id || ' | ' || {_pad('rpad', 'event_type', 20)} || ' | ' ||
          customer_id || ' | ' || device AS line FROM raw_user_events"""
    )
    q["watch_order_lines"] = _sql(
        "SELECT order_id, COALESCE(product_name, 'N/A') || ' x' || quantity AS products FROM order_lines"
    )

    # few rows
    shown = 'customer_id, order_id, "date", "timestamp", region, city, final_amount, status'
    q["customer_history"] = _sql(
        f"""SELECT {shown} FROM c_orders WHERE customer_id IN (
          SELECT customer_id FROM c_orders WHERE customer_id IS NOT NULL GROUP BY customer_id
          ORDER BY {_sum('final_amount')} DESC NULLS LAST, customer_id LIMIT 10)
          ORDER BY customer_id, "date" DESC NULLS LAST, "timestamp" DESC NULLS LAST, order_id"""
    )
    q["region_premium_orders"] = _sql(
        f"""SELECT {shown} FROM c_orders WHERE final_amount >= 100000 AND region = (
          SELECT region FROM c_orders WHERE region IS NOT NULL GROUP BY region
          ORDER BY {_sum('final_amount')} DESC NULLS LAST, region LIMIT 1)"""
    )

    # warehouse
    q["catalog_event_partitions"] = _sql('SELECT DISTINCT "date" AS dt FROM c_user_events')
    described = [(c, "string") for c in (
        "event_id", "customer_id", "event_type", "product_id", "product_name", "category",
        "search_query", "device", "session_id", "page_url", "event_time", "kafka_topic",
        "pipeline_version", "dt",
    )] + [("kafka_partition", "int"), ("kafka_offset", "bigint"), ("kafka_timestamp", "timestamp"),
          ("is_product_event", "boolean"), ("is_search_event", "boolean"),
          ("event_timestamp", "timestamp"), ("event_hour", "int"), ("processed_at", "timestamp")]
    q["catalog_event_columns"] = "SELECT col_name, data_type FROM (VALUES {}) AS c(col_name, data_type)".format(
        ", ".join(f"('{c}', '{t}')" for c, t in described)
    )
    q["catalog_event_funnel"] = _sql(
        """SELECT "date" AS dt, event_type, COUNT(*) AS total_events, MIN("timestamp") AS first_event
          FROM c_user_events GROUP BY "date", event_type"""
    )
    q["catalog_daily_sales"] = _sql(
        f"""SELECT "date" AS sale_date, * EXCLUDE ("date", computed_at), computed_at AS computed_date
          FROM ({_daily_sales('upper(trim(device))')})"""
    )
    q["catalog_daily_orders"] = _sql(
        """SELECT "date" AS dt, COUNT(*) AS orders, MAX(final_amount) AS largest, MIN("timestamp") AS first_order
          FROM c_orders GROUP BY "date\""""
    )
    q["catalog_daily_payments"] = _sql(
        """SELECT "date" AS dt, payment_method, COUNT(*) AS payments, MAX("timestamp") AS last_payment
          FROM c_payments GROUP BY "date", payment_method"""
    )
    q["catalog_customer_rfm"] = q["rfm_scores"]
    q["catalog_churn_candidates"] = q["churn_candidates"]
    q["catalog_payment_analysis"] = q["payment_analysis"].replace('SELECT "date"', 'SELECT "date" AS analysis_date', 1)
    q["layer_inventory"] = _sql(
        " UNION ALL ".join(
            f"""SELECT DISTINCT '{topic}' AS topic, "date", TRUE AS holds_files FROM c_{topic} WHERE "date" IS NOT NULL"""
            for topic in ("orders", "payments", "user_events")
        )
    )
    q["parse_order_items"] = _sql("SELECT * FROM order_lines")
    q["export_order_items"] = q["export_lines_json"]
    q["quality_item_lines"] = q["quality_line_totals"]
    q["quality_item_catalogue"] = q["quality_catalogue"]
    for name, table in (("revenue_by_region", "c_orders"), ("payment_methods", "c_payments")):
        q[f"{name}_range"] = q[name].replace(
            f"FROM {table}", f"""FROM (SELECT * FROM {table} WHERE "date" BETWEEN '1997-01-01' AND '1997-12-31')"""
        )
    return q
