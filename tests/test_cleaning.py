import pytest
from pyspark.sql import types as T

from mercato import schemas
from mercato.operators import cleaning
from tests.helpers import column, curated, event, order, payment, raw


def types_of(ddl):
    return [(f.name, f.dataType) for f in T.StructType.fromDDL(ddl).fields]


@pytest.mark.parametrize(
    "topic, body, ddl, width",
    [
        ("orders", order(1), schemas.CURATED_ORDERS, 28),
        ("payments", payment(1), schemas.CURATED_PAYMENTS, 19),
        ("user_events", event(1), schemas.CURATED_EVENTS, 22),
    ],
)
def test_curated_shape_is_the_declared_one(spark, topic, body, ddl, width):
    df = curated(spark, topic, [body])
    assert [(f.name, f.dataType) for f in df.schema.fields] == types_of(ddl)
    assert len(df.columns) == width
    assert df.count() == 1


def test_malformed_and_empty_bodies_stay_raw_and_leave_curated(spark):
    bodies = [order(1), "{not json", None]
    records = raw(spark, "orders", bodies)
    kept = [(r["order_id"], r["json_str"] is None) for r in records.orderBy("kafka_offset").collect()]
    assert kept == [("ORD1", False), (None, False), (None, True)]
    assert curated(spark, "orders", bodies).count() == 1


def test_wrongly_typed_field_is_null_and_the_record_dropped(spark):
    bodies = [order(1, num_items=2.0), order(2, num_items="3"), order(3, num_items=2)]
    assert column(curated(spark, "orders", bodies), "order_id", "order_id") == ["ORD3"]


def test_ids_are_trimmed_and_upper_cased_blank_ones_dropped(spark):
    bodies = [order(1, order_id="  ord9 "), order(2, order_id="   "), order(3, order_id=None),
              order(4, customer_id="  ")]
    assert column(curated(spark, "orders", bodies), "order_id", "order_id") == ["ORD9"]


def test_amount_rules(spark):
    amounts = [0, -1.0, 0.001, 9999.99, 10000, 49999.995, 50000, 99999.99, 100000]
    bodies = [order(i, final_amount=a) for i, a in enumerate(amounts)]
    bodies.append('{"order_id":"ORD99","customer_id":"C","num_items":1,"final_amount":NaN}')
    rows = curated(spark, "orders", bodies).orderBy("order_id").collect()
    assert [(r["final_amount"], r["value_segment"], r["is_high_value"]) for r in rows] == [
        (0.0, "LOW", False), (9999.99, "LOW", False), (10000.0, "MEDIUM", False),
        (50000.0, "HIGH", True), (50000.0, "HIGH", True), (99999.99, "HIGH", True),
        (100000.0, "PREMIUM", True),
    ]


def test_discount_defaults(spark):
    bodies = [order(1, discount=None), order(2, discount=0), order(3, discount=0.01)]
    rows = curated(spark, "orders", bodies).orderBy("order_id").collect()
    assert [(r["discount"], r["is_discounted"]) for r in rows] == [(0.0, False), (0.0, False), (0.01, True)]


def test_bad_timestamp_gives_null_and_keeps_the_row(spark):
    row = curated(spark, "orders", [order(1, timestamp="soon")]).first()
    assert (row["event_timestamp"], row["order_hour"], row["order_day_of_week"]) == (None, None, None)


def test_day_and_hour_come_from_the_event_time(spark):
    row = curated(spark, "orders", [order(1)]).first()
    assert (row["order_day_of_week"], row["order_hour"]) == (7, 10)  # 2026-05-16 is a Saturday


def test_personal_fields_are_gone(spark):
    assert {"address", "customer_phone", "json_str"}.isdisjoint(curated(spark, "orders", [order(1)]).columns)


def test_payment_status_is_folded(spark):
    bodies = [payment(1, status=" success "), payment(2, status="FAILED"), payment(3, status=None)]
    rows = curated(spark, "payments", bodies).orderBy("payment_id").collect()
    assert [(r["status"], r["is_successful"]) for r in rows] == [
        ("SUCCESS", True), ("FAILED", False), (None, False)
    ]


def test_event_flags(spark):
    bodies = [event(1), event(2, event_type="search", product_id=None, search_query="mat"),
              event(3, event_type=" ")]
    rows = curated(spark, "user_events", bodies).orderBy("event_id").collect()
    assert [(r["event_type"], r["is_product_event"], r["is_search_event"], r["device"]) for r in rows] == [
        ("PAGE_VIEW", True, False, "TABLET"), ("SEARCH", False, True, "TABLET")
    ]


def test_reject_accounting(spark):
    bodies = [order(1), order(2, final_amount=0), order(3, order_id=""), order(4, num_items=None), "bad"]
    records = raw(spark, "orders", bodies)
    assert cleaning.reject_summary(records, "orders").first().asDict() == {
        "topic": "orders", "received": 5, "clean": 1, "dropped": 4
    }
    reasons = {r["failed_rule"]: r["dropped"] for r in cleaning.reject_reasons(records, "orders").collect()}
    assert reasons == {"final_amount": 1, "order_id": 2, "num_items": 1}
