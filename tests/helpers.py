"""Hand-made messages for the unit tests."""

import json
import os
from datetime import datetime

import duckdb
from pyspark.sql import functions as F

from mercato import schemas
from mercato.sources.envelope import parse_envelope
from mercato.streaming.layers import TOPICS


def order(i, **changes):
    record = {
        "order_id": f"ORD{i}", "customer_id": f"CUST{i % 3}", "customer_name": "A Name",
        "customer_email": "a@example.com", "customer_phone": "1", "region": "South",
        "city": "Kochi", "address": "x", "num_items": 1, "subtotal": 100.0, "discount": 0,
        "final_amount": 100.0, "device": "Mobile", "status": "PLACED",
        "timestamp": "2026-05-16T10:11:12.123456", "date": "2026-05-16", "hour": 10,
        "items": [{"product_id": "P007", "product_name": "Yoga Mat Premium", "category": "Sports",
                   "unit_price": 1299, "quantity": 2, "item_total": 2598}],
    }
    return {**record, **changes}


def payment(i, **changes):
    record = {
        "payment_id": f"PAY{i}", "order_id": f"ORD{i}", "customer_id": f"CUST{i % 3}",
        "amount": 100.0, "payment_method": "UPI", "status": "SUCCESS", "gateway": "PayU",
        "transaction_id": f"TXN{i}", "timestamp": "2026-05-16T10:11:12", "date": "2026-05-16",
    }
    return {**record, **changes}


def event(i, **changes):
    record = {
        "event_id": f"EVT{i}", "customer_id": f"CUST{i % 3}", "event_type": "PAGE_VIEW",
        "product_id": "P001", "product_name": "iPhone 15 Pro", "category": "Electronics",
        "search_query": None, "device": "Tablet", "session_id": "SES1", "page_url": "/product/p001",
        "timestamp": "2026-05-16T10:11:12", "date": "2026-05-16",
    }
    return {**record, **changes}


def envelope(spark, topic, bodies, first_offset=0):
    """Envelope rows; a body may be a dict, JSON text or None."""
    rows = []
    for i, body in enumerate(bodies):
        text = json.dumps(body) if isinstance(body, dict) else body
        rows.append(
            (None, None if text is None else bytearray(text.encode()), topic, 0, first_offset + i,
             datetime(2026, 5, 16, 10), 0)
        )
    return spark.createDataFrame(rows, schemas.ENVELOPE)


def raw(spark, topic, bodies):
    return parse_envelope(envelope(spark, topic, bodies), TOPICS[topic].record)


def curated(spark, topic, bodies):
    return TOPICS[topic].clean(raw(spark, topic, bodies), now=F.lit(datetime(2026, 5, 17)))


def column(df, name, by):
    return [r[name] for r in df.orderBy(by).collect()]


def shop_tables(folder, orders=600):
    """Star-schema tables of so many orders, dealt out over all landings; every 50th has no date."""
    os.makedirs(folder, exist_ok=True)
    bodies = {
        "region": "SELECT 0 AS r_regionkey, 'ASIA' AS r_name",
        "nation": "SELECT 0 AS n_nationkey, 'INDIA' AS n_name, 0 AS n_regionkey",
        "customer": "SELECT i AS c_custkey, 'Name ' || i AS c_name, 0 AS c_nationkey FROM range(50) t(i)",
        "orders": f"""SELECT i AS o_orderkey, i % 50 AS o_custkey, 'F' AS o_orderstatus, 100.0::DOUBLE + i AS o_totalprice,
            CASE WHEN i % 50 <> 49 THEN TIMESTAMP '1995-01-01' + to_days(CAST(i * 2400 // {orders} AS INTEGER)) END AS o_orderdate
          FROM range({orders}) t(i)""",
        "lineitem": f"SELECT i AS l_orderkey, 100.0::DOUBLE AS l_extendedprice FROM range({orders}) t(i)",
    }
    for name, body in bodies.items():
        duckdb.sql(f"COPY ({body}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)
