"""Test tables with hot keys, gaps and odd values, derived from the given ones."""

import os

import duckdb

ODD = {
    # a third of the orders on one customer; unknown customers; bad amounts; no date; repeats
    "orders": """
        SELECT o_orderkey,
          CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 97 = 0 THEN 99999999 ELSE o_custkey END AS o_custkey,
          CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
          CASE o_orderkey % 101 WHEN 0 THEN NULL WHEN 1 THEN 0.0 WHEN 2 THEN -5.0 WHEN 3 THEN 0.001
            WHEN 4 THEN 10000.0 WHEN 5 THEN 9999.99 WHEN 6 THEN 50000.0 ELSE o_totalprice END AS o_totalprice,
          CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate, o_orderpriority
        FROM {src} UNION ALL SELECT * FROM {src} WHERE o_orderkey % 61 = 10""",
    # a third of the lines on one order, a third on one part; unknown parts; no quantity
    "lineitem": """
        SELECT * REPLACE (
          CASE WHEN (l_partkey + l_linenumber) % 3 = 0 THEN 21 ELSE l_orderkey END AS l_orderkey,
          CASE WHEN l_suppkey % 3 = 0 THEN 5 WHEN l_partkey % 37 = 0 THEN 88888888 ELSE l_partkey END AS l_partkey,
          CASE WHEN l_partkey % 41 = 0 THEN 0.0 ELSE l_quantity END AS l_quantity)
        FROM {src}""",
    # a third of the events from one user; unknown kinds, users and properties
    "events": """
        SELECT * REPLACE (
          CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 47 = 0 THEN NULL ELSE user_id END AS user_id,
          CASE WHEN event_id % 59 = 0 THEN 'other' WHEN event_id % 67 = 0 THEN NULL ELSE event_type END AS event_type,
          CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 73 = 0 THEN '{{}}' ELSE props END AS props)
        FROM {src}""",
}


def write_odd_tables(sf_dir: str, out_dir: str) -> str:
    os.makedirs(out_dir, exist_ok=True)
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "part", "orders", "lineitem", "events"):
        src = f"'{sf_dir}/{name}.parquet'"
        body = ODD.get(name, "SELECT * FROM {src}").format(src=src)
        con.execute(f"COPY ({body}) TO '{out_dir}/{name}.parquet' (FORMAT parquet)")
    return out_dir
