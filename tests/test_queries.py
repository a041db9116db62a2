"""Every registered query against its DuckDB twin, and the plans behind them."""

import datetime
import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as spark_entry
from mercato.oracle import build_oracle
from mercato.queries import build_queries
from mercato.plans import summaries
from mercato.workspace import AS_OF, Workspace
from tests.odd_tables import write_odd_tables

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module", params=["given", "odd"])
def tables(request, tmp_path_factory):
    """The given test tables, and the same with hot keys, gaps and odd values."""
    if request.param == "given":
        return SF
    return write_odd_tables(SF, str(tmp_path_factory.mktemp("odd")))


@pytest.fixture(scope="module")
def duck(tables):
    con = duckdb.connect()
    for file in glob.glob(f"{tables}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return value


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(build_oracle()))
def test_query_equals_duckdb(spark, duck, tables, name):
    df = build_queries()[name](spark, tables)
    columns = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    got = ordered(rows)
    result = duck.execute(build_oracle()[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert sorted(kinds) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    at = [[d[0] for d in result.description].index(c) for c in columns]
    want = [tuple(r[i] for i in at) for r in result.fetchall()]
    if tables == SF and re.search(r"ORDER BY [^()]*$", build_oracle()[name]):  # the engines place nulls differently
        assert rows == want  # the query sorts, so its order counts, too
    assert got == ordered(want)


@pytest.mark.parametrize("name", sorted(set(build_queries()) - set(build_oracle())))
def test_other_queries_give_rows(spark, name):
    assert build_queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# These do their work when they are called, and return a few rows about it.
EAGER = {"nightly_manifest", "nightly_snapshot", "table_counts", "table_index", "report_manifest", "stream_topic_counts", "exported_rows"}
LAZY = [n for n in build_queries() if n not in EAGER]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join_in_the_plan(spark, name):
    text = plan(build_queries()[name](spark, SF))
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


# Grouped rows meet in one task for a total over them; detail rows never do.
ON_GROUPED_ROWS = {
    "reject_summary_orders", "reject_summary_payments", "reject_summary_events",
    "warehouse_device_share", "warehouse_event_funnel", "finding_biggest_segment",
    "finding_device_split", "finding_data_volume", "device_share", "rfm_share", "segment_share",
}


@pytest.mark.parametrize("name", sorted(set(LAZY) - ON_GROUPED_ROWS))
def test_no_single_task(spark, name):
    assert "SinglePartition" not in plan(build_queries()[name](spark, SF))


@pytest.mark.parametrize("name", sorted(ON_GROUPED_ROWS))
def test_a_total_comes_after_the_aggregate(spark, name):
    text = plan(build_queries()[name](spark, SF))
    below = text.split("Exchange SinglePartition")[1].splitlines()[1:]
    first = next(line for line in below if "- Project" not in line)
    assert "HashAggregate" in first


def test_customer_totals_combine_before_the_shuffle(spark):
    text = plan(build_queries()["customer_metrics"](spark, SF))
    heavy = text.split("hashpartitioning(customer_id")[-1]
    assert "partial_max_by" in heavy and text.count("hashpartitioning(customer_id") == 1


def test_scores_need_no_single_task(spark):
    scored = summaries.rfm_scores(Workspace(spark, SF).tables.orders, AS_OF)
    text = plan(scored)
    assert "SinglePartition" not in text and "Exchange" not in text and "Window" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(build_queries()["warehouse_region_orders"](spark, SF))
    assert "ReadSchema: struct<order_id:string,region:string,final_amount:double>" in text
