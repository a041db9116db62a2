from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.functions import money, text

amounts = st.lists(st.integers(1, 10**9), min_size=1, max_size=20)


@settings(max_examples=15, deadline=None)
@given(amounts)
def test_money_is_exact_and_rounds_half_up(spark, values):
    df = spark.createDataFrame([(v / 100,) for v in values], "x double")
    row = df.agg(money.money_sum("x").alias("s"), money.money_avg("x").alias("a")).first()
    assert row["s"] == sum(values) / 100
    mean = (Decimal(sum(values)) / 100 / len(values)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert Decimal(str(row["a"])) == mean


def test_money_of_nothing_is_null(spark):
    row = spark.createDataFrame([(None,)], "x double").agg(
        money.money_sum("x").alias("s"), money.money_avg("x").alias("a")
    ).first()
    assert (row["s"], row["a"]) == (None, None)


def test_money_sum_passes_the_bigint_range(spark):
    huge = spark.range(200).select(F.lit(9.0e14).alias("x"))  # 200 * 9e16 cents > 2^63
    assert huge.agg(money.money_sum("x").alias("s")).first()["s"] == 200 * 9.0e14


def test_percent_and_share(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n bigint")
    shares = df.select("k", money.share_of_total("n").alias("p"), money.share_of_total("n", 1).alias("q"))
    assert [tuple(r) for r in shares.orderBy("k").collect()] == [("a", 33.33, 33.3), ("b", 66.67, 66.7)]


def test_labels(spark):
    df = spark.createDataFrame(
        [(1234567.0, "AT_RISK", "Kochi", "SOUTH", [("Mat", 2), ("Book", 1)])],
        "x double, s string, city string, region string, items array<struct<product_name:string,quantity:int>>",
    )
    row = df.select(
        text.lakh_label("x"), text.rupee_label("x"), text.rupee_cents_label("x"),
        text.stacked_label("s"), text.place_label("city", "region"), text.items_label("items"),
        text.pad_right(F.col("city"), 8), text.pad_left(F.col("city"), 3), text.day_name(F.lit(7)),
    ).first()
    assert list(row) == [
        "₹12.3L", "₹1,234,567", "₹1,234,567.00", "AT\nRISK", "Kochi (SOUTH)", "Mat x2, Book x1",
        "Kochi   ", "Kochi", "Sat",
    ]


def test_missing_text(spark):
    df = spark.createDataFrame([(None,), ("x",)], "p string")
    assert [r[0] for r in df.select(text.or_missing("p")).collect()] == ["N/A", "x"]


def test_day_names(spark):
    df = spark.createDataFrame([(None,), (1,), (7,), (8,)], "d int")
    assert [r[0] for r in df.select(text.day_name(F.col("d"))).collect()] == [None, "Sun", "Sat", None]


def test_negative_amounts_keep_their_sign(spark):
    df = spark.createDataFrame([(-5.0,), (-1234.56,), (0.05,)], "x double")
    labels = [r[0] for r in df.select(text.rupee_cents_label("x")).collect()]
    assert labels == ["₹-5.00", "₹-1,234.56", "₹0.05"]
