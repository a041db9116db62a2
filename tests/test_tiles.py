import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators.tiles import boundary_places, global_ntile


def tiles(spark, values, k=5):
    df = spark.createDataFrame(list(enumerate(values)), "n int, v bigint").select(
        F.format_string("id%06d", "n").alias("id"), "v"
    )
    plain = F.ntile(k).over(Window.orderBy("v", "id"))
    down = F.ntile(k).over(Window.orderBy(-F.col("v"), "id"))
    got = global_ntile(df, {"up": F.col("v"), "down": -F.col("v")}, "id", k)
    both = df.select(plain.alias("a"), got["up"].alias("b"), down.alias("c"), got["down"].alias("d"))
    return [pair for r in both.collect() for pair in ((r["a"], r["b"]), (r["c"], r["d"]))]


@pytest.mark.parametrize("n", [1, 2, 4, 5, 6, 7, 9, 11, 101])
def test_equals_ntile(spark, n):
    values = random.Random(n).choices(range(20), k=n)
    assert all(want == got for want, got in tiles(spark, values))


def test_all_ties_are_broken_by_id(spark):
    assert all(want == got for want, got in tiles(spark, [1] * 503))


def test_one_value_with_most_rows(spark):
    values = [1] * 400 + list(range(2, 200))
    assert all(want == got for want, got in tiles(spark, values))


def test_empty_input(spark):
    df = spark.createDataFrame([], "id string, v bigint")
    assert df.withColumn("t", global_ntile(df, {"x": F.col("v")}, "id", 5)["x"]).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=6), st.integers(1, 7))
def test_boundaries_whatever_the_partition_sizes(sizes, k):
    firsts = [1000 * p + 17 for p in range(len(sizes))]
    rows = [first + i for first, size in zip(firsts, sizes) for i in range(size)]
    total = len(rows)
    tile_of_rank = [
        next(t for t in range(k) if rank < (t + 1) * (total // k) + min(t + 1, total % k))
        for rank in range(total)
    ]
    starts = [rows[r] for r in range(1, total) if tile_of_rank[r] != tile_of_rank[r - 1]]
    assert boundary_places(list(zip(firsts, sizes)), k) == starts
