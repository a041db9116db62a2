"""Equal-sized tiles over a whole table, without moving the table to one task.

``ntile(k) over (order by …)`` without a partition clause sorts every row in a single
task, once per ordering. Only the k-1 rows where a new tile starts matter, so:

1. range-partition the narrow (ranking, value, tie) rows of all rankings together; the tie
   column is part of the range, so a value shared by a third of the rows still spreads
   over many tasks;
2. number the rows inside each sorted partition and add the partition sizes up;
3. read the k-1 boundary rows of each ranking and turn them into literals.

Tiles then are a row-wise comparison, and all rankings cost one pass over the table.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.session import staged

Starts = list[tuple[float, str]]


def tile_starts(df: DataFrame, rankings: dict[str, Column], tie: str, k: int) -> dict[str, Starts]:
    """Per ranking, (value, tie) of the first row of tiles 2..k; fewer for fewer rows."""
    narrow = F.array(
        *[
            F.struct(
                F.lit(name).alias("ranking"), value.cast("double").alias("value"), F.col(tie).alias("tie")
            )
            for name, value in rankings.items()
        ]
    )
    ordered = (
        df.select(F.inline(narrow))
        .repartitionByRange("ranking", "value", "tie")
        .sortWithinPartitions("ranking", "value", "tie")
        .withColumn("place", F.monotonically_increasing_id())
    )
    # Range bounds are sampled anew in every run, so the numbering is stored once.
    with staged(ordered, "tiles") as placed:
        runs = (  # a ranking's rows in a partition have consecutive places
            placed.groupBy("ranking", F.shiftright("place", 33).alias("part"))
            .agg(F.min("place").alias("first"), F.count("*").alias("rows"))
            .orderBy("ranking", "part")
            .collect()  # one row per shuffle partition, and one more per ranking at most
        )
        places = [
            place
            for name in rankings
            for place in boundary_places([(r["first"], r["rows"]) for r in runs if r["ranking"] == name], k)
        ]
        rows = placed.filter(F.col("place").isin(places)).orderBy("place").collect() if places else []
    return {name: [(r["value"], r["tie"]) for r in rows if r["ranking"] == name] for name in rankings}


def boundary_places(runs: list[tuple[int, int]], k: int) -> list[int]:
    """Places where tiles 2..k start, given each partition's (first place, rows) in order."""
    ends = list(accumulate(rows for _, rows in runs))
    total = ends[-1] if ends else 0
    small, larger = divmod(total, k)  # the first ``larger`` tiles hold one row more
    places = []
    for tile in range(1, k):
        rank = tile * small + min(tile, larger)
        if rank < total:
            i = next(i for i, end in enumerate(ends) if rank < end)
            first, rows = runs[i]
            places.append(first + rank - (ends[i] - rows))
    return places


def tile_of(value: Column, tie: str, starts: Starts) -> Column:
    """1-based tile of a row, given the boundary rows of its ranking."""
    value, tile = value.cast("double"), F.lit(1)
    for start_value, start_tie in starts:
        reached = (value > start_value) | ((value == start_value) & (F.col(tie) >= start_tie))
        tile = tile + F.when(reached, 1).otherwise(0)
    return tile


def global_ntile(df: DataFrame, rankings: dict[str, Column], tie: str, k: int) -> dict[str, Column]:
    """Columns equal to ``ntile(k) over (order by value, tie)`` for each ranking.

    Values are numbers a double holds exactly; values and tie are non-null, and the tie is
    unique. ``df`` is read twice, so it should be a stored table.
    """
    starts = tile_starts(df, rankings, tie, k)
    return {name: tile_of(value, tie, starts[name]) for name, value in rankings.items()}
