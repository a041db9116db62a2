"""Storage in which few rows are found without reading the others.

Inside a date, rows follow a Z-order curve over a few columns, so a file and a row group hold a small box
of their values, and a filter on any of those columns leaves most row groups out. Ids carry Parquet
bloom filters, which leave out the row groups that do not hold an id.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CURVE = "__curve"
#: Values of one column that are looked for by pushed filters; more are joined.
PUSHED = 400
#: Spark pushes so many values of an IN one by one, and only the range of longer lists.
_IN = 10


@dataclass(frozen=True)
class Layout:
    """Where rows lie inside a date. Nulls share a cell, of numbers the lowest.

    ``hashed`` columns (with bits) are looked for by equality; ``ranged`` ones (with bits) are numbers, cut
    at quantiles of the rows that are written.
    ``tie`` orders rows of one cell, so that a hot one can be cut anywhere. Row groups are of
    ``row_group_bytes``, or Parquet's default size.
    """

    hashed: dict[str, int]
    ranged: dict[str, int]
    ids: list[str]
    tie: str
    row_group_bytes: int | None = None
    accuracy: int = 1000

    def arrange(self, rows: DataFrame, folder: str = "date") -> DataFrame:
        """The rows ranged and sorted by (folder, curve): a folder with most of the rows is cut along the curve.

        Reads the ranged columns once for their quantiles, and the rows once more for the ranges.
        """
        order = [folder, _CURVE, self.tie]
        placed = rows.withColumn(_CURVE, curve(self._cells(rows)))
        return placed.repartitionByRange(*order).sortWithinPartitions(*order).drop(_CURVE)

    def options(self) -> dict[str, str]:
        """Parquet options of the writer."""
        # a filter is as large as the values of its row group need, from 1 MB down to 64 bytes
        options = {"parquet.bloom.filter.adaptive.enabled": "true"}
        for c in self.ids:
            options |= {f"parquet.bloom.filter.enabled#{c}": "true", f"parquet.bloom.filter.candidates.number#{c}": "15"}
        if self.row_group_bytes is not None:
            options["parquet.block.size"] = str(self.row_group_bytes)
        return options

    def _cells(self, rows: DataFrame) -> list[tuple[Column, int]]:
        cells = [(F.pmod(F.xxhash64(c), F.lit(1 << bits)), bits) for c, bits in self.hashed.items()]
        for c, bounds in self._quantiles(rows).items():
            above = [F.coalesce(F.col(c) > b, F.lit(False)).cast("bigint") for b in sorted(set(bounds))]
            cells.append((reduce(lambda a, b: a + b, above, F.lit(0).cast("bigint")), self.ranged[c]))
        return cells

    def _quantiles(self, rows: DataFrame) -> dict[str, list[float]]:
        if not self.ranged:
            return {}
        shares = {c: [i / (1 << bits) for i in range(1, 1 << bits)] for c, bits in self.ranged.items()}
        found = rows.agg(*[F.percentile_approx(c, shares[c], self.accuracy).alias(c) for c in self.ranged]).first()
        return {c: found[c] or [] for c in self.ranged}


def curve(cells: list[tuple[Column, int]]) -> Column:
    """Place on the curve of a row with these cell numbers of so many bits: their bits in turns, highest first."""
    deepest = max(bits for _, bits in cells)
    turns = [
        F.shiftright(cell.cast("bigint"), bits - 1 - depth).bitwiseAND(F.lit(1).cast("bigint"))
        for depth in range(deepest) for cell, bits in cells if depth < bits
    ]
    return reduce(lambda place, bit: F.shiftleft(place, 1).bitwiseOR(bit), turns)


def rows_with(rows: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Rows whose column has one of the values; nulls and repeats among the values do not matter.

    Up to ``PUSHED`` values reach the scan, ten to a filter, as longer lists would go as their range only.
    """
    wanted = sorted({v for v in values if v is not None})
    if len(wanted) > PUSHED:
        listed = rows.sparkSession.createDataFrame([(v,) for v in wanted], f"{column} {rows.schema[column].dataType.simpleString()}")
        return rows.join(listed, column, "left_semi").select(*rows.columns)
    parts = [F.col(column).isin(wanted[i : i + _IN]) for i in range(0, len(wanted), _IN)]
    return rows.where(reduce(lambda a, b: a | b, parts, F.lit(False)))


#: Layouts of the curated layers.
LAYOUTS = {
    "orders": Layout({"customer_id": 10, "region": 3}, {"final_amount": 5}, ["customer_id", "order_id"], "order_id"),
    "payments": Layout(
        {"customer_id": 10, "payment_method": 3}, {"amount": 5}, ["customer_id", "order_id", "payment_id"], "payment_id"
    ),
    "user_events": Layout({"customer_id": 10, "event_type": 3}, {}, ["customer_id", "event_id"], "event_id"),
}
