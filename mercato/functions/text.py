"""Band lookups, day names and the label texts that reports print."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mercato import schemas
from mercato.functions.money import cents, half_up


def band(value: Column, bands: list[tuple[int, str]], otherwise: str) -> Column:
    """First label whose lower bound the value reaches; bounds come highest first."""
    (bound, label), *rest = bands
    chain = F.when(value >= bound, label)
    return reduce(lambda acc, b: acc.when(value >= b[0], b[1]), rest, chain).otherwise(otherwise)


def listed_rank(column: str, ordered: list[str]) -> Column:
    """1-based place in a fixed list, NULL outside it."""
    arms = " ".join(f"when '{v}' then {i}" for i, v in enumerate(ordered, 1))
    return F.expr(f"case {column} {arms} end")


def day_name(day_of_week: Column) -> Column:
    """Name of day 1 (Sunday) to 7, NULL for anything else."""
    return F.get(F.array(*[F.lit(d) for d in schemas.DAY_NAMES]), day_of_week - 1)


def tidy(column: str) -> Column:
    return F.trim(F.col(column))


def upper_tidy(column: str) -> Column:
    return F.upper(F.trim(F.col(column)))


def lakh_label(amount: Column | str) -> Column:
    """Amount in units of 100,000 with one decimal, e.g. 1234567.0 -> ₹12.3L."""
    tenths = half_up(cents(amount), F.lit(1_000_000))
    return F.concat(
        F.lit("₹"), F.call_function("div", tenths, F.lit(10)).cast("string"),
        F.lit("."), (tenths % 10).cast("string"), F.lit("L"),
    )


def rupee_label(amount: Column | str) -> Column:
    """Whole rupees with thousands separators."""
    return F.concat(F.lit("₹"), F.format_number(half_up(cents(amount), F.lit(100)), 0))


def rupee_cents_label(amount: Column | str) -> Column:
    """Two decimals with thousands separators; also for the negative amounts of raw records."""
    c = cents(amount)
    size = F.abs(c)
    whole = F.format_number(F.call_function("div", size, F.lit(100)), 0)
    return F.concat(
        F.lit("₹"), F.when(c < 0, "-").otherwise(""), whole,
        F.lit("."), F.lpad((size % 100).cast("string"), 2, "0"),
    )


def place_label(city: str, region: str) -> Column:
    return F.concat(F.col(city), F.lit(" ("), F.col(region), F.lit(")"))


def stacked_label(column: str) -> Column:
    return F.replace(F.col(column), F.lit("_"), F.lit("\n"))


def items_label(items: str) -> Column:
    """'name xqty' of every line, joined with ', '."""

    def line(item: Column) -> Column:
        name = F.coalesce(item["product_name"], F.lit("N/A"))
        return F.concat(name, F.lit(" x"), item["quantity"].cast("string"))

    return F.array_join(F.transform(items, line), ", ")


def or_missing(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("N/A"))


def pad_right(value: Column, width: int) -> Column:
    """Fill to a width; longer text stays whole."""
    return F.rpad(value, F.greatest(F.lit(width), F.length(value)), F.lit(" "))


def pad_left(value: Column, width: int) -> Column:
    return F.lpad(value, F.greatest(F.lit(width), F.length(value)), F.lit(" "))
