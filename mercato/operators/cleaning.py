"""From raw records to curated ones: validity rules, tidy values, derived columns.

Every transform is one projection over one filter: no shuffle, no Python in the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato import schemas
from mercato.functions.text import band, tidy, upper_tidy


# -- validity rules -----------------------------------------------------------
def filled(column: str) -> Column:
    """Not null and not only blanks (ids are trimmed later, so blank would become '')."""
    return F.col(column).isNotNull() & (tidy(column) != "")


def positive(column: str) -> Column:
    """Above zero and an amount whose cents can be summed: no NaN (Spark sorts it above every
    number), no infinity, below ``AMOUNT_BELOW``."""
    value = F.col(column)
    return value.isNotNull() & (value > 0) & (value < schemas.AMOUNT_BELOW)


def usable(amount: str) -> Column:
    """The amount, or null where it is no number that can be summed."""
    return F.when(F.abs(amount) < schemas.AMOUNT_BELOW, F.col(amount))


RULES: dict[str, list[tuple[str, Callable[[str], Column]]]] = {
    "orders": [
        ("order_id", filled), ("customer_id", filled),
        ("final_amount", positive), ("num_items", positive),
    ],
    "payments": [("payment_id", filled), ("order_id", filled), ("amount", positive)],
    "user_events": [("event_id", filled), ("customer_id", filled), ("event_type", filled)],
}


def is_valid(topic: str) -> Column:
    return reduce(Column.__and__, [rule(column) for column, rule in RULES[topic]])


def first_failure(topic: str) -> Column:
    """Name of the first column whose rule fails, NULL for a valid record."""
    return F.coalesce(*[F.when(~rule(column), F.lit(column)) for column, rule in RULES[topic]])


def reject_summary(raw: DataFrame, topic: str) -> DataFrame:
    """One row: records received, kept and dropped."""
    counts = raw.agg(F.count("*").alias("received"), F.count_if(is_valid(topic)).alias("clean"))
    return counts.select(
        F.lit(topic).alias("topic"), "received", "clean",
        (F.col("received") - F.col("clean")).alias("dropped"),
    )


def reject_reasons(raw: DataFrame, topic: str) -> DataFrame:
    """Dropped records per first failed rule."""
    return (
        raw.select(first_failure(topic).alias("failed_rule"))
        .filter("failed_rule is not null")
        .groupBy("failed_rule")
        .agg(F.count("*").alias("dropped"))
    )


# -- shared pieces ------------------------------------------------------------
def _event_time() -> Column:
    """ISO text to timestamp; text that is no time gives NULL and the record stays."""
    return F.col("timestamp").try_cast("timestamp")


def _audit(now: Column | None) -> dict[str, Column]:
    return {
        "processed_at": F.current_timestamp() if now is None else now,
        "pipeline_version": F.lit(schemas.PIPELINE_VERSION),
    }


def _holds(condition: Column) -> Column:
    """True or false, never NULL."""
    return F.coalesce(condition, F.lit(False))


# -- the three transforms -----------------------------------------------------
def clean_orders(raw: DataFrame, now: Column | None = None) -> DataFrame:
    tidied = raw.filter(is_valid("orders")).withColumns(
        {
            "order_id": upper_tidy("order_id"),
            "customer_name": tidy("customer_name"),
            "city": tidy("city"),
            "region": upper_tidy("region"),
            "final_amount": F.round("final_amount", 2),
            "discount": F.round(F.coalesce(usable("discount"), F.lit(0.0)), 2),
            "event_timestamp": _event_time(),
        }
    )
    return tidied.withColumns(
        {
            "is_high_value": _holds(F.col("final_amount") >= schemas.HIGH_VALUE_FROM),
            "is_discounted": _holds(F.col("discount") > 0),
            "order_day_of_week": F.dayofweek("event_timestamp"),
            "order_hour": F.hour("event_timestamp"),
            "value_segment": band(F.col("final_amount"), schemas.VALUE_BANDS, "LOW"),
            **_audit(now),
        }
    ).drop("address", "customer_phone", "json_str")


def clean_payments(raw: DataFrame, now: Column | None = None) -> DataFrame:
    tidied = raw.filter(is_valid("payments")).withColumns(
        {
            **{c: upper_tidy(c) for c in ("payment_id", "order_id", "payment_method", "status")},
            "amount": F.round("amount", 2),
        }
    )
    return (
        tidied.withColumns(
            {"is_successful": _holds(F.col("status") == "SUCCESS"), "event_timestamp": _event_time()}
        )
        .withColumns({"payment_hour": F.hour("event_timestamp"), **_audit(now)})
        .drop("json_str")
    )


def clean_events(raw: DataFrame, now: Column | None = None) -> DataFrame:
    tidied = raw.filter(is_valid("user_events")).withColumns(
        {c: upper_tidy(c) for c in ("event_id", "event_type", "device")}
    )
    return (
        tidied.withColumns(
            {
                "is_product_event": F.col("product_id").isNotNull(),
                "is_search_event": _holds(F.col("event_type") == "SEARCH"),
                "event_timestamp": _event_time(),
            }
        )
        .withColumns({"event_hour": F.hour("event_timestamp"), **_audit(now)})
        .drop("json_str")
    )


CLEAN: dict[str, Callable[..., DataFrame]] = {
    "orders": clean_orders,
    "payments": clean_payments,
    "user_events": clean_events,
}
