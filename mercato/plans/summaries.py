"""The nightly summaries, each a pure DataFrame -> DataFrame of an as-of date.

``compat=True`` keeps the historic reading of a rule where the default corrects it:
recency scored the other way round, device names compared without folding their case,
and customers split by every name and e-mail they ever gave.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import schemas
from mercato.functions.money import money_avg, money_sum, percent
from mercato.functions.text import band
from mercato.operators.customers import customer_metrics
from mercato.operators.tiles import global_ntile
from mercato.session import stage

_NEVER = 1_000_000  # days; sorts customers without a known date behind everyone


def daily_sales(
    orders: DataFrame, as_of: str, compat: bool = False, dates: list[str] | None = None
) -> DataFrame:
    """Sales per date and region. ``dates`` limits the work to those date partitions."""
    if dates is not None:
        orders = orders.filter(F.col("date").isin(dates))
    device = F.col("device") if compat else F.upper(F.trim("device"))
    return (
        orders.groupBy("date", "region")
        .agg(
            F.count("order_id").alias("total_orders"),
            money_sum("final_amount").alias("total_revenue"),
            money_avg("final_amount").alias("avg_order_value"),
            money_sum("discount").alias("total_discount"),
            F.count_if("is_high_value").alias("high_value_orders"),
            F.count_if(F.col("status") == "CANCELLED").alias("cancelled_orders"),
            F.count_if(device == "MOBILE").alias("mobile_orders"),
            F.count_if(device == "DESKTOP").alias("desktop_orders"),
        )
        .withColumn("computed_at", F.lit(as_of))
    )


def rfm_scores(orders: DataFrame, as_of: str, compat: bool = False) -> DataFrame:
    """Recency, frequency and monetary scores 1-5 and the segment of their sum.

    The customer metrics are stored in the shared folder first and stay there, because the
    result reads them; :func:`score_customers` takes metrics the caller looks after.
    """
    return score_customers(
        stage(customer_metrics(orders, as_of, by_identity=compat), "customer-metrics"), as_of, compat
    )


def score_customers(metrics: DataFrame, as_of: str, compat: bool = False) -> DataFrame:
    """Scores from customer metrics that are already stored (they are read several times).

    Tiles are over the whole customer base; ties go by customer id.
    """
    # the identity split can repeat an id, so the tie-break then names the whole identity
    tie = "identity" if compat else "customer_id"
    if compat:
        metrics = metrics.withColumn(
            "identity",
            F.concat_ws(
                "\x01", "customer_id", F.coalesce("customer_name", F.lit("")),
                F.coalesce("customer_email", F.lit("")),
            ),
        )
    days = F.col("days_since_order")
    tiles = global_ntile(
        metrics,
        {
            "recency": F.coalesce(-days, F.lit(_NEVER if compat else -_NEVER)),
            "frequency": F.col("total_orders"),
            "monetary": F.coalesce("total_revenue", F.lit(0.0)),
        },
        tie,
        5,
    )
    scored = metrics.withColumns(
        {
            "recency_score": 6 - tiles["recency"] if compat else tiles["recency"],
            "frequency_score": tiles["frequency"],
            "monetary_score": tiles["monetary"],
        }
    )
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return scored.select(
        "customer_id", "customer_name", "customer_email", "last_order_date", "days_since_order",
        "total_orders", "total_revenue", "avg_order_value",
        "recency_score", "frequency_score", "monetary_score",
        band(total, schemas.RFM_BANDS, "LOST_CUSTOMERS").alias("rfm_segment"),
        F.lit(as_of).alias("computed_date"),
    )


def rfm_segment_counts(rfm: DataFrame) -> DataFrame:
    counts = rfm.groupBy("rfm_segment").agg(F.count("*").alias("customers"))
    return counts.orderBy(F.desc("customers"), "rfm_segment")


def churn_candidates(orders: DataFrame, as_of: str, compat: bool = False) -> DataFrame:
    """Customers without an order for 30 days or more, with their risk."""
    return churn_from_metrics(customer_metrics(orders, as_of, by_identity=compat), as_of)


def churn_from_metrics(metrics: DataFrame, as_of: str) -> DataFrame:
    risk = band(F.col("days_since_order"), schemas.CHURN_BANDS, "ACTIVE")
    return metrics.select(
        "customer_id", "customer_name", "customer_email", "last_order_date", "total_orders",
        F.col("total_revenue").alias("total_lifetime_value"),
        "days_since_order",
        risk.alias("churn_risk"),
        F.lit(as_of).alias("computed_date"),
    ).filter(F.col("churn_risk") != "ACTIVE")


def churn_risk_counts(churn: DataFrame) -> DataFrame:
    counts = churn.groupBy("churn_risk").agg(F.count("*").alias("customers"))
    return counts.orderBy(F.desc("customers"), "churn_risk")


def payment_analysis(
    payments: DataFrame, as_of: str, dates: list[str] | None = None
) -> DataFrame:
    """Payment outcomes per date and method."""
    if dates is not None:
        payments = payments.filter(F.col("date").isin(dates))
    per_method = payments.groupBy("date", "payment_method").agg(
        F.count("payment_id").alias("total_transactions"),
        F.count_if("is_successful").alias("successful"),
        F.count_if(~F.col("is_successful")).alias("failed"),
        money_sum("amount").alias("total_amount"),
    )
    return per_method.withColumns(
        {
            "success_rate": percent(F.col("successful"), F.col("total_transactions")),
            "computed_date": F.lit(as_of),
        }
    )
