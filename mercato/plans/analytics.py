"""The business analyses, report sheets and warehouse queries.

Each is a function of :class:`Tables`. Grouping is by a few business dimensions, so the
map-side partial aggregate sends a handful of rows per task into the only shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato import schemas
from mercato.functions.money import (
    count_avg, money_avg, money_sum, percent, share_of_total,
)
from mercato.functions.text import (
    band, day_name, lakh_label, listed_rank, place_label, rupee_label, stacked_label,
)
from mercato.plans.tables import Tables

# Measures by output column; built on demand because columns need a running session.
ORDER_MEASURES = {
    "total_orders": lambda: F.count("order_id"),
    "orders": lambda: F.count("order_id"),
    "total_revenue": lambda: money_sum("final_amount"),
    "revenue": lambda: money_sum("final_amount"),
    "daily_revenue": lambda: money_sum("final_amount"),
    "avg_order_value": lambda: money_avg("final_amount"),
    "total_discount": lambda: money_sum("discount"),
    "high_value_orders": lambda: F.count_if("is_high_value"),
    "discounted_orders": lambda: F.count_if(F.col("discount") > 0),
    "avg_items": lambda: count_avg("num_items"),
    "avg_items_per_order": lambda: count_avg("num_items"),
    "weekend_orders": lambda: F.count_if(F.col("order_day_of_week").isin(schemas.WEEKEND)),
    "weekday_orders": lambda: F.count_if(~F.col("order_day_of_week").isin(schemas.WEEKEND)),
}


def orders_by(t: Tables, keys: list[str | Column], *measures: str) -> DataFrame:
    return t.orders.groupBy(*keys).agg(*[ORDER_MEASURES[m]().alias(m) for m in measures])


def _payments_by_method(t: Tables) -> DataFrame:
    per_method = t.payments.groupBy("payment_method").agg(
        F.count("payment_id").alias("total_transactions"),
        F.count_if("is_successful").alias("successful"),
        F.count_if(~F.col("is_successful")).alias("failed"),
        money_sum("amount").alias("total_amount"),
        money_avg("amount").alias("avg_transaction"),
    )
    return per_method.withColumn(
        "success_rate", percent(F.col("successful"), F.col("total_transactions"))
    )


def _segment_order(df: DataFrame) -> DataFrame:
    return df.orderBy(listed_rank("value_segment", schemas.VALUE_SEGMENTS))


# -- analyses -----------------------------------------------------------------
def revenue_by_region(t: Tables) -> DataFrame:
    return orders_by(
        t, ["region"], "total_orders", "total_revenue", "avg_order_value",
        "high_value_orders", "total_discount",
    ).orderBy(F.desc("total_revenue"), "region")


def region_chart(t: Tables) -> DataFrame:
    """Bar labels of revenue by region."""
    return revenue_by_region(t).select(
        "region", "total_revenue", lakh_label("total_revenue").alias("revenue_label")
    )


def sales_trend(t: Tables) -> DataFrame:
    return orders_by(
        t, ["date"], "total_orders", "daily_revenue", "avg_order_value", "discounted_orders"
    ).orderBy("date")


def sales_trend_axis(t: Tables) -> DataFrame:
    """The trend with a real date for its axis and labels for its values."""
    return sales_trend(t).select(
        F.col("date").try_cast("date").alias("day"),
        "daily_revenue",
        lakh_label("daily_revenue").alias("revenue_label"),
    )


def peak_hours(t: Tables) -> DataFrame:
    return orders_by(t, ["order_hour", "order_day_of_week"], "total_orders", "total_revenue").orderBy(
        "order_day_of_week", "order_hour"
    )


def peak_hours_heatmap(t: Tables) -> DataFrame:
    """Orders per hour (rows) and day of the week (columns)."""
    days = [
        F.count_if(F.col("order_day_of_week") == i).alias(name)
        for i, name in enumerate(schemas.DAY_NAMES, 1)
    ]
    known = t.orders.filter("order_hour is not null and order_day_of_week is not null")
    return known.groupBy("order_hour").agg(*days).orderBy("order_hour")


def peak_days(t: Tables) -> DataFrame:
    """Orders per named day of the week."""
    named = t.orders.groupBy("order_day_of_week").agg(F.count("order_id").alias("total_orders"))
    return named.select(
        day_name(F.col("order_day_of_week")).alias("day_name"), "order_day_of_week", "total_orders"
    ).orderBy("order_day_of_week")


def hourly_orders(t: Tables) -> DataFrame:
    return (
        orders_by(t, ["order_hour"], "total_orders")
        .withColumn("is_evening", F.col("order_hour").isin(schemas.EVENING_HOURS))
        .orderBy("order_hour")
    )


def value_segments(t: Tables) -> DataFrame:
    return _segment_order(
        orders_by(
            t, ["value_segment"], "total_orders", "total_revenue", "avg_order_value", "avg_items"
        )
    )


def payment_methods(t: Tables) -> DataFrame:
    return (
        _payments_by_method(t)
        .select(
            "payment_method", "total_transactions", "successful", "failed", "success_rate",
            "avg_transaction",
        )
        .orderBy(F.desc("total_transactions"), "payment_method")
    )


def payment_success_band(t: Tables) -> DataFrame:
    return payment_methods(t).select(
        "payment_method", "success_rate",
        band(F.col("success_rate"), schemas.SUCCESS_BANDS, "red").alias("band"),
        rupee_label("avg_transaction").alias("avg_label"),
    )


def _rfm_by_segment(t: Tables) -> DataFrame:
    return t.customer_rfm.groupBy("rfm_segment").agg(
        F.count("customer_id").alias("customer_count"),
        money_avg("total_revenue").alias("avg_lifetime_value"),
        count_avg("total_orders").alias("avg_orders"),
        count_avg("days_since_order").alias("avg_days_inactive"),
    )


def rfm_distribution(t: Tables) -> DataFrame:
    """Segments in their fixed order; labels outside the list are left out."""
    known = _rfm_by_segment(t).filter(F.col("rfm_segment").isin(schemas.RFM_SEGMENTS))
    return known.orderBy(listed_rank("rfm_segment", schemas.RFM_SEGMENTS))


def rfm_chart(t: Tables) -> DataFrame:
    return rfm_distribution(t).select(
        stacked_label("rfm_segment").alias("segment_label"),
        "avg_lifetime_value",
        rupee_label("avg_lifetime_value").alias("value_label"),
    )


def device_breakdown(t: Tables) -> DataFrame:
    return orders_by(t, ["device"], "total_orders", "total_revenue", "avg_order_value").orderBy(
        F.desc("total_orders"), "device"
    )


def _cities(t: Tables, n: int, *measures: str) -> DataFrame:
    ranked = orders_by(t, ["city", "region"], *measures)
    return ranked.orderBy(F.desc("total_revenue"), "city", "region").limit(n)


def top_cities(t: Tables) -> DataFrame:
    return _cities(t, 10, "total_orders", "total_revenue", "avg_order_value")


def top_cities_bubbles(t: Tables) -> DataFrame:
    return top_cities(t).select(
        place_label("city", "region").alias("place"),
        "total_orders",
        "avg_order_value",
        (F.col("total_revenue") / 5000).alias("bubble_size"),
        lakh_label("total_revenue").alias("revenue_label"),
    )


def segment_share(t: Tables) -> DataFrame:
    grouped = orders_by(t, ["value_segment"], "total_orders")
    return _segment_order(grouped.withColumn("share_pct", share_of_total("total_orders", 1)))


def rfm_share(t: Tables) -> DataFrame:
    known = t.customer_rfm.filter(F.col("rfm_segment").isin(schemas.RFM_SEGMENTS))
    grouped = known.groupBy("rfm_segment").agg(F.count("customer_id").alias("customer_count"))
    return grouped.withColumn("share_pct", share_of_total("customer_count", 1)).orderBy(
        listed_rank("rfm_segment", schemas.RFM_SEGMENTS)
    )


def device_share(t: Tables) -> DataFrame:
    grouped = orders_by(t, ["device"], "total_orders")
    return grouped.withColumn("share_pct", share_of_total("total_orders", 1)).orderBy(
        F.desc("total_orders"), "device"
    )


# -- report sheets ------------------------------------------------------------
SAMPLE_ROWS = 1000  # the two sample sheets are samples by definition


def latest_rows(df: DataFrame, n: int, *then: str | Column) -> DataFrame:
    """The ``n`` rows of the latest dates, equal dates in the order of ``then``.

    Rows are first counted per date, which reads one column (or only folder names where
    the table is partitioned by date). The sort then reads just the dates it needs.
    """
    per_date = df.filter("date is not null").groupBy("date").agg(F.count("*").alias("rows"))
    latest_first = Window.orderBy(F.desc("date"))  # one row per date
    so_far = per_date.select("date", F.sum("rows").over(latest_first).alias("so_far"))
    first_date = so_far.filter(F.col("so_far") >= n).agg(F.max("date")).first()[0]
    if first_date is not None:  # else there are fewer rows, and undated ones belong to them
        df = df.filter(F.col("date") >= first_date)
    return df.orderBy(F.desc("date"), *then).limit(n)


def sheet_orders_sample(t: Tables) -> DataFrame:
    """The latest, largest orders; equal ones go by id."""
    return latest_rows(
        t.orders.select(
            "order_id", "customer_name", "customer_email", "city", "region", "final_amount",
            "num_items", "device", "value_segment", "is_high_value", "is_discounted", "discount",
            "order_hour", "date",
        ),
        SAMPLE_ROWS, F.desc("final_amount"), "order_id",
    )


def sheet_revenue_by_region(t: Tables) -> DataFrame:
    return orders_by(
        t, ["region"], "total_orders", "total_revenue", "avg_order_value", "total_discount",
        "high_value_orders",
    ).orderBy(F.desc("total_revenue"), "region")


def sheet_daily_sales(t: Tables) -> DataFrame:
    return orders_by(
        t, ["date"], "total_orders", "daily_revenue", "avg_order_value", "discounted_orders",
        "high_value_orders",
    ).orderBy("date")


def sheet_payment_analysis(t: Tables) -> DataFrame:
    return (
        _payments_by_method(t)
        .select(
            "payment_method", "total_transactions", "successful", "failed",
            F.col("success_rate").alias("success_rate_pct"), "avg_transaction",
        )
        .orderBy(F.desc("total_transactions"), "payment_method")
    )


def sheet_value_segments(t: Tables) -> DataFrame:
    return orders_by(
        t, ["value_segment"], "total_orders", "total_revenue", "avg_order_value",
        "avg_items_per_order", "total_discount",
    ).orderBy(F.desc("total_revenue"), "value_segment")


def sheet_peak_hours(t: Tables) -> DataFrame:
    return orders_by(
        t, [F.col("order_hour").alias("hour_of_day")], "total_orders", "total_revenue",
        "avg_order_value", "weekend_orders", "weekday_orders",
    ).orderBy("hour_of_day")


def sheet_top_cities(t: Tables) -> DataFrame:
    return _cities(t, 20, "total_orders", "total_revenue", "avg_order_value", "high_value_orders")


def sheet_event_funnel(t: Tables) -> DataFrame:
    devices = [
        F.count_if(F.col("device") == d.upper()).alias(f"{d.lower()}_events") for d in schemas.DEVICES
    ]
    return (
        t.user_events.groupBy("event_type")
        .agg(
            F.count("event_id").alias("total_events"),
            F.countDistinct("customer_id").alias("unique_customers"),
            *devices,
        )
        .orderBy(F.desc("total_events"), "event_type")
    )


def sheet_customer_rfm(t: Tables) -> DataFrame:
    """Every customer, largest first: a range-partitioned sort, no single task."""
    return t.customer_rfm.select(
        "customer_id", "customer_name", "customer_email", "last_order_date", "days_since_order",
        "total_orders", "total_revenue", "avg_order_value", "recency_score", "frequency_score",
        "monetary_score", "rfm_segment", "computed_date",
    ).orderBy(F.desc("total_revenue"), "customer_id")


def sheet_payments_sample(t: Tables) -> DataFrame:
    return latest_rows(
        t.payments.select(
            "payment_id", "order_id", "customer_id", "amount", "payment_method", "status",
            "gateway", "is_successful", "payment_hour", "date",
        ),
        SAMPLE_ROWS, "payment_id",
    )


# The report's sheet names.
REPORT_SHEETS = {
    "Orders": sheet_orders_sample,
    "Revenue by Region": sheet_revenue_by_region,
    "Daily Sales Trend": sheet_daily_sales,
    "Payment Analysis": sheet_payment_analysis,
    "Value Segments": sheet_value_segments,
    "Peak Hours": sheet_peak_hours,
    "Top Cities": sheet_top_cities,
    "User Event Funnel": sheet_event_funnel,
    "Customer RFM": sheet_customer_rfm,
    "Payments Sample": sheet_payments_sample,
}


# -- warehouse queries --------------------------------------------------------
def warehouse_region_revenue(t: Tables) -> DataFrame:
    return orders_by(
        t, ["region"], "total_orders", "total_revenue", "avg_order_value", "high_value_orders"
    ).orderBy(F.desc("total_revenue"), "region")


def warehouse_orders_by_hour(t: Tables) -> DataFrame:
    return orders_by(t, ["order_hour"], "total_orders", "total_revenue", "avg_order_value").orderBy(
        "order_hour"
    )


def warehouse_device_share(t: Tables) -> DataFrame:
    grouped = orders_by(t, ["device"], "total_orders", "total_revenue")
    return grouped.withColumn("percentage", share_of_total("total_orders")).orderBy(
        F.desc("total_orders"), "device"
    )


def warehouse_value_segments(t: Tables) -> DataFrame:
    return _segment_order(
        orders_by(t, ["value_segment"], "total_orders", "total_revenue", "avg_order_value")
    )


def warehouse_payment_success(t: Tables) -> DataFrame:
    return (
        _payments_by_method(t)
        .select(
            "payment_method", "total_transactions", "successful", "failed",
            F.col("success_rate").alias("success_rate_pct"), "total_amount",
        )
        .orderBy(F.desc("total_transactions"), "payment_method")
    )


def warehouse_daily_revenue(t: Tables) -> DataFrame:
    return orders_by(
        t, ["date"], "total_orders", "daily_revenue", "avg_order_value", "discounted_orders"
    ).orderBy("date")


def warehouse_event_funnel(t: Tables) -> DataFrame:
    grouped = t.user_events.groupBy("event_type").agg(
        F.count("event_id").alias("total_events"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    return grouped.withColumn("event_share_pct", share_of_total("total_events")).orderBy(
        F.desc("total_events"), "event_type"
    )


def warehouse_top_cities(t: Tables) -> DataFrame:
    return _cities(t, 10, "total_orders", "total_revenue")


def warehouse_weekend_split(t: Tables) -> DataFrame:
    day_type = F.when(F.col("order_day_of_week").isin(schemas.WEEKEND), "Weekend").otherwise("Weekday")
    return orders_by(
        t, [day_type.alias("day_type")], "total_orders", "total_revenue", "avg_order_value"
    )


def warehouse_rfm_segments(t: Tables) -> DataFrame:
    return (
        _rfm_by_segment(t)
        .select(
            "rfm_segment", "customer_count", "avg_lifetime_value",
            F.col("avg_orders").alias("avg_orders_per_customer"),
        )
        .orderBy(F.desc("avg_lifetime_value"), "rfm_segment")
    )


def warehouse_region_orders(t: Tables) -> DataFrame:
    return orders_by(t, ["region"], "orders", "revenue").orderBy(F.desc("revenue"), "region")


# -- layer checks -------------------------------------------------------------
def breakdown(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, the most frequent first; ``top`` keeps so many values."""
    counts = df.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), column)
    return counts if top is None else counts.limit(top)


def layer_sample(df: DataFrame, columns: list[str], order_by: str | None = None, rows: int = 5) -> DataFrame:
    """A few rows to look at; without ``order_by`` only the first partition is read."""
    return (df if order_by is None else df.orderBy(order_by)).select(*columns).limit(rows)


def check_value_segments(t: Tables) -> DataFrame:
    return breakdown(t.orders, "value_segment")


def check_payment_methods(t: Tables) -> DataFrame:
    return breakdown(t.payments, "payment_method")


def check_event_types(t: Tables) -> DataFrame:
    return breakdown(t.user_events, "event_type")


def check_orders_sample(t: Tables) -> DataFrame:
    return layer_sample(
        t.orders,
        ["order_id", "customer_name", "city", "region", "final_amount", "value_segment",
         "is_high_value", "order_hour"],
        "order_id",
    )


def check_payments_sample(t: Tables) -> DataFrame:
    return layer_sample(
        t.payments,
        ["payment_id", "order_id", "amount", "payment_method", "status", "is_successful"],
        "payment_id",
    )


def check_events_sample(t: Tables) -> DataFrame:
    return layer_sample(
        t.user_events, ["event_id", "customer_id", "event_type", "device", "is_search_event"],
        "event_id",
    )


# -- headline findings --------------------------------------------------------
def finding_top_region(t: Tables) -> DataFrame:
    return orders_by(t, ["region"], "total_revenue").orderBy(F.desc("total_revenue"), "region").limit(1)


def finding_biggest_segment(t: Tables) -> DataFrame:
    grouped = orders_by(t, ["value_segment"], "total_orders", "avg_order_value")
    return (
        grouped.withColumn("share_pct", share_of_total("total_orders"))
        .orderBy(F.desc("total_orders"), "value_segment")
        .limit(1)
    )


def finding_best_payment_method(t: Tables) -> DataFrame:
    return (
        _payments_by_method(t)
        .select("payment_method", "success_rate")
        .orderBy(F.desc("success_rate"), "payment_method")
        .limit(1)
    )


def finding_top_city(t: Tables) -> DataFrame:
    return orders_by(t, ["city"], "total_revenue").orderBy(F.desc("total_revenue"), "city").limit(1)


def finding_device_split(t: Tables) -> DataFrame:
    grouped = orders_by(t, ["device"], "total_orders")
    return grouped.select("device", share_of_total("total_orders").alias("share_pct"))


def finding_peak_hour(t: Tables) -> DataFrame:
    return orders_by(t, ["order_hour"], "total_orders").orderBy(F.desc("total_orders"), "order_hour").limit(1)


def finding_data_volume(t: Tables) -> DataFrame:
    """Rows of each curated table, in one row per table."""
    counts = [
        t[name].agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name in schemas.TOPICS
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


ANALYSES = {
    f.__name__: f
    for f in (
        revenue_by_region, region_chart, sales_trend, sales_trend_axis, peak_hours,
        peak_hours_heatmap, peak_days, hourly_orders, value_segments, payment_methods,
        payment_success_band, rfm_distribution, rfm_chart, device_breakdown, top_cities,
        top_cities_bubbles, segment_share, rfm_share, device_share,
        *REPORT_SHEETS.values(),
        warehouse_region_revenue, warehouse_orders_by_hour, warehouse_device_share,
        warehouse_value_segments, warehouse_payment_success, warehouse_daily_revenue,
        warehouse_event_funnel, warehouse_top_cities, warehouse_weekend_split,
        warehouse_rfm_segments, warehouse_region_orders,
        check_value_segments, check_payment_methods, check_event_types,
        check_orders_sample, check_payments_sample, check_events_sample,
        finding_top_region, finding_biggest_segment, finding_best_payment_method,
        finding_top_city, finding_device_split, finding_peak_hour, finding_data_volume,
    )
}
