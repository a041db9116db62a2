"""Set-level checks of the rules the shop's messages are meant to follow.

Repeated or hot keys are collapsed by a partial aggregate before any join, so no check
pairs up the rows of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato import schemas
from mercato.functions.money import cents, total_cents


def _status_counts(df: DataFrame, status: Column, count: str) -> DataFrame:
    return df.select(status.alias("status")).groupBy("status").agg(F.count("*").alias(count))


# -- line items ---------------------------------------------------------------
def explode_items(orders: DataFrame) -> DataFrame:
    """One row per line of each order's ``items`` array."""
    return orders.select("order_id", F.explode("items").alias("line")).select("order_id", "line.*")


#: Columns of line sums and order headers, as they can be stored.
LINE_SUMS = "order_id string, lines bigint, bad_lines bigint, line_cents decimal(38,0)"
HEADERS = "order_id string, num_items int, subtotal_cents bigint"


def line_sums(lines: DataFrame) -> DataFrame:
    """Lines, wrong lines and their total per order; sums of parts merge by adding."""
    return lines.groupBy("order_id").agg(
        F.count("*").alias("lines"),
        F.count_if(cents("item_total") != cents("unit_price") * F.col("quantity")).alias("bad_lines"),
        total_cents("item_total").alias("line_cents"),
    )


def merged_line_sums(sums: DataFrame) -> DataFrame:
    return sums.groupBy("order_id").agg(
        *[F.sum(c).cast(t).alias(c) for c, t in (("lines", "bigint"), ("bad_lines", "bigint"), ("line_cents", "decimal(38,0)"))]
    )


def order_headers(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", "num_items", cents("subtotal").alias("subtotal_cents"))


def line_checks(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Per order: do its lines add up to the header?"""
    return headers_against_sums(order_headers(orders), line_sums(lines))


def headers_against_sums(headers: DataFrame, per_order: DataFrame) -> DataFrame:
    """The line check on an order's header and the sums of its lines, a row per order there."""
    status = (
        F.when(F.col("lines").isNull(), "NO_LINES")
        .when(F.col("num_items").isNull() | (F.col("lines") != F.col("num_items")), "COUNT_MISMATCH")
        .when(F.col("line_cents") != F.col("subtotal_cents"), "SUBTOTAL_MISMATCH")
        .when(F.col("bad_lines") > 0, "LINE_TOTAL_MISMATCH")
        .otherwise("OK")
    )
    return headers.join(per_order, "order_id", "left").select(
        "order_id",
        F.coalesce("lines", F.lit(0)).alias("lines"),
        F.coalesce("bad_lines", F.lit(0)).alias("bad_lines"),
        status.alias("status"),
    )


def line_check_counts(orders: DataFrame, lines: DataFrame) -> DataFrame:
    return _status_counts(line_checks(orders, lines), F.col("status"), "orders")


# -- amounts ------------------------------------------------------------------
def amount_check_counts(orders: DataFrame) -> DataFrame:
    """final_amount = subtotal - discount, in cents."""
    expected = cents("subtotal") - cents("discount")
    status = (
        F.when(F.col("subtotal").isNull(), "NO_SUBTOTAL")
        .when(cents("final_amount") == expected, "OK")
        .otherwise("AMOUNT_MISMATCH")
    )
    return _status_counts(orders, status, "orders")


# -- payments against orders --------------------------------------------------
#: Columns of one side, as it can be stored.
SIDE = "order_id string, n bigint, low bigint, high bigint, customer string, customer_2 string"


def order_side(df: DataFrame, amount: str) -> DataFrame:
    """What a side says of each order id; rows of parts merge, see :func:`merged_sides`."""
    return df.groupBy("order_id").agg(
        F.count("*").alias("n"),
        F.min(cents(amount)).alias("low"),
        F.max(cents(amount)).alias("high"),
        F.min("customer_id").alias("customer"),
        F.max("customer_id").alias("customer_2"),
    )


def merged_sides(parts: DataFrame) -> DataFrame:
    return parts.groupBy("order_id").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("customer").alias("customer"), F.max("customer_2").alias("customer_2"),
    )


def reconcile_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order id seen on either side, with how the two sides agree."""
    return reconcile_sides(order_side(orders, "final_amount"), order_side(payments, "amount"))


def reconcile_sides(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """The same from what each side says per order id.

    Both sides are one row per id before they meet, on the partitioning and order the
    aggregates already have.
    """
    sides = [
        df.select("order_id", *[F.col(c).alias(f"{prefix}_{'rows' if c == 'n' else c}") for c in ("n", "low", "high", "customer", "customer_2")])
        for df, prefix in ((orders, "order"), (payments, "payment"))
    ]
    both = sides[0].join(sides[1], "order_id", "full_outer")
    status = (
        F.when(F.col("order_rows").isNull(), "PAYMENT_WITHOUT_ORDER")
        .when(F.col("payment_rows").isNull(), "ORDER_WITHOUT_PAYMENT")
        .when(
            (F.col("order_low") != F.col("payment_low")) | (F.col("order_high") != F.col("payment_high")),
            "AMOUNT_MISMATCH",
        )
        .when(
            ~F.col("order_customer").eqNullSafe(F.col("payment_customer"))
            | ~F.col("order_customer_2").eqNullSafe(F.col("payment_customer_2")),
            "CUSTOMER_MISMATCH",
        )
        .when((F.col("order_rows") > 1) | (F.col("payment_rows") > 1), "REPEATED")
        .otherwise("OK")
    )
    return both.select(
        "order_id",
        F.coalesce("order_rows", F.lit(0)).alias("order_rows"),
        F.coalesce("payment_rows", F.lit(0)).alias("payment_rows"),
        status.alias("status"),
    )


def reconcile_counts(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return _status_counts(reconcile_payments(orders, payments), F.col("status"), "order_ids")


# -- events -------------------------------------------------------------------
def search_check_counts(events: DataFrame) -> DataFrame:
    """Searches carry a query and no product; every other event the reverse."""
    searching = F.upper(F.trim("event_type")) == "SEARCH"
    product, query = F.col("product_id").isNotNull(), F.col("search_query").isNotNull()
    status = (
        F.when(searching & product, "SEARCH_WITH_PRODUCT")
        .when(searching & ~query, "SEARCH_WITHOUT_QUERY")
        .when(~searching & query, "QUERY_OUTSIDE_SEARCH")
        .when(~searching & ~product, "PRODUCT_MISSING")
        .otherwise("OK")
    )
    return _status_counts(events, status, "events")


# -- domains ------------------------------------------------------------------
def _fixed_rows(df: DataFrame, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A fixed list as a table of known, small size."""
    listed = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows])
    return df.sparkSession.range(1).select(F.inline(listed))


def shop_places(df: DataFrame) -> DataFrame:
    """The shop's fixed (region, city) list, 20 rows."""
    rows = [(region, city) for region, cities in schemas.CITIES_BY_REGION.items() for city in cities]
    return _fixed_rows(df, ["region", "city"], rows)


def unknown_places(orders: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Orders per (region, city) pair that the place list does not hold.

    Pairs are counted first, so the anti join sees one row per pair.
    """
    known = (shop_places(orders) if places is None else places).select(
        F.upper(F.trim("region")).alias("region"), F.trim("city").alias("city")
    )
    pairs = orders.groupBy(
        F.upper(F.trim("region")).alias("region"), F.trim("city").alias("city")
    ).agg(F.count("*").alias("orders"))
    return pairs.join(known.distinct(), ["region", "city"], "left_anti")


DOMAINS: dict[str, dict[str, list[str]]] = {
    "orders": {"status": schemas.ORDER_STATUSES, "device": schemas.DEVICES},
    "payments": {
        "status": schemas.PAYMENT_STATUSES,
        "payment_method": schemas.PAYMENT_METHODS,
        "gateway": schemas.GATEWAYS,
    },
    "user_events": {"event_type": schemas.EVENT_TYPES, "device": schemas.DEVICES},
}


def domain_counts(df: DataFrame, topic: str) -> DataFrame:
    """Rows per value of each enumerated column and whether the value is in its domain."""
    columns = DOMAINS[topic]
    fields = F.array(
        *[
            F.struct(
                F.lit(f"{topic}.{c}").alias("field"),
                F.upper(F.trim(c)).alias("value"),
                F.coalesce(
                    F.upper(F.trim(c)).isin(*[v.upper() for v in values]), F.lit(False)
                ).alias("known"),
            )
            for c, values in columns.items()
        ]
    )
    return (
        df.select(F.explode(fields).alias("f"))
        .groupBy("f.field", "f.value", "f.known")
        .agg(F.count("*").alias("rows"))
    )


# -- repeated deliveries ------------------------------------------------------
def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")


def deduplicate(df: DataFrame, key: str, first_by: str = "kafka_timestamp") -> DataFrame:
    """One row per event id, the earliest delivered; equal times go by the other columns.

    Broker offsets restart when a topic is recreated, ids do not. Copies are reduced to one
    per task before the shuffle, however many an id has.
    """
    others = [c for c in df.columns if c not in (key, first_by)]
    kept = df.groupBy(key).agg(F.min(F.struct(first_by, *others)).alias("kept"))
    return kept.select(key, "kept.*").select(*df.columns)


# -- product catalogue --------------------------------------------------------
def shop_products(df: DataFrame) -> DataFrame:
    """The shop's fixed product list, 15 rows."""
    return _fixed_rows(df, ["product_id", "product_name", "category", "unit_price"], schemas.PRODUCTS)


def catalogue_check_counts(lines: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Lines that match the product list, or how they differ.

    A product's lines collapse to their distinct variants before the join, so a product
    in a third of all lines does not skew it. Lines of a product that the list has twice, with
    different entries, are DUPLICATE_PRODUCT.
    """
    listed = (shop_products(lines) if products is None else products).select(
        "product_id",
        F.struct(
            F.col("product_name").alias("listed_name"),
            F.col("category").alias("listed_category"),
            cents("unit_price").alias("listed_cents"),
        ).alias("entry"),
    )
    known = listed.groupBy("product_id").agg(
        F.min("entry").alias("entry"), (~F.min("entry").eqNullSafe(F.max("entry"))).alias("twice")
    ).select("product_id", "entry.*", "twice", F.lit(True).alias("known"))
    variants = lines.groupBy(
        "product_id", "product_name", "category", cents("unit_price").alias("price_cents")
    ).agg(F.count("*").alias("n"))
    status = (
        F.when(F.col("known").isNull(), "UNKNOWN_PRODUCT")
        .when(F.col("twice"), "DUPLICATE_PRODUCT")
        .when(~F.col("product_name").eqNullSafe(F.col("listed_name")), "NAME_MISMATCH")
        .when(~F.col("category").eqNullSafe(F.col("listed_category")), "CATEGORY_MISMATCH")
        .when(~F.col("price_cents").eqNullSafe(F.col("listed_cents")), "PRICE_MISMATCH")
        .otherwise("OK")
    )
    return (
        variants.join(known, "product_id", "left")
        .groupBy(status.alias("status"))
        .agg(F.sum("n").alias("lines"))
    )
