"""Brand analysis of shop events, by joins of branches or in a single pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.bitmaps import bitmaps, distinct_counts
from stratalake.functions.columns import brand_tier
from stratalake.functions.numeric import PLAIN, guarded_percent, safe_ratio
from stratalake.operators.lookups import left_chain
from stratalake.operators.transforms import SYSTEM_COLUMNS

_DISTINCT = {"unique_users": "user_id", "unique_products": "product_id", "unique_categories": "category_id"}


def purchase_totals(purchases: DataFrame, math=PLAIN) -> DataFrame:
    totals = purchases.groupBy("brand").agg(
        F.count("*").alias("num_purchases"), math.total(F.col("price")).alias("total_revenue")
    )
    return totals.withColumn("average_check", safe_ratio(F.col("total_revenue"), F.col("num_purchases")))


def brand_counts(events: DataFrame, name: str) -> DataFrame:
    return events.groupBy("brand").agg(F.count("*").alias(name))


def brand_reach(events: DataFrame) -> DataFrame:
    """Distinct users, products and categories per brand.

    Spark counts distinct pairs ``(brand, value)`` first, so one large brand is spread over tasks.
    """
    return events.groupBy("brand").agg(*[F.count_distinct(c).alias(name) for name, c in _DISTINCT.items()])


def brand_reach_by_bitmaps(events: DataFrame) -> DataFrame:
    """The same counts for ids that lie close together."""
    return distinct_counts(bitmaps(events, ["brand"], _DISTINCT), ["brand"], list(_DISTINCT))


def gold_rates(math=PLAIN) -> dict[str, Column]:
    """Purchases per cart and carts per view, in percent, NULL without a positive divisor."""
    return {
        "conversion_rate": guarded_percent(F.col("num_purchases"), F.col("num_carts"), math),
        "cart_abandon_rate": guarded_percent(F.col("num_carts"), F.col("num_views"), math),
    }


def job_rates(math=PLAIN) -> dict[str, Column]:
    """Purchases per view and carts per view, in percent."""
    views = F.col("num_views")
    return {
        "conversion_rate": math.round(safe_ratio(F.col("num_purchases"), views) * 100, 2),
        "cart_abandon_rate": math.round(safe_ratio(F.col("num_carts"), views) * 100, 2),
    }


def brand_analysis(
    brands: DataFrame, purchases: DataFrame, views: DataFrame, carts: DataFrame, store: DataFrame, math=PLAIN
) -> DataFrame:
    """Gold table from the Silver tables: brands with a purchase, without the NULL brand."""
    joined = left_chain(
        purchase_totals(purchases, math),
        [brand_counts(views, "num_views"), brands, brand_reach(store), brand_counts(carts, "num_carts")],
        "brand",
    )
    return joined.withColumns(gold_rates(math)).where(F.col("brand").isNotNull()).drop(*SYSTEM_COLUMNS)


def brand_job(events: DataFrame, math=PLAIN) -> DataFrame:
    """Job variant by five branches and four joins; the NULL brand stays and matches nothing."""
    brands = (
        events.select("brand").distinct().dropna(subset=["brand"]).withColumn("brand_tier", brand_tier(F.col("brand")))
    )
    of_type = {t: events.where(F.col("event_type") == t) for t in ("purchase", "view", "cart")}
    joined = left_chain(
        purchase_totals(of_type["purchase"], math),
        [
            brand_counts(of_type["view"], "num_views"),
            brands,
            brand_reach(events),
            brand_counts(of_type["cart"], "num_carts"),
        ],
        "brand",
    )
    return joined.withColumns(job_rates(math)).orderBy(F.desc("total_revenue"))


def brand_job_single_pass(events: DataFrame, math=PLAIN, by_bitmaps: bool = False) -> DataFrame:
    """The same rows from one scan and one aggregation instead of five scans and four joins.

    Rows of event types other than the three still count for the distinct measures, as in the
    branch form. A brand without views or carts has NULL there, not zero. With ``by_bitmaps`` the distinct
    measures come from a second, narrow scan and no row is multiplied.
    """
    kind = F.col("event_type")

    def rows_of(event_type: str) -> Column:
        return F.count_if(kind == event_type)

    known = F.col("brand").isNotNull()
    reach = [] if by_bitmaps else [F.count_distinct(c).alias(name) for name, c in _DISTINCT.items()]
    summed = events.groupBy("brand").agg(
        rows_of("purchase").alias("num_purchases"),
        math.total(F.when(kind == "purchase", F.col("price"))).alias("total_revenue"),
        rows_of("view").alias("num_views"),
        *reach,
        rows_of("cart").alias("num_carts"),
    )
    if by_bitmaps:
        summed = summed.join(brand_reach_by_bitmaps(events), "brand", "left").na.fill(0, list(_DISTINCT))
    return (
        summed.where(F.col("num_purchases") > 0)
        .select(
            "brand",
            "num_purchases",
            "total_revenue",
            safe_ratio(F.col("total_revenue"), F.col("num_purchases")).alias("average_check"),
            F.when(known & (F.col("num_views") > 0), F.col("num_views")).alias("num_views"),
            F.when(known, brand_tier(F.col("brand"))).alias("brand_tier"),
            *[F.when(known, F.col(name)).alias(name) for name in _DISTINCT],
            F.when(known & (F.col("num_carts") > 0), F.col("num_carts")).alias("num_carts"),
        )
        .withColumns(job_rates(math))
        .orderBy(F.desc("total_revenue"))
    )
