"""Joins, aggregates, windows, order and set operations (J, A, W, O, V)."""

from pyspark.sql import functions as F

from checks.domain import CHANGE_KEYS
from checks.q_analytics import CENTS
from checks.registry import mean, query, rounded, total
from stratalake.functions.bitmaps import bitmaps, distinct_counts, merged
from stratalake.functions.columns import EVENT_TYPES, hour_parts, same_keys
from stratalake.functions.numeric import safe_ratio
from stratalake.operators import scd2
from stratalake.operators import transforms as t
from stratalake.operators.dedup import latest_per_key, latest_per_key_sql
from stratalake.operators.lookups import broadcast_if_small, left_chain, left_lookup
from stratalake.operators.quality import invalid_values, repeated_values
from stratalake.plans.brands import brand_counts, purchase_totals
from stratalake.plans.sales import customer_sales
from stratalake.sources.catalog import save_table

TRACKED = ["city", "email_address"]


@query(
    "j1_left_join_on_shared_column",
    """SELECT c.customerID, c.city, s.spent FROM silver_customers c LEFT JOIN
    (SELECT customerID, CAST(sum(totalPrice) AS BIGINT) AS spent FROM silver_transactions GROUP BY customerID) s
    ON c.customerID = s.customerID""",
)
def _(d):
    spent = d.transactions.groupBy("customerID").agg(F.sum("totalPrice").alias("spent"))
    return d.customers.select("customerID", "city").join(spent, "customerID", "left")


BRAND_CHAIN = """
SELECT p.brand, p.purchases, v.views, c.carts, b.brand_tier, a.events
FROM (SELECT brand, count(*) AS purchases FROM silver_store WHERE event_type = 'purchase' GROUP BY brand) p
LEFT JOIN (SELECT brand, count(*) AS views FROM silver_store WHERE event_type = 'view' GROUP BY brand) v ON p.brand = v.brand
LEFT JOIN (SELECT brand, count(*) AS carts FROM silver_store WHERE event_type = 'cart' GROUP BY brand) c ON p.brand = c.brand
LEFT JOIN brand_rows b ON p.brand = b.brand
LEFT JOIN (SELECT brand, count(*) AS events FROM silver_store GROUP BY brand) a ON p.brand = a.brand"""


def _brand_chain(d, first_hint: str | None = None):
    first = brand_counts(t.extract_purchases(d.store), "purchases")
    tiers = t.extract_brands(d.store).select("brand", "brand_tier").distinct()
    others = [
        brand_counts(t.extract_views(d.store), "views"),
        brand_counts(t.extract_carts(d.store), "carts"),
        tiers,
        brand_counts(d.store, "events"),
    ]
    return left_chain(first, [o.hint(first_hint) for o in others] if first_hint else others, "brand")


@query("j2_chain_of_left_joins", BRAND_CHAIN)
def _(d):
    return _brand_chain(d)


@query("j9_sort_merge_join", BRAND_CHAIN)
def _(d):
    return _brand_chain(d, "merge")


def _bucketed(d, name: str, keys: list[str]):
    """A test table as a catalog table in eight buckets; its files lie in the scratch folder."""
    path = d.scratch(f"catalog-{name}")
    return save_table(d.base(name), f"{name}_{path.rsplit('-', 1)[1]}", path, 8, keys)


@query(
    "j9_bucketed_tables_without_shuffle",
    """SELECT o_orderkey, o_orderstatus, count(l_orderkey) AS lines, max(l_linenumber) AS last_line
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus""",
)
def _(d):
    """Two created tables are joined and grouped by the key that deals their buckets."""
    orders, lines = _bucketed(d, "orders", ["o_orderkey"]), _bucketed(d, "lineitem", ["l_orderkey"])
    joined = orders.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.groupBy("o_orderkey", "o_orderstatus").agg(F.count("l_orderkey").alias("lines"), F.max("l_linenumber").alias("last_line"))


ZONED = """SELECT t.*, z.Borough, z.Zone, z.service_zone FROM
    (SELECT PULocationID, count(*) AS trips FROM typed_trips GROUP BY PULocationID) t
LEFT JOIN zone_file z ON t.PULocationID = z.LocationID"""


@query("j3_left_join_on_named_columns", ZONED)
def _(d):
    per_zone = d.trips.groupBy("PULocationID").agg(F.count("*").alias("trips"))
    return left_lookup(per_zone, d.zone_file, "PULocationID", "LocationID")


@query("j4_broadcast_left_join", ZONED)
def _(d):
    per_zone = d.trips.groupBy("PULocationID").agg(F.count("*").alias("trips"))
    return left_lookup(per_zone, broadcast_if_small(d.zone_file), "PULocationID", "LocationID")


@query(
    "j5_dimension_in_two_roles",
    """SELECT p.borough AS pickup_borough, q.borough AS dropoff_borough, count(*) AS trips
FROM typed_trips LEFT JOIN zones p ON PULocationID = p.location_id LEFT JOIN zones q ON DOLocationID = q.location_id
GROUP BY 1, 2""",
)
def _(d):
    dim = broadcast_if_small(d.zones)
    both = left_lookup(d.trips, t.zones_as("pickup", dim), "PULocationID", "pickup_location_id")
    both = left_lookup(both, t.zones_as("dropoff", dim), "DOLocationID", "dropoff_location_id")
    return both.groupBy("pickup_borough", "dropoff_borough").agg(F.count("*").alias("trips"))


@query(
    "j6_inner_join_with_residual",
    """SELECT s.* FROM day_two s JOIN day_one t ON s.customerID = t.customerID
WHERE s.city IS DISTINCT FROM t.city OR s.email_address IS DISTINCT FROM t.email_address""",
)
def _(d):
    return scd2.changed_rows(d.history_one.where("is_current"), d.day_two, ["customerID"], TRACKED)


@query("j7_anti_join", "SELECT s.* FROM day_two s LEFT JOIN day_one t ON s.customerID = t.customerID WHERE t.customerID IS NULL")
def _(d):
    return scd2.new_rows(d.history_one.where("is_current"), d.day_two, ["customerID"])


@query(
    "j8_composite_key_join",
    """SELECT o.order_id, o.line_no, o.quantity AS old_quantity, n.quantity AS new_quantity
FROM old_state o JOIN new_batch n ON o.order_id = n.order_id AND o.line_no = n.line_no""",
)
def _(d):
    pairs = d.old_state.alias("o").join(d.new_batch.alias("n"), same_keys("o", "n", CHANGE_KEYS))
    return pairs.select(
        "o.order_id", "o.line_no", F.col("o.quantity").alias("old_quantity"), F.col("n.quantity").alias("new_quantity")
    )


# -- aggregates -------------------------------------------------------------------------------


@query(
    "a1_group_by_one_key",
    """SELECT customerID, CAST(sum(totalPrice) AS BIGINT) AS total_spent, count(DISTINCT transactionID) AS total_transactions,
    floor(avg(totalPrice) * 100.0 + 0.5) / 100.0 AS average_check, CAST(sum(quantity) AS BIGINT) AS total_items_bought,
    count(DISTINCT franchiseID) AS unique_franchises_visited, max(dateTime) AS last_transaction_date
FROM silver_transactions GROUP BY customerID""",
)
def _(d):
    return customer_sales(d.transactions, math=CENTS)


@query(
    "a2_group_by_many_keys",
    """SELECT PULocationID, payment_type, RatecodeID, VendorID, count(*) AS n FROM typed_trips GROUP BY ALL""",
)
def _(d):
    return d.trips.groupBy("PULocationID", "payment_type", "RatecodeID", "VendorID").agg(F.count("*").alias("n"))


@query("a3_group_by_expression", "SELECT hour(tpep_pickup_datetime)::INT AS pickup_hour, count(*) AS n FROM typed_trips GROUP BY 1")
def _(d):
    return d.trips.groupBy(F.hour("tpep_pickup_datetime").alias("pickup_hour")).agg(F.count("*").alias("n"))


@query("a4_count_rows", "SELECT brand, count(*) AS n FROM silver_store GROUP BY brand")
def _(d):
    return d.store.groupBy("brand").agg(F.count("*").alias("n"))


@query("a5_sum", "SELECT franchiseID, CAST(sum(totalPrice) AS BIGINT) AS total FROM silver_transactions GROUP BY franchiseID")
def _(d):
    return d.transactions.groupBy("franchiseID").agg(F.sum("totalPrice").alias("total"))


@query("a6_average_ignores_null", "SELECT PULocationID, avg(payment_type) AS mean_code FROM typed_trips GROUP BY PULocationID")
def _(d):
    return d.trips.groupBy("PULocationID").agg(F.avg("payment_type").alias("mean_code"))


@query("a7_max_of_text_time", "SELECT customerID, max(dateTime) AS newest FROM silver_transactions GROUP BY customerID")
def _(d):
    return d.transactions.groupBy("customerID").agg(F.max("dateTime").alias("newest"))


@query(
    "a8_several_distinct_counts",
    """SELECT brand, count(DISTINCT user_id) AS users, count(DISTINCT product_id) AS products,
    count(DISTINCT category_id) AS categories FROM silver_store GROUP BY brand""",
)
def _(d):
    return d.store.groupBy("brand").agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("product_id").alias("products"),
        F.count_distinct("category_id").alias("categories"),
    )


IDS = {"users": "user_id", "products": "product_id", "categories": "category_id"}


@query(
    "a8_distinct_counts_by_bitmaps",
    """SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT product_id) AS products,
    count(DISTINCT category_id) AS categories FROM silver_store GROUP BY event_type""",
)
def _(d):
    return distinct_counts(bitmaps(d.store, ["event_type"], IDS), ["event_type"], list(IDS))


@query(
    "a8_bitmaps_of_hours_merged",
    """SELECT year(event_time)::INT AS year, month(event_time)::INT AS month, day(event_time)::INT AS day, count(DISTINCT user_id) AS users,
    count(DISTINCT product_id) AS products, count(DISTINCT category_id) AS categories FROM silver_store GROUP BY ALL""",
)
def _(d):
    """Bitmaps are stored per hour; days are counted from them without the events."""
    path, day = d.scratch("a8-hours"), ["year", "month", "day"]
    events = d.store.withColumns(hour_parts(F.col("event_time")))
    bitmaps(events, [*day, "hour"], IDS).write.parquet(path)
    return distinct_counts(merged(d.spark.read.parquet(path), day), day, list(IDS))


@query(
    "a9_rounded_aggregates",
    f"""SELECT DOLocationID, {rounded(total("fare_amount"), 2)} AS fare, {rounded(mean("trip_distance"), 1)} AS distance
FROM typed_trips GROUP BY DOLocationID""",
)
def _(d):
    return d.trips.groupBy("DOLocationID").agg(
        CENTS.round(CENTS.total(F.col("fare_amount")), 2).alias("fare"),
        CENTS.round(CENTS.mean(F.col("trip_distance")), 1).alias("distance"),
    )


@query("a10_conditional_count", "SELECT VendorID, count(*) FILTER (WHERE RatecodeID IN (2, 3)) AS airport FROM typed_trips GROUP BY VendorID")
def _(d):
    return d.trips.groupBy("VendorID").agg(F.count_if(F.col("RatecodeID").isin(2, 3)).alias("airport"))


@query(
    "a11_percentage_share",
    f"""SELECT VendorID, {rounded("count(*) FILTER (WHERE payment_type = 1) * 1.0::DOUBLE / count(*) * 100", 1)} AS card_pct
FROM typed_trips GROUP BY VendorID""",
)
def _(d):
    share = safe_ratio(F.count_if(F.col("payment_type") == 1), F.count("*")) * 100
    return d.trips.groupBy("VendorID").agg(CENTS.round(share, 1).alias("card_pct"))


@query(
    "a12_ratio_of_sums",
    f"""SELECT PULocationID, {total("tip_amount")} / nullif({total("CASE WHEN payment_type = 1 THEN fare_amount ELSE 0 END")}, 0) AS tip_rate
FROM typed_trips GROUP BY PULocationID""",
)
def _(d):
    card_fare = F.when(F.col("payment_type") == 1, F.col("fare_amount")).otherwise(0.0)
    ratio = safe_ratio(CENTS.total(F.col("tip_amount")), CENTS.total(card_fare))
    return d.trips.groupBy("PULocationID").agg(ratio.alias("tip_rate"))


@query(
    "a13_column_after_aggregate",
    f"""SELECT *, total_revenue / num_purchases AS average_check FROM (
    SELECT brand, count(*) AS num_purchases, {total("price")} AS total_revenue
    FROM silver_store WHERE event_type = 'purchase' GROUP BY brand)""",
)
def _(d):
    return purchase_totals(t.extract_purchases(d.store), CENTS)


@query("a14_filter_after_aggregate", "SELECT user_session, count(*) AS n FROM silver_store GROUP BY 1 HAVING count(*) >= 3")
def _(d):
    return d.store.groupBy("user_session").agg(F.count("*").alias("n")).where(F.col("n") >= 3)


@query("a15_global_maximum", "SELECT max(_ingestion_timestamp) AS newest FROM silver_store")
def _(d):
    return d.store.agg(F.max("_ingestion_timestamp").alias("newest"))


@query("a16_global_count", "SELECT count(*) AS n FROM silver_store")
def _(d):
    return d.store.agg(F.count("*").alias("n"))


@query("a17_distinct_rows", "SELECT DISTINCT brand, category_code FROM silver_store")
def _(d):
    return d.store.select("brand", "category_code").distinct()


@query(
    "a18_count_over_groups",
    "SELECT count(*) AS sessions FROM (SELECT user_session FROM silver_store GROUP BY user_session HAVING count(*) > 1)",
)
def _(d):
    return repeated_values(d.store, "user_session").agg(F.count("*").alias("sessions"))


# -- windows, order, sets ---------------------------------------------------------------------


@query("w1_latest_row_per_key", "SELECT * FROM latest_changes")
def _(d):
    return latest_per_key(d.changes, CHANGE_KEYS, "changed_at")


@query("w2_latest_row_per_key_in_sql", "SELECT * FROM latest_changes")
def _(d):
    return latest_per_key_sql(d.changes, CHANGE_KEYS, "changed_at")


@query(
    "w3_validity_intervals",
    """SELECT order_id, line_no, changed_at, changed_at AS effective_from,
    lead(changed_at) OVER (PARTITION BY order_id, line_no ORDER BY changed_at) AS effective_to,
    lead(changed_at) OVER (PARTITION BY order_id, line_no ORDER BY changed_at) IS NULL AS is_current
FROM (SELECT DISTINCT order_id, line_no, changed_at FROM changes)""",
)
def _(d):
    return scd2.intervals(d.changes.select(*CHANGE_KEYS, "changed_at").distinct(), CHANGE_KEYS, "changed_at")


@query(
    "w3_intervals_by_range",
    """SELECT order_id, line_no, changed_at, changed_at AS effective_from, lead(changed_at) OVER w AS effective_to, lead(changed_at) OVER w IS NULL AS is_current
FROM (SELECT DISTINCT order_id, line_no, changed_at FROM changes) WINDOW w AS (PARTITION BY order_id, line_no ORDER BY changed_at)""",
)
def _(d):
    log = d.changes.select(*CHANGE_KEYS, "changed_at").distinct()
    return scd2.intervals_by_range(log, CHANGE_KEYS, "changed_at", d.scratch("w3"))


@query(
    "o1_order_descending",
    """SELECT franchiseID, CAST(sum(totalPrice) AS BIGINT) AS revenue FROM silver_transactions GROUP BY franchiseID
ORDER BY revenue DESC""",
)
def _(d):
    return d.transactions.groupBy("franchiseID").agg(F.sum("totalPrice").alias("revenue")).orderBy(F.desc("revenue"))


@query(
    "o2_order_by_several",
    """SELECT month(tpep_pickup_datetime)::INT AS month, hour(tpep_pickup_datetime)::INT AS hour, count(*) AS n
FROM typed_trips GROUP BY 1, 2 ORDER BY 1, 2""",
)
def _(d):
    month, hour = F.month("tpep_pickup_datetime").alias("month"), F.hour("tpep_pickup_datetime").alias("hour")
    return d.trips.groupBy(month, hour).agg(F.count("*").alias("n")).orderBy("month", "hour")


@query("o3_top_k", "SELECT * FROM silver_transactions ORDER BY totalPrice DESC, transactionID LIMIT 25")
def _(d):
    return d.transactions.orderBy(F.desc("totalPrice"), "transactionID").limit(25)


@query("o4_first_row", "SELECT min(_ingestion_timestamp) AS first_time FROM silver_store")
def _(d):
    first = d.store.select("_ingestion_timestamp").orderBy("_ingestion_timestamp").first()[0]
    return d.store.limit(1).select(F.lit(first).alias("first_time"))


CHANGED_OR_NEW = """
SELECT s.* FROM day_two s JOIN day_one t ON s.customerID = t.customerID
WHERE s.city IS DISTINCT FROM t.city OR s.email_address IS DISTINCT FROM t.email_address
UNION ALL SELECT s.* FROM day_two s WHERE s.customerID NOT IN (SELECT customerID FROM day_one)"""


@query("v1_union_of_changed_and_new", CHANGED_OR_NEW)
def _(d):
    current = d.history_one.where("is_current")
    return scd2.changed_rows(current, d.day_two, ["customerID"], TRACKED).unionByName(
        scd2.new_rows(current, d.day_two, ["customerID"])
    )


@query(
    "v2_values_outside_allowed_set",
    "SELECT DISTINCT event_type FROM silver_store WHERE event_type NOT IN ('view', 'cart', 'purchase') OR event_type IS NULL",
)
def _(d):
    return invalid_values(d.store, "event_type", EVENT_TYPES)


@query("v3_common_table_expressions", CHANGED_OR_NEW)
def _(d):
    return scd2.changes_sql(d.history_one.where("is_current"), d.day_two, ["customerID"], TRACKED)


@query("v4_temp_view_in_sql", "SELECT event_type, count(*) AS n FROM silver_store GROUP BY event_type")
def _(d):
    d.store.createOrReplaceTempView("v4_store")
    return d.spark.sql("SELECT event_type, count(*) AS n FROM v4_store GROUP BY event_type")


@query(
    "v5_history_of_one_key",
    "SELECT * FROM history_one WHERE customerID = 15 ORDER BY effective_to DESC NULLS LAST, effective_from DESC LIMIT 10",
)
def _(d):
    return scd2.history_of(d.history_one, F.col("customerID") == 15)


@query("v6_rows_of_one_key", "SELECT * FROM history_one WHERE customerID = 25 LIMIT 10")
def _(d):
    return d.history_one.where(F.col("customerID") == 25).limit(10)
