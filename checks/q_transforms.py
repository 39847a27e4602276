"""Projections, predicates and scalar functions (P, F, C, D)."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from checks.domain import AS_OF, RULES
from checks.registry import query
from stratalake.functions import columns as c
from stratalake.functions.numeric import Fixed, guarded_percent, safe_ratio
from stratalake.operators import transforms as t
from stratalake.operators.incremental import split_deletes
from stratalake.operators.quality import fails_any, in_hour
from stratalake.operators.scd2 import changed_rows

CENTS = Fixed(2)
EVENT_COLUMNS = (
    "event_time, product_id, category_id, category_code, brand, price, user_id, user_session, "
    "_ingestion_timestamp, _source_file, _batch_id, _is_deleted"
)


@query("p1_prepare_sales_customers", "SELECT * FROM silver_customers")
def _(d):
    return t.prepare_sales_customers(d.view("sales_customers"))


@query("p2_prepare_sales_franchises", "SELECT * FROM silver_franchises")
def _(d):
    return t.prepare_sales_franchises(d.view("sales_franchises"))


@query("p3_prepare_sales_suppliers", "SELECT * FROM silver_suppliers")
def _(d):
    return t.prepare_sales_suppliers(d.view("sales_suppliers"))


@query("p4_prepare_sales_transactions", "SELECT * FROM silver_transactions")
def _(d):
    return t.prepare_sales_transactions(d.view("sales_transactions"))


@query("p5_process_events", "SELECT * FROM silver_store")
def _(d):
    return t.process_data(d.view("ecommerce_store"))


@query(
    "p6_extract_brands",
    """SELECT s.brand, _ingestion_timestamp, _source_file, _batch_id, _is_deleted, brand_tier
FROM silver_store s JOIN brand_rows b ON s.brand = b.brand""",
)
def _(d):
    return t.extract_brands(d.store)


@query("p7_extract_purchases", f"SELECT {EVENT_COLUMNS} FROM silver_store WHERE event_type = 'purchase'")
def _(d):
    return t.extract_purchases(d.store)


@query("p8_extract_views", f"SELECT {EVENT_COLUMNS} FROM silver_store WHERE event_type = 'view'")
def _(d):
    return t.extract_views(d.store)


@query("p9_extract_carts", f"SELECT {EVENT_COLUMNS} FROM silver_store WHERE event_type = 'cart'")
def _(d):
    return t.extract_carts(d.store)


@query(
    "p10_extract_users",
    "SELECT user_id, user_session, _ingestion_timestamp, _source_file, _batch_id, _is_deleted FROM silver_store",
)
def _(d):
    return t.extract_users(d.store)


@query(
    "p11_add_lineage",
    f"""SELECT * EXCLUDE (_is_deleted), TIMESTAMP '{AS_OF}' AS _ingestion_timestamp, 'landing/changes' AS _source_file,
    'batch-1' AS _batch_id, coalesce(_is_deleted, FALSE) AS _is_deleted FROM changes""",
)
def _(d):
    return t.add_lineage(d.changes, datetime.fromisoformat(AS_OF), "landing/changes", "batch-1")


@query("p12_type_trips", "SELECT * FROM typed_trips")
def _(d):
    return t.type_trips(d.view("trips"))


@query(
    "p13_customer_profile",
    "SELECT customerID, concat_ws(' ', first_name, last_name) AS full_name, email_address, city, state, country FROM silver_customers",
)
def _(d):
    return t.customer_profile(d.customers)


@query("p14_drop_columns", "SELECT * EXCLUDE (_ingestion_timestamp, _source_file, _batch_id, _is_deleted) FROM silver_transactions")
def _(d):
    return t.drop_columns(d.transactions, *t.SYSTEM_COLUMNS)


@query(
    "p15_zones_in_two_roles",
    """SELECT p.location_id AS pickup_location_id, p.borough AS pickup_borough, p.zone AS pickup_zone,
    q.borough AS dropoff_borough, q.zone AS dropoff_zone
FROM zones p JOIN zones q ON p.location_id = q.location_id""",
)
def _(d):
    return t.zones_as("pickup", d.zones).join(
        t.zones_as("dropoff", d.zones).withColumnRenamed("dropoff_location_id", "pickup_location_id"), "pickup_location_id"
    )


@query("p16_transform_by_table_name", "SELECT * FROM silver_suppliers")
def _(d):
    return d.view("sales_suppliers").transform(t.transform_for("silver.sales_suppliers"))


@query("p17_star_with_repeated_columns", "SELECT customerID AS key, first_name AS shown_name, s.* FROM silver_customers s")
def _(d):
    return d.spark.sql("SELECT customerID AS key, first_name AS shown_name, s.* FROM {rows} s", rows=d.customers)


# -- predicates -------------------------------------------------------------------------------


def _where(name: str, predicate: str, condition) -> None:
    """``condition`` is SQL text or a function that builds the column."""

    @query(name, f"SELECT * FROM typed_trips WHERE {predicate}")
    def _(d):
        return d.trips.where(condition if isinstance(condition, str) else condition())


_where("f1_is_not_null", "fare_amount IS NOT NULL", lambda: F.col("fare_amount").isNotNull())
_where("f2_equals_literal", "payment_type = 2", lambda: F.col("payment_type") == 2)
_where(
    "f3_greater_less_at_least",
    "fare_amount > 300 AND trip_distance < 10 AND tpep_pickup_datetime >= TIMESTAMP '1997-06-01'",
    lambda: (F.col("fare_amount") > 300)
    & (F.col("trip_distance") < 10)
    & (F.col("tpep_pickup_datetime") >= F.lit("1997-06-01").cast("timestamp")),
)
_where("f4_in_list", "RatecodeID IN (2, 3)", lambda: F.col("RatecodeID").isin(*c.AIRPORT_RATE_CODES))
_where("f5_between", "PULocationID BETWEEN 1 AND 20", "PULocationID BETWEEN 1 AND 20")
_where(
    "f6_half_open_range",
    "tpep_pickup_datetime >= TIMESTAMP '1997-01-01' AND tpep_pickup_datetime < TIMESTAMP '1998-01-01'",
    "tpep_pickup_datetime >= '1997-01-01' AND tpep_pickup_datetime < '1998-01-01'",
)
_where("f7_column_to_column", "tpep_dropoff_datetime > tpep_pickup_datetime", "tpep_dropoff_datetime > tpep_pickup_datetime")
_where(
    "f8_between_or_null",
    "payment_type BETWEEN 1 AND 4 OR payment_type IS NULL",
    "payment_type BETWEEN 1 AND 4 OR payment_type IS NULL",
)


@query(
    "f9_not_all_rules_three_valued",
    """SELECT tpep_pickup_datetime, fare_amount, NOT (tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND tpep_dropoff_datetime > tpep_pickup_datetime AND tpep_pickup_datetime >= TIMESTAMP '1996-01-01'
    AND tpep_pickup_datetime < TIMESTAMP '2001-01-01' AND fare_amount > 0 AND total_amount > 0 AND trip_distance >= 0
    AND PULocationID BETWEEN 1 AND 265 AND DOLocationID BETWEEN 1 AND 265
    AND (payment_type BETWEEN 1 AND 6 OR payment_type IS NULL)) AS flag FROM typed_trips""",
)
def _(d):
    return d.trips.select("tpep_pickup_datetime", "fare_amount", fails_any(RULES, strict_null=True).alias("flag"))


@query("f10_text_condition_on_boolean", "SELECT * FROM flagged_trips WHERE is_quarantined")
def _(d):
    return d.flagged.where("is_quarantined = true")


@query(
    "f11_split_by_boolean",
    """SELECT *, 'delete' AS side FROM new_batch WHERE _is_deleted
UNION ALL SELECT *, 'upsert' AS side FROM new_batch WHERE NOT _is_deleted""",
)
def _(d):
    deletes, upserts = split_deletes(d.new_batch)
    return deletes.withColumn("side", F.lit("delete")).unionByName(upserts.withColumn("side", F.lit("upsert")))


def hourly_store(d, label: str):
    """Shop events stored under one folder per hour, with integer partition columns."""
    path = d.scratch(label)
    parts = c.hour_parts(F.col("event_time"))
    d.store.withColumns(parts).hint("rebalance", "year", "month", "day").write.partitionBy(*parts).parquet(path)
    return d.spark.read.parquet(path)


HOUR_SQL = "year(event_time) = 2024 AND month(event_time) = 1 AND day(event_time) = 15 AND hour(event_time) = 13"


@query(
    "f12_partition_predicate",
    f"SELECT *, 2024 AS year, 1 AS month, 15 AS day, 13 AS hour FROM silver_store WHERE {HOUR_SQL}",
)
def _(d):
    return in_hour(hourly_store(d, "f12"), datetime(2024, 1, 15, 13))


_where("f13_null_or_not_positive", "fare_amount IS NULL OR fare_amount <= 0", "fare_amount IS NULL OR fare_amount <= 0")


@query(
    "f14_any_tracked_column_differs",
    """SELECT s.customerID, s.city, s.email_address FROM day_two s JOIN day_one t ON s.customerID = t.customerID
WHERE s.city <> t.city OR s.email_address <> t.email_address""",
)
def _(d):
    current = d.history_one.where("is_current")
    changed = changed_rows(current, d.day_two, ["customerID"], ["city", "email_address"], null_safe=False)
    return changed.select("customerID", "city", "email_address")


@query(
    "f15_oldest_row_of_key",
    "SELECT * FROM silver_transactions WHERE customerID = 7 ORDER BY _ingestion_timestamp, transactionID LIMIT 1",
)
def _(d):
    return d.transactions.where(F.col("customerID") == 7).orderBy("_ingestion_timestamp", "transactionID").limit(1)


# -- scalar functions -------------------------------------------------------------------------


@query(
    "c1_casts",
    """SELECT transactionID AS raw_id, TRY_CAST(transactionID AS BIGINT) AS as_bigint, TRY_CAST(quantity AS INT) AS as_int,
    TRY_CAST(totalPrice AS DOUBLE) AS as_double, CAST(TRY_CAST(customerID AS BIGINT) AS VARCHAR) AS as_string,
    TRY_CAST(CASE WHEN _is_deleted THEN 'true' ELSE 'false' END AS BOOLEAN) AS as_boolean,
    TRY_CAST(_ingestion_timestamp AS TIMESTAMP) AS as_timestamp FROM sales_transactions""",
)
def _(d):
    flag = F.when(F.col("_is_deleted"), "true").otherwise("false")
    return d.view("sales_transactions").select(
        F.col("transactionID").alias("raw_id"),
        F.col("transactionID").try_cast("bigint").alias("as_bigint"),
        F.col("quantity").try_cast("int").alias("as_int"),
        F.col("totalPrice").try_cast("double").alias("as_double"),
        F.col("customerID").try_cast("bigint").cast("string").alias("as_string"),
        flag.try_cast("boolean").alias("as_boolean"),
        F.col("_ingestion_timestamp").try_cast("timestamp").alias("as_timestamp"),
    )


@query("c2_digits_only", "SELECT phone_number, regexp_replace(phone_number, '[^0-9]', '', 'g') AS digits FROM sales_customers")
def _(d):
    return d.view("sales_customers").select("phone_number", c.digits_only(F.col("phone_number")).alias("digits"))


@query("c3_full_name", "SELECT customerID, concat_ws(' ', first_name, last_name) AS full_name FROM silver_customers")
def _(d):
    return d.customers.select("customerID", c.full_name("first_name", "last_name").alias("full_name"))


@query(
    "c4_payment_label",
    """SELECT payment_type, CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
    WHEN 4 THEN 'Dispute' ELSE 'Unknown' END AS label, count(*) AS n FROM typed_trips GROUP BY 1, 2""",
)
def _(d):
    label = c.payment_label(F.col("payment_type")).alias("label")
    return d.trips.groupBy("payment_type", label).agg(F.count("*").alias("n"))


@query(
    "c5_guarded_percent",
    """SELECT transactionID, CASE WHEN quantity % 3 > 0 THEN floor(CAST(unitPrice AS DOUBLE) / (quantity % 3) * 100 * 100.0 + 0.5) / 100.0 END AS pct
FROM silver_transactions""",
)
def _(d):
    return d.transactions.select(
        "transactionID", guarded_percent(F.col("unitPrice"), F.col("quantity") % 3, CENTS).alias("pct")
    )


@query("c6_brand_tier", "SELECT brand, brand_tier FROM brand_rows")
def _(d):
    return d.store.where("brand IS NOT NULL").select("brand", c.brand_tier(F.col("brand")).alias("brand_tier")).distinct()


@query(
    "c7_round",
    """SELECT l_orderkey, l_extendedprice, CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)), 1) AS DOUBLE) AS one_digit,
    CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)), 0) AS DOUBLE) AS whole FROM lineitem""",
)
def _(d):
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return d.base("lineitem").select(
        "l_orderkey",
        "l_extendedprice",
        F.round(price, 1).cast("double").alias("one_digit"),
        F.round(price, 0).cast("double").alias("whole"),
    )


@query("c8_nullif_zero", "SELECT l_orderkey, l_discount, nullif(l_discount, 0) AS divisor FROM lineitem")
def _(d):
    return d.base("lineitem").select(
        "l_orderkey", "l_discount", F.nullif(F.col("l_discount"), F.lit(0.0)).alias("divisor")
    )


@query(
    "c9_arithmetic",
    """SELECT l_orderkey, l_extendedprice * (1 - l_discount) AS net, l_extendedprice - l_tax AS less_tax,
    l_extendedprice / nullif(l_discount, 0) AS ratio FROM lineitem""",
)
def _(d):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return d.base("lineitem").select(
        "l_orderkey",
        (price * (1 - discount)).alias("net"),
        (price - F.col("l_tax")).alias("less_tax"),
        safe_ratio(price, discount).alias("ratio"),
    )


@query(
    "c10_literals",
    "SELECT o_orderkey, FALSE AS flag, 'fixed' AS label, CAST(NULL AS TIMESTAMP) AS ends, 42 AS number FROM orders",
)
def _(d):
    return d.base("orders").select(
        "o_orderkey",
        F.lit(False).alias("flag"),
        F.lit("fixed").alias("label"),
        F.lit(None).cast("timestamp").alias("ends"),
        F.lit(42).alias("number"),
    )


@query(
    "c11_sql_expression",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'large' ELSE lower(o_orderpriority) END AS class FROM orders",
)
def _(d):
    return d.base("orders").select(
        "o_orderkey",
        F.expr("CASE WHEN o_totalprice > 200000 THEN 'large' ELSE lower(o_orderpriority) END").alias("class"),
    )


@query(
    "d1_to_d4_time_fields",
    """SELECT event_time, hour(event_time)::INT AS hour, (dayofweek(event_time) + 1)::INT AS day_of_week, dayname(event_time) AS day_name,
    month(event_time)::INT AS month FROM silver_store""",
)
def _(d):
    time = F.col("event_time")
    return d.store.select(
        time,
        F.hour(time).alias("hour"),
        F.dayofweek(time).alias("day_of_week"),
        F.date_format(time, "EEEE").alias("day_name"),
        F.month(time).alias("month"),
    )


@query(
    "d5_minutes_between",
    """SELECT tpep_pickup_datetime, tpep_dropoff_datetime,
    round((epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60, 1) AS minutes FROM typed_trips""",
)
def _(d):
    start, end = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    return d.trips.select(start, end, c.minutes_between(start, end, CENTS).alias("minutes"))


@query("d6_current_time", "SELECT user_id, TRUE AS one_moment_per_query FROM (SELECT DISTINCT user_id FROM silver_store)")
def _(d):
    stamped = d.store.select("user_id", F.current_timestamp().alias("now"))
    return stamped.groupBy("user_id").agg((F.min("now") == F.max("now")).alias("one_moment_per_query"))


@query(
    "d7_hour_stamp",
    "SELECT strftime(event_time, '%Y-%m-%d_%H') AS stamp, count(*) AS n FROM silver_store GROUP BY 1",
)
def _(d):
    return d.store.groupBy(c.hour_stamp(F.col("event_time")).alias("stamp")).agg(F.count("*").alias("n"))


@query(
    "d8_parse_utc_text",
    "SELECT event_time AS text, CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) AS time FROM ecommerce_store",
)
def _(d):
    return d.view("ecommerce_store").select(
        F.col("event_time").alias("text"), F.col("event_time").try_cast("timestamp").alias("time")
    )


@query(
    "d9_hour_parts",
    """SELECT event_time, year(event_time)::INT AS year, month(event_time)::INT AS month, day(event_time)::INT AS day,
    hour(event_time)::INT AS hour FROM silver_store""",
)
def _(d):
    return d.store.select("event_time").withColumns(c.hour_parts(F.col("event_time")))


@query("d10_batch_id", "SELECT count(*) AS rows, 1::BIGINT AS batch_ids FROM orders")
def _(d):
    loaded = t.add_lineage(d.base("orders"), datetime.fromisoformat(AS_OF), "orders", str(uuid.uuid4()))
    return loaded.agg(F.count("*").alias("rows"), F.count_distinct("_batch_id").alias("batch_ids"))
