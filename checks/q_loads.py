"""Sources, sinks, merges, incremental loads, history and time travel (S, K, I, X)."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from checks.domain import AS_OF, CHANGE_KEYS
from checks.q_analytics import BOROUGH_SQL, BRAND_SQL, CENTS, PATTERN_SQL, ROUTE_SQL, SUMMARY_SQL, silver_shop
from checks.q_transforms import HOUR_SQL, hourly_store
from checks.registry import query
from stratalake.functions.columns import hour_parts
from stratalake.operators import incremental as inc
from stratalake.operators import merge as m
from stratalake.operators import scd2
from stratalake.operators import transforms as t
from stratalake.operators.dedup import latest_per_key, latest_per_key_sql
from stratalake.plans.brands import brand_analysis
from stratalake.plans.gold import SalesSummary
from stratalake.plans.layers import CUSTOMER_HISTORY, SALES_LOADS, STORE_LOADS, USER_HISTORY, Lakehouse
from stratalake.plans.sales import customer_sales_summary
from stratalake.plans.trips import revenue_by_borough, trip_summary, trip_time_patterns, vendor_stats
from stratalake.sources import readers, writers
from stratalake.sources.catalog import save_table
from stratalake.sources.snapshots import SnapshotTable

DAYS = [datetime(2024, 3, 1) + timedelta(days=n) for n in range(6)]
KEY = ["customerID"]
TRACKED = ["city", "email_address"]
OLD = "_ingestion_timestamp < TIMESTAMP '2024-01-03 00:00:00'"
NEW = "_ingestion_timestamp >= TIMESTAMP '2024-01-03 00:00:00'"


# -- sources ----------------------------------------------------------------------------------


@query("s1_json_as_text", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, o_custkey::VARCHAR AS o_custkey FROM orders")
def _(d):
    path = d.scratch("s1")
    d.base("orders").select("o_orderkey", "o_orderstatus", "o_custkey").write.json(path)
    return readers.json_as_text(d.spark, path)


@query("s1_json_declared_columns", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, NULL::VARCHAR AS clerk, o_totalprice::BIGINT::VARCHAR AS price FROM orders")
def _(d):
    """Read in one pass; a column that no file has is NULL."""
    path = d.scratch("s1d")
    d.base("orders").select("o_orderkey", "o_orderstatus", F.expr("cast(bround(o_totalprice) as bigint)").alias("price")).write.json(path)
    return readers.json_as_text(d.spark, path, ["o_orderkey", "o_orderstatus", "clerk", "price"])


@query("s2_csv_as_text", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def _(d):
    path = d.scratch("s2")
    d.base("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.option("header", True).csv(path)
    return readers.csv_as_text(d.spark, path)


EVENT_NAMES = "event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"


def _event_text(d):
    return d.view("ecommerce_store").select(*EVENT_NAMES.split(", "))


@query(
    "s3_csv_declared",
    """SELECT event_time, event_type, TRY_CAST(product_id AS BIGINT) AS product_id, TRY_CAST(category_id AS BIGINT) AS category_id,
    category_code, brand, TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(user_id AS BIGINT) AS user_id, user_session
FROM ecommerce_store""",
)
def _(d):
    path = d.scratch("s3")
    _event_text(d).write.option("header", True).csv(path)
    return readers.csv_declared(d.spark, path)


@query("s4_csv_inferred_lookup", "SELECT * FROM zones")
def _(d):
    path = d.scratch("s4")
    d.zone_file.write.option("header", True).csv(path)
    return t.zone_dimension(readers.csv_inferred(d.spark, path))


@query("s5_parquet_glob", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(d):
    return readers.parquet_files(d.spark, f"{d.sf_dir}/order*.parquet").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("s6_catalog_table", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1")
def _(d):
    d.base("part").createOrReplaceTempView("s6_part")
    return readers.table(d.spark, "s6_part").groupBy("p_brand").agg(F.count("*").alias("n"))


@query("s6_created_table_by_name", "SELECT p_brand, p_type, count(*) AS n, sum(p_size) AS total_size FROM part GROUP BY ALL")
def _(d):
    """A table made from a query, read by its name in SQL."""
    path = d.scratch("s6")
    name = f"part_{path.rsplit('-', 1)[1]}"
    save_table(d.base("part").select("p_brand", "p_type", F.col("p_size").cast("bigint").alias("p_size")), name, path)
    return d.spark.sql(f"SELECT p_brand, p_type, count(*) AS n, sum(p_size) AS total_size FROM {name} GROUP BY p_brand, p_type")


@query("k2_create_or_replace_catalog_table", "SELECT * EXCLUDE (s_acctbal), s_acctbal > 0 AS solvent FROM supplier")
def _(d):
    """Created twice: the second query replaces rows and columns."""
    path = d.scratch("k2c")
    name = f"supplier_{path.rsplit('-', 1)[1]}"
    save_table(d.base("supplier"), name, f"{path}/1", 4, ["s_suppkey"])
    return save_table(d.base("supplier").withColumn("solvent", F.col("s_acctbal") > 0).drop("s_acctbal"), name, f"{path}/2", 4, ["s_suppkey"])


def _versions(d, label: str) -> SnapshotTable:
    """A table of three versions: created, appended to, merged into."""
    table = SnapshotTable(d.spark, d.scratch(label), ["transactionID"], buckets=4)
    rows = d.transactions
    table.overwrite(rows.where("paymentMethod = 'visa'"), DAYS[0], "create")
    table.append(rows.where("paymentMethod <> 'visa' AND product <> '1-URGENT'"), DAYS[1])
    fixed = rows.where("product = '1-URGENT'").withColumn("product", F.lit("fixed"))
    table.merge(fixed, lambda target, source: m.merge_replace(target, source, ["transactionID"]), DAYS[2])
    return table


V1_SQL = "SELECT * FROM silver_transactions WHERE paymentMethod = 'visa' OR product <> '1-URGENT'"
V2_SQL = "SELECT * REPLACE (CASE WHEN product = '1-URGENT' THEN 'fixed' ELSE product END AS product) FROM silver_transactions"


@query("s9_read_version", V1_SQL)
def _(d):
    return _versions(d, "s9").read(version=1)


@query("s9_read_newest", V2_SQL)
def _(d):
    return _versions(d, "s9").read()


@query("s10_read_as_of_time", V1_SQL)
def _(d):
    return _versions(d, "s10").read(as_of=DAYS[1] + timedelta(hours=5))


@query("s11_version_in_sql", f"SELECT count(*) AS n FROM ({V1_SQL})")
def _(d):
    _versions(d, "s11").register("s11_before", version=1)
    return d.spark.sql("SELECT count(*) AS n FROM s11_before")


@query(
    "s12_newest_history",
    f"""SELECT * FROM (VALUES (2::BIGINT, TIMESTAMP '2024-03-03', 'merge'), (1::BIGINT, TIMESTAMP '2024-03-02', 'append'))
    v(version, timestamp, operation), (SELECT count(*) AS total_rows FROM ({V2_SQL}))""",
)
def _(d):
    table = _versions(d, "s12")
    total = table.read().count()
    return table.newest_versions(2).select("version", "timestamp", "operation", F.lit(total).alias("total_rows"))


@query(
    "s13_hours_without_data",
    """WITH seen AS (SELECT date_trunc('hour', event_time) AS h FROM silver_store WHERE event_type = 'purchase'),
every AS (SELECT unnest(generate_series((SELECT min(date_trunc('hour', event_time)) FROM silver_store), (SELECT max(event_time) FROM silver_store), INTERVAL 1 HOUR)) AS h)
SELECT year(h)::INT AS year, month(h)::INT AS month, day(h)::INT AS day, hour(h)::INT AS hour FROM every WHERE h NOT IN (SELECT h FROM seen WHERE h IS NOT NULL)""",
)
def _(d):
    """Hours without a purchase, of all hours between the first and the last event."""
    time = F.date_trunc("hour", F.col("event_time"))
    bounds = d.store.agg(F.min(time).alias("first"), F.max(time).alias("last"))
    expected = bounds.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 HOUR"))).alias("moment"))
    expected = expected.select(*[part.alias(name) for name, part in hour_parts(F.col("moment")).items()])
    return readers.missing_hours(t.extract_purchases(d.store).withColumns(hour_parts(F.col("event_time"))), expected)


@query("s13_hour_gate", f"SELECT count(*) > 0 AS present, FALSE AS absent FROM silver_store WHERE {HOUR_SQL}")
def _(d):
    hourly = hourly_store(d, "s13")
    present = readers.hour_available(hourly, datetime(2024, 1, 15, 13))
    absent = readers.hour_available(hourly, datetime(2024, 6, 15, 13))
    return d.store.limit(1).select(F.lit(present).alias("present"), F.lit(absent).alias("absent"))


@query(
    "s14_rows_in_code",
    "SELECT o_orderstatus, label, count(*) AS n FROM orders LEFT JOIN (VALUES ('O', 'open'), ('F', 'filled')) v(status, label) ON o_orderstatus = status GROUP BY 1, 2",
)
def _(d):
    labels = readers.rows(d.spark, [("O", "open"), ("F", "filled")], "o_orderstatus string, label string")
    return d.base("orders").join(labels, "o_orderstatus", "left").groupBy("o_orderstatus", "label").agg(F.count("*").alias("n"))


@query("s15_table_exists", "SELECT FALSE AS before, TRUE AS after, count(*) AS n FROM orders")
def _(d):
    table = SnapshotTable(d.spark, d.scratch("s15"))
    before = table.exists()
    table.append(d.base("orders"), DAYS[0])
    return table.read().agg(F.lit(before).alias("before"), F.lit(table.exists()).alias("after"), F.count("*").alias("n"))


@query("s16_missing_source", "SELECT count(*) AS n, TRUE AS reported FROM orders")
def _(d):
    try:
        readers.table(d.spark, "no_such_source")
        reported = False
    except readers.MissingSourceError:
        reported = True
    return d.base("orders").agg(F.count("*").alias("n"), F.lit(reported).alias("reported"))


@query("s17_source_file", "SELECT 'orders.parquet' AS file, count(*) AS n FROM orders")
def _(d):
    named = readers.with_source_file(d.base("orders"))
    return named.groupBy(F.substring_index("_source_file", "/", -1).alias("file")).agg(F.count("*").alias("n"))


# -- sinks ------------------------------------------------------------------------------------


@query("k1_json_export", "SELECT * FROM zone_file")
def _(d):
    path = writers.json_snapshot(d.zone_file, d.scratch("k1"), "zones", datetime(2024, 1, 15, 13))
    return d.spark.read.schema(d.zone_file.schema).json(path)


@query("k2_create_table", "SELECT * FROM silver_suppliers")
def _(d):
    table = SnapshotTable(d.spark, d.scratch("k2"), ["supplierID"], buckets=4)
    table.overwrite(t.prepare_sales_suppliers(d.view("sales_suppliers")), DAYS[0], "create")
    return table.read()


@query(
    "k3_append_with_new_column",
    """SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, CAST(NULL AS VARCHAR), o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""",
)
def _(d):
    table = SnapshotTable(d.spark, d.scratch("k3"))
    orders = d.base("orders")
    table.append(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"), DAYS[0])
    table.append(orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority"), DAYS[1])
    return table.read()


@query("k4_append", "SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_size > 25")
def _(d):
    path = d.scratch("k4")
    writers.append_files(d.base("part"), path)
    writers.append_files(d.base("part").where("p_size > 25"), path)
    return d.spark.read.parquet(path)


MERGED = """
SELECT o.* FROM old_state o LEFT JOIN (SELECT * FROM new_batch WHERE _is_deleted IS NOT NULL) n
    ON o.order_id = n.order_id AND o.line_no = n.line_no WHERE n.order_id IS NULL
UNION ALL SELECT * FROM new_batch WHERE NOT _is_deleted"""


@query("k5_merge_upsert_delete", MERGED)
def _(d):
    return m.merge_upsert(d.old_state, d.new_batch, CHANGE_KEYS)


@query("k5_merge_into_table", MERGED)
def _(d):
    table = SnapshotTable(d.spark, d.scratch("k5"), CHANGE_KEYS, buckets=8)
    table.overwrite(d.old_state, DAYS[0], "create")
    table.merge(d.new_batch, lambda target, source: m.merge_upsert(target, source, CHANGE_KEYS), DAYS[1])
    return table.read()


@query(
    "k6_merge_replace",
    """SELECT o.* FROM old_state o WHERE NOT EXISTS
    (SELECT 1 FROM new_batch n WHERE o.order_id = n.order_id AND o.line_no = n.line_no)
UNION ALL SELECT * FROM new_batch""",
)
def _(d):
    return m.merge_replace(d.old_state, d.new_batch, CHANGE_KEYS)


@query(
    "k7_update_matched",
    """SELECT h.* REPLACE (CASE WHEN is_current AND n.customerID IS NOT NULL THEN TIMESTAMP '2024-02-02' ELSE effective_to END AS effective_to,
    CASE WHEN is_current AND n.customerID IS NOT NULL THEN FALSE ELSE is_current END AS is_current)
FROM history_one h LEFT JOIN (SELECT DISTINCT customerID FROM day_two WHERE continent = 'AFRICA') n ON h.customerID = n.customerID""",
)
def _(d):
    return m.update_matched(
        d.history_one,
        d.day_two.where("continent = 'AFRICA'"),
        KEY,
        F.col("is_current"),
        {"effective_to": F.lit(AS_OF).cast("timestamp"), "is_current": F.lit(False)},
    )


@query("k8_discard", "SELECT count(*) AS n FROM lineitem")
def _(d):
    writers.discard(d.base("lineitem"))
    return d.base("lineitem").agg(F.count("*").alias("n"))


@query(
    "k9_hourly_csv",
    f"""SELECT {EVENT_NAMES}, year(t)::INT AS year, month(t)::INT AS month, day(t)::INT AS day, hour(t)::INT AS hour
FROM (SELECT *, CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) AS t FROM ecommerce_store)""",
)
def _(d):
    path = d.scratch("k9")
    writers.hourly_csv(_event_text(d), path)
    again = _event_text(d).where("event_time LIKE '2024-01-15%'")
    writers.hourly_csv(again, path)  # replaces that day only
    names = ", ".join(f"{c} string" for c in EVENT_NAMES.split(", "))
    return readers.csv_declared(d.spark, path, f"{names}, year int, month int, day int, hour int")


@query("k11_materialized_refresh", "SELECT VendorID, count(*) AS num_trips FROM typed_trips GROUP BY VendorID")
def _(d):
    house = Lakehouse(d.spark, d.scratch("k11"))
    house.materialize("gold.vendors", lambda: vendor_stats(d.trips.where("VendorID = 1"), CENTS), DAYS[0])
    house.materialize("gold.vendors", lambda: vendor_stats(d.trips, CENTS), DAYS[1])
    return house.source("gold.vendors").select("VendorID", "num_trips")


@query("k12_staging_by_flag", "SELECT is_quarantined, count(*) AS n FROM flagged_trips GROUP BY 1")
def _(d):
    path = d.scratch("k12")
    writers.flag_partitioned(d.flagged, path)
    return d.spark.read.schema(d.flagged.schema).parquet(path).groupBy("is_quarantined").agg(F.count("*").alias("n"))


@query("k13_show", "SELECT franchiseID, count(*) AS n FROM silver_transactions GROUP BY 1")
def _(d):
    per_franchise = d.transactions.groupBy("franchiseID").agg(F.count("*").alias("n"))
    writers.show(per_franchise, 5)
    return per_franchise


@query(
    "k14_merge_audit",
    """SELECT (SELECT count(*) FROM changes WHERE changed_at >= TIMESTAMP '1999-01-01') AS slice_rows, count(*) AS batch_rows,
    count(*) FILTER (WHERE NOT _is_deleted) AS upserts, count(*) FILTER (WHERE _is_deleted) AS deletes FROM new_batch""",
)
def _(d):
    table = SnapshotTable(d.spark, d.scratch("k14"), CHANGE_KEYS, buckets=4)
    table.overwrite(d.old_state, DAYS[0], "create")
    in_slice = d.changes.where("changed_at >= '1999-01-01'").count()
    audit = {"slice_rows": in_slice, **m.merge_audit(d.new_batch).first().asDict()}
    table.merge(d.new_batch, lambda target, source: m.merge_upsert(target, source, CHANGE_KEYS), DAYS[1], metrics=audit)
    stored = table.newest_versions(1)
    return stored.select(*[F.col("metrics")[name].alias(name) for name in audit])


# -- incremental loads ------------------------------------------------------------------------


def _bronze_store(d):
    return d.view("ecommerce_store").withColumn("_ingestion_timestamp", F.col("_ingestion_timestamp").cast("timestamp"))


@query(
    "i1_ingest_with_lineage",
    f"""SELECT {EVENT_NAMES}, TIMESTAMP '2024-03-01' AS _ingestion_timestamp, 'landing/a' AS _source_file, 'a' AS _batch_id, FALSE AS _is_deleted FROM ecommerce_store
UNION ALL SELECT {EVENT_NAMES}, TIMESTAMP '2024-03-02', 'landing/b', 'b', FALSE FROM ecommerce_store WHERE event_type = 'view'""",
)
def _(d):
    house, path = Lakehouse(d.spark, d.scratch("i1")), d.scratch("i1-files")
    _event_text(d).write.option("header", True).csv(f"{path}/a")
    _event_text(d).where("event_type = 'view'").write.option("header", True).csv(f"{path}/b")
    for n, name in enumerate("ab"):
        house.ingest_files(f"{path}/{name}", "bronze.events", "csv", as_of=DAYS[n], batch_id=name)
    return house.source("bronze.events").withColumn(
        "_source_file", F.concat(F.lit("landing/"), F.substring_index("_source_file", "/", -1))
    )


@query("i2_newer_than_watermark", "SELECT * FROM silver_store WHERE _ingestion_timestamp > (SELECT max(_ingestion_timestamp) FROM silver_store WHERE event_type = 'view' AND _ingestion_timestamp < TIMESTAMP '2024-01-04')")
def _(d):
    loaded = d.store.where("event_type = 'view' AND _ingestion_timestamp < '2024-01-04'")
    return inc.select_slice(d.store, loaded)


@query("i3_bounded_backfill", "SELECT * FROM silver_store WHERE _ingestion_timestamp > TIMESTAMP '2024-01-02' AND _ingestion_timestamp < TIMESTAMP '2024-01-04'")
def _(d):
    return inc.select_slice(d.store, d.store, "2024-01-02", "2024-01-04")


@query(
    "i3_backfill_load",
    """WITH loaded AS (SELECT * FROM silver_store WHERE event_type = 'view'),
again AS (SELECT * REPLACE ('again' AS category_code) FROM silver_store WHERE _ingestion_timestamp > TIMESTAMP '2024-01-02' AND _ingestion_timestamp < TIMESTAMP '2024-01-04'),
latest AS (SELECT user_id, user_session, event_type, event_time, max(_ingestion_timestamp) AS t FROM again GROUP BY ALL)
SELECT user_id, user_session, event_type, event_time, any_value(kind) AS kind FROM (
    SELECT user_id, user_session, event_type, event_time, 'again' AS kind FROM latest
    UNION ALL SELECT user_id, user_session, event_type, event_time, 'loaded' FROM loaded l WHERE NOT EXISTS (SELECT 1 FROM latest a
        WHERE a.user_id = l.user_id AND a.user_session = l.user_session AND a.event_type = l.event_type AND a.event_time = l.event_time)) GROUP BY ALL""",
)
def _(d):
    """Views are loaded; then all events of two days come again, corrected, through the bounded load of the same job."""
    house, job = Lakehouse(d.spark, d.scratch("i3b"), buckets=4), STORE_LOADS[0]
    bronze, events = house.table("bronze.ecommerce_store"), _timed(d, "ecommerce_store").withColumn("_is_deleted", F.lit(False))
    bronze.append(events.where("event_type = 'view'"), DAYS[0])
    house.load(job, as_of=DAYS[0], validate_first=True)
    bronze.append(events.withColumn("category_code", F.lit("z again")), DAYS[1])  # greater text wins a tie
    house.load(job, "2024-01-02", "2024-01-04", as_of=DAYS[1], validate_first=True)
    kind = F.when(F.col("category_code") == "z again", "again").otherwise("loaded")
    return house.source(job.target).select("user_id", "user_session", "event_type", "event_time", kind.alias("kind"))


@query("i4_first_run_loads_all", "SELECT * FROM silver_store")
def _(d):
    return inc.select_slice(d.store, None)


@query("i5_empty_slice_is_skipped", "SELECT 0::BIGINT AS version, TRUE AS skipped, count(*) AS n FROM silver_suppliers WHERE NOT _is_deleted")
def _(d):
    house = Lakehouse(d.spark, d.scratch("i5"), buckets=4)
    house.table("bronze.sales_suppliers").append(_timed(d, "sales_suppliers"), DAYS[0])
    job = SALES_LOADS[2]
    house.load(job, as_of=DAYS[0])
    skipped = house.load(job, as_of=DAYS[1]) is None
    version = house.table(job.target).version()
    return house.source(job.target).agg(
        F.lit(version).cast("bigint").alias("version"), F.lit(skipped).alias("skipped"), F.count("*").alias("n")
    )


def _timed(d, name: str):
    return d.view(name).withColumn("_ingestion_timestamp", F.col("_ingestion_timestamp").cast("timestamp"))


STORE_KEYS = ["user_id", "user_session", "event_type", "event_time"]
_LATEST_TEXT = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, user_session, event_type
    ORDER BY _ingestion_timestamp DESC, event_time DESC, product_id DESC NULLS LAST) AS rn FROM ecommerce_store) WHERE rn = 1)"""


@query(
    "i6_dedup_before_validation",
    f"""SELECT event_time, event_type, user_session, price FROM (
    SELECT CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) AS event_time, event_type, user_session, user_id, TRY_CAST(price AS DOUBLE) AS price FROM {_LATEST_TEXT})
WHERE user_id IS NOT NULL AND price > 0""",
)
def _(d):
    def dedup(rows, keys, order_by):
        return latest_per_key(rows, keys, order_by, ["event_time", "product_id"])

    prepared = inc.prepare_slice(
        d.view("ecommerce_store"), ["user_id", "user_session", "event_type"], t.process_data, dedup=dedup
    )
    return prepared.select("event_time", "event_type", "user_session", "price")


@query(
    "i6_validation_before_dedup",
    """SELECT event_time, event_type, user_session, price FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, user_session, event_type
    ORDER BY _ingestion_timestamp DESC, event_time DESC, product_id DESC NULLS LAST) AS rn FROM silver_store) WHERE rn = 1""",
)
def _(d):
    def dedup(rows, keys, order_by):
        return latest_per_key(rows, keys, order_by, ["event_time", "product_id"])

    prepared = inc.prepare_slice(
        d.view("ecommerce_store"), ["user_id", "user_session", "event_type"], t.process_data, validate_first=True, dedup=dedup
    )
    return prepared.select("event_time", "event_type", "user_session", "price")


@query("i7_first_load_without_deletes", "SELECT * FROM silver_transactions WHERE NOT _is_deleted")
def _(d):
    house = Lakehouse(d.spark, d.scratch("i7"), buckets=4)
    house.table("bronze.sales_transactions").append(_timed(d, "sales_transactions"), DAYS[0])
    house.load(SALES_LOADS[3], as_of=DAYS[0])
    return house.source("silver.sales_transactions")


LOADED_TWICE = """
WITH versions AS (
    SELECT * FROM silver_customers
    UNION ALL SELECT * REPLACE (coalesce(city, '') || ' new' AS city, TIMESTAMP '2024-02-10' AS _ingestion_timestamp, gender = 'female' AS _is_deleted)
        FROM silver_customers WHERE state = 'BUILDING'),
latest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customerID ORDER BY _ingestion_timestamp DESC) AS rn FROM versions) WHERE rn = 1)
SELECT * EXCLUDE (rn) FROM latest WHERE NOT _is_deleted"""


def _loaded_twice(d, label: str, **options):
    """All customers, also those without a number, in two deliveries; the second also changes and deletes earlier ones."""
    house = Lakehouse(d.spark, d.scratch(label), buckets=4)
    bronze, rows = house.table("bronze.sales_customers"), _timed(d, "sales_customers")
    bronze.append(rows.where("_ingestion_timestamp < '2024-01-03'"), DAYS[0])
    house.load(SALES_LOADS[0], as_of=DAYS[0], **options)
    second = rows.where("state = 'BUILDING'").withColumns(
        {
            "city": F.concat(F.coalesce("city", F.lit("")), F.lit(" new")),
            "_ingestion_timestamp": F.lit("2024-02-10").cast("timestamp"),
            "_is_deleted": F.col("gender") == "female",
        }
    )
    bronze.append(rows.where("_ingestion_timestamp >= '2024-01-03'").unionByName(second), DAYS[1])
    house.load(SALES_LOADS[0], as_of=DAYS[1], **options)
    return house


@query("i8_incremental_load", LOADED_TWICE)
def _(d):
    return _loaded_twice(d, "i8").source("silver.sales_customers")


@query("i8_incremental_load_sql_dedup", LOADED_TWICE)
def _(d):
    return _loaded_twice(d, "i8s", dedup=latest_per_key_sql).source("silver.sales_customers")


@query(
    "i9_ordered_loads",
    """SELECT 'ecommerce_store' AS name, count(*) AS n FROM s UNION ALL
SELECT 'ecommerce_brands', count(DISTINCT brand) FROM s UNION ALL
SELECT 'ecommerce_users', count(*) FROM (SELECT DISTINCT user_id, user_session FROM s) UNION ALL
SELECT 'ecommerce_purchases', count(*) FROM (SELECT DISTINCT user_id, user_session, event_time FROM s WHERE event_type = 'purchase') UNION ALL
SELECT 'ecommerce_views', count(*) FROM (SELECT DISTINCT user_id, user_session, event_time FROM s WHERE event_type = 'view') UNION ALL
SELECT 'ecommerce_carts', count(*) FROM (SELECT DISTINCT user_id, user_session, event_time FROM s WHERE event_type = 'cart')""".replace(
        " s ", " (SELECT * FROM silver_store WHERE NOT _is_deleted) s "
    ).replace(" s)", " (SELECT * FROM silver_store WHERE NOT _is_deleted) s)"),
)
def _(d):
    house = Lakehouse(d.spark, d.scratch("i9"), buckets=4)
    house.table("bronze.ecommerce_store").append(_bronze_store(d), DAYS[0])
    house.load_all(STORE_LOADS, as_of=DAYS[0])
    counts = [
        house.source(job.target).agg(F.lit(job.target.split(".")[1]).alias("name"), F.count("*").alias("n"))
        for job in STORE_LOADS
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


@query("i10_gold_refresh", SUMMARY_SQL)
def _(d):
    """A refresh over part of the customers, then over all of them."""
    house = Lakehouse(d.spark, d.scratch("i10"), buckets=4)
    for n, customers in enumerate([d.customers.where("gender = 'male'"), d.customers]):
        house.refresh(
            "gold.customer_sales_summary",
            KEY,
            lambda rows=customers: customer_sales_summary(rows, d.transactions, AS_OF, math=CENTS),
            DAYS[n],
        )
    return house.source("gold.customer_sales_summary")


@query("i10_brand_analysis_refresh", BRAND_SQL)
def _(d):
    """Brand analysis merged by brand: first from the views, carts and purchases of some brands, then from all."""
    house, shop = Lakehouse(d.spark, d.scratch("i10b"), buckets=4), silver_shop(d)
    some = {name: rows.where("brand LIKE 's%'") for name, rows in shop.items()}
    for n, tables in enumerate((some, shop)):
        house.refresh("gold.brand_analysis", ["brand"], lambda t=tables: brand_analysis(**t, math=CENTS), DAYS[n])
    return house.source("gold.brand_analysis")


def _register_report(name: str, sql: str, build) -> None:
    @query(f"k11_{name}_materialized", sql)
    def _(d):
        """Replaced as a whole: the first version holds one vendor's trips only."""
        house = Lakehouse(d.spark, d.scratch(f"k11-{name}"))
        for n, trips in enumerate((d.clean_trips.where("VendorID = 1"), d.clean_trips)):
            house.materialize(f"gold.{name}", lambda rows=trips: build(rows, d.zones), DAYS[n])
        return house.source(f"gold.{name}")


_register_report("revenue_by_borough", BOROUGH_SQL, lambda t, z: revenue_by_borough(t, z, CENTS))
_register_report("trip_time_patterns", PATTERN_SQL, lambda t, z: trip_time_patterns(t, CENTS))
_register_report("trip_summary", ROUTE_SQL, lambda t, z: trip_summary(t, z, math=CENTS))


# -- type 2 history ---------------------------------------------------------------------------

DIFFERS = "(s.city IS DISTINCT FROM t.city OR s.email_address IS DISTINCT FROM t.email_address)"
CLOSED_SQL = f"""SELECT t.* REPLACE (CASE WHEN s.customerID IS NOT NULL AND {DIFFERS} THEN TIMESTAMP '{AS_OF}' ELSE t.effective_to END AS effective_to,
    NOT (s.customerID IS NOT NULL AND {DIFFERS}) AS is_current)
FROM day_one t LEFT JOIN day_two s ON s.customerID = t.customerID"""
OPENED_SQL = f"""SELECT s.*, TIMESTAMP '{AS_OF}' AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM day_two s LEFT JOIN day_one t ON s.customerID = t.customerID WHERE t.customerID IS NULL OR {DIFFERS}"""
APPLIED_SQL = f"SELECT * FROM closed_one UNION ALL {CLOSED_SQL} UNION ALL {OPENED_SQL}"


@query("x1_initial_history", f"SELECT *, TIMESTAMP '{AS_OF}' AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current FROM silver_customers")
def _(d):
    return scd2.open_versions(d.customers, AS_OF)


@query("x2_changed_rows", f"SELECT s.* FROM day_two s JOIN day_one t ON s.customerID = t.customerID WHERE {DIFFERS}")
def _(d):
    return scd2.changed_rows(d.history_one.where("is_current"), d.day_two, KEY, TRACKED)


@query("x3_new_or_reopened_keys", "SELECT s.* FROM day_two s WHERE s.customerID NOT IN (SELECT customerID FROM day_one)")
def _(d):
    return scd2.new_rows(d.history_one.where("is_current"), d.day_two, KEY)


@query("x4_close_versions", CLOSED_SQL)
def _(d):
    return scd2.close_versions(d.history_one.where("is_current"), d.day_two, KEY, TRACKED, AS_OF)


@query("x5_open_versions", OPENED_SQL)
def _(d):
    after = scd2.apply_scd2(d.history_one, d.day_two, KEY, TRACKED, AS_OF)
    return after.where(F.col("is_current") & (F.col("effective_from") == F.lit(AS_OF).cast("timestamp")))


@query("x6_apply_history", APPLIED_SQL)
def _(d):
    return scd2.apply_scd2(d.history_one, d.day_two, KEY, TRACKED, AS_OF)


@query("x6_apply_history_not_null_safe", APPLIED_SQL.replace(DIFFERS, "coalesce(s.city <> t.city OR s.email_address <> t.email_address, FALSE)"))
def _(d):
    return scd2.apply_scd2(d.history_one, d.day_two, KEY, TRACKED, AS_OF, null_safe=False)


@query("x6_apply_history_to_table", APPLIED_SQL)
def _(d):
    """Only current rows of touched buckets are rewritten; closed rows are added to their own area."""
    table = SnapshotTable(d.spark, d.scratch("x6"), KEY, buckets=4, append_only=~F.col("is_current"))
    table.overwrite(d.history_one, DAYS[0], "create")
    table.merge(d.day_two, lambda current, source: scd2.apply_scd2(current, source, KEY, TRACKED, AS_OF), DAYS[1], "scd2")
    return table.read()


@query(
    "x7_incremental_history_load",
    """WITH changed AS (
    SELECT * REPLACE ('Ottoline' AS first_name, TIMESTAMP '2024-02-10' AS _ingestion_timestamp) FROM silver_customers WHERE customerID = 20)
SELECT *, TIMESTAMP '2024-03-01' AS effective_from,
    CASE WHEN customerID = 20 THEN TIMESTAMP '2024-03-02' END AS effective_to, customerID <> 20 AS is_current FROM silver_customers
UNION ALL SELECT *, TIMESTAMP '2024-03-02', CAST(NULL AS TIMESTAMP), TRUE FROM changed""",
)
def _(d):
    house = Lakehouse(d.spark, d.scratch("x7"), buckets=4)
    house.table("bronze.sales_customers").append(_timed(d, "sales_customers"), DAYS[0])
    house.load(CUSTOMER_HISTORY, as_of=DAYS[0])
    house.inject("bronze.sales_customers", F.col("customerID") == "20", {"first_name": "Ottoline"}, datetime(2024, 2, 10))
    house.load(CUSTOMER_HISTORY, as_of=DAYS[1])
    return house.source(CUSTOMER_HISTORY.target)


@query(
    "x7_user_history_load",
    "SELECT user_id, count(DISTINCT user_session) > 0 AS has_session, 1::BIGINT AS versions, TRUE AS current FROM silver_store GROUP BY user_id",
)
def _(d):
    """Users twice, the second time newer but with the same attributes: no second version."""
    house = Lakehouse(d.spark, d.scratch("x7u"), buckets=4)
    store = house.table("silver.ecommerce_store")
    store.append(d.store, DAYS[0])
    house.load(USER_HISTORY, as_of=DAYS[0])
    store.append(d.store.withColumn("_ingestion_timestamp", F.lit("2024-02-10").cast("timestamp")), DAYS[1])
    house.load(USER_HISTORY, as_of=DAYS[1])
    return house.source(USER_HISTORY.target).groupBy("user_id").agg(
        (F.count("user_session") > 0).alias("has_session"),
        F.count("*").alias("versions"),
        F.bool_and("is_current").alias("current"),
    )


@query(
    "x7_user_history_of_changes",
    f"""WITH u AS (SELECT DISTINCT user_id FROM silver_store)
SELECT user_id, FALSE AS renamed, TIMESTAMP '{DAYS[0]}' AS effective_from, CASE WHEN user_id % 3 = 0 THEN TIMESTAMP '{DAYS[1]}' END AS effective_to, user_id % 3 <> 0 AS is_current FROM u
UNION ALL SELECT user_id, TRUE, TIMESTAMP '{DAYS[1]}', NULL, TRUE FROM u WHERE user_id % 3 = 0""",
)
def _(d):
    """Every third user comes with another name in the second delivery: the old version ends where the new one begins."""
    house, store = Lakehouse(d.spark, d.scratch("x7c"), buckets=4), d.store
    events = house.table("silver.ecommerce_store")
    events.append(store, DAYS[0])
    house.load(USER_HISTORY, as_of=DAYS[0])
    events.append(store.withColumn("_ingestion_timestamp", F.lit("2024-02-10").cast("timestamp")), DAYS[1])

    def renamed(rows):
        changes = F.when(F.col("user_id") % 3 == 0, F.lit("Renamed")).otherwise(F.col("last_name"))
        return t.enrich_users(rows).withColumn("last_name", changes)

    house.load(USER_HISTORY, as_of=DAYS[1], transform=renamed)
    name = (F.col("last_name") == "Renamed").alias("renamed")
    return house.source(USER_HISTORY.target).select("user_id", name, "effective_from", "effective_to", "is_current")


@query(
    "x8_inject_change",
    """SELECT * FROM silver_transactions UNION ALL SELECT * EXCLUDE (rn) REPLACE ('gift' AS product, TIMESTAMP '2024-02-10' AS _ingestion_timestamp)
FROM (SELECT *, row_number() OVER (ORDER BY _ingestion_timestamp, cardNumber, customerID, dateTime, franchiseID, paymentMethod, product, quantity, totalPrice, transactionID) AS rn
      FROM silver_transactions WHERE customerID = 7) WHERE rn = 1""",
)
def _(d):
    change = inc.inject_change(d.transactions, F.col("customerID") == 7, {"product": "gift"}, datetime(2024, 2, 10))
    return d.transactions.unionByName(change)


@query(
    "x9_history_at_time",
    """SELECT * FROM history_one WHERE effective_from <= TIMESTAMP '2024-01-15' AND (effective_to IS NULL OR effective_to > TIMESTAMP '2024-01-15')""",
)
def _(d):
    return scd2.valid_at(d.history_one, "2024-01-15")


@query(
    "s9_time_travel_report",
    f"""SELECT 1 AS current_version, 0 AS previous_version, (SELECT count(*) FROM silver_customers WHERE {OLD} AND NOT _is_deleted) AS previous_rows,
    (SELECT count(*) FROM silver_customers WHERE {OLD} AND NOT _is_deleted) AS rows_at_time""",
)
def _(d):
    report = _loaded_twice(d, "travel").time_travel("silver.sales_customers")
    return d.base("region").limit(1).select(*[F.lit(v).alias(k) for k, v in report.items()])


def _changed_silver(summary: str) -> str:
    """The summary over what the two deliveries of `_gold_by_increments` leave in Silver, without its time."""
    silver = """sold AS (
    SELECT * REPLACE (CASE WHEN transactionID % 7 <> 0 AND transactionID % 5 = 1 THEN totalPrice + 1 ELSE totalPrice END AS totalPrice,
        CASE WHEN transactionID % 7 <> 0 AND transactionID % 5 = 1 THEN 9 ELSE customerID END AS customerID,
        CASE WHEN transactionID % 7 <> 0 AND transactionID % 5 = 1 THEN '1990-01-01' ELSE dateTime END AS dateTime)
    FROM silver_transactions
    WHERE CASE WHEN transactionID % 7 = 0 THEN NOT _is_deleted WHEN transactionID % 5 = 1 THEN TRUE WHEN transactionID % 11 = 2 THEN FALSE ELSE NOT _is_deleted END),
known AS (
    SELECT * REPLACE (CASE WHEN state = 'MACHINERY' THEN 'Moved' ELSE city END AS city) FROM silver_customers
    WHERE CASE WHEN state = 'MACHINERY' THEN TRUE WHEN state = 'FURNITURE' AND gender = 'female' THEN FALSE ELSE NOT _is_deleted END),"""
    body = summary.strip().removeprefix("WITH").replace("FROM silver_transactions", "FROM sold").replace("FROM silver_customers", "FROM known")
    return f"SELECT * EXCLUDE (_gold_updated_at) FROM (WITH {silver}{body})"


@query("i10_gold_by_increments", _changed_silver(SUMMARY_SQL))
def _(d):
    """Inserts, updates that move sales to another customer, and deletes, taken up without reading other customers."""
    house = Lakehouse(d.spark, d.scratch("i10g"), buckets=8)
    summary = SalesSummary(house, CENTS)
    sales, customers = _timed(d, "sales_transactions"), _timed(d, "sales_customers")
    key = F.coalesce(F.col("transactionID").try_cast("bigint"), F.lit(1))
    changed, gone = (key % 7 != 0) & (key % 5 == 1), (key % 7 != 0) & (key % 5 != 1) & (key % 11 == 2)
    later = {"_ingestion_timestamp": F.lit("2024-02-10").cast("timestamp")}
    update = {
        "totalPrice": F.when(changed, (F.col("totalPrice").try_cast("bigint") + 1).cast("string")).otherwise(F.col("totalPrice")),
        "customerID": F.when(changed, F.lit("9")).otherwise(F.col("customerID")),
        "dateTime": F.when(changed, F.lit("1990-01-01")).otherwise(F.col("dateTime")),
        "_is_deleted": F.when(changed, F.lit(False)).when(gone, F.lit(True)).otherwise(F.col("_is_deleted")),
    }
    moved, left = F.col("state") == "MACHINERY", (F.col("state") == "FURNITURE") & (F.col("gender") == "female")
    news = {"city": F.when(moved, F.lit("Moved")).otherwise(F.col("city")), "_is_deleted": F.when(moved, F.lit(False)).when(left, F.lit(True)).otherwise(F.col("_is_deleted"))}
    deliveries = (
        (sales.where(key % 7 != 0), customers.where("state <> 'BUILDING'")),
        (sales.where((key % 7 == 0) | changed | gone).withColumns(update).withColumns(later), customers.where(F.col("state").isin("BUILDING", "MACHINERY") | left).withColumns(news).withColumns(later)),
    )
    for n, (sold, known) in enumerate(deliveries):
        house.table("bronze.sales_transactions").append(sold, DAYS[n])
        house.table("bronze.sales_customers").append(known, DAYS[n])
        summary.load(DAYS[n])
        summary.refresh(DAYS[n])
    return summary.gold.read().drop("_gold_updated_at")
