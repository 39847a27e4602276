"""Streams (T, and the stream sources and sinks of S and K)."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.domain import AS_OF, CHANGE_KEYS, CHECKED_AT, RULES
from checks.registry import query
from stratalake.operators import cdc
from stratalake.operators import quality as q
from stratalake.sources import readers, writers
from stratalake.sources.evolving import SchemaStore, evolving_stream
from stratalake.sources.snapshots import SnapshotTable
from stratalake.streaming import flows
from stratalake.streaming.chain import COMPRESSION, TripChain


#: Rows up to which a landing folder is dealt to its few files.
DEALT = 3_000_000


def _landed(d, rows, label: str, files: int = 3) -> str:
    """Rows as a landing folder of a few files; of more than `DEALT` rows every split of the scan is a file, so that none is one task's share of all."""
    path = d.scratch(label)
    (rows.repartition(files) if rows.count() <= DEALT else rows).write.parquet(path)
    return path


def _trip_stream(d, label: str):
    raw = d.view("trips")
    return readers.file_stream(d.spark, _landed(d, raw, label), raw.schema).drop("_source_file")


@query(
    "t1_bronze_stream",
    f"""SELECT *, 'lineitem.parquet' AS file, TIMESTAMP '{AS_OF}' AS _ingestion_timestamp, 'run-1' AS _batch_id FROM lineitem""",
)
def _(d):
    """Files of the table folder itself as a stream."""
    table = d.base("lineitem")
    stream = readers.file_stream(d.spark, f"{d.sf_dir}/lineitem*.parquet", table.schema)
    path = d.scratch("t1")
    writers.append_stream(flows.bronze(stream, AS_OF, "run-1"), path, f"{path}-progress")
    stored = d.spark.read.parquet(path)
    return stored.withColumn("file", F.substring_index("_source_file", "/", -1)).drop("_source_file")


@query("t2_staging_stream", "SELECT * FROM flagged_trips")
def _(d):
    path = d.scratch("t2")
    staged = flows.staging(_trip_stream(d, "t2-landing"), RULES, CHECKED_AT)
    writers.append_stream(staged, path, f"{path}-progress")
    return d.spark.read.parquet(path)


@query("t3_quarantine_stream", "SELECT * FROM flagged_trips WHERE is_quarantined")
def _(d):
    path = d.scratch("t3")
    staged = flows.staging(_trip_stream(d, "t3-landing"), RULES, CHECKED_AT)
    writers.append_stream(q.quarantined(staged), path, f"{path}-progress")
    return d.spark.read.parquet(path)


@query(
    "t3_both_branches_of_one_read",
    "SELECT is_quarantined AS rejected, count(*) AS n, CAST(sum(PULocationID) AS BIGINT) AS zones FROM flagged_trips GROUP BY 1",
)
def _(d):
    base = d.scratch("t3b")
    staged = flows.staging(_trip_stream(d, "t3b-landing"), RULES, CHECKED_AT)
    flows.split_to_files(staged, f"{base}/clean", f"{base}/quarantine", f"{base}/progress")

    def branch(name: str, rejected: bool):
        rows = d.spark.read.parquet(f"{base}/{name}").select("PULocationID")
        return rows.groupBy(F.lit(rejected).alias("rejected")).agg(F.count("*").alias("n"), F.sum("PULocationID").alias("zones"))

    return branch("clean", False).unionByName(branch("quarantine", True))


@query("t4_clean_stream", "SELECT * FROM clean_trips")
def _(d):
    path = d.scratch("t4")
    staged = flows.staging(_trip_stream(d, "t4-landing"), RULES, CHECKED_AT)
    writers.append_stream(q.clean(staged), path, f"{path}-progress")
    return d.spark.read.parquet(path)


def _change_table(d, label: str) -> SnapshotTable:
    return SnapshotTable(d.spark, d.scratch(label), CHANGE_KEYS, buckets=4)


def _change_stream(d, path: str, batches: int = 3):
    """The files of a landing folder in a few micro-batches, however many files there are: one for each file of a small one."""
    files = len(d.spark.read.schema(d.changes.schema).parquet(path).inputFiles())
    return readers.file_stream(d.spark, path, d.changes.schema, files_per_batch=-(-files // batches)).drop("_source_file")


@query("t5_fold_newest_row", "SELECT * FROM latest_changes")
def _(d):
    return cdc.fold_changes(d.changes, CHANGE_KEYS, "changed_at")


@query("t5_fold_stream_into_table", "SELECT * FROM latest_changes")
def _(d):
    """Three micro-batches, each of one file or an equal number of files, with rows of all times in every file."""
    table = _change_table(d, "t5")
    stream = _change_stream(d, _landed(d, d.changes, "t5-landing"))
    flows.fold_into(stream, table, "changed_at", f"{table.path}-progress", "changes")
    return flows.current_rows(table)


NULLS_KEPT = """SELECT order_id, line_no, max(changed_at) AS changed_at,
    (max(struct_pack(s := changed_at, v := quantity)) FILTER (WHERE quantity IS NOT NULL)).v AS quantity,
    (max(struct_pack(s := changed_at, v := price)) FILTER (WHERE price IS NOT NULL)).v AS price,
    (max(struct_pack(s := changed_at, v := state)) FILTER (WHERE state IS NOT NULL)).v AS state,
    (max(struct_pack(s := changed_at, v := _is_deleted)) FILTER (WHERE _is_deleted IS NOT NULL)).v AS _is_deleted
FROM changes GROUP BY 1, 2"""


@query("t6_fold_ignoring_nulls", NULLS_KEPT)
def _(d):
    return cdc.fold_changes(d.changes, CHANGE_KEYS, "changed_at", ignore_nulls=True)


@query("t6_fold_stream_ignoring_nulls", NULLS_KEPT)
def _(d):
    table = _change_table(d, "t6")
    stream = _change_stream(d, _landed(d, d.changes, "t6-landing"))
    flows.fold_into(stream, table, "changed_at", f"{table.path}-progress", "changes", ignore_nulls=True)
    return flows.current_rows(table, ignore_nulls=True)


TRIP_VALUES = [
    "VendorID", "passenger_count", "trip_distance", "RatecodeID", "payment_type", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "Airport_fee",
]


@query(
    "t5_trips_by_composite_key",
    "SELECT "
    + ", ".join(flows.TRIP_KEYS)
    + ", max(_ingestion_timestamp) AS _ingestion_timestamp, "
    + ", ".join(
        f"(max(struct_pack(s := _ingestion_timestamp, v := {c})) FILTER (WHERE {c} IS NOT NULL)).v AS {c}" for c in TRIP_VALUES
    )
    + " FROM clean_trips GROUP BY "
    + ", ".join(flows.TRIP_KEYS),
)
def _(d):
    return cdc.fold_changes(d.clean_trips, list(flows.TRIP_KEYS), "_ingestion_timestamp", ignore_nulls=True)


@query("t7_replay_changes_nothing", "SELECT l.*, 2::BIGINT AS newest_version FROM latest_changes l")
def _(d):
    """The same files again: once with the kept progress, once with the progress lost."""
    table, landing = _change_table(d, "t7"), _landed(d, d.changes, "t7-landing", files=2)
    for progress in ("first", "first", "lost"):
        flows.fold_into(_change_stream(d, landing, batches=2), table, "changed_at", f"{table.path}-{progress}", "changes")
    return flows.current_rows(table).withColumn("newest_version", F.lit(table.version()).cast("bigint"))


@query("t8_late_rows_do_not_overwrite", "SELECT * FROM latest_changes")
def _(d):
    """Newer rows arrive first, the older ones in a later run."""
    table, landing = _change_table(d, "t8"), d.scratch("t8-landing")
    for part in ("changed_at >= '1999-01-01'", "changed_at < '1999-01-01'"):
        d.changes.where(part).write.mode("append").parquet(landing)
        flows.fold_into(_change_stream(d, landing), table, "changed_at", f"{table.path}-progress", "changes")
    return flows.current_rows(table)


@query("s7_stream_reads_only_new_files", "SELECT 'first' AS run, count(*) AS n FROM orders UNION ALL SELECT 'repeated', count(*) FROM orders UNION ALL SELECT 'grown', count(*) + count(*) FILTER (WHERE o_orderstatus = 'O') FROM orders")
def _(d):
    orders = d.base("orders")
    landing, path = _landed(d, orders, "s7-landing"), d.scratch("s7")
    counts = []
    for run in ("first", "repeated", "grown"):
        if run == "grown":
            orders.where("o_orderstatus = 'O'").write.mode("append").parquet(landing)
        writers.append_stream(readers.file_stream(d.spark, landing, orders.schema), path, f"{path}-progress")
        counts.append((run, d.spark.read.parquet(path).count()))
    return d.spark.createDataFrame(counts, "run string, n bigint")


@query("s8_table_as_stream", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def _(d):
    path = d.scratch("s8")
    name = "s8_" + path.rsplit("-", 1)[1]
    _landing = _landed(d, d.base("orders"), "s8-landing")
    d.spark.catalog.createTable(name, path=_landing, source="parquet")
    try:
        writers.append_stream(readers.table_stream(d.spark, name), path, f"{path}-progress")
    finally:
        d.spark.sql(f"DROP TABLE {name}")
    return d.spark.read.parquet(path).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("k10_append_stream", "SELECT * FROM part")
def _(d):
    part, path = d.base("part"), d.scratch("k10")
    stream = readers.file_stream(d.spark, _landed(d, part, "k10-landing"), part.schema, files_per_batch=1)
    writers.append_stream(stream.drop("_source_file"), path, f"{path}-progress")
    return d.spark.read.parquet(path)


@query("q17_observed_on_stream", "SELECT count(*) AS rows, count(*) FILTER (WHERE coalesce(fare_amount, 0) <= 0) AS failed_fare, count(*) FILTER (WHERE PULocationID NOT BETWEEN 1 AND 265) AS failed_zone FROM typed_trips")
def _(d):
    path = d.scratch("q17")
    staged = flows.observed(flows.staging(_trip_stream(d, "q17-landing"), RULES, CHECKED_AT), RULES)
    done = writers.append_stream(staged, path, f"{path}-progress")
    metrics = [p.observedMetrics["rule_failures"] for p in done.recentProgress if "rule_failures" in p.observedMetrics]

    def summed(name: str) -> int:
        return sum(m[name] for m in metrics)

    values = (summed("rows"), summed("failed_fare_amount_positive"), summed("failed_pu_location_valid"))
    return d.spark.createDataFrame([values], "rows bigint, failed_fare bigint, failed_zone bigint")


@query("t5_new_checkpoint_finds_new_rows", "SELECT * FROM latest_changes")
def _(d):
    """Two folders under one stream name, the second with a checkpoint of its own whose batches begin at 0 again."""
    table = _change_table(d, "t5n")
    for n, part in enumerate(("line_no % 2 = 0", "line_no % 2 <> 0 OR line_no IS NULL")):
        stream = _change_stream(d, _landed(d, d.changes.where(part), f"t5n-landing-{n}"))
        flows.fold_into(stream, table, "changed_at", f"{table.path}-progress-{n}", "changes")
    return flows.current_rows(table)


@query(
    "t3_two_runs_keep_their_rows",
    "SELECT is_quarantined AS rejected, 2 * count(*) AS n FROM flagged_trips GROUP BY 1",
)
def _(d):
    """The same trips split twice into the same folders, with two checkpoints: both runs are kept."""
    base = d.scratch("t3r")
    for n in range(2):
        staged = flows.staging(_trip_stream(d, f"t3r-landing-{n}"), RULES, CHECKED_AT)
        flows.split_to_files(staged, f"{base}/clean", f"{base}/quarantine", f"{base}/progress-{n}")

    def branch(name: str, rejected: bool):
        return d.spark.read.parquet(f"{base}/{name}").groupBy(F.lit(rejected).alias("rejected")).agg(F.count("*").alias("n"))

    return branch("clean", False).unionByName(branch("quarantine", True))


SECOND_DELIVERY = {
    "tip_amount": "CASE WHEN VendorID = 2 THEN NULL ELSE tip_amount + 1 END",
    "congestion_surcharge": "CASE WHEN VendorID = 1 THEN CAST(NULL AS DOUBLE) ELSE CAST(0.75 AS DOUBLE) END",
}
CBD_FEE = "CASE WHEN VendorID <> 6 THEN CAST(0.75 AS DOUBLE) END"
DELIVERED = ("2024-03-01 00:00:00", "2024-03-02 00:00:00")


def _both_deliveries(table: str) -> str:
    """The rows of both deliveries: the second has other values and one more column."""
    changes = ", ".join(f"{e} AS {c}" for c, e in SECOND_DELIVERY.items())
    return f"""SELECT * REPLACE (TIMESTAMP '{DELIVERED[0]}' AS _ingestion_timestamp), CAST(NULL AS DOUBLE) AS cbd_congestion_fee FROM {table}
    UNION ALL SELECT * REPLACE (TIMESTAMP '{DELIVERED[1]}' AS _ingestion_timestamp, {changes}), {CBD_FEE} FROM {table}"""


def _delivered_twice(d, label: str) -> TripChain:
    """Landing files to folded trips; the second delivery brings a new column and wider zone numbers."""
    landing, chain = d.scratch(f"{label}-landing"), TripChain(d.spark, d.scratch(label), RULES)
    trips = d.view("trips").drop("_ingestion_timestamp")
    narrow = trips.withColumns({c: F.col(c).cast("int") for c in ("PULocationID", "DOLocationID", "payment_type")})
    later = trips.withColumns({c: F.expr(e) for c, e in SECOND_DELIVERY.items()} | {"cbd_congestion_fee": F.expr(CBD_FEE)})
    for rows, moment in ((narrow, DELIVERED[0]), (later, DELIVERED[1])):
        rows.write.mode("append").option("compression", COMPRESSION).parquet(landing)
        chain.run(landing, moment, moment, CHECKED_AT)
    return chain


@query(
    "t1_to_t6_trip_chain",
    f"WITH delivered AS ({_both_deliveries('clean_trips')}) SELECT "
    + ", ".join(flows.TRIP_KEYS)
    + ", max(_ingestion_timestamp) AS _ingestion_timestamp, max(_ingestion_timestamp) AS _batch, "
    + ", ".join(
        f"(max(struct_pack(s := _ingestion_timestamp, v := {c})) FILTER (WHERE {c} IS NOT NULL)).v AS {c}"
        for c in [*TRIP_VALUES, "cbd_congestion_fee"]
    )
    + " FROM delivered GROUP BY "
    + ", ".join(flows.TRIP_KEYS),
)
def _(d):
    """Four streams in a row, run once per delivery."""
    return _delivered_twice(d, "t16").trips().drop("_source_file").withColumn("_batch", F.col("_batch_id").cast("timestamp")).drop("_batch_id")


@query(
    "t3_chain_quarantine",
    f"SELECT *, _ingestion_timestamp AS _batch FROM ({_both_deliveries('flagged_trips')}) WHERE is_quarantined",
)
def _(d):
    """What the chain keeps of rejected rows, of both deliveries."""
    rows = _delivered_twice(d, "t3c").quarantine_rows()
    return rows.drop("_source_file").withColumn("_batch", F.col("_batch_id").cast("timestamp")).drop("_batch_id")


@query(
    "s7_inferred_schema_grows",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, NULL AS clerk FROM orders "
    "UNION ALL SELECT o_orderkey + 5000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'clerk ' || CAST(o_custkey % 10 AS VARCHAR) FROM orders",
)
def _(d):
    """Order numbers outgrow int in the second folder, which also has one more column; no schema is declared."""
    orders, landing, path = d.base("orders"), d.scratch("s7e-landing"), d.scratch("s7e")
    schemas = SchemaStore(d.spark, f"{path}-schema")
    first = orders.withColumns({"o_orderkey": F.col("o_orderkey").cast("int"), "o_totalprice": F.col("o_totalprice")})
    second = orders.withColumns({"o_orderkey": F.col("o_orderkey") + 5_000_000_000, "clerk": F.concat(F.lit("clerk "), (F.col("o_custkey") % 10).cast("string"))})
    for rows in (first, second):
        rows.write.mode("append").parquet(landing)
        evolving_stream(d.spark, landing, schemas, lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/batch={n}"), f"{path}-progress")
    return d.spark.read.schema(schemas.schema()).parquet(f"{path}/*")


DELAY_DAYS = 5


@query(
    "t5_repeats_dropped_within_watermark",
    f"""SELECT event_id, user_id, event_type, ts FROM events UNION ALL
SELECT event_id + 10000000, user_id, event_type, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL '{DELAY_DAYS}' DAY""",
)
def _(d):
    """Three deliveries: all events; the same again; all under new numbers, of which those behind the watermark are late."""
    events = d.base("events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    landing, path = d.scratch("t5w-landing"), d.scratch("t5w")
    for shift in (0, 0, 10_000_000):
        events.withColumn("event_id", F.col("event_id") + shift).write.mode("append").parquet(landing)
        stream = readers.file_stream(d.spark, landing, events.schema).drop("_source_file")
        writers.append_stream(flows.without_repeats(stream, ["event_id"], "ts", f"{DELAY_DAYS} days"), path, f"{path}-progress")
    return d.spark.read.parquet(path)


@query(
    "t5_repeats_dropped_before_the_fold",
    f"""WITH kept AS (SELECT event_id, user_id, event_type, ts FROM events)
SELECT user_id, event_type, max(ts) AS ts, count(*) AS first_events, (max(struct_pack(s := ts, v := event_id))).v AS event_id FROM kept GROUP BY ALL""",
)
def _(d):
    """Events delivered twice are folded to the newest per user and type, with the number of different ones stored."""
    events = d.base("events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    landing, path = d.scratch("t5f-landing"), d.scratch("t5f")
    for _delivery in range(2):
        events.write.mode("append").parquet(landing)
        stream = readers.file_stream(d.spark, landing, events.schema).drop("_source_file")
        writers.append_stream(flows.without_repeats(stream, ["event_id"], "ts", f"{DELAY_DAYS} days"), path, f"{path}-progress")
    kept, keys = d.spark.read.parquet(path), ["user_id", "event_type"]
    counts = kept.groupBy(*keys).agg(F.count("*").alias("first_events"))
    return cdc.fold_changes(kept, keys, "ts").join(counts, keys)
