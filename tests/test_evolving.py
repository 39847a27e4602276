import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.domain import CHECKED_AT, RULES, Domain
from stratalake.operators.cdc import fold_changes
from stratalake.operators.quality import passing, quarantined
from stratalake.operators.transforms import type_trips
from stratalake.sources.evolving import SchemaConflictError, SchemaStore, evolving_stream, schema_of_files, widen_schema
from stratalake.streaming import flows
from stratalake.streaming.chain import TripChain

SF = "/root/testdata/sf0.001"


def ddl(text):
    return StructType.fromDDL(text)


def test_types_only_grow(spark):
    old = ddl("a int, b struct<x: float, y: string>, c array<smallint>")
    new = ddl("b struct<x: double, z: int>, a bigint, c array<int>, d date")
    wide = ddl("a bigint, b struct<x: double, y: string, z: int>, c array<int>, d date")
    assert widen_schema(old, new) == wide and widen_schema(wide, old) == wide
    for change in ("a string", "a float", "a decimal(10, 2)"):
        with pytest.raises(SchemaConflictError, match="column a"):
            widen_schema(ddl("a bigint"), ddl(change))


@pytest.fixture
def landing(spark, tmp_path):
    path = str(tmp_path / "landing")

    def add(schema, *rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)
        return path

    return add


def test_files_that_disagree_are_halved(spark, landing):
    for schema, row in (("a int", (1,)), ("a bigint, b string", (1, "x")), ("a int, c double", (1, 1.0)), ("a double", (1.0,))):
        path = landing(schema, row) if schema != "a double" else path
    files = [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    found = schema_of_files(spark, files)
    assert {f.name: f.dataType.simpleString() for f in found.fields} == {"a": "bigint", "b": "string", "c": "double"}


def test_store_opens_footers_of_new_files_only(spark, tmp_path, landing, monkeypatch):
    from stratalake.sources import evolving

    opened, read = [], evolving.schema_of_files
    monkeypatch.setattr(evolving, "schema_of_files", lambda s, paths: opened.append(len(paths)) or read(s, paths))
    monkeypatch.setattr(evolving, "OVERLAP_SECONDS", -1)  # nothing is looked at twice
    store = SchemaStore(spark, str(tmp_path / "schemas"))
    assert store.refresh(str(tmp_path / "nowhere")) is False and store.schema() is None
    path = landing("a int", (1,))
    assert store.refresh(path) is False or store.versions().count() == 1
    assert store.refresh(path) is False
    import time

    time.sleep(2.1)
    landing("a bigint, b string", (2, "x"))
    assert store.refresh(path) is True
    assert opened == [1, 1] and store.schema() == ddl("a bigint, b string")


def test_a_wider_file_that_arrives_during_a_batch_is_read_whole(spark, tmp_path, landing):
    """The batch is given up, the stream starts again, and both files are stored once with all columns."""
    path, out, store = landing("a int", (1,)), str(tmp_path / "out"), SchemaStore(spark, str(tmp_path / "schemas"))
    refresh, calls = store.refresh, []

    def late(folder):
        calls.append(folder)
        if len(calls) == 2:  # inside the first batch
            landing("a bigint, b string", (2, "x"))
        return refresh(folder)

    store.refresh = late
    restarts = evolving_stream(spark, path, store, lambda b, n: b.drop("_source_file").write.mode("overwrite").parquet(f"{out}/batch={n}"), str(tmp_path / "progress"))
    rows = spark.read.schema(store.schema()).parquet(f"{out}/*").collect()
    assert restarts == 1 and sorted(tuple(r) for r in rows) == [(1, None), (2, "x")]


def test_other_failures_of_a_batch_are_not_hidden(spark, tmp_path, landing):
    def fail(batch, number):
        raise RuntimeError("no room")

    with pytest.raises(Exception, match="no room"):
        evolving_stream(spark, landing("a int", (1,)), SchemaStore(spark, str(tmp_path / "schemas")), fail, str(tmp_path / "progress"))


def test_chain_equals_the_batch_and_stands_lost_progress(spark, tmp_path, bag):
    trips = Domain(spark, SF).view("trips").drop("_ingestion_timestamp")
    landed, base = str(tmp_path / "landing"), str(tmp_path / "chain")
    expected = None
    for n, moment in enumerate(("2024-01-02", "2024-01-01")):  # the second delivery is older
        rows = trips.withColumn("tip_amount", F.when(F.col("VendorID") == 2 - n, F.lit(float(n + 1))))
        rows.repartition(2).write.mode("append").parquet(landed)
        chain = TripChain(spark, base, RULES)
        chain.run(landed, moment, f"run {n}", CHECKED_AT, files_per_batch=1)
        stamped = rows.withColumns({"_ingestion_timestamp": F.lit(moment).cast("timestamp"), "_batch_id": F.lit(f"run {n}")})
        expected = stamped if expected is None else expected.unionByName(stamped)
    clean = fold_changes(passing(type_trips(expected), RULES), flows.TRIP_KEYS, "_ingestion_timestamp", ignore_nulls=True)
    columns = clean.columns
    assert bag(chain.trips(), *columns) == bag(clean, *columns)
    rejected = quarantined(flows.staging(expected, RULES, CHECKED_AT))
    assert bag(chain.quarantine_rows(), *rejected.columns) == bag(rejected, *rejected.columns)
    assert chain.bronze_rows().count() == expected.count()
    chain._progress = lambda hop: f"{base}/{'again' if hop == 'fold' else 'progress'}/{hop}"  # the fold starts anew
    chain._to_fold()
    assert bag(chain.trips(), *columns) == bag(clean, *columns)
    chain.run(landed, "2024-01-03", "nothing new", CHECKED_AT)
    assert chain.bronze_rows().count() == expected.count()
