"""Domain tables derived from the shared test tables.

The statements use SQL that both Spark and DuckDB accept, so both sides of a comparison start from
the same rows. They put in what the test tables lack: NULLs, unreadable text, values that break
rules, and keys that hold a third of all rows. Trips and shop events come from one table each, so
no join is spent on making the input.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import transforms as t
from stratalake.operators.dedup import latest_per_key
from stratalake.operators.quality import flag_rows, passing, trip_rules
from stratalake.session import scratch_dir

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
PERIOD = ("1996-01-01", "2001-01-01")
CHECKED_AT = "2024-02-01 00:00:00"
AS_OF = "2024-02-02 00:00:00"

_SYSTEM = """'2024-01-0' || CAST({key} % 5 + 1 AS STRING) || ' 0' || CAST({key} % 8 AS STRING) || ':15:30' AS _ingestion_timestamp,
    'landing/{name}' AS _source_file, 'batch-' || CAST({key} % 5 AS STRING) AS _batch_id,
    CASE WHEN {key} % 41 = 7 THEN TRUE ELSE FALSE END AS _is_deleted"""

_PICKUP_SECOND = "(l_orderkey % 12 + 6) * 3600 + l_partkey % 60 * 60"
_PICKUP = f"CAST(l_shipdate AS TIMESTAMP) + INTERVAL '1' SECOND * CAST({_PICKUP_SECOND} AS INT)"
_DROPOFF = f"""CAST(l_shipdate AS TIMESTAMP)
    + INTERVAL '1' SECOND * CAST({_PICKUP_SECOND} + (l_quantity - 3) * 60 + l_suppkey % 60 AS INT)"""

VIEWS = {
    "sales_customers": f"""
SELECT 'Street ' || CAST(c_custkey % 90 AS STRING) AS address, n_name AS city, r_name AS continent,
    n_name AS country, CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE CAST(c_custkey AS STRING) END AS customerID,
    CASE WHEN c_custkey % 13 = 1 THEN NULL ELSE 'c' || CAST(c_custkey AS STRING) || '@mail.test' END AS email_address,
    CASE WHEN c_custkey % 17 = 2 THEN NULL ELSE substr(c_name, 1, 8) END AS first_name,
    CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender, substr(c_name, 10) AS last_name,
    '+1-(555) ' || CAST(c_custkey % 900 + 100 AS STRING) || '.' || CAST(c_custkey AS STRING) AS phone_number,
    CASE WHEN c_custkey % 19 = 0 THEN 'n/a' ELSE CAST(10000 + c_custkey % 80000 AS STRING) END AS postal_zip_code,
    c_mktsegment AS state, {_SYSTEM.format(key="c_custkey", name="customers")}
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey""",
    "sales_franchises": f"""
SELECT n_name AS city, n_name AS country, 'Île ' || CAST(s_suppkey % 7 AS STRING) AS district,
    CASE WHEN s_suppkey % 23 = 4 THEN NULL ELSE CAST(s_suppkey AS STRING) END AS franchiseID,
    CAST(floor(s_acctbal) / 128 AS STRING) AS latitude,
    CASE WHEN s_suppkey % 9 = 0 THEN 'west' ELSE CAST(floor(s_acctbal) / 64 AS STRING) END AS longitude,
    s_name AS name, 'S' AS size, CAST(s_suppkey % 50 AS STRING) AS supplierID, '0' || CAST(s_suppkey AS STRING) AS zipcode,
    {_SYSTEM.format(key="s_suppkey", name="franchises")}
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey""",
    "sales_suppliers": f"""
SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'Y' ELSE 'N' END AS approved, n_name AS city, r_name AS continent,
    'district ' || CAST(s_suppkey % 7 AS STRING) AS district, 'banana' AS ingredient,
    CAST(floor(s_acctbal) / 128 AS STRING) AS latitude, CAST(floor(s_acctbal) / 64 AS STRING) AS longitude, s_name AS name,
    'L' AS size, CASE WHEN s_suppkey % 29 = 3 THEN NULL ELSE CAST(s_suppkey AS STRING) END AS supplierID,
    {_SYSTEM.format(key="s_suppkey", name="suppliers")}
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey""",
    "sales_transactions": f"""
SELECT CAST(4111111111110000 + o_custkey AS STRING) AS cardNumber,
    CAST(CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS STRING) AS customerID,
    CAST(o_orderdate AS STRING) AS dateTime, CAST(o_orderkey % 40 AS STRING) AS franchiseID,
    CASE WHEN o_orderkey % 2 = 0 THEN 'visa' ELSE 'amex' END AS paymentMethod, o_orderpriority AS product,
    CAST(o_orderkey % 9 + 1 AS STRING) AS quantity,
    CASE WHEN o_orderkey % 101 = 7 THEN NULL WHEN o_orderkey % 103 = 9 THEN 'free' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END AS totalPrice,
    CASE WHEN o_orderkey % 107 = 8 THEN 'lost' ELSE CAST(o_orderkey AS STRING) END AS transactionID,
    CAST(CAST(floor(o_totalprice / 8) AS BIGINT) AS STRING) AS unitPrice,
    {_SYSTEM.format(key="o_orderkey", name="transactions")}
FROM {{orders}}""",
    "ecommerce_store": f"""
SELECT CAST(date_trunc('second', ts) AS STRING) || ' UTC' AS event_time,
    CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type,
    CASE WHEN event_id % 37 = 0 THEN 'qwertyuiop' ELSE CAST(event_id % 500 AS STRING) END AS product_id,
    CAST(event_id % 10 + 100 AS STRING) AS category_id, 'category.' || CAST(event_id % 10 AS STRING) AS category_code,
    CASE WHEN event_id % 3 = 0 THEN 'samsung' WHEN event_id % 10 = 1 THEN NULL WHEN event_id % 10 = 2 THEN 'apple'
         WHEN event_id % 10 = 3 THEN 'sony' WHEN event_id % 10 = 4 THEN 'xiaomi'
         ELSE 'brand-' || CAST(event_id % 31 AS STRING) END AS brand,
    CASE WHEN event_id % 43 = 1 THEN NULL WHEN event_id % 47 = 2 THEN '0' WHEN event_id % 53 = 3 THEN 'free' ELSE CAST(value AS STRING) END AS price,
    CASE WHEN event_id % 59 = 4 THEN NULL ELSE CAST(user_id AS STRING) END AS user_id,
    CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS user_session,
    {_SYSTEM.format(key="event_id", name="events")}
FROM {{events}}""",
    "trips": f"""
SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 6 END AS VendorID,
    CASE WHEN l_orderkey % 211 = 3 THEN NULL ELSE {_PICKUP} END AS tpep_pickup_datetime,
    CASE WHEN l_orderkey % 223 = 3 THEN NULL ELSE {_DROPOFF} END AS tpep_dropoff_datetime,
    CAST(l_linenumber AS DOUBLE) AS passenger_count, l_quantity / 4 AS trip_distance,
    CAST(CASE WHEN l_orderkey % 3 = 0 THEN 4 ELSE l_partkey % 27 END AS BIGINT) AS PULocationID,
    CAST(CASE WHEN l_suppkey % 2 = 0 THEN 5 ELSE l_suppkey % 27 END AS BIGINT) AS DOLocationID, CAST(l_linenumber % 6 + 1 AS DOUBLE) AS RatecodeID,
    CAST(CASE WHEN l_linenumber = 6 THEN NULL ELSE l_linenumber END AS BIGINT) AS payment_type,
    CASE WHEN l_orderkey % 173 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN 0 ELSE floor(l_extendedprice) / 100 END AS fare_amount,
    floor(l_tax * 100) / 100 AS extra, CAST(0.5 AS DOUBLE) AS mta_tax, floor(l_extendedprice * l_discount) / 100 AS tip_amount,
    CAST(l_linenumber % 3 AS DOUBLE) * 1.25 AS tolls_amount, CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    floor(l_extendedprice * (1 + l_discount) + 80) / 100 AS total_amount,
    CASE WHEN l_suppkey % 4 = 0 THEN 0 ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge, CAST(l_linenumber % 2 AS DOUBLE) * 1.75 AS Airport_fee,
    CAST(l_shipdate AS TIMESTAMP) + INTERVAL '30' DAY AS _ingestion_timestamp
FROM {{lineitem}}""",
    "zone_file": """
SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone,
    CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE n_nationkey <> 24""",
    "changes": """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN 3 ELSE l_orderkey END AS order_id,
    CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_linenumber END AS line_no,
    CAST(l_shipdate AS TIMESTAMP) AS changed_at,
    CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity END AS quantity, l_extendedprice AS price,
    CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_returnflag END AS state,
    CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 6 = 0 THEN TRUE ELSE FALSE END AS _is_deleted
FROM {lineitem}""",
}

_TYPED_SYSTEM = """CAST(_ingestion_timestamp AS TIMESTAMP) AS _ingestion_timestamp, _source_file, _batch_id, _is_deleted"""

RULES = trip_rules(*PERIOD)

_CHANGE_ORDER = "changed_at DESC NULLS LAST, quantity DESC NULLS LAST, price DESC NULLS LAST, state DESC NULLS LAST, _is_deleted DESC NULLS LAST"

# DuckDB forms of the typed tables, for the comparison statements only.
TYPED = {
    "silver_customers": f"""
SELECT TRY_CAST(customerID AS BIGINT) AS customerID, first_name, last_name, email_address,
    regexp_replace(phone_number, '[^0-9]', '', 'g') AS phone_number, address, city, state, country, continent,
    TRY_CAST(postal_zip_code AS BIGINT) AS postal_zip_code, gender, {_TYPED_SYSTEM}
FROM sales_customers WHERE customerID IS NOT NULL""",
    "silver_franchises": f"""
SELECT city, country, district, TRY_CAST(franchiseID AS BIGINT) AS franchiseID, TRY_CAST(latitude AS DOUBLE) AS latitude,
    TRY_CAST(longitude AS DOUBLE) AS longitude, name, size, TRY_CAST(supplierID AS BIGINT) AS supplierID, zipcode, {_TYPED_SYSTEM}
FROM sales_franchises WHERE franchiseID IS NOT NULL""",
    "silver_suppliers": f"""
SELECT approved, city, continent, district, ingredient, TRY_CAST(latitude AS DOUBLE) AS latitude,
    TRY_CAST(longitude AS DOUBLE) AS longitude, name, size, supplierID, {_TYPED_SYSTEM}
FROM sales_suppliers WHERE supplierID IS NOT NULL""",
    "silver_transactions": f"""
SELECT TRY_CAST(cardNumber AS BIGINT) AS cardNumber, TRY_CAST(customerID AS BIGINT) AS customerID, dateTime,
    TRY_CAST(franchiseID AS BIGINT) AS franchiseID, paymentMethod, product, TRY_CAST(quantity AS BIGINT) AS quantity,
    TRY_CAST(totalPrice AS BIGINT) AS totalPrice, TRY_CAST(transactionID AS BIGINT) AS transactionID,
    TRY_CAST(unitPrice AS BIGINT) AS unitPrice, {_TYPED_SYSTEM}
FROM sales_transactions WHERE TRY_CAST(transactionID AS BIGINT) IS NOT NULL AND TRY_CAST(totalPrice AS BIGINT) IS NOT NULL""",
    "silver_store": f"""
SELECT CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) AS event_time, event_type, TRY_CAST(product_id AS BIGINT) AS product_id,
    TRY_CAST(category_id AS BIGINT) AS category_id, category_code, brand, TRY_CAST(price AS DOUBLE) AS price,
    TRY_CAST(user_id AS BIGINT) AS user_id, user_session, {_TYPED_SYSTEM}
FROM ecommerce_store WHERE user_id IS NOT NULL AND TRY_CAST(price AS DOUBLE) > 0""",
    "brand_rows": """
SELECT brand, CASE WHEN brand IN ('samsung', 'apple', 'huawei') THEN 'premium'
    WHEN brand IN ('xiaomi', 'lg', 'sony') THEN 'mid' ELSE 'other' END AS brand_tier
FROM (SELECT DISTINCT brand FROM silver_store WHERE brand IS NOT NULL)""",
    "typed_trips": """
SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, CAST(passenger_count AS INT) AS passenger_count, trip_distance,
    CAST(PULocationID AS INT) AS PULocationID, CAST(DOLocationID AS INT) AS DOLocationID, CAST(RatecodeID AS INT) AS RatecodeID,
    CAST(payment_type AS INT) AS payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    total_amount, congestion_surcharge, Airport_fee, _ingestion_timestamp
FROM trips""",
    "flagged_trips": f"""
SELECT *, NOT (tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND coalesce(tpep_dropoff_datetime > tpep_pickup_datetime, FALSE)
    AND coalesce(tpep_pickup_datetime >= TIMESTAMP '{PERIOD[0]}' AND tpep_pickup_datetime < TIMESTAMP '{PERIOD[1]}', FALSE)
    AND coalesce(fare_amount > 0, FALSE) AND total_amount > 0 AND trip_distance >= 0
    AND PULocationID BETWEEN 1 AND 265 AND DOLocationID BETWEEN 1 AND 265
    AND (payment_type IS NULL OR payment_type BETWEEN 1 AND 6)) AS is_quarantined,
    TIMESTAMP '{CHECKED_AT}' AS _dq_checked_at
FROM typed_trips""",
    "clean_trips": "SELECT * EXCLUDE (is_quarantined, _dq_checked_at) FROM flagged_trips WHERE NOT is_quarantined",
    "zones": "SELECT LocationID AS location_id, Borough AS borough, Zone AS zone, service_zone FROM zone_file",
    "latest_changes": f"""
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, line_no ORDER BY {_CHANGE_ORDER}) AS rn FROM changes) WHERE rn = 1""",
    "old_state": f"""
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, line_no ORDER BY {_CHANGE_ORDER}) AS rn
    FROM changes WHERE changed_at < TIMESTAMP '1999-01-01') WHERE rn = 1 AND NOT _is_deleted""",
    "new_batch": f"""
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, line_no ORDER BY {_CHANGE_ORDER}) AS rn
    FROM changes WHERE changed_at >= TIMESTAMP '1999-01-01') WHERE rn = 1""",
    "day_one": """
SELECT *, TIMESTAMP '2024-01-20 00:00:00' AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM silver_customers WHERE state <> 'BUILDING'""",
    "closed_one": """
SELECT *, TIMESTAMP '2024-01-10 00:00:00' AS effective_from, TIMESTAMP '2024-01-20 00:00:00' AS effective_to, FALSE AS is_current
FROM silver_customers WHERE state IN ('BUILDING', 'MACHINERY')""",
    "history_one": "SELECT * FROM day_one UNION ALL SELECT * FROM closed_one",
    "day_two": """
SELECT * REPLACE (CASE WHEN continent = 'ASIA' THEN 'Moved' ELSE city END AS city,
    CASE WHEN continent = 'EUROPE' THEN NULL ELSE email_address END AS email_address)
FROM silver_customers WHERE state <> 'FURNITURE'""",
}

_ALL = {**{name: re.sub(r"\{(\w+)\}", r"\1", text) for name, text in VIEWS.items()}, **TYPED}


def with_views(statement: str) -> str:
    """The statement preceded by the domain tables it mentions, directly or through another one."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _ALL:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(_ALL[name])
                if name not in needed:
                    needed.append(name)

    visit(statement)
    body = statement.strip()
    if not needed:
        return body
    heads = ",\n".join(f"{name} AS ({_ALL[name].strip()})" for name in needed)
    if body.upper().startswith("WITH "):
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"


class Domain:
    """Lazy domain tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        used = {b: self.base(b) for b in BASE_TABLES if f"{{{b}}}" in text}
        return self.spark.sql(text, **used)

    def scratch(self, label: str) -> str:
        return scratch_dir(self.spark, label)

    def rows(self, *values: tuple, schema: str) -> DataFrame:
        return self.spark.createDataFrame(list(values), schema)

    @cached_property
    def customers(self) -> DataFrame:
        return t.prepare_sales_customers(self.view("sales_customers"))

    @cached_property
    def transactions(self) -> DataFrame:
        return t.prepare_sales_transactions(self.view("sales_transactions"))

    @cached_property
    def store(self) -> DataFrame:
        return t.process_data(self.view("ecommerce_store"))

    @cached_property
    def trips(self) -> DataFrame:
        return t.type_trips(self.view("trips"))

    @cached_property
    def flagged(self) -> DataFrame:
        return flag_rows(t.computed_once(self.trips), RULES, CHECKED_AT)

    @cached_property
    def clean_trips(self) -> DataFrame:
        return passing(self.trips, RULES)

    @cached_property
    def zone_file(self) -> DataFrame:
        return self.view("zone_file")

    @cached_property
    def zones(self) -> DataFrame:
        return t.zone_dimension(self.zone_file)

    @cached_property
    def changes(self) -> DataFrame:
        return self.view("changes")

    def latest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, CHANGE_KEYS, "changed_at")

    @cached_property
    def old_state(self) -> DataFrame:
        return self.latest(self.changes.where("changed_at < '1999-01-01'")).where("NOT _is_deleted")

    @cached_property
    def new_batch(self) -> DataFrame:
        return self.latest(self.changes.where("changed_at >= '1999-01-01'"))

    @cached_property
    def history_one(self) -> DataFrame:
        """A type 2 table after its first load: current rows, and closed ones of some keys."""

        def interval(rows: DataFrame, start: str, end: str | None, current: bool) -> DataFrame:
            return rows.withColumns(
                {
                    "effective_from": F.lit(start).cast("timestamp"),
                    "effective_to": F.lit(end).cast("timestamp"),
                    "is_current": F.lit(current),
                }
            )

        live = self.customers.where("state <> 'BUILDING'")
        return interval(live, "2024-01-20", None, True).unionByName(
            interval(self.customers.where("state IN ('BUILDING', 'MACHINERY')"), "2024-01-10", "2024-01-20", False)
        )

    @cached_property
    def day_two(self) -> DataFrame:
        """The next delivery: moved customers, removed e-mails, some new and some missing keys."""
        return self.customers.where("state <> 'FURNITURE'").withColumns(
            {
                "city": F.when(F.col("continent") == "ASIA", "Moved").otherwise(F.col("city")),
                "email_address": F.when(F.col("continent") != "EUROPE", F.col("email_address")),
            }
        )


CHANGE_KEYS = ["order_id", "line_no"]
