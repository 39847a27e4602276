"""Typed projections from text tables to clean tables.

A layout is a DDL string: the output holds exactly its columns, in its order and types, so surplus
input columns never leak through.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.functions.columns import brand_tier, digits_only, full_name, lenient_cast
from stratalake.functions.enrich import FIRST_NAMES, LAST_NAMES, keyed_phone, pick

SYSTEM_LAYOUT = (
    "_ingestion_timestamp timestamp, _source_file string, _batch_id string, _is_deleted boolean"
)
SYSTEM_COLUMNS = ("_ingestion_timestamp", "_source_file", "_batch_id", "_is_deleted")

CUSTOMERS = (
    "customerID bigint, first_name string, last_name string, email_address string, "
    "phone_number string, address string, city string, state string, country string, "
    f"continent string, postal_zip_code bigint, gender string, {SYSTEM_LAYOUT}"
)
FRANCHISES = (
    "city string, country string, district string, franchiseID bigint, latitude double, "
    f"longitude double, name string, size string, supplierID bigint, zipcode string, {SYSTEM_LAYOUT}"
)
SUPPLIERS = (
    "approved string, city string, continent string, district string, ingredient string, "
    f"latitude double, longitude double, name string, size string, supplierID string, {SYSTEM_LAYOUT}"
)
TRANSACTIONS = (
    "cardNumber bigint, customerID bigint, dateTime string, franchiseID bigint, "
    "paymentMethod string, product string, quantity bigint, totalPrice bigint, "
    f"transactionID bigint, unitPrice bigint, {SYSTEM_LAYOUT}"
)
STORE_EVENTS = (
    "event_time timestamp, event_type string, product_id bigint, category_id bigint, "
    f"category_code string, brand string, price double, user_id bigint, user_session string, {SYSTEM_LAYOUT}"
)
EVENT_DETAIL = (
    "event_time", "product_id", "category_id", "category_code", "brand", "price", "user_id",
    "user_session", *SYSTEM_COLUMNS,
)
TRIP_TYPES = (
    "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count int, "
    "trip_distance double, PULocationID int, DOLocationID int, RatecodeID int, payment_type int, "
    "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double, congestion_surcharge double, "
    "Airport_fee double"
)


def conform(df: DataFrame, layout: str, required: Sequence[str] = ()) -> DataFrame:
    """Project and cast to ``layout``; drop rows where a required column is NULL after the cast."""
    fields = StructType.fromDDL(layout).fields
    typed = df.select([lenient_cast(df.schema[f.name], f) for f in fields])
    return typed.dropna(subset=list(required)) if required else typed


def retype(df: DataFrame, layout: str) -> DataFrame:
    """Cast the columns named in ``layout`` and keep all others as they are."""
    fields = StructType.fromDDL(layout).fields
    return df.withColumns({f.name: lenient_cast(df.schema[f.name], f) for f in fields})


def prepare_sales_customers(df: DataFrame) -> DataFrame:
    typed = conform(df, CUSTOMERS, required=["customerID"])
    return typed.withColumn("phone_number", digits_only(F.col("phone_number")))


def prepare_sales_franchises(df: DataFrame) -> DataFrame:
    return conform(df, FRANCHISES, required=["franchiseID"])


def prepare_sales_suppliers(df: DataFrame) -> DataFrame:
    return conform(df, SUPPLIERS, required=["supplierID"])


def prepare_sales_transactions(df: DataFrame) -> DataFrame:
    return conform(df, TRANSACTIONS, required=["transactionID", "totalPrice"])


def process_data(df: DataFrame) -> DataFrame:
    """Typed shop events with a user and a positive price."""
    return conform(df, STORE_EVENTS, required=["user_id"]).where(F.col("price") > 0)


def extract_brands(df: DataFrame) -> DataFrame:
    """Brand rows with the tier computed from the brand; a tier in the input is ignored."""
    return (
        df.select("brand", *SYSTEM_COLUMNS)
        .dropna(subset=["brand"])
        .withColumn("brand_tier", brand_tier(F.col("brand")))
    )


def _events_of_type(df: DataFrame, event_type: str) -> DataFrame:
    return df.where(F.col("event_type") == event_type).select(*EVENT_DETAIL)


def extract_purchases(df: DataFrame) -> DataFrame:
    return _events_of_type(df, "purchase")


def extract_views(df: DataFrame) -> DataFrame:
    return _events_of_type(df, "view")


def extract_carts(df: DataFrame) -> DataFrame:
    return _events_of_type(df, "cart")


def extract_users(df: DataFrame) -> DataFrame:
    return df.select("user_id", "user_session", *SYSTEM_COLUMNS).dropna(subset=["user_id"])


def enrich_users(df: DataFrame) -> DataFrame:
    """Users with name and phone attributes derived from the user id."""
    return extract_users(df).withColumns(
        {
            "first_name": pick(FIRST_NAMES, "user_id", salt="first"),
            "last_name": pick(LAST_NAMES, "user_id", salt="last"),
            "phone_number": keyed_phone("user_id"),
        }
    )


def customer_profile(df: DataFrame) -> DataFrame:
    return df.select(
        "customerID",
        full_name("first_name", "last_name").alias("full_name"),
        "email_address", "city", "state", "country",
    )


def type_trips(df: DataFrame) -> DataFrame:
    return retype(df, TRIP_TYPES)


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, whose columns are computed before any filter on them.

    Otherwise a filter repeats the derivation of a column as often as it names it; one of many rules on derived columns then
    grows beyond what the JVM compiles, and every row is interpreted.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def zone_dimension(df: DataFrame) -> DataFrame:
    """Lookup file columns under the names used in joins."""
    return df.select(
        F.col("LocationID").try_cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone"),
    )


def zones_as(role: str, zones: DataFrame) -> DataFrame:
    """A copy of the zone dimension under role names (``pickup``/``dropoff``)."""
    return zones.select(
        F.col("location_id").alias(f"{role}_location_id"),
        F.col("borough").alias(f"{role}_borough"),
        F.col("zone").alias(f"{role}_zone"),
    )


def add_lineage(
    df: DataFrame,
    as_of: datetime | Column,
    source_file: str | Column,
    batch_id: str,
    keep_delete_flag: bool = True,
) -> DataFrame:
    """Add the four system columns. One time and one batch id hold for the whole load.

    A delete flag that the source already carries is kept, so that deletes reach the merge;
    ``keep_delete_flag=False`` overwrites it with false.
    """
    flagged = keep_delete_flag and "_is_deleted" in df.columns
    deleted = F.coalesce(F.col("_is_deleted").try_cast("boolean"), F.lit(False)) if flagged else F.lit(False)
    return df.withColumns(
        {
            "_ingestion_timestamp": as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp"),
            "_source_file": source_file if isinstance(source_file, Column) else F.lit(source_file),
            "_batch_id": F.lit(batch_id),
            "_is_deleted": deleted,
        }
    )


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


Transform = Callable[[DataFrame], DataFrame]

TRANSFORMS: dict[str, Transform] = {
    "silver.sales_customers": prepare_sales_customers,
    "silver.sales_customers_scd2": prepare_sales_customers,
    "silver.sales_franchises": prepare_sales_franchises,
    "silver.sales_suppliers": prepare_sales_suppliers,
    "silver.sales_transactions": prepare_sales_transactions,
    "silver.ecommerce_store": process_data,
    "silver.ecommerce_brands": extract_brands,
    "silver.ecommerce_purchases": extract_purchases,
    "silver.ecommerce_views": extract_views,
    "silver.ecommerce_carts": extract_carts,
    "silver.ecommerce_users": extract_users,
    "silver.ecommerce_users_scd2": enrich_users,
}


def register_transform(target: str, transform: Transform) -> None:
    TRANSFORMS[target] = transform


def transform_for(target: str) -> Transform:
    try:
        return TRANSFORMS[target]
    except KeyError:
        raise ValueError(f"no transform registered for table {target!r}") from None
