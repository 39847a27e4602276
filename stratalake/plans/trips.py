"""Trip analytics.

Every query aggregates before it joins where the keys allow it, so the zone dimension meets a few
aggregated rows instead of every trip. Facts are scanned once per query with only the columns used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.columns import AIRPORT_RATE_CODES, minutes_between, payment_label
from stratalake.functions.numeric import PLAIN, safe_ratio
from stratalake.operators.lookups import broadcast_if_small, left_lookup
from stratalake.operators.transforms import zones_as

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def _trips(name: str = "num_trips") -> Column:
    return F.count("*").alias(name)


def pickup_stats(trips: DataFrame, zones: DataFrame, math=PLAIN) -> DataFrame:
    stats = trips.groupBy("PULocationID").agg(
        _trips(),
        math.mean(F.col("trip_distance")).alias("avg_distance"),
        math.mean(F.col("total_amount")).alias("avg_fare"),
        math.total(F.col("total_amount")).alias("total_revenue"),
        math.mean(F.col("tip_amount")).alias("avg_tip"),
    )
    return left_lookup(stats, zones, "PULocationID", "LocationID").orderBy(F.desc("total_revenue"))


def dropoff_stats(trips: DataFrame, zones: DataFrame, math=PLAIN) -> DataFrame:
    stats = trips.groupBy("DOLocationID").agg(
        _trips("num_dropoffs"), math.mean(F.col("total_amount")).alias("avg_dropoff_fare")
    )
    return left_lookup(stats, zones, "DOLocationID", "LocationID").orderBy(F.desc("num_dropoffs"))


def payment_stats(trips: DataFrame, zones: DataFrame, math=PLAIN) -> DataFrame:
    stats = trips.groupBy("PULocationID", "payment_type").agg(
        _trips("num_trips_by_payment"), math.total(F.col("total_amount")).alias("revenue_by_payment")
    )
    return left_lookup(stats, zones, "PULocationID", "LocationID").orderBy(F.desc("revenue_by_payment"))


def hourly_volume(trips: DataFrame, math=PLAIN) -> DataFrame:
    return (
        trips.groupBy(F.hour(PICKUP).alias("hour"))
        .agg(
            _trips(),
            math.mean(F.col("total_amount")).alias("avg_fare"),
            math.mean(F.col("trip_distance")).alias("avg_distance"),
        )
        .orderBy("hour")
    )


def vendor_stats(trips: DataFrame, math=PLAIN) -> DataFrame:
    return trips.groupBy("VendorID").agg(
        _trips(),
        math.mean(F.col("total_amount")).alias("avg_fare"),
        math.mean(F.col("tip_amount")).alias("avg_tip"),
        math.mean(F.col("trip_distance")).alias("avg_distance"),
    )


def trip_reports(trips: DataFrame, zones: DataFrame, math=PLAIN, tuned: bool = True) -> dict[str, DataFrame]:
    """The five reports. Tuned: the zones are hinted for broadcast after a check of their size."""
    dim = broadcast_if_small(zones) if tuned else zones
    return {
        "pickup": pickup_stats(trips, dim, math),
        "dropoff": dropoff_stats(trips, dim, math),
        "payment": payment_stats(trips, dim, math),
        "hourly": hourly_volume(trips, math),
        "vendor": vendor_stats(trips, math),
    }


def _parts(math, *columns: str) -> list[Column]:
    """Totals and counts of columns per group of ids, to be summed up after the join with names."""
    return [x for c in columns for x in (math.part(F.col(c)).alias(f"{c}_part"), F.count(c).alias(f"{c}_count"))]


def _whole(math, column: str) -> Column:
    return math.whole(F.col(f"{column}_part"))


def _mean(math, column: str) -> Column:
    return F.try_divide(_whole(math, column), F.sum(f"{column}_count"))


def revenue_by_borough(trips: DataFrame, zones: DataFrame, math=PLAIN) -> DataFrame:
    """Ten measures per pickup borough and service zone; trips without a known borough are left out.

    Trips are summed up by zone id first, so only one row per zone meets the names.
    """
    dim = broadcast_if_small(zones.select("location_id", "borough", "service_zone"))
    per_zone = trips.groupBy("PULocationID").agg(
        _trips("trips"),
        F.count_if(F.col("payment_type") == 1).alias("card"),
        F.sum("passenger_count").alias("passengers"),
        F.count("passenger_count").alias("counted"),
        *_parts(math, "fare_amount", "tip_amount", "total_amount", "trip_distance"),
    )
    tip, fare = _whole(math, "tip_amount"), _whole(math, "fare_amount")
    return (
        left_lookup(per_zone, dim, "PULocationID", "location_id")
        .where(F.col("borough").isNotNull())
        .groupBy(F.col("borough").alias("pickup_borough"), "service_zone")
        .agg(
            F.sum("trips").alias("total_trips"),
            math.round(fare, 2).alias("total_fare_revenue"),
            math.round(_mean(math, "fare_amount"), 2).alias("avg_fare"),
            math.round(tip, 2).alias("total_tips"),
            math.round(_mean(math, "tip_amount"), 2).alias("avg_tip"),
            math.round(safe_ratio(tip, fare) * 100, 2).alias("tip_rate_pct"),
            math.round(_whole(math, "total_amount"), 2).alias("total_revenue"),
            math.round(_mean(math, "trip_distance"), 2).alias("avg_trip_distance_miles"),
            math.round(safe_ratio(F.sum("passengers"), F.sum("counted")), 1).alias("avg_passenger_count"),
            math.round(safe_ratio(F.sum("card"), F.sum("trips")) * 100, 1).alias("credit_card_pct"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def trip_time_patterns(trips: DataFrame, math=PLAIN) -> DataFrame:
    """Volume and averages per hour, weekday (1 = Sunday) and month of the pickup."""
    keys = [
        F.hour(PICKUP).alias("pickup_hour"),
        F.dayofweek(PICKUP).alias("pickup_dayofweek"),
        F.date_format(PICKUP, "EEEE").alias("pickup_dayname"),
        F.month(PICKUP).alias("pickup_month"),
    ]
    airport = F.col("RatecodeID").isin(*AIRPORT_RATE_CODES)
    return (
        trips.withColumn("trip_duration_minutes", minutes_between(PICKUP, DROPOFF, math))
        .groupBy(*keys)
        .agg(
            _trips("total_trips"),
            math.round(math.mean(F.col("total_amount")), 2).alias("avg_total_amount"),
            math.round(math.mean(F.col("trip_duration_minutes")), 1).alias("avg_duration_minutes"),
            math.round(math.mean(F.col("trip_distance")), 2).alias("avg_distance_miles"),
            math.round(F.avg("passenger_count"), 1).alias("avg_passengers"),
            F.sum(F.when(airport, 1).otherwise(0)).alias("airport_trips"),
        )
        .orderBy("pickup_month", "pickup_dayofweek", "pickup_hour")
    )


def trip_summary(trips: DataFrame, zones: DataFrame, min_trips: int = 5, math=PLAIN) -> DataFrame:
    """Eleven measures per route, month, hour, weekday, airport flag and payment label.

    Trips are summed up by zone ids first; several ids may share a name, so the names group once more.
    """
    dim = broadcast_if_small(zones)
    times = {
        "pickup_month": F.month(PICKUP),
        "pickup_hour": F.hour(PICKUP),
        "pickup_dayname": F.date_format(PICKUP, "EEEE"),
        "is_airport_trip": F.col("RatecodeID").isin(*AIRPORT_RATE_CODES),
        "payment_type_label": payment_label(F.col("payment_type")),
    }
    timed = trips.withColumn("minutes", minutes_between(PICKUP, DROPOFF, math))
    per_ids = timed.groupBy("PULocationID", "DOLocationID", *[c.alias(n) for n, c in times.items()]).agg(
        _trips("trips"), *_parts(math, "fare_amount", "tip_amount", "total_amount", "trip_distance", "minutes", "congestion_surcharge")
    )
    routed = left_lookup(per_ids, zones_as("pickup", dim), "PULocationID", "pickup_location_id").where(
        F.col("pickup_borough").isNotNull()
    )
    routed = left_lookup(routed, zones_as("dropoff", dim), "DOLocationID", "dropoff_location_id")
    fare, distance = _whole(math, "fare_amount"), _whole(math, "trip_distance")
    return (
        routed.groupBy("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone", *times)
        .agg(
            F.sum("trips").alias("total_trips"),
            math.round(fare, 2).alias("total_fare"),
            math.round(_mean(math, "fare_amount"), 2).alias("avg_fare"),
            math.round(_whole(math, "tip_amount"), 2).alias("total_tips"),
            math.round(_mean(math, "tip_amount"), 2).alias("avg_tip"),
            math.round(_whole(math, "total_amount"), 2).alias("total_revenue"),
            math.round(_mean(math, "total_amount"), 2).alias("avg_total_amount"),
            math.round(_mean(math, "trip_distance"), 2).alias("avg_distance_miles"),
            math.round(_mean(math, "minutes"), 1).alias("avg_duration_minutes"),
            math.round(_whole(math, "congestion_surcharge"), 2).alias("total_congestion_surcharge"),
            math.round(safe_ratio(fare, distance), 2).alias("revenue_per_mile"),
        )
        .where(F.col("total_trips") >= min_trips)
    )
