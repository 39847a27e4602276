"""Named analytics (G1-G13)."""

from pyspark.sql import functions as F

from checks.domain import AS_OF
from checks.registry import mean, query, rounded, total
from stratalake.functions.numeric import Fixed
from stratalake.operators import transforms as t
from stratalake.operators.dedup import latest_per_key
from stratalake.plans import brands as b
from stratalake.plans import trips as tr
from stratalake.plans.sales import customer_sales_summary
from stratalake.tuning import cached, settings

CENTS = Fixed(2)

SUMMARY_SQL = f"""
WITH sales AS (
    SELECT customerID, CAST(sum(totalPrice) AS BIGINT) AS total_spent, count(DISTINCT transactionID) AS total_transactions,
        {rounded("avg(totalPrice)", 2)} AS average_check, CAST(sum(quantity) AS BIGINT) AS total_items_bought,
        count(DISTINCT franchiseID) AS unique_franchises_visited, max(dateTime) AS last_transaction_date
    FROM silver_transactions GROUP BY customerID)
SELECT c.customerID, concat_ws(' ', c.first_name, c.last_name) AS full_name, c.email_address, c.city, c.state, c.country,
    s.total_spent, s.total_transactions, s.average_check, s.total_items_bought, s.unique_franchises_visited,
    s.last_transaction_date, TIMESTAMP '{AS_OF}' AS _gold_updated_at
FROM silver_customers c LEFT JOIN sales s ON c.customerID = s.customerID"""


@query("g1_customer_sales_summary", SUMMARY_SQL)
def _(d):
    return customer_sales_summary(d.customers, d.transactions, AS_OF, math=CENTS)


@query("g1_customer_sales_summary_unique_transactions", SUMMARY_SQL)
def _(d):
    return customer_sales_summary(d.customers, d.transactions, AS_OF, unique_transactions=True, math=CENTS)


def silver_shop(d):
    store = d.store
    return {
        "brands": latest_per_key(t.extract_brands(store), ["brand"], tie_break=["_source_file", "_batch_id", "_is_deleted"]),
        "purchases": t.extract_purchases(store),
        "views": t.extract_views(store),
        "carts": t.extract_carts(store),
        "store": store,
    }


def _brand_measures(brand_join: str) -> str:
    return f"""
    SELECT p.brand, p.num_purchases, p.total_revenue, p.total_revenue / p.num_purchases AS average_check, v.num_views,
        b.brand_tier, u.unique_users, u.unique_products, u.unique_categories, c.num_carts
    FROM (SELECT brand, count(*) AS num_purchases, {total("price")} AS total_revenue
          FROM silver_store WHERE event_type = 'purchase' GROUP BY brand) p
    LEFT JOIN (SELECT brand, count(*) AS num_views FROM silver_store WHERE event_type = 'view' GROUP BY brand) v ON p.brand = v.brand
    LEFT JOIN brand_rows b ON p.brand = b.brand
    LEFT JOIN (SELECT brand, count(DISTINCT user_id) AS unique_users, count(DISTINCT product_id) AS unique_products,
               count(DISTINCT category_id) AS unique_categories FROM silver_store GROUP BY brand) u ON p.brand = u.brand
    LEFT JOIN (SELECT brand, count(*) AS num_carts FROM silver_store WHERE event_type = 'cart' GROUP BY brand) c ON p.brand = c.brand
    {brand_join}"""


BRAND_SQL = f"""SELECT m.*, {rounded("num_purchases * 1.0::DOUBLE / nullif(num_carts, 0) * 100", 2)} AS conversion_rate,
    {rounded("num_carts * 1.0::DOUBLE / nullif(num_views, 0) * 100", 2)} AS cart_abandon_rate
FROM ({_brand_measures("WHERE p.brand IS NOT NULL")}) m"""


@query("g2_brand_analysis", BRAND_SQL)
def _(d):
    return b.brand_analysis(**silver_shop(d), math=CENTS)


JOB_SQL = f"""SELECT m.*, {rounded("num_purchases * 1.0::DOUBLE / num_views * 100", 2)} AS conversion_rate,
    {rounded("num_carts * 1.0::DOUBLE / num_views * 100", 2)} AS cart_abandon_rate
FROM ({_brand_measures("")}) m ORDER BY total_revenue DESC"""


@query("g3_brand_job", JOB_SQL)
def _(d):
    return b.brand_job(d.store, CENTS)


@query("g4_brand_job_bitmaps", JOB_SQL)
def _(d):
    return b.brand_job_single_pass(d.store, CENTS, by_bitmaps=True)


@query("g4_brand_job_single_pass", JOB_SQL)
def _(d):
    return b.brand_job_single_pass(d.store, CENTS)


ZONE = "z.Borough, z.Zone, z.service_zone"

PICKUP_SQL = f"""
SELECT s.*, {ZONE} FROM (
    SELECT PULocationID, count(*) AS num_trips, {mean("trip_distance")} AS avg_distance, {mean("total_amount")} AS avg_fare,
        {total("total_amount")} AS total_revenue, {mean("tip_amount")} AS avg_tip
    FROM typed_trips GROUP BY PULocationID) s
LEFT JOIN zone_file z ON s.PULocationID = z.LocationID ORDER BY total_revenue DESC"""
DROPOFF_SQL = f"""
SELECT s.*, {ZONE} FROM (
    SELECT DOLocationID, count(*) AS num_dropoffs, {mean("total_amount")} AS avg_dropoff_fare
    FROM typed_trips GROUP BY DOLocationID) s
LEFT JOIN zone_file z ON s.DOLocationID = z.LocationID ORDER BY num_dropoffs DESC"""
PAYMENT_SQL = f"""
SELECT s.*, {ZONE} FROM (
    SELECT PULocationID, payment_type, count(*) AS num_trips_by_payment, {total("total_amount")} AS revenue_by_payment
    FROM typed_trips GROUP BY PULocationID, payment_type) s
LEFT JOIN zone_file z ON s.PULocationID = z.LocationID ORDER BY revenue_by_payment DESC"""
HOURLY_SQL = f"""
SELECT hour(tpep_pickup_datetime)::INT AS hour, count(*) AS num_trips, {mean("total_amount")} AS avg_fare, {mean("trip_distance")} AS avg_distance
FROM typed_trips GROUP BY 1 ORDER BY 1"""
VENDOR_SQL = f"""
SELECT VendorID, count(*) AS num_trips, {mean("total_amount")} AS avg_fare, {mean("tip_amount")} AS avg_tip, {mean("trip_distance")} AS avg_distance
FROM typed_trips GROUP BY VendorID"""


@query("g5_pickup_stats", PICKUP_SQL)
def _(d):
    return tr.pickup_stats(d.trips, d.zone_file, CENTS)


@query("g6_dropoff_stats", DROPOFF_SQL)
def _(d):
    return tr.dropoff_stats(d.trips, d.zone_file, CENTS)


@query("g7_payment_stats", PAYMENT_SQL)
def _(d):
    return tr.payment_stats(d.trips, d.zone_file, CENTS)


@query("g8_hourly_volume", HOURLY_SQL)
def _(d):
    return tr.hourly_volume(d.trips, CENTS)


@query("g9_vendor_stats", VENDOR_SQL)
def _(d):
    return tr.vendor_stats(d.trips, CENTS)


def _register_tuned(report: str, sql: str) -> None:
    @query(f"g10_tuned_{report}", sql)
    def _(d):
        return tr.trip_reports(d.trips, d.zone_file, CENTS)[report]


for _report, _sql in {
    "pickup": PICKUP_SQL, "dropoff": DROPOFF_SQL, "payment": PAYMENT_SQL, "hourly": HOURLY_SQL, "vendor": VENDOR_SQL,
}.items():
    _register_tuned(_report, _sql)


BOROUGH_SQL = f"""
SELECT z.borough AS pickup_borough, z.service_zone, count(*) AS total_trips, {rounded(total("fare_amount"), 2)} AS total_fare_revenue,
    {rounded(mean("fare_amount"), 2)} AS avg_fare, {rounded(total("tip_amount"), 2)} AS total_tips, {rounded(mean("tip_amount"), 2)} AS avg_tip,
    {rounded(f"{total('tip_amount')} / nullif({total('fare_amount')}, 0) * 100", 2)} AS tip_rate_pct,
    {rounded(total("total_amount"), 2)} AS total_revenue, {rounded(mean("trip_distance"), 2)} AS avg_trip_distance_miles,
    {rounded("avg(passenger_count)", 1)} AS avg_passenger_count,
    {rounded("count(*) FILTER (WHERE payment_type = 1) * 1.0::DOUBLE / count(*) * 100", 1)} AS credit_card_pct
FROM clean_trips LEFT JOIN zones z ON PULocationID = z.location_id
WHERE z.borough IS NOT NULL GROUP BY 1, 2 ORDER BY total_revenue DESC"""


@query("g11_revenue_by_borough", BOROUGH_SQL)
def _(d):
    return tr.revenue_by_borough(d.clean_trips, d.zones, CENTS)


MINUTES = rounded("(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60", 1)


PATTERN_SQL = f"""
SELECT hour(tpep_pickup_datetime)::INT AS pickup_hour, (dayofweek(tpep_pickup_datetime) + 1)::INT AS pickup_dayofweek,
    dayname(tpep_pickup_datetime) AS pickup_dayname, month(tpep_pickup_datetime)::INT AS pickup_month, count(*) AS total_trips,
    {rounded(mean("total_amount"), 2)} AS avg_total_amount, {rounded(mean("duration"), 1)} AS avg_duration_minutes,
    {rounded(mean("trip_distance"), 2)} AS avg_distance_miles, {rounded("avg(passenger_count)", 1)} AS avg_passengers,
    count(*) FILTER (WHERE RatecodeID IN (2, 3)) AS airport_trips
FROM (SELECT *, {MINUTES} AS duration FROM clean_trips) GROUP BY 1, 2, 3, 4 ORDER BY 4, 2, 1"""


@query("g12_trip_time_patterns", PATTERN_SQL)
def _(d):
    return tr.trip_time_patterns(d.clean_trips, CENTS)


ROUTE_SQL = f"""
SELECT * FROM (
    SELECT p.borough AS pickup_borough, p.zone AS pickup_zone, q.borough AS dropoff_borough, q.zone AS dropoff_zone,
        month(tpep_pickup_datetime)::INT AS pickup_month, hour(tpep_pickup_datetime)::INT AS pickup_hour,
        dayname(tpep_pickup_datetime) AS pickup_dayname, RatecodeID IN (2, 3) AS is_airport_trip,
        CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge' WHEN 4 THEN 'Dispute' ELSE 'Unknown' END AS payment_type_label,
        count(*) AS total_trips, {rounded(total("fare_amount"), 2)} AS total_fare, {rounded(mean("fare_amount"), 2)} AS avg_fare,
        {rounded(total("tip_amount"), 2)} AS total_tips, {rounded(mean("tip_amount"), 2)} AS avg_tip,
        {rounded(total("total_amount"), 2)} AS total_revenue, {rounded(mean("total_amount"), 2)} AS avg_total_amount,
        {rounded(mean("trip_distance"), 2)} AS avg_distance_miles, {rounded(mean("duration"), 1)} AS avg_duration_minutes,
        {rounded(total("congestion_surcharge"), 2)} AS total_congestion_surcharge,
        {rounded(f"{total('fare_amount')} / nullif({total('trip_distance')}, 0)", 2)} AS revenue_per_mile
    FROM (SELECT *, {MINUTES} AS duration FROM clean_trips)
    LEFT JOIN zones p ON PULocationID = p.location_id LEFT JOIN zones q ON DOLocationID = q.location_id
    GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9)
WHERE pickup_borough IS NOT NULL AND total_trips >= 5"""


@query("g13_trip_summary", ROUTE_SQL)
def _(d):
    return tr.trip_summary(d.clean_trips, d.zones, math=CENTS)


@query("g4_brand_job_cached_branches", JOB_SQL)
def _(d):
    """The branch form over a cached input, run under its own settings and stored."""
    path = d.scratch("g4")
    with settings(d.spark, {"spark.sql.shuffle.partitions": "8"}), cached(d.store) as store:
        b.brand_job(store, CENTS).write.parquet(path)
    return d.spark.read.parquet(path)


# Amounts in quarters have exact double sums, so ordinary double arithmetic gives the same bits in any order.
_QUARTERS = ("trip_distance", "fare_amount", "tip_amount", "total_amount")


def _in_quarters(d):
    return d.trips.withColumns({c: F.floor(F.col(c) * 4) / 4.0 for c in _QUARTERS})


QUARTERS_SQL = "(SELECT * REPLACE (" + ", ".join(f"floor({c} * 4) / 4.0::DOUBLE AS {c}" for c in _QUARTERS) + ") FROM typed_trips)"


@query(
    "g9_plain_doubles",
    f"""SELECT VendorID, count(*) AS num_trips, avg(total_amount) AS avg_fare, avg(tip_amount) AS avg_tip, avg(trip_distance) AS avg_distance
FROM {QUARTERS_SQL} GROUP BY VendorID""",
)
def _(d):
    """The default arithmetic of the vendor report."""
    return tr.vendor_stats(_in_quarters(d))


@query(
    "g1_plain_doubles",
    SUMMARY_SQL.replace(rounded("avg(totalPrice)", 2), "round(avg(totalPrice), 2)"),
)
def _(d):
    """The default arithmetic of the customer summary: whole prices, averages rounded by the engine."""
    return customer_sales_summary(d.customers, d.transactions, AS_OF)
