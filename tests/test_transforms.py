"""Typed projections: one good row and mutated copies of it."""

import pytest
from pyspark.sql import functions as F

from stratalake.operators import transforms as t

SYSTEM = {
    "_ingestion_timestamp": "2026-04-13 14:41:30.538445",
    "_source_file": "/landing/raw_data",
    "_batch_id": "8c46efb9-5ccf-48bb-a50d-c701b6e2094d",
    "_is_deleted": False,
}
ROWS = {
    "customers": dict(
        address="9 Elm", city="Bern", continent="Europe", country="CH", customerID="2000260", email_address="a@b.c",
        first_name="Amanda", gender="female", last_name="Reed", phone_number="+1-999-308-9110", postal_zip_code="6657", state="BE",
    ),
    "franchises": dict(
        city="Paris", country="France", district="Île-de-France", franchiseID="101", latitude="48.8566", longitude="2.3522",
        name="Golden Crumbs", size="S", supplierID="201", zipcode="75001",
    ),
    "suppliers": dict(
        approved="Y", city="Quito", continent="South America", district="Pichincha", ingredient="banana", latitude="-0.18",
        longitude="-78.46", name="Banana Co", size="L", supplierID="201",
    ),
    "transactions": dict(
        cardNumber="4111111111111111", customerID="2000260", dateTime="2024-05-14 12:17:01", franchiseID="101", paymentMethod="visa",
        product="cookie", quantity="5", totalPrice="10", transactionID="1001", unitPrice="2",
    ),
    "events": dict(
        event_time="2019-10-01 00:00:00 UTC", event_type="purchase", product_id="qwertyuiop", category_id="7", category_code="a.b",
        brand="apple", price="2", user_id="10", user_session="s-1",
    ),
    "brands": dict(brand="Quillmere", brand_tier="premium"),
}
PREPARE = {
    "customers": t.prepare_sales_customers,
    "franchises": t.prepare_sales_franchises,
    "suppliers": t.prepare_sales_suppliers,
    "transactions": t.prepare_sales_transactions,
    "events": t.process_data,
    "brands": t.extract_brands,
}


@pytest.fixture
def prepared(spark):
    def run(kind, *changes, extra=()):
        base = {**ROWS[kind], **SYSTEM, **dict.fromkeys(extra, "x")}
        schema = ", ".join(f"{c} {'boolean' if c == '_is_deleted' else 'string'}" for c in base)
        rows = [tuple({**base, **change}.values()) for change in (changes or ({},))]
        return PREPARE[kind](spark.createDataFrame(rows, schema))

    return run


@pytest.mark.parametrize("given, digits", [("+1-999-308-9110", "19993089110"), (".5.55.222.33.....33", "5552223333")])
def test_phone_keeps_digits_only(prepared, given, digits):
    assert prepared("customers", {"phone_number": given}).first()["phone_number"] == digits


@pytest.mark.parametrize(
    "kind, column, bad",
    [
        ("customers", "customerID", None),
        ("franchises", "franchiseID", None),
        ("suppliers", "supplierID", None),
        ("transactions", "transactionID", None),
        ("transactions", "totalPrice", None),
        ("transactions", "totalPrice", "free"),
        ("events", "user_id", None),
        ("events", "price", None),
        ("events", "price", "0"),
        ("events", "price", "-1"),
        ("brands", "brand", None),
    ],
)
def test_row_without_required_value_is_dropped(prepared, kind, column, bad):
    assert prepared(kind, {}, {column: bad}).count() == 1


@pytest.mark.parametrize(
    "kind, column, type_name",
    [
        ("customers", "customerID", "bigint"), ("customers", "postal_zip_code", "bigint"), ("customers", "_ingestion_timestamp", "timestamp"),
        ("customers", "_is_deleted", "boolean"), ("franchises", "franchiseID", "bigint"), ("franchises", "latitude", "double"),
        ("franchises", "longitude", "double"), ("franchises", "supplierID", "bigint"), ("franchises", "_ingestion_timestamp", "timestamp"),
        ("franchises", "_is_deleted", "boolean"), ("suppliers", "supplierID", "string"), ("suppliers", "latitude", "double"),
        ("suppliers", "longitude", "double"), ("suppliers", "_ingestion_timestamp", "timestamp"), ("suppliers", "_is_deleted", "boolean"),
        ("transactions", "cardNumber", "bigint"), ("transactions", "customerID", "bigint"), ("transactions", "franchiseID", "bigint"),
        ("transactions", "quantity", "bigint"), ("transactions", "totalPrice", "bigint"), ("transactions", "transactionID", "bigint"),
        ("transactions", "unitPrice", "bigint"), ("transactions", "dateTime", "string"), ("transactions", "_ingestion_timestamp", "timestamp"),
        ("transactions", "_is_deleted", "boolean"), ("events", "event_time", "timestamp"), ("events", "price", "double"),
    ],
)
def test_column_type(prepared, kind, column, type_name):
    assert dict(prepared(kind).dtypes)[column] == type_name


@pytest.mark.parametrize("kind, columns", [("customers", 16), ("franchises", 14), ("suppliers", 14), ("transactions", 14), ("events", 13)])
def test_surplus_column_is_not_kept(prepared, kind, columns):
    result = prepared(kind, extra=["extra_col"])
    assert "extra_col" not in result.columns and len(result.columns) == columns


@pytest.mark.parametrize("brand, tier", [("apple", "premium"), ("sony", "mid"), ("Quillmere", "other")])
def test_brand_tier_is_computed(prepared, brand, tier):
    assert prepared("brands", {"brand": brand}).first()["brand_tier"] == tier


def test_unreadable_number_is_null_and_row_stays(prepared):
    assert prepared("events").first()["product_id"] is None


def test_utc_text_becomes_time(prepared):
    assert str(prepared("events").first()["event_time"]) == "2019-10-01 00:00:00"


@pytest.mark.parametrize("text, number", [("12.50", 12), (" 7 ", 7), ("-3.", -3), ("1e3", None), ("12.x", None), ("", None), ("99999999999999999999", None)])
def test_text_to_integer_as_in_a_lenient_cast(frame, text, number):
    assert t.conform(frame("n string", (text,)), "n bigint").first()["n"] == number


def test_event_branches_and_users(prepared):
    events = prepared("events", {}, {"event_type": "view"}, {"event_type": "cart"}, {"event_type": "view"})
    counts = [f(events).count() for f in (t.extract_purchases, t.extract_views, t.extract_carts, t.extract_users)]
    assert counts == [1, 2, 1, 4]
    assert "event_type" not in t.extract_views(events).columns


def test_enriched_users_are_the_same_in_every_evaluation(prepared):
    users = t.enrich_users(prepared("events", *[{"user_id": str(n)} for n in range(50)]))
    first, second = users.collect(), users.repartition(7).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))


def test_lineage_keeps_a_delete_flag_of_the_source(frame):
    rows = frame("id int, _is_deleted string", (1, "true"), (2, None), (3, "false"))
    flags = {r["id"]: r["_is_deleted"] for r in t.add_lineage(rows, F.lit("2024-01-01").cast("timestamp"), "f", "b").collect()}
    assert flags == {1: True, 2: False, 3: False}
    overwritten = t.add_lineage(rows, F.lit("2024-01-01").cast("timestamp"), "f", "b", keep_delete_flag=False)
    assert overwritten.where("_is_deleted").isEmpty()


def test_unknown_table_has_no_transform():
    with pytest.raises(ValueError, match="gold.nothing"):
        t.transform_for("gold.nothing")


def test_registered_transform_is_found():
    t.register_transform("silver.same", lambda df: df)
    try:
        assert t.transform_for("silver.same")("rows") == "rows"
    finally:
        del t.TRANSFORMS["silver.same"]
