import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators.increments import Measures, add, finished, signed_rows, totals_of, values_of
from stratalake.operators.merge import merge_upsert

ROW = "id int, k string, amount bigint, shop int, day string, _is_deleted boolean"
MEASURES = Measures(["k"], sums=["amount"], distincts=["shop"], maxima=["day"])


def test_deltas_follow_every_merge(spark, bag):
    rng = random.Random(4)

    def row(i):
        return (i, rng.choice(["a", "b", None]), rng.choice([None, 1, 5]), rng.choice([None, 1, 2]), rng.choice([None, "x", "y"]), rng.choice([False, False, True, None]))

    state = spark.createDataFrame([], ROW)
    totals = values = None
    for size in (12, 8, 8):
        batch = spark.createDataFrame([row(i) for i in rng.sample(range(16), size)], ROW)
        signed = signed_rows(state, batch, ["id"])
        new = totals_of(signed, MEASURES), values_of(signed, MEASURES)
        totals = new[0] if totals is None else add(totals, new[0], ["k"])
        values = new[1] if values is None else add(values, new[1], MEASURES.value_keys)
        state = spark.createDataFrame(merge_upsert(state, batch, ["id"]).collect(), ROW)
        whole = state.groupBy("k").agg(
            F.count("*").alias("n_rows"), F.sum("amount").alias("sum_amount"), F.count("amount").alias("known_amount"),
            F.count_distinct("shop").alias("distinct_shop"), F.max("day").alias("max_day"),
        )
        assert bag(finished(totals, values, MEASURES), *whole.columns) == bag(whole)


def test_maxima_must_be_text(frame):
    with pytest.raises(TypeError, match="amount"):
        values_of(frame("k string, amount int, _sign int"), Measures(["k"], maxima=["amount"]))


@pytest.fixture
def house(spark, tmp_path):
    from stratalake.plans.layers import Lakehouse

    return Lakehouse(spark, str(tmp_path / "house"), buckets=8)


def _bronze(spark, table, rows, moment):
    from stratalake.operators import transforms as t

    layout = {"sales_customers": t.CUSTOMERS, "sales_transactions": t.TRANSACTIONS}[table]
    fields = [f.split()[0] for f in layout.split(", ")]
    full = [tuple({"_ingestion_timestamp": moment, "_source_file": "f", "_batch_id": "b", "_is_deleted": False, **r}.get(c) for c in fields) for r in rows]
    schema = ", ".join(f"{c} {'timestamp' if c == '_ingestion_timestamp' else 'boolean' if c == '_is_deleted' else 'string'}" for c in fields)
    return spark.createDataFrame(full, schema)


def test_refresh_reads_touched_customers_and_goes_on_after_a_break(spark, house, monkeypatch):
    from datetime import datetime

    from stratalake.plans.gold import SalesSummary

    summary = SalesSummary(house)

    def deliver(day, customers, sales):
        moment = datetime(2024, 1, day)
        if customers:
            house.table("bronze.sales_customers").append(_bronze(spark, "sales_customers", customers, moment), moment)
        house.table("bronze.sales_transactions").append(_bronze(spark, "sales_transactions", sales, moment), moment)
        summary.load(moment)
        return moment

    def sale(i, customer, price, **more):
        return {"transactionID": str(i), "customerID": str(customer), "totalPrice": str(price), "quantity": "1", "franchiseID": str(i % 2), "dateTime": f"day {i}", **more}

    first = deliver(1, [{"customerID": str(c), "first_name": f"n{c}"} for c in range(20)], [sale(i, i % 10, 10) for i in range(40)])
    summary.refresh(first)
    second = deliver(2, [], [sale(1, 2, 99), sale(3, 3, 0, _is_deleted=True)])  # moves from 1 to 2; one of 3 is gone
    assert sorted(r[0] for r in summary.touched().collect()) == [1, 2, 3]
    merge = type(summary.gold).merge

    def broken(table, *args, **kwargs):
        if table.path == summary.gold.path:
            raise RuntimeError("lost")
        return merge(table, *args, **kwargs)

    monkeypatch.setattr(type(summary.gold), "merge", broken)
    with pytest.raises(RuntimeError):
        summary.refresh(second)
    monkeypatch.setattr(type(summary.gold), "merge", merge)
    summary.refresh(second)
    assert summary.refresh(second) is None
    rows = {r.customerID: (r.total_spent, r.total_transactions, r.last_transaction_date, r._gold_updated_at) for r in summary.gold.read().collect()}
    assert rows[1] == (30, 3, "day 31", second) and rows[2] == (139, 5, "day 32", second) and rows[3] == (30, 3, "day 33", second)
    assert rows[4] == (40, 4, "day 4", first) and rows[15][:3] == (None, None, None) and len(rows) == 20
    files = {f.rsplit("/", 2)[1] for f in summary.rebuilt(spark.createDataFrame([(1,)], "customerID bigint"), second).inputFiles()}
    assert len(files) <= 3 < 8  # one bucket of each of the three tables
