"""The customer summary kept up to date from what each load changes.

`SalesSummary.load` records the signed changes of a load beside the table it merges into, under the version that
the merge is going to make; `refresh` takes up the versions it has not seen yet: sums and value counts of
`operators.increments` are added up, and Gold rows are rebuilt for touched customers only. Each of the three tables
knows the last version it took, so a refresh that broke off goes on where it stopped, and a load that
broke off overwrites its own record.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.numeric import PLAIN
from stratalake.operators.increments import Measures, add, finished, signed_rows, totals_of, values_of
from stratalake.operators.merge import merge_replace
from stratalake.operators.transforms import customer_profile
from stratalake.plans.layers import SALES_LOADS, Lakehouse, Load
from stratalake.sources.snapshots import SnapshotTable

CUSTOMERS, TRANSACTIONS = SALES_LOADS[0], SALES_LOADS[3]
#: A transaction is one row of the merged table, so its number needs no distinct count.
SALES = Measures(["customerID"], sums=["totalPrice", "quantity"], distincts=["franchiseID"], maxima=["dateTime"])


class SalesSummary:
    def __init__(self, house: Lakehouse, math=PLAIN):
        self.house, self.spark, self.math = house, house.spark, math
        self.totals = house.table("gold.customer_sales_totals", SALES.groups)
        self.values = house.table("gold.customer_sales_values", SALES.groups)
        self.gold = house.table("gold.customer_sales_summary", ["customerID"])

    # -- changes ------------------------------------------------------------------------------

    def _changes(self, job: Load) -> str:
        return f"{self.house.root}/changes/{job.target.replace('.', '/')}"

    def _record(self, job: Load) -> Callable[[SnapshotTable, DataFrame], None]:
        def record(table: SnapshotTable, batch: DataFrame) -> None:
            before, version = (table.touched_by(batch), table.version() + 1) if table.exists() else (None, 0)
            signed_rows(before, batch, job.keys).write.mode("overwrite").parquet(f"{self._changes(job)}/version={version}")

        return record

    def load(self, as_of: datetime | None = None) -> dict[str, int | None]:
        """Load customers and transactions, with a record of what changes."""
        return {job.target: self.house.load(job, as_of=as_of, before_merge=self._record(job)) for job in (CUSTOMERS, TRANSACTIONS)}

    def changes(self, job: Load, after: int) -> DataFrame | None:
        """Signed rows of the versions of a load's table after ``after``; only their folders are read."""
        newest = self.house.table(job.target).version()
        if newest is None or newest <= after:
            return None
        return self.spark.read.option("mergeSchema", "true").parquet(*[f"{self._changes(job)}/version={v}" for v in range(after + 1, newest + 1)])

    def _taken(self, table: SnapshotTable, job: Load) -> int:
        """The last version of a load's table that ``table`` has taken up."""
        last = table.last_batch(job.target) if table.exists() else None
        return -1 if last is None else last

    # -- refresh ------------------------------------------------------------------------------

    def _add(self, table: SnapshotTable, delta: Callable[[DataFrame, Measures], DataFrame], keys: list[str]) -> None:
        rows = self.changes(TRANSACTIONS, self._taken(table, TRANSACTIONS))
        if rows is None:
            return
        upto = {TRANSACTIONS.target: self.house.table(TRANSACTIONS.target).version()}
        new = delta(rows, SALES)
        if not table.exists():
            table.overwrite(new.limit(0), operation="create")
        table.merge(new, lambda state, d: add(state, d, keys), operation="add", streams=upto)

    def touched(self) -> DataFrame | None:
        """Customers whose Gold row may change: their own row or a sale of theirs did."""
        found = [c.select("customerID") for job in (CUSTOMERS, TRANSACTIONS) if (c := self.changes(job, self._taken(self.gold, job))) is not None]
        if not found:
            return None
        both = found[0].unionByName(found[1]) if len(found) > 1 else found[0]
        return both.where(F.col("customerID").isNotNull()).distinct()

    def rebuilt(self, touched: DataFrame, as_of: datetime | str) -> DataFrame:
        """Gold rows of the touched customers, from the buckets that hold them."""
        tables = (self.house.table(CUSTOMERS.target, CUSTOMERS.keys), self.totals, self.values)
        mine = [t.touched_by(touched).join(touched, "customerID", "left_semi") for t in tables]
        sales = finished(mine[1], mine[2], SALES).select(
            "customerID",
            F.col("sum_totalPrice").alias("total_spent"),
            F.col("n_rows").alias("total_transactions"),
            self.math.round(F.try_divide(F.col("sum_totalPrice"), F.col("known_totalPrice")), 2).alias("average_check"),
            F.col("sum_quantity").alias("total_items_bought"),
            F.col("distinct_franchiseID").alias("unique_franchises_visited"),
            F.col("max_dateTime").alias("last_transaction_date"),
        )
        return customer_profile(mine[0]).join(sales, "customerID", "left").withColumn("_gold_updated_at", F.lit(as_of).cast("timestamp"))

    def refresh(self, as_of: datetime | str) -> int | None:
        """Bring Gold up to the newest loads; None when nothing changed. Customers that are gone leave Gold."""
        self._add(self.totals, totals_of, list(SALES.groups))
        self._add(self.values, values_of, SALES.value_keys)
        touched = self.touched()
        if touched is None:
            return None
        upto = {job.target: v for job in (CUSTOMERS, TRANSACTIONS) if (v := self.house.table(job.target).version()) is not None}
        rows = self.rebuilt(touched, as_of)
        if not self.gold.exists():
            self.gold.overwrite(rows.limit(0), operation="create")
        marked = touched.join(rows, "customerID", "left").withColumn("_gone", F.col("_gold_updated_at").isNull())
        return self.gold.merge(
            marked, lambda t, s: merge_replace(t, s, ["customerID"]).where("NOT coalesce(_gone, false)").drop("_gone"), operation="refresh", streams=upto
        )
