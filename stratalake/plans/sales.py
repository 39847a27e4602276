"""Customer sales summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.numeric import PLAIN
from stratalake.operators.scd2 import VALIDITY
from stratalake.operators.transforms import customer_profile


def customer_sales(transactions: DataFrame, unique_transactions: bool = False, math=PLAIN) -> DataFrame:
    """Measures per customer.

    ``unique_transactions`` states that ``transactionID`` is a key of the input, as in a merged
    Silver table. The distinct count is then a plain count and the input is not multiplied for
    two distinct aggregates.
    """
    transaction = F.count("transactionID") if unique_transactions else F.count_distinct("transactionID")
    spent = F.col("totalPrice")
    return transactions.groupBy("customerID").agg(
        F.sum(spent).alias("total_spent"),
        transaction.alias("total_transactions"),
        math.round(F.avg(spent), 2).alias("average_check"),
        F.sum("quantity").alias("total_items_bought"),
        F.count_distinct("franchiseID").alias("unique_franchises_visited"),
        F.max("dateTime").alias("last_transaction_date"),
    )


def customer_sales_summary(
    customers: DataFrame,
    transactions: DataFrame,
    as_of: datetime | str,
    unique_transactions: bool = False,
    math=PLAIN,
) -> DataFrame:
    """Every customer with profile and measures; customers without sales have NULL measures.

    ``customers`` may also be a type 2 history: its current rows are used.
    """
    if set(VALIDITY) <= set(customers.columns):
        customers = customers.where(F.col("is_current"))
    return (
        customer_profile(customers)
        .join(customer_sales(transactions, unique_transactions, math), "customerID", "left")
        .withColumn("_gold_updated_at", F.lit(as_of).cast("timestamp"))
    )
