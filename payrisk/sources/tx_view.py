"""Transactions derived from order-line tables, one per line item.

The tables given for testing hold no payments, so this view maps them onto the
transaction schema. ``tx_id`` identifies a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.schema import TX_SCHEMA

TX_COLUMNS = ("tx_id", *TX_SCHEMA.fieldNames())


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders, customer, supplier = (
        spark.read.parquet(f"{sf_dir}/{table}.parquet")
        for table in ("lineitem", "orders", "customer", "supplier")
    )
    return build_transactions(lineitem, orders, customer, supplier)


def _to_cents(value: Column) -> Column:
    """Round to 2 places with plain double arithmetic."""
    return F.rint(value * F.lit(100.0)) / F.lit(100.0)


def _opening(balance: str) -> Column:
    return _to_cents(F.greatest(F.col(balance), F.lit(0.0)) * F.lit(50.0))


def build_transactions(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, supplier: DataFrame
) -> DataFrame:
    """Join order lines to their parties.

    Orders meet customers first: that moves the narrower, shorter table, so each order
    line is shuffled at most for its order and its supplier. Lines and orders grow alike, so
    they are always merged; the file sizes Spark would judge by understate the lines. Parties
    are broadcast only below Spark's size threshold. Adaptive execution splits the
    partitions of hot customers and suppliers.
    """
    senders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "o_orderpriority", _opening("c_acctbal").alias("sender_before")
    )
    receivers = supplier.select("s_suppkey", _opening("s_acctbal").alias("receiver_before"))
    amounts = lineitem.withColumn(
        "amount", _to_cents(F.col("l_extendedprice") * F.col("l_linenumber"))
    )
    lines = amounts.join(
        senders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    ).join(receivers, F.col("l_suppkey") == F.col("s_suppkey"))
    amount, before = F.col("amount"), F.col("sender_before")
    received = F.col("receiver_before")
    returned, open_line = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
    odd_line = F.col("l_linenumber") % 2 == 1
    priority = F.col("o_orderpriority")
    ship_date = F.col("l_shipdate").cast("date")
    noisy_label = (F.col("l_partkey") % 10 < 9) & (amount > F.lit(100_000.0))
    return lines.select(
        F.concat_ws(
            "-",
            *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber")],
            *[F.col(c).cast("string") for c in ("l_partkey", "l_suppkey")],
            F.substring(F.col("l_shipdate").cast("string"), 1, 10),
        ).alias("tx_id"),
        F.datediff(ship_date, F.to_date(F.lit("1992-01-01"))).alias("step"),
        F.when(returned & open_line, F.when(odd_line, "TRANSFER").otherwise("CASH_OUT"))
        .when(priority == "1-URGENT", "TRANSFER")
        .when(priority == "2-HIGH", "CASH_OUT")
        .when(priority == "3-MEDIUM", "PAYMENT")
        .when(priority == "5-LOW", "CASH_IN")
        .otherwise("DEBIT")
        .alias("type"),
        "amount",
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("nameOrig"),
        before.alias("oldbalanceOrg"),
        F.when(returned, F.lit(0.0))
        .otherwise(F.greatest(_to_cents(before - amount), F.lit(0.0)))
        .alias("newbalanceOrig"),
        F.concat(F.lit("M"), F.col("l_suppkey").cast("string")).alias("nameDest"),
        received.alias("oldbalanceDest"),
        F.when(open_line, received)
        .otherwise(_to_cents(received + amount))
        .alias("newbalanceDest"),
        F.when(returned & open_line & noisy_label, 1).otherwise(0).alias("isFraud"),
        F.when(returned & open_line & odd_line & (amount > F.lit(200_000.0)), 1)
        .otherwise(0)
        .alias("isFlaggedFraud"),
    )
