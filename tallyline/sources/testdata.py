"""Raw retail lines derived from order, line-item, customer, nation and part tables.

The tables carry no cancellations, returns, missing customers or duplicates, so those are
derived from key arithmetic: the same tables always give the same lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


VOIDED, SENT_BACK, THIRD = 1, 2, 3


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _padded(key: Column, width: int) -> Column:
    """Zero-padded to at least ``width``; longer keys stay whole."""
    text = key.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The eight raw columns for every line item."""
    # What a line's number and flag tell is one small number, so that a line travels in few bytes.
    line_no, returned = F.col("l_linenumber"), F.col("l_returnflag") == "R"
    kind = F.when(returned & (line_no == 1), VOIDED).when(returned & (line_no == 2), SENT_BACK).when(line_no == 3, THIRD).otherwise(0)
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", kind.cast("tinyint").alias("_kind")
    )
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    parts = read_table(spark, folder, "part").select("p_partkey", "p_name")

    # Orders meet their customers first, so lines, of which there are most, are shuffled once less. What an
    # order's columns tell is computed for the order, not for each of its lines.
    minutes = F.make_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    orders = orders.select(
        "o_orderkey", "o_custkey", (F.col("o_orderdate") + minutes).cast("timestamp_ntz").alias("InvoiceDate")
    )
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    joined = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )

    order, part = F.col("l_orderkey"), F.col("l_partkey")
    voided, sent_back = F.col("_kind") == VOIDED, F.col("_kind") == SENT_BACK
    number = _padded(order, 6)
    quantity = F.col("l_quantity").cast("int")
    each = F.col("l_extendedprice") / F.col("l_quantity")

    derived = joined.select(
        F.when(voided, F.concat(F.lit("C"), number))
        .when(order % 997 == 5, F.concat(F.lit("A"), number))
        .otherwise(number)
        .alias("InvoiceNo"),
        F.when(part % 100 == 0, "POST").otherwise(_padded(part, 5)).alias("StockCode"),
        F.when(order % 331 == 0, F.lit(None))
        .when(order % 53 == 0, "damaged")
        .when(F.col("_kind") == THIRD, F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
        .otherwise(F.col("p_name"))
        .alias("Description"),
        F.when(voided | sent_back, -quantity)
        .when(order % 1009 == 3, F.lit(0))
        .otherwise(quantity)
        .alias("Quantity"),
        "InvoiceDate",
        F.when(sent_back | (order % 401 == 0), F.lit(0))
        .otherwise(F.round(each.cast("decimal(38,10)"), 3))
        .cast("decimal(12,4)")
        .alias("UnitPrice"),
        F.when(F.col("o_custkey") % 4 != 3, F.col("o_custkey")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
        F.when(order % 211 == 0, F.array(F.lit(1), F.lit(2)))
        .otherwise(F.array(F.lit(1)))
        .alias("_copies"),
    )
    return derived.withColumn("_copy", F.explode("_copies")).drop("_copies", "_copy")
