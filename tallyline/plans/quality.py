"""Status views, quality monitors and duplicate sensitivity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline.functions import status as S
from tallyline.functions.money import or_zero, percent, ratio

# A sale repeats another when all of these agree (null customers agree with each other).
SAME_SALE = [
    "invoice_no",
    "product_key",
    "customer_key",
    "country_key",
    "invoice_timestamp",
    "quantity",
    "unit_price",
]


def with_status(fact: DataFrame, status: str) -> DataFrame:
    """V-1..V-4: lines of one status. The filter reaches the parquet scan."""
    return fact.filter(S.has_status(status))


def quality_monitor(fact: DataFrame) -> DataFrame:
    """V-8: rows and flag counts per status."""
    counts = [
        F.count_if(flag).alias(f"{flag.removeprefix('flag_')}_count") for flag in C.FLAGS
    ]
    return fact.groupBy("transaction_status").agg(F.count("*").alias("row_count"), *counts)


def status_distribution(fact: DataFrame) -> DataFrame:
    """D1, M-12: rows, share of rows and revenue per status."""
    sums = fact.groupBy("transaction_status").agg(
        F.count("*").alias("row_count"), F.sum("line_revenue").alias("total_line_revenue")
    )
    everything = F.sum("row_count").over(Window.partitionBy())  # one row per status
    return sums.select(
        "transaction_status",
        "row_count",
        percent(F.col("row_count"), everything).alias("pct_of_rows"),
        "total_line_revenue",
    )


def reversals(fact: DataFrame) -> DataFrame:
    """D2: cancellations and potential returns, in one pass."""
    return fact.agg(
        S.rows_with(C.CANCELLATION).alias("cancellation_row_count"),
        S.cancellation_value().alias("cancellation_value"),
        S.rows_with(C.POTENTIAL_RETURN).alias("potential_return_row_count"),
        S.revenue_of(C.POTENTIAL_RETURN).alias("potential_return_value"),
    )


def non_standard_reasons(fact: DataFrame) -> DataFrame:
    """D3: reasons overlap, so they need not add up to the total."""
    return with_status(fact, C.NON_STANDARD).agg(
        F.count("*").alias("total_non_standard"),
        F.count_if("flag_non_positive_price").alias("non_positive_price_count"),
        F.count_if("flag_zero_quantity").alias("zero_quantity_count"),
        F.count_if("flag_non_standard_invoice_format").alias("non_standard_invoice_format_count"),
    )


def flag_rate(fact: DataFrame, flag: str) -> DataFrame:
    """D4, D5: count and share of a flag per status."""
    name = flag.removeprefix("flag_")
    sums = fact.groupBy("transaction_status").agg(
        F.count("*").alias("row_count"), F.count_if(flag).alias(f"{name}_count")
    )
    return sums.withColumn(f"{name}_pct", percent(F.col(f"{name}_count"), F.col("row_count")))


def in_status_order(df: DataFrame) -> DataFrame:
    return df.orderBy(S.status_order())


def anomalous_invoices(fact: DataFrame) -> DataFrame:
    """D7."""
    return fact.filter("flag_non_standard_invoice_format").select(
        "source_row_id", "invoice_no", "quantity", "unit_price", "line_revenue",
        "transaction_status",
    )


def sales_deduplicated(fact: DataFrame, same: list[str] | None = None) -> DataFrame:
    """V-9: the first line of every group of repeated sales.

    Spark keeps one line per group and task before the shuffle, so a group that makes up a
    large part of the table reaches its task as one line per task.
    """
    window = Window.partitionBy(*(same or SAME_SALE)).orderBy("source_row_id")
    ranked = with_status(fact, C.VALID_SALE).withColumn("dedup_rank", F.row_number().over(window))
    return ranked.filter("dedup_rank = 1").withColumn("dedup_rank", F.lit(1).cast("bigint"))


def duplicate_sensitivity(fact: DataFrame) -> DataFrame:
    """V-18: sales with and without repeated lines.

    One pass: repeated lines have equal quantity and price, hence equal revenue, so a group
    of n lines contributes n times its revenue to one version and once to the other. Both
    versions contain the same invoices, which are counted from the lines: those of an invoice lie
    together there and are combined before the shuffle, but groups no longer do.
    """
    sales = with_status(fact, C.VALID_SALE)
    groups = (
        sales.groupBy(*SAME_SALE)
        .agg(
            F.sum("line_revenue").alias("all_revenue"),
            F.min("line_revenue").alias("one_revenue"),
            F.sum("quantity").alias("all_units"),
        )
    )
    sums = groups.agg(
        or_zero(F.sum("all_revenue")).alias("all_revenue"),
        or_zero(F.sum("one_revenue")).alias("one_revenue"),
        F.coalesce(F.sum("all_units"), F.lit(0)).alias("all_units"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("one_units"),
    ).withColumn("order_count", F.coalesce(sales.agg(F.count_distinct("invoice_no")).scalar(), F.lit(0)))

    def version(name: str, prefix: str):
        return F.struct(
            F.lit(name).alias("dataset_version"),
            F.col(f"{prefix}_revenue").cast("decimal(24,2)").alias("revenue"),
            F.col("order_count"),
            F.col(f"{prefix}_units").alias("units_sold"),
            ratio(F.col(f"{prefix}_revenue"), F.col("order_count"), 2).alias("average_order_value"),
        )

    both = F.array(version(C.COMPLETE, "all"), version(C.DEDUPLICATED, "one"))
    return sums.select(F.inline(both))


def sensitivity_delta(versions: DataFrame) -> DataFrame:
    """V-19: complete minus deduplicated, from the two rows of V-18."""

    def difference(metric: str):
        def value(name: str):
            return F.max(F.when(F.col("dataset_version") == name, F.col(metric)))

        return (value(C.COMPLETE) - value(C.DEDUPLICATED)).alias(f"{metric}_difference")

    metrics = ["revenue", "order_count", "units_sold", "average_order_value"]
    return versions.agg(*[difference(m) for m in metrics])
