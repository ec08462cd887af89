"""Interactive figures computed from the published extracts rather than from the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline.functions.money import safe_divide
from tallyline.functions.text import contains_pattern


def months_between(months: DataFrame, start: str, end: str) -> DataFrame:
    """M-2: months whose first observed day lies in the range, ends included."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return months.filter(F.col("month_start").between(first, last))


def headline_kpis(months: DataFrame) -> DataFrame:
    """M-3: totals of the selected months. A selection without months has zero totals."""

    def total(name: str, kind: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast(kind)

    gross = total("gross_sales_revenue", "decimal(24,2)")
    cancelled = total("cancellation_value", "decimal(24,2)")
    orders = total("order_count", "bigint")
    return months.agg(
        gross.alias("gross_sales_revenue"),
        cancelled.alias("cancellation_value"),
        (gross + cancelled).alias("net_revenue"),
        orders.alias("order_count"),
        safe_divide(gross + cancelled, orders).alias("average_order_value"),
        F.count("*").alias("months_included"),
        F.coalesce(F.bool_or("is_partial_month"), F.lit(False)).alias("has_partial_month"),
    )


def _first_day() -> Column:
    return F.make_date("year", "month", F.lit(1))


def top_products(trend: DataFrame, start: str, end: str, n: int = 10) -> DataFrame:
    """M-4: best products by revenue within a range of calendar months."""
    chosen = trend.filter(_first_day().between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return (
        chosen.groupBy("stock_code", "description")
        .agg(F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "stock_code")
        .limit(n)
    )


def first_row(table: DataFrame) -> DataFrame:
    """M-5: a one-row table as itself."""
    return table.limit(1)


def only_values(table: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """M-6: rows with one of the values; no selection keeps everything."""
    return table.filter(F.col(column).isin(list(values))) if values else table


def search_products(products: DataFrame, pattern: str) -> DataFrame:
    """M-7: case-insensitive pattern in description or stock code."""
    return products.filter(contains_pattern(pattern, "description", "stock_code"))


def merchandise(products: DataFrame, wanted: bool = True) -> DataFrame:
    """M-8."""
    flag = F.col("is_non_merchandise")
    return products.filter(~flag if wanted else flag)


def smallest_ranks(table: DataFrame, rank: str, key: str, n: int = 10) -> DataFrame:
    """M-10: exactly ``n`` rows with the smallest ranks."""
    return table.orderBy(rank, key).limit(n)


def contribution(products: DataFrame, n: int = 10) -> DataFrame:
    """M-9: shares of the best ``n`` products and of all others together."""
    top = smallest_ranks(products, "revenue_rank", "stock_code", n).select(
        F.col("description").alias("label"), F.col("pct_of_total_revenue").alias("pct")
    )
    entries = F.collect_list(F.struct("label", "pct"))  # n rows
    rest = F.greatest(F.lit(100) - F.coalesce(F.sum("pct"), F.lit(0)), F.lit(0))
    others = F.array(
        F.struct(F.lit("All other products").alias("label"), F.col("rest").alias("pct"))
    )
    return (
        top.agg(entries.alias("entries"), rest.cast("decimal(24,4)").alias("rest"))
        .select(F.inline(F.concat("entries", F.when(F.col("rest") > 0, others).otherwise(F.array()))))
    )


def product_series(trend: DataFrame, description: str) -> DataFrame:
    """M-14: months of one product."""
    return trend.filter(F.col("description") == description).withColumn("month_start", _first_day())


def version_difference(versions: DataFrame, metric: str) -> DataFrame:
    """M-13: one metric of V-18 in both versions, and the difference."""

    def value(name: str) -> Column:
        return F.max(F.when(F.col("dataset_version") == name, F.col(metric)))

    return versions.agg(
        value(C.COMPLETE).alias("complete"),
        value(C.DEDUPLICATED).alias("deduplicated"),
        (value(C.COMPLETE) - value(C.DEDUPLICATED)).alias("difference"),
    )
