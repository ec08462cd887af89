"""Measures that recompute under any filter and grouping.

``frame`` is the fact, joined with the dimensions a question needs by :func:`wide`. ``by``
names grouping columns. Every measure filters the status itself, so revenue of different
statuses is never mixed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline.contracts import ContractError, Star
from tallyline.functions import status as S
from tallyline.functions.money import safe_divide
from tallyline.operators.ordering import fits_one_task, rank_rows, ranked_values
from tallyline.plans.products import non_merchandise_listed
from tallyline.session import stash

PARTIAL_TEXT = "The selection contains an incomplete month; its growth is not comparable."


def wide(
    star: Star,
    *dimensions: str,
    segments: DataFrame | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Fact with the named dimensions: date, country, customer, product, segment. ``years``
    selects the first and last year, and reads these only."""
    star = star.during(*years) if years else star
    frame = star.fact
    if "date" in dimensions:
        frame = frame.join(star.dates, "date_key")
    if "country" in dimensions:
        frame = frame.join(star.countries, "country_key")
    if "product" in dimensions:
        frame = frame.join(star.products, "product_key")
    if "customer" in dimensions:
        frame = left_by_customer(frame, star.customers)
    if "segment" in dimensions:
        frame = with_segment(frame, segments)
    return frame


def with_segment(frame: DataFrame, segments: DataFrame) -> DataFrame:
    """BI-11: attach the customer segment. The segment table must hold each customer once,
    else lines would multiply; its per-customer totals are left out on purpose."""
    slim = segments.select("customer_key", "rfm_segment_heuristic")
    repeated = slim.groupBy("customer_key").agg(F.count("*").alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        raise ContractError("a customer occurs more than once in the segment table")
    return left_by_customer(frame, slim)


def left_by_customer(frame: DataFrame, side: DataFrame) -> DataFrame:
    """Left join on ``customer_key``. Lines without a customer match nothing: they are joined on their own
    number below zero, which no customer has, so that they do not meet in one task."""
    spread = F.coalesce(F.col("customer_key"), -1 - F.col("source_row_id"))
    keyed = side.withColumnRenamed("customer_key", "_meet")
    return frame.withColumn("_meet", spread).join(keyed, "_meet", "left").drop("_meet")


def sales(frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """BI-1."""
    sums = frame.groupBy(*by).agg(
        S.gross_revenue().alias("gross_sales_revenue"),
        S.cancellation_value().alias("cancellation_value"),
        S.net_revenue().alias("net_revenue"),
        S.orders().alias("total_orders"),
        S.units().alias("units_sold"),
    )
    return sums.withColumn(
        "average_order_value", safe_divide(F.col("net_revenue"), F.col("total_orders"))
    )


def partial_months(months: DataFrame) -> DataFrame:
    """BI-2: whether the selected months include a partial one, and the text to show."""
    found = months.agg(
        F.coalesce(F.bool_or("is_partial_month"), F.lit(False)).alias("has_partial_month")
    )
    return found.withColumn(
        "warning_text", F.when(F.col("has_partial_month"), PARTIAL_TEXT).otherwise("")
    )


def customers(frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """BI-3: active customers and the share with at least two invoices in the selection."""
    per_customer = (
        frame.filter(S.sold() & F.col("customer_key").isNotNull())
        .groupBy(*by, "customer_key")
        .agg(F.count_distinct("invoice_no").alias("orders"))
    )
    counts = per_customer.groupBy(*by).agg(
        F.count("*").alias("active_customers"),
        F.count_if(F.col("orders") >= 2).alias("repeat_customers"),
    )
    return counts.withColumn(
        "repeat_customer_rate", safe_divide(F.col("repeat_customers"), F.col("active_customers"))
    )


def concentration(spend: DataFrame, share: str = "0.1") -> DataFrame:
    """BI-5: revenue share of the top ``ceil(share * n)`` customers; customers who tie with
    the last of them count too."""
    stored = stash(spend.select("monetary"), "spend")
    count = stored.filter("monetary IS NOT NULL").count()
    last = count - math.ceil(count * Fraction(share))
    least = ranked_values(stored, "monetary", [last])[last] if count else None
    top = F.sum(F.when(F.col("monetary") >= F.lit(least), F.col("monetary")))
    return stored.agg(
        top.alias("top_revenue"), safe_divide(top, F.sum("monetary")).alias("top_revenue_share")
    )


def product_revenue(star: Star, frame: DataFrame) -> DataFrame:
    """BI-6, BI-7: revenue, rank and share of all selected revenue for every product."""
    sums = frame.filter(S.sold()).groupBy("product_key").agg(F.sum("line_revenue").alias("revenue"))
    named = stash(
        sums.join(star.products.select("product_key", "stock_code", "description"), "product_key"),
        "product-revenue",
    )
    ranked = rank_rows(named, "revenue_rank", "revenue", ["product_key"], single=fits_one_task(named))
    total = named.agg(F.sum("revenue")).scalar()
    return ranked.select(
        "stock_code",
        "description",
        "revenue",
        "revenue_rank",
        safe_divide(F.col("revenue"), total).alias("revenue_contribution"),
        non_merchandise_listed().alias("is_non_merchandise"),
    )


def quality(frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """BI-8."""
    rows = F.count("*")
    return frame.groupBy(*by).agg(
        rows.alias("total_source_records"),
        S.rows_with(C.VALID_SALE).alias("valid_sales_count"),
        S.rows_with(C.CANCELLATION).alias("cancellations_count"),
        S.rows_with(C.POTENTIAL_RETURN).alias("potential_returns_count"),
        S.rows_with(C.NON_STANDARD).alias("non_standard_count"),
        F.count_if("flag_non_standard_invoice_format").alias("anomalous_invoice_format_count"),
        safe_divide(F.count_if("flag_missing_customer_id"), rows).alias("missing_customer_id_rate"),
        F.count_if("flag_duplicate_candidate").alias("duplicate_candidate_count"),
    )


def duplicate_share(versions: DataFrame) -> DataFrame:
    """BI-9: share of revenue that depends on how repeated lines are handled."""

    def revenue(name: str):
        return F.max(F.when(F.col("dataset_version") == name, F.col("revenue")))

    complete, single = revenue(C.COMPLETE), revenue(C.DEDUPLICATED)
    return versions.agg(
        complete.alias("complete_revenue"),
        single.alias("deduplicated_revenue"),
        safe_divide(complete - single, complete).alias("duplicate_revenue_sensitivity"),
    )


def product_country_matrix(star: Star, products: int = 10, countries: int = 5) -> DataFrame:
    """BI-10: sales revenue of the best products in the best countries, one row per pair.

    Both are chosen by sales of the data, ties by code and name; a pair without a sale has no
    revenue but keeps its row."""
    sums = (
        star.fact.filter(S.sold())
        .groupBy("product_key", "country_key")
        .agg(F.sum("line_revenue").alias("revenue"))
    )

    def best(dimension: DataFrame, key: str, name: str, n: int) -> DataFrame:
        totals = sums.groupBy(key).agg(F.sum("revenue").alias("_total"))
        named = totals.join(dimension.select(key, name), key)
        return named.orderBy(F.col("_total").desc(), name).limit(n).select(key, name)

    rows = best(star.products, "product_key", "stock_code", products)
    columns = best(star.countries, "country_key", "country_name", countries)
    # products x countries rows, both parameters
    grid = rows.withColumn("_one", F.lit(1)).join(columns.withColumn("_one", F.lit(1)), "_one")
    return grid.join(sums, ["product_key", "country_key"], "left").select(
        "stock_code", "country_name", "revenue"
    )


def cancellation_rates(fact: DataFrame) -> DataFrame:
    """M-15: cancelled share of completed business by rows, and revenue offset by it."""
    sums = fact.agg(
        S.rows_with(C.CANCELLATION).alias("cancellation_rows"),
        S.rows_with(C.VALID_SALE).alias("valid_sale_rows"),
        S.cancellation_value().alias("cancellation_value"),
        S.gross_revenue().alias("gross_sales_revenue"),
    )
    return sums.select(
        "*",
        safe_divide(
            F.col("cancellation_rows"), F.col("valid_sale_rows") + F.col("cancellation_rows")
        ).alias("cancellation_row_rate"),
        safe_divide(-F.col("cancellation_value"), F.col("gross_sales_revenue")).alias(
            "cancellation_revenue_offset"
        ),
    )
