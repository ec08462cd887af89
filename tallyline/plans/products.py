"""Product sales, rankings, trends and cancellations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import contracts as C
from tallyline.contracts import Star
from tallyline.functions import status as S
from tallyline.functions.money import percent
from tallyline.operators.ordering import fits_one_task, rank_rows
from tallyline.plans.sales import month_of, year_of
from tallyline.session import stash


def _named(star: Star, sums: DataFrame) -> DataFrame:
    """Attach product attributes after the fact has been reduced to products."""
    return sums.join(star.products.select("product_key", "stock_code", "description"), "product_key")


def _volumes(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(S.sold())
        .groupBy("product_key")
        .agg(F.sum("quantity").alias("units_sold"), F.sum("line_revenue").alias("revenue"))
    )


def _sales(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(S.sold())
        .groupBy("product_key")
        .agg(
            F.sum("quantity").alias("units_sold"),
            F.sum("line_revenue").alias("revenue"),
            F.count_distinct("invoice_no").alias("order_count"),
        )
    )


def product_summary(star: Star) -> DataFrame:
    """V-6."""
    return _named(star, _sales(star.fact)).select(
        "product_key",
        "stock_code",
        "description",
        "order_count",
        F.col("units_sold").alias("total_units_sold"),
        F.col("revenue").alias("total_revenue"),
    )


def _ranked(star: Star, sums: DataFrame) -> DataFrame:
    """Add both ranks and the share of all revenue. Ranks are taken on narrow rows; names
    come last."""
    sums = stash(sums, "product-sales")
    single = fits_one_task(sums)
    total = sums.agg(F.sum("revenue")).scalar()
    ranked = rank_rows(sums, "revenue_rank", "revenue", ["product_key"], single=single)
    ranked = rank_rows(ranked, "quantity_rank", "units_sold", ["product_key"], single=single)
    return _named(star, ranked).withColumn(
        "pct_of_total_revenue", percent(F.col("revenue"), total, 4)
    )


def product_performance(star: Star) -> DataFrame:
    """V-12: sales with revenue rank, quantity rank and share of all revenue."""
    return _ranked(star, _sales(star.fact)).select(
        "product_key",
        "stock_code",
        "description",
        "units_sold",
        "revenue",
        "order_count",
        "revenue_rank",
        "quantity_rank",
        "pct_of_total_revenue",
    )


def _best(star: Star, n: int, by: str, other: str) -> DataFrame:
    """The ``n`` best products by one figure, with both ranks and the share of all revenue.

    Whatever ranks before one of them by the first figure is itself among them. For the other
    figure, one aggregate counts the products above each of the ``n`` values."""
    sums = stash(_volumes(star.fact), "product-volumes")  # the fact is read once for both aggregates
    names = star.products.select("product_key", "stock_code", "description")
    best = sums.join(names, "product_key").orderBy(F.col(by).desc(), "stock_code").limit(n).drop("product_key")
    rows = best.collect()  # n rows
    above = [F.count_if(F.col(other) > F.lit(r[other])).alias(f"_{i}") for i, r in enumerate(rows)]
    figures = sums.agg(F.sum("revenue").alias("total"), *above).first()
    ranked = [
        (*r, 1 + sum(x[by] > r[by] for x in rows), 1 + figures[f"_{i}"], figures["total"])
        for i, r in enumerate(rows)
    ]
    schema = T.StructType([
        *best.schema.fields,
        *[T.StructField(f"{c}_rank", T.LongType()) for c in (by, other)],
        T.StructField("_total", T.DecimalType(38, 2)),
    ])
    shown = star.fact.sparkSession.createDataFrame(ranked, schema)
    return shown.withColumn("pct_of_total_revenue", percent(F.col("revenue"), F.col("_total"), 4))


def top_by_revenue(star: Star, n: int = 10) -> DataFrame:
    """B1."""
    return (
        _best(star, n, "revenue", "units_sold")
        .withColumnRenamed("units_sold_rank", "quantity_rank")
        .orderBy("revenue_rank", "stock_code")
        .select(
            "stock_code", "description", "revenue", "revenue_rank", "quantity_rank",
            "pct_of_total_revenue",
        )
    )


def top_by_quantity(star: Star, n: int = 10) -> DataFrame:
    """B2."""
    return (
        _best(star, n, "units_sold", "revenue")
        .withColumnRenamed("units_sold_rank", "quantity_rank")
        .orderBy("quantity_rank", "stock_code")
        .select(
            "stock_code", "description", "units_sold", "revenue", "revenue_rank", "quantity_rank"
        )
    )


def largest_lines(star: Star, n: int = 5) -> DataFrame:
    """B3: the largest sale lines. Only the chosen lines meet the product table."""
    lines = (
        star.fact.filter(S.sold()).orderBy(F.col("quantity").desc(), "source_row_id").limit(n)
    )
    return _named(star, lines).select(
        "source_row_id", "invoice_no", "stock_code", "description", "quantity", "unit_price",
        "line_revenue", "invoice_timestamp",
    )


def _revenue(star: Star) -> DataFrame:
    return _named(
        star,
        star.fact.filter(S.sold()).groupBy("product_key").agg(F.sum("line_revenue").alias("revenue")),
    )


def cumulative_contribution(star: Star, n: int = 20) -> DataFrame:
    """B4: running revenue over the best ``n`` products.

    Every product that sorts before one of the best ``n`` is itself among them, so rank and
    running sum need only those rows.
    """
    best = _revenue(star).orderBy(F.col("revenue").desc(), "stock_code").limit(n)
    total = star.fact.filter(S.sold()).agg(F.sum("line_revenue")).scalar()
    by_rank = Window.orderBy(F.col("revenue").desc(), "stock_code")
    running = F.sum("revenue").over(
        by_rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return best.select(
        "stock_code",
        "description",
        "revenue",
        F.rank().over(Window.orderBy(F.col("revenue").desc())).cast("bigint").alias("revenue_rank"),
        running.alias("cumulative_revenue"),
        percent(running, total).alias("cumulative_pct_of_total"),
    )


def _by_country(star: Star) -> DataFrame:
    return (
        star.fact.filter(S.sold())
        .groupBy("country_key", "product_key")
        .agg(F.sum("line_revenue").alias("revenue"))
    )


def _ranked_names(star: Star, ranked: DataFrame) -> DataFrame:
    return (
        _named(star, ranked)
        .join(star.countries, "country_key")
        .select("country_name", "stock_code", "description", "revenue", "rank_within_country")
    )


def country_rankings(star: Star) -> DataFrame:
    """V-13: every product ranked within every country. A country with more products than one
    task should sort makes the rank a distributed one."""
    sums = stash(_by_country(star), "product-country")
    ranked = rank_rows(
        sums,
        "rank_within_country",
        "revenue",
        ["product_key"],
        within=["country_key"],
        single=fits_one_task(sums, ["country_key"]),
    )
    return _ranked_names(star, ranked)


def top_per_country(star: Star, n: int = 3) -> DataFrame:
    """B5, X-9: ranks up to ``n`` (ties included). Spark applies the limit to each task's rows
    before the shuffle, so no country travels whole; only the survivors get names."""
    window = Window.partitionBy("country_key").orderBy(F.col("revenue").desc())
    ranked = _by_country(star).withColumn("rank_within_country", F.rank().over(window))
    kept = ranked.filter(F.col("rank_within_country") <= n)
    return _ranked_names(
        star, kept.withColumn("rank_within_country", F.col("rank_within_country").cast("bigint"))
    )


def _months(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(S.sold())
        .groupBy("product_key", year_of().alias("year"), month_of().alias("month"))
        .agg(F.sum("quantity").alias("units_sold"), F.sum("line_revenue").alias("revenue"))
    )


_TREND = ["stock_code", "description", "year", "month", "units_sold", "revenue"]


def monthly_trend(star: Star) -> DataFrame:
    """V-14."""
    return _named(star, _months(star.fact)).select(*_TREND)


def trend_of(star: Star, description: str) -> DataFrame:
    """Months of the products with one description; the fact is cut to them before anything is aggregated."""
    keys = star.products.filter(F.col("description") == description).select("product_key")
    return _named(star, _months(star.fact.join(keys, "product_key", "left_semi"))).select(*_TREND)


def trend_of_best(star: Star, n: int = 5) -> DataFrame:
    """B6: months of the ``n`` best products. The fact is cut to those products by a semi
    join with ``n`` broadcast rows before anything is aggregated."""
    best = (
        _revenue(star).orderBy(F.col("revenue").desc(), "stock_code").limit(n).select("product_key")
    )
    lines = star.fact.join(F.broadcast(best), "product_key", "left_semi")
    return _named(star, _months(lines)).select(*_TREND)


def cancellation_activity(star: Star) -> DataFrame:
    """V-15: products with at least one cancellation."""
    sums = (
        star.fact.filter(F.col("transaction_status").isin(C.VALID_SALE, C.CANCELLATION))
        .groupBy("product_key")
        .agg(
            S.rows_with(C.CANCELLATION).alias("cancellation_count"),
            S.cancellation_value().alias("cancellation_value"),
            S.rows_with(C.VALID_SALE).alias("valid_sale_count"),
        )
        .filter("cancellation_count > 0")
    )
    attempts = F.col("cancellation_count") + F.col("valid_sale_count")
    return _named(star, sums).select(
        "stock_code",
        "description",
        "cancellation_count",
        "cancellation_value",
        "valid_sale_count",
        percent(F.col("cancellation_count"), attempts).alias("cancellation_rate_pct"),
    )


def most_cancelled(star: Star, n: int = 10) -> DataFrame:
    """B7."""
    return (
        cancellation_activity(star)
        .orderBy(F.col("cancellation_count").desc(), "stock_code")
        .limit(n)
    )


def non_merchandise(code: str = "stock_code") -> Column:
    """SNK-5: the code does not start with a digit."""
    return ~S.product_code(F.col(code))


def non_merchandise_listed(code: str = "stock_code") -> Column:
    """BI-7: a listed service code, or not starting with a digit."""
    return F.col(code).isin(C.NON_MERCHANDISE_CODES) | non_merchandise(code)
