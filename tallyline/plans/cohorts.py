"""Monthly cohorts and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.contracts import Star
from tallyline.functions import status as S
from tallyline.functions.money import percent, ratio


#: Months that one word of a customer's activity holds; the sign bit stays free.
MONTHS_A_WORD = 63


def _month_at(number: Column) -> Column:
    """The first day of a month from its number, twelve to a year and 1 for January."""
    return F.make_date(F.floor((number - 1) / 12).cast("int"), (F.pmod(number - 1, F.lit(12)) + 1).cast("int"), F.lit(1))


def _bits(word: str, first: int, months: int) -> Column:
    """The numbers of the months that are set in a word which begins with month ``first``."""
    numbers = F.sequence(F.lit(first), F.lit(min(first + MONTHS_A_WORD, months) - 1))
    return F.filter(numbers, lambda m: F.getbit(F.col(word), m - first) == 1)


def cohort_retention(star: Star) -> DataFrame:
    """V-17: customers of each first-purchase month who bought again in each later month.

    A customer's months are bits, 63 of them to a word, combined before the one shuffle by customer; the lowest
    bit is the cohort, and each bit is a month in which the customer came back. The calendar tells how
    many words it takes. Months a cohort was not seen in have no row.
    """
    sales = star.fact.filter(S.sold())
    last_month = F.trunc(sales.agg(F.max("invoice_timestamp").cast("date")).scalar(), "month")
    span = star.dates.agg(F.min("date_value").alias("first"), F.max("date_value").alias("last")).first()
    start = span["first"].year * 12 + span["first"].month if span["first"] else 0
    months = span["last"].year * 12 + span["last"].month - start + 1 if span["last"] else 1
    place = F.year("invoice_timestamp") * 12 + F.month("invoice_timestamp") - F.lit(start)
    bit = F.expr(f"shiftleft(1L, CAST(pmod(_place, {MONTHS_A_WORD}) AS INT))")
    words = [
        F.bit_or(F.when(F.floor(F.col("_place") / MONTHS_A_WORD) == w, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"_w{w}")
        for w in range(-(-months // MONTHS_A_WORD))
    ]
    seen = sales.filter("customer_key IS NOT NULL").withColumn("_place", place).groupBy("customer_key").agg(*words)
    active = F.concat(*[_bits(f"_w{w}", w * MONTHS_A_WORD, months) for w in range(len(words))])
    cells = (
        seen.select(active.alias("_months"))
        .select(F.get("_months", F.lit(0)).alias("_cohort"), F.explode("_months").alias("_month"))
        .groupBy("_cohort", "_month")
        .agg(F.count("*").alias("returning_customers"))
        .select(
            _month_at(F.col("_cohort") + start).alias("cohort_month"),
            _month_at(F.col("_month") + start).alias("activity_month"),
            (F.col("_month") - F.col("_cohort")).alias("_index"),
            "returning_customers",
        )
    )
    index = F.col("_index")
    # Everyone is active in the first month, so that cell is the cohort's size.
    size = F.max(F.when(index == 0, F.col("returning_customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return cells.select(
        "cohort_month",
        "activity_month",
        index.alias("month_index"),
        size.alias("cohort_size"),
        "returning_customers",
        percent(F.col("returning_customers"), size).alias("retention_pct"),
        last_month.alias("dataset_last_month"),
    )


def retention_curve(cells: DataFrame, eligible_only: bool = False) -> DataFrame:
    """E2: average retention per month index after the first.

    ``eligible_only`` keeps cells whose month lies before the last, still open, month.
    """
    later = cells.filter("month_index > 0")
    if eligible_only:
        later = later.filter("activity_month < dataset_last_month")
    return later.groupBy("month_index").agg(
        F.count_distinct("cohort_month").alias("cohorts_observed_at_this_index"),
        ratio(F.sum("retention_pct"), F.count("*"), 2).alias("avg_retention_pct"),
    )


def cohort_sizes(cells: DataFrame) -> DataFrame:
    """E3."""
    return cells.select("cohort_month", "cohort_size").distinct()


def cohort_cells(cells: DataFrame) -> DataFrame:
    """M-11, one row per cohort and month index."""
    return cells.select("cohort_month", "month_index", "retention_pct")


def cohort_matrix(cells: DataFrame) -> DataFrame:
    """M-11: one row per cohort, one column M0, M1, ... for every month index that occurs.

    The columns follow the data; there are as many as months between its first and last one."""
    found = cells.select("month_index").distinct().orderBy("month_index").collect()
    months = [r["month_index"] for r in found]
    return (
        cells.groupBy("cohort_month")
        .pivot("month_index", months)
        .agg(F.first("retention_pct"))
        .select("cohort_month", *[F.col(str(i)).alias(f"M{i}") for i in months])
    )
