"""Headline totals, months and countries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.contracts import Star
from tallyline.functions import status as S
from tallyline.functions.money import or_zero, percent, ratio
from tallyline.operators.ordering import fits_one_task, rank_rows
from tallyline.session import stash


def year_of(key: str = "date_key") -> Column:
    return F.expr(f"CAST({key} DIV 10000 AS INT)")


def month_of(key: str = "date_key") -> Column:
    return F.expr(f"CAST({key} DIV 100 % 100 AS INT)")


def headline(fact: DataFrame) -> DataFrame:
    """A1: orders, units, gross, cancellations, net and net revenue per order."""
    totals = fact.agg(
        S.orders().alias("total_orders"),
        S.units().alias("units_sold"),
        S.gross_revenue().alias("gross_sales_revenue"),
        S.cancellation_value().alias("cancellation_value"),
        S.net_revenue().alias("net_revenue"),
    )
    return totals.withColumn(
        "average_order_value", ratio(F.col("net_revenue"), F.col("total_orders"), 2)
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """V-7: revenue per month. Gross and cancellations stay null where a month has none."""
    return _by_month(fact).drop("first_at", "last_at")


def _by_month(fact: DataFrame) -> DataFrame:
    return fact.groupBy(year_of().alias("year"), month_of().alias("month")).agg(
        F.min("invoice_timestamp").cast("date").alias("month_start"),
        S.gross_revenue().alias("gross_sales_revenue"),
        S.cancellation_value().alias("cancellation_value"),
        S.net_revenue().alias("net_revenue"),
        S.orders().alias("order_count"),
        F.min("invoice_timestamp").alias("first_at"),
        F.max("invoice_timestamp").alias("last_at"),
    )


def monthly_growth(fact: DataFrame) -> DataFrame:
    """V-10: months with previous month, growth, running total and partial-month flag.

    One pass over the fact; the windows run over months, of which there are few. A month is
    partial when it is the first or last one and the data stops short of its calendar edge.
    Growth compares with the previous month present in the data.
    """
    in_order = Window.orderBy("year", "month")
    all_months = Window.partitionBy()
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    month = F.make_date("year", "month", F.lit(1))
    first_at = F.min("first_at").over(all_months).cast("date")
    last_at = F.max("last_at").over(all_months).cast("date")
    previous = F.lag("net_revenue").over(in_order)
    starts_late = (F.trunc(first_at, "month") == month) & (first_at > month)
    ends_early = (F.trunc(last_at, "month") == month) & (last_at < F.last_day(month))
    return (
        _by_month(fact)
        .withColumns(
            {
                "gross_sales_revenue": or_zero(F.col("gross_sales_revenue")),
                "cancellation_value": or_zero(F.col("cancellation_value")),
            }
        )
        .select(
            "year",
            "month",
            "month_start",
            (starts_late | ends_early).alias("is_partial_month"),
            "gross_sales_revenue",
            "cancellation_value",
            "net_revenue",
            "order_count",
            ratio(F.col("net_revenue"), F.col("order_count"), 2).alias("average_order_value"),
            previous.alias("previous_month_net_revenue"),
            percent(F.col("net_revenue") - previous, previous).alias(
                "month_over_month_growth_pct"
            ),
            F.sum("net_revenue").over(so_far).alias("cumulative_net_revenue"),
        )
    )


def full_months(fact: DataFrame) -> DataFrame:
    """A4: totals over complete months only."""
    months = monthly_growth(fact).filter(~F.col("is_partial_month"))
    return months.agg(
        F.sum("order_count").alias("total_orders_full_months"),
        F.sum("net_revenue").alias("net_revenue_full_months"),
        ratio(F.sum("net_revenue"), F.count("net_revenue"), 2).alias(
            "average_monthly_net_revenue_full_months"
        ),
    )


def revenue_by_country(star: Star) -> DataFrame:
    """V-11: countries by net revenue. The fact is reduced to countries before the join, and the
    stored dimension tells whether one task can rank them."""
    sums = star.fact.groupBy("country_key").agg(
        S.orders().alias("order_count"),
        or_zero(S.gross_revenue()).alias("gross_sales_revenue"),
        or_zero(S.cancellation_value()).alias("cancellation_value"),
        S.net_revenue().alias("net_revenue"),
    )
    single = fits_one_task(star.countries)
    ranked = rank_rows(sums if single else stash(sums, "country-sales"), "revenue_rank", "net_revenue", ["country_key"], single=single)
    return ranked.join(star.countries, "country_key").select(
        "country_key",
        "country_name",
        "order_count",
        "gross_sales_revenue",
        "cancellation_value",
        "net_revenue",
        "revenue_rank",
    )


def country_share(star: Star) -> DataFrame:
    """A3: countries with their share of all net revenue."""
    everything = F.sum("net_revenue").over(Window.partitionBy())
    return revenue_by_country(star).select(
        "country_name",
        "order_count",
        "gross_sales_revenue",
        "cancellation_value",
        "net_revenue",
        "revenue_rank",
        percent(F.col("net_revenue"), everything).alias("pct_of_total_net_revenue"),
    )
