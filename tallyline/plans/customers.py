"""Customer summaries, spend distribution and RFM segments."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline.contracts import Star
from tallyline.functions import status as S
from tallyline.functions.money import percent, ratio
from tallyline.operators.ordering import fits_one_task, number_rows, percentile_at, ranked_values, tile, tile_rows
from tallyline.session import stash


def _identified(star: Star) -> DataFrame:
    return star.fact.filter("customer_key IS NOT NULL")


def customer_summary(star: Star) -> DataFrame:
    """V-5: identified customers with sales. ``total_net_revenue`` counts sales only."""
    sums = (
        _identified(star)
        .filter(S.sold())
        .groupBy("customer_key")
        .agg(
            F.count_distinct("invoice_no").alias("order_count"),
            F.sum("line_revenue").alias("total_net_revenue"),
            F.min("invoice_timestamp").alias("first_order_at"),
            F.max("invoice_timestamp").alias("last_order_at"),
        )
    )
    return sums.join(star.customers, "customer_key").select(
        "customer_key",
        "customer_id",
        "order_count",
        "total_net_revenue",
        "first_order_at",
        "last_order_at",
        (F.col("order_count") > 1).alias("is_repeat_customer"),
    )


def customer_totals(star: Star) -> DataFrame:
    """Purchase dates, frequency and spend (own cancellations netted) of customers with at
    least one sale."""
    sale_time = F.when(S.sold(), F.col("invoice_timestamp"))
    sums = (
        _identified(star)
        .filter(F.col("transaction_status").isin(C.VALID_SALE, C.CANCELLATION))
        .groupBy("customer_key")
        .agg(
            F.min(sale_time).alias("first_purchase_at"),
            F.max(sale_time).alias("last_purchase_at"),
            S.orders().alias("frequency"),
            S.net_revenue().alias("monetary"),
        )
        .filter("first_purchase_at IS NOT NULL")
    )
    return sums.join(star.customers, "customer_key").select("customer_id", *sums.columns)


def segment() -> Column:
    """Segment of the three scores; the first rule that holds decides."""
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    return (
        F.when((r == 4) & (f == 4) & (m == 4), C.CHAMPIONS)
        .when((r >= 3) & (f >= 3), C.LOYAL)
        .when((r <= 2) & (f >= 3), C.AT_RISK)
        .when((r >= 3) & (f <= 2), C.OCCASIONAL)
        .otherwise(C.OTHER)
    )


def stored_totals(star: Star) -> DataFrame:
    """:func:`customer_totals`, written once for all that read it."""
    return stash(customer_totals(star), "customers")


def rfm(star: Star, totals: DataFrame | None = None) -> DataFrame:
    """V-16: quartile scores of recency, frequency and spend (4 is best), and a segment.

    Days count from the day after the last invoice of the whole fact. Equal values are
    ordered by customer id. ``totals`` are :func:`stored_totals` that the caller has already.
    """
    last = star.fact.agg(F.max("invoice_timestamp").cast("date")).scalar()
    recency = F.datediff(F.date_add(last, 1), F.col("last_purchase_at").cast("date"))
    if totals is None:
        scored = stash(customer_totals(star).withColumn("recency_days", recency), "customers")
    else:
        scored = totals.withColumn("recency_days", recency)
    single = fits_one_task(scored if totals is None else totals)
    tie = F.col("customer_id").asc()
    for score, order in [
        ("recency_score", F.col("recency_days").desc()),
        ("frequency_score", F.col("frequency").asc()),
        ("monetary_score", F.col("monetary").asc()),
    ]:
        scored = tile_rows(scored, score, 4, [order, tie], single=single)
    return scored.select(
        "customer_key",
        "customer_id",
        "first_purchase_at",
        "last_purchase_at",
        "recency_days",
        "frequency",
        "monetary",
        "recency_score",
        "frequency_score",
        "monetary_score",
        (F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")).alias(
            "rfm_total_score"
        ),
        segment().alias("rfm_segment_heuristic"),
    )


def customer_coverage(star: Star) -> DataFrame:
    """C1: identified customers, and those with a sale."""
    qualifying = _identified(star).filter(S.sold()).agg(F.count_distinct("customer_key")).scalar()
    return star.customers.agg(F.count("*").alias("identified_customers")).withColumn(
        "customers_with_qualifying_purchase", qualifying
    )


def orders_per_customer(star: Star) -> DataFrame:
    return (
        _identified(star)
        .filter(S.sold())
        .groupBy("customer_key")
        .agg(F.count_distinct("invoice_no").alias("order_count"))
    )


def repeat_rate(star: Star) -> DataFrame:
    """C2."""
    counts = orders_per_customer(star).agg(
        F.count("*").alias("customers_with_qualifying_purchase"),
        F.count_if(F.col("order_count") >= 2).alias("repeat_customers"),
    )
    return counts.withColumn(
        "repeat_customer_rate_pct",
        percent(F.col("repeat_customers"), F.col("customers_with_qualifying_purchase")),
    )


def frequency_histogram(star: Star) -> DataFrame:
    """C3."""
    return orders_per_customer(star).groupBy("order_count").agg(F.count("*").alias("customer_count"))


def _by_spend(star: Star, descending: bool, totals: DataFrame | None = None) -> DataFrame:
    """Customer totals with spend position ``_n`` and number of customers ``_of``."""
    totals = stored_totals(star) if totals is None else totals
    spend = F.col("monetary").desc() if descending else F.col("monetary").asc()
    return number_rows(
        totals,
        "_n",
        [spend, F.col("customer_id").asc()],
        total="_of",
        single=fits_one_task(totals),
    )


def spend_statistics(star: Star) -> DataFrame:
    """C4: mean, exact median and 90th percentile, minimum and maximum spend. The percentiles lie between
    two customers each, whose spends are selected by counting; customers are not sorted."""
    totals = stash(customer_totals(star).select("monetary"), "customer-spend")
    count = totals.count()
    places = {f: (count - 1) * Fraction(f) for f in ("0.5", "0.9")}
    spends = ranked_values(totals, "monetary", [r for p in places.values() for r in (math.floor(p), math.ceil(p))]) if count else {}

    def percentile(fraction: str) -> Column:
        if not count:
            return F.lit(None).cast("double")
        low, high = (Fraction(spends[end(places[fraction])]) for end in (math.floor, math.ceil))
        return F.lit(float(low + (high - low) * (places[fraction] % 1)))

    return totals.agg(
        ratio(F.sum("monetary"), F.count("*"), 2).alias("mean_customer_spend"),
        percentile("0.5").alias("median_customer_spend"),
        percentile("0.9").alias("p90_customer_spend"),
        F.min("monetary").alias("min_customer_spend"),
        F.max("monetary").alias("max_customer_spend"),
    )


def spend_deciles(
    star: Star, count_name: str = "customers_in_decile", totals: DataFrame | None = None
) -> DataFrame:
    """C5, X-12: customers, revenue and revenue share per spend decile, largest first."""
    tiles = _by_spend(star, descending=True, totals=totals).withColumn("decile", tile(F.col("_n"), F.col("_of"), 10))
    sums = tiles.groupBy("decile").agg(
        F.count("*").alias(count_name), F.sum("monetary").alias("decile_revenue")
    )
    total = F.sum("decile_revenue").over(Window.partitionBy())  # ten rows
    return sums.withColumn("pct_of_total_revenue", percent(F.col("decile_revenue"), total))


def longest_lifespans(star: Star, n: int = 10) -> DataFrame:
    """C6."""
    days = F.datediff(F.col("last_purchase_at").cast("date"), F.col("first_purchase_at").cast("date"))
    return (
        customer_totals(star)
        .select(
            "customer_id",
            "first_purchase_at",
            "last_purchase_at",
            days.alias("observed_lifespan_days"),
            "frequency",
            "monetary",
        )
        .orderBy(F.col("observed_lifespan_days").desc(), "customer_id")
        .limit(n)
    )


def highest_value(star: Star, n: int = 10) -> DataFrame:
    """C7: observed spend so far; no prediction."""
    return (
        customer_totals(star)
        .select(
            "customer_id",
            F.col("monetary").alias("observed_historical_net_revenue"),
            F.col("frequency").alias("order_count"),
        )
        .orderBy(F.col("observed_historical_net_revenue").desc(), "customer_id")
        .limit(n)
    )


def segment_summary(customers: DataFrame) -> DataFrame:
    """C8, X-11: averages per segment of an RFM table."""
    size = F.count("*")
    return customers.groupBy("rfm_segment_heuristic").agg(
        size.alias("customer_count"),
        ratio(F.sum("recency_days"), size, 1).alias("avg_recency_days"),
        ratio(F.sum("frequency"), size, 1).alias("avg_frequency"),
        ratio(F.sum("monetary"), size, 2).alias("avg_monetary"),
    )


def top_summary(star: Star, n: int = 10) -> DataFrame:
    """R1: customers with the highest sales."""
    return (
        customer_summary(star).orderBy(F.col("total_net_revenue").desc(), "customer_id").limit(n)
    )


def customer_headline(star: Star, totals: DataFrame | None = None) -> DataFrame:
    """X-13: one row of customer figures, from one ordered pass over customer totals."""
    n, of = F.col("_n"), F.col("_of")
    first_decile = tile(n, of, 10) == 1
    figures = _by_spend(star, descending=True, totals=totals).agg(
        F.count("*").alias("customers_with_qualifying_purchase"),
        F.count("*").alias("customers_with_orders"),
        F.count_if(F.col("frequency") >= 2).alias("repeat_customers"),
        percent(F.count_if(F.col("frequency") >= 2), F.count("*")).alias("repeat_customer_rate_pct"),
        ratio(F.sum("monetary"), F.count("*"), 2).alias("mean_customer_spend"),
        # the median is the same from either end
        percentile_at("monetary", of - n + 1, of, "0.5").alias("median_customer_spend"),
        F.sum(F.when(first_decile, F.col("monetary"))).alias("top_decile_revenue"),
        percent(F.sum(F.when(first_decile, F.col("monetary"))), F.sum("monetary")).alias(
            "top_decile_revenue_pct"
        ),
    )
    known = star.customers.agg(F.count("*")).scalar()
    return figures.select(known.alias("identified_customers"), *figures.columns)
