"""Dimensions and fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline.contracts import Star
from tallyline.functions.money import stored_price
from tallyline.operators.merge import extend_keys, insert_absent, upsert, with_keys


def date_key(at: str) -> Column:
    return (F.year(at) * 10000 + F.month(at) * 100 + F.dayofmonth(at)).cast("int")


def dim_date(cleaned: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Every calendar day from the first to the last invoice, traded or not."""
    span = cleaned.agg(
        F.min("invoice_date").cast("date").alias("first"),
        F.max("invoice_date").cast("date").alias("last"),
    ).filter("first IS NOT NULL")
    day = F.col("date_value")
    calendar = span.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date_value")
    ).select(
        date_key("date_value").alias("date_key"),
        "date_value",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )
    return calendar if existing is None else insert_absent(existing, calendar, "date_key")


def _keyed(members: DataFrame, surrogate: str, key: str, existing: DataFrame | None) -> DataFrame:
    if existing is None:
        return with_keys(members, surrogate, [F.col(key).asc()])
    return extend_keys(existing, members, surrogate, key)


def dim_country(cleaned: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    names = cleaned.select(F.col("country").alias("country_name")).distinct()
    keyed = _keyed(names, "country_key", "country_name", existing)
    return keyed if existing is None else insert_absent(existing, keyed, "country_name")


def dim_customer(cleaned: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    ids = cleaned.filter("customer_id IS NOT NULL").select("customer_id").distinct()
    keyed = _keyed(ids, "customer_key", "customer_id", existing)
    return keyed if existing is None else insert_absent(existing, keyed, "customer_id")


def product_members(cleaned: DataFrame) -> DataFrame:
    """Stock codes with their most frequent description (the smallest of equally frequent
    ones) and the number of distinct descriptions.

    Counts per (code, description) come first, so a hot code is combined before the shuffle
    and never builds a value map in one buffer.
    """
    spelled = cleaned.groupBy("stock_code", "description").agg(F.count("*").alias("n"))
    best = F.min(
        F.when(
            F.col("description").isNotNull(),
            F.struct((-F.col("n")).alias("rank"), "description"),
        )
    )
    return spelled.groupBy("stock_code").agg(
        best.getField("description").alias("description"),
        F.count("description").alias("description_variant_count"),
    )


def dim_product(cleaned: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """On reload, known products keep their key and take the new attributes, null included."""
    keyed = _keyed(product_members(cleaned), "product_key", "stock_code", existing)
    return keyed if existing is None else upsert(existing, keyed, "stock_code")


def build_fact(
    cleaned: DataFrame,
    countries: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    broadcast: bool = False,
) -> DataFrame:
    """Fact at line grain. Every line needs a product and a country; the customer is optional.

    ``broadcast`` states that the caller measured all dimensions and found them small;
    otherwise Spark chooses the join from table sizes and splits skewed partitions.
    """
    hint = F.broadcast if broadcast else (lambda side: side)
    # A line without a customer must not match. Joining it on its row id spreads such lines
    # evenly instead of sending all nulls to one partition; a chance match is discarded.
    people = customers.select(
        F.col("customer_key").alias("_matched"), F.col("customer_id").alias("_match")
    )
    joined = (
        cleaned.withColumn("_match", F.coalesce("customer_id", "source_row_id"))
        .join(hint(products.select("product_key", "stock_code")), "stock_code")
        .join(
            hint(countries.select("country_key", F.col("country_name").alias("country"))),
            "country",
        )
        .join(hint(people), "_match", "left")
        .withColumn("customer_key", F.when(F.col("customer_id").isNotNull(), F.col("_matched")))
    )
    return joined.withColumns(
        {
            "date_key": date_key("invoice_date"),
            "invoice_timestamp": F.col("invoice_date"),
            "unit_price": stored_price(F.col("unit_price")),
        }
    ).select(*C.FACT_COLUMNS)


def merge_fact(existing: DataFrame, incoming: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """Replace lines with the same id, add new ones, keep the rest. ``replaced`` names the ids to
    take out of ``existing`` where that is more than ``incoming`` brings back."""
    if replaced is None:
        return upsert(existing, incoming, "source_row_id")
    kept = existing.join(replaced.select("source_row_id"), "source_row_id", "left_anti")
    return kept.select(*existing.columns).unionByName(incoming.select(*existing.columns))


def broken_references(star: Star, broadcast: bool = False) -> DataFrame:
    """Rows per guard: keys without a dimension row, forbidden nulls, bad ids and statuses.

    ``broadcast`` states that the dimensions' size was measured and is small: the fact then is read
    once, beside all four. Otherwise distinct keys are taken before an anti join for each of them, so hot keys
    cost one row each.
    """
    fact = star.fact
    references = [
        ("orphan_product", "product_key", star.products), ("orphan_country", "country_key", star.countries),
        ("orphan_customer", "customer_key", star.customers), ("orphan_date", "date_key", star.dates),
    ]
    orphans = []
    if broadcast:
        for guard, key, dimension in references:
            known = dimension.select(F.col(key).alias(f"_{key}"))
            fact = fact.join(F.broadcast(known), F.col(key) == F.col(f"_{key}"), "left")
            orphans.append(F.count_if(F.col(key).isNotNull() & F.col(f"_{key}").isNull()).alias(guard))

    def dangling(guard: str, key: str, dimension: DataFrame) -> DataFrame:
        used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        lost = used.join(dimension.select(key), key, "left_anti")
        return lost.agg(F.lit(guard).alias("guard"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))

    faults = fact.agg(
        F.count_if(F.col("source_row_id") < 0).alias("negative_id"),
        F.count_if(~F.col("transaction_status").isin(C.STATUSES)).alias("unknown_status"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in C.FACT_REQUIRED],
        *orphans,
    )
    result = faults.unpivot([], faults.columns, "guard", "rows")
    for reference in references if not broadcast else []:
        result = result.unionByName(dangling(*reference))
    return result
