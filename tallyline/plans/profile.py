"""Profile of a raw extract and summary of a cleaned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline.functions import status as S
from tallyline.functions.money import line_value, percent


def _int_count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def raw_statistics(raw: DataFrame) -> DataFrame:
    """PRF-2, 5, 6, 7, 8, 10: every one-pass figure as one row. A caller that selects a few
    columns pays only for those."""
    quantity, price = F.col("Quantity"), F.col("UnitPrice")
    voided = S.is_cancelled(F.col("InvoiceNo"))
    return raw.agg(
        F.count("*").alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in raw.columns],
        F.min("InvoiceDate").alias("invoice_date_min"),
        F.max("InvoiceDate").alias("invoice_date_max"),
        F.min(quantity).alias("quantity_min"),
        F.max(quantity).alias("quantity_max"),
        _int_count(quantity < 0).alias("quantity_negative_count"),
        _int_count(quantity == 0).alias("quantity_zero_count"),
        F.min(price).alias("unit_price_min"),
        F.max(price).alias("unit_price_max"),
        _int_count(price < 0).alias("unit_price_negative_count"),
        _int_count(price == 0).alias("unit_price_zero_count"),
        F.count_if(voided).alias("cancellation_count"),
        _int_count((quantity < 0) & ~voided).alias("potential_return_count"),
    )


def shape(raw: DataFrame) -> DataFrame:
    """PRF-1: every column with its type, whether it is expected, and the table's size."""
    described = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.lit(name not in C.RAW_COLUMNS).alias("is_unexpected"),
        )
        for name, kind in raw.dtypes
    ]
    return raw.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(len(raw.columns)).cast("bigint").alias("column_count"),
        F.inline(F.array(*described)),
    )


def missing_values(raw: DataFrame) -> DataFrame:
    """PRF-2: nulls per column, counted for all columns in one pass."""
    stats = raw_statistics(raw)
    counted = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"missing_{c}").alias("missing_count"),
            percent(F.col(f"missing_{c}"), F.col("row_count")).alias("missing_pct"),
        )
        for c in raw.columns
    ]
    return stats.select(F.inline(F.array(*counted)))


def duplicate_rows(raw: DataFrame) -> DataFrame:
    """PRF-3: rows beyond the first of each group of equal rows."""
    groups = raw.groupBy(*raw.columns).agg(F.count("*").alias("n"))
    extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return groups.agg(
        extra.alias("duplicate_rows"), percent(extra, F.sum("n")).alias("duplicate_rows_pct")
    )


def _distinct(raw: DataFrame, column: str) -> Column:
    """Distinct non-null values of one column as a scalar; reads only that column."""
    return raw.agg(F.count_distinct(column)).scalar()


def distinct_counts(raw: DataFrame, approximate: bool = False) -> DataFrame:
    """PRF-4. Exact by default, one narrow scan per column; several distinct aggregates in
    one query would copy every row once per column instead."""
    names = {
        "unique_invoice_count": "InvoiceNo",
        "unique_customer_count": "CustomerID",
        "unique_product_count": "StockCode",
        "unique_country_count": "Country",
    }
    if approximate:
        return raw.agg(*[F.approx_count_distinct(c).alias(n) for n, c in names.items()])
    first, *rest = names.items()
    counts = raw.agg(F.count_distinct(first[1]).alias(first[0]))
    return counts.withColumns({n: _distinct(raw, c) for n, c in rest})


def date_range(raw: DataFrame) -> DataFrame:
    """PRF-5: ISO texts."""
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    return raw_statistics(raw).select(
        F.date_format("invoice_date_min", iso).alias("invoice_date_min"),
        F.date_format("invoice_date_max", iso).alias("invoice_date_max"),
    )


def quantity_range(raw: DataFrame) -> DataFrame:
    """PRF-6."""
    return raw_statistics(raw).select(
        "quantity_min", "quantity_max", "quantity_negative_count", "quantity_zero_count"
    )


def price_range(raw: DataFrame) -> DataFrame:
    """PRF-7."""
    return raw_statistics(raw).select(
        "unit_price_min", "unit_price_max", "unit_price_negative_count", "unit_price_zero_count"
    )


def reversal_counts(raw: DataFrame) -> DataFrame:
    """PRF-8."""
    return raw_statistics(raw).select(
        "cancellation_count",
        percent(F.col("cancellation_count"), F.col("row_count")).alias("cancellation_pct_of_rows"),
        "potential_return_count",
    )


def country_distribution(raw: DataFrame) -> DataFrame:
    """PRF-9: rows per country; a missing country gets its own bucket."""
    country = F.coalesce(F.col("Country"), F.lit("(missing)"))
    return raw.groupBy(country.alias("country")).agg(F.count("*").alias("row_count"))


def top_countries(raw: DataFrame, n: int = 15) -> DataFrame:
    return country_distribution(raw).orderBy(F.col("row_count").desc(), "country").limit(n)


def identifier_coverage(raw: DataFrame) -> DataFrame:
    """PRF-10."""
    rows = F.col("row_count")
    customers, codes = rows - F.col("missing_CustomerID"), rows - F.col("missing_StockCode")
    return raw_statistics(raw).select(
        customers.alias("customer_id_present_count"),
        percent(customers, rows).alias("customer_id_present_pct"),
        codes.alias("stock_code_present_count"),
        percent(codes, rows).alias("stock_code_present_pct"),
    )


def profile_figures(raw: DataFrame) -> DataFrame:
    """The whole profile as one row: statistics, distinct counts and duplicates."""
    extra = duplicate_rows(raw).select(F.struct("*")).scalar()
    distinct = distinct_counts(raw).select(F.struct("*")).scalar()
    return raw_statistics(raw).select(
        "*",
        extra.getField("duplicate_rows").alias("duplicate_rows"),
        extra.getField("duplicate_rows_pct").alias("duplicate_rows_pct"),
        distinct.alias("distinct"),
        F.lit(len([c for c in raw.columns if c not in C.RAW_COLUMNS]))
        .cast("bigint")
        .alias("unexpected_column_count"),
    )


def exact_value(status: str | None = None) -> Column:
    """CLN-15: unrounded quantity x price summed, rounded once at the end."""
    value = line_value(F.col("quantity"), F.col("unit_price"))
    if status:
        value = F.when(S.has_status(status), value)
    return F.coalesce(F.round(F.sum(value), 2), F.lit(0)).cast("decimal(24,2)")


def exact_revenue(cleaned: DataFrame) -> DataFrame:
    """CLN-15 for every status, plus net."""
    sums = cleaned.agg(
        exact_value(C.VALID_SALE).alias("gross_sales_revenue"),
        exact_value(C.CANCELLATION).alias("cancellation_value"),
        exact_value(C.POTENTIAL_RETURN).alias("potential_return_value"),
        exact_value(C.NON_STANDARD).alias("non_standard_value"),
    )
    net = F.col("gross_sales_revenue") + F.col("cancellation_value")
    return sums.withColumn("net_revenue", net)


def cleaning_figures(cleaned: DataFrame) -> DataFrame:
    """CLN-16 as one row. The duplicate groups are counted over flagged lines only."""
    flags = [F.count_if(f).alias(f.removeprefix("flag_")) for f in C.FLAGS]
    groups = (
        cleaned.filter("flag_duplicate_candidate")
        .groupBy(*C.LINE_COLUMNS)
        .agg(F.count("*").alias("n"))
        .agg(F.struct(F.count("*").alias("groups"), F.coalesce(F.max("n"), F.lit(0)).alias("max")))
        .scalar()
    )
    net = exact_value(C.VALID_SALE) + exact_value(C.CANCELLATION)
    unmatched = S.cancelled() & F.coalesce(F.col("quantity") >= 0, F.lit(False))
    one_row = cleaned.agg(
        F.count("*").alias("row_count"),
        *[S.rows_with(s).alias(f"{s}_rows") for s in C.STATUSES],
        F.count_if(unmatched).alias("cancellation_exceptions"),
        *flags,
        exact_value(C.VALID_SALE).alias("gross_sales_revenue"),
        exact_value(C.CANCELLATION).alias("cancellation_value"),
        exact_value(C.POTENTIAL_RETURN).alias("potential_return_value"),
        exact_value(C.NON_STANDARD).alias("non_standard_value"),
        net.alias("net_revenue"),
    )
    return one_row.withColumns(
        {
            "duplicate_group_count": groups.getField("groups"),
            "largest_duplicate_group": groups.getField("max"),
        }
    )


def cleaning_summary(cleaned: DataFrame, raw_rows: Column | None = None) -> DataFrame:
    """CLN-16 as (section, metric, value) rows."""
    rows = F.col("row_count")
    entries = [("rows", "raw", raw_rows if raw_rows is not None else rows), ("rows", "cleaned", rows)]
    entries += [("status_count", s, F.col(f"{s}_rows")) for s in C.STATUSES]
    entries += [("status_pct", s, percent(F.col(f"{s}_rows"), rows)) for s in C.STATUSES]
    entries += [
        ("exceptions", "cancellation_exceptions", F.col("cancellation_exceptions")),
        ("exceptions", "invoice_format_exceptions", F.col("non_standard_invoice_format")),
    ]
    entries += [
        ("flags", name, F.col(name))
        for name in (f.removeprefix("flag_") for f in C.FLAGS)
        if name != "non_standard_invoice_format"
    ]
    entries += [
        ("duplicates", "candidate_row_count", F.col("duplicate_candidate")),
        ("duplicates", "distinct_group_count", F.col("duplicate_group_count")),
        ("duplicates", "largest_group_size", F.col("largest_duplicate_group")),
    ]
    entries += [
        ("revenue", name, F.col(name))
        for name in [
            "gross_sales_revenue", "cancellation_value", "potential_return_value",
            "non_standard_value", "net_revenue",
        ]
    ]
    listed = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit(metric).alias("metric"),
            value.cast("decimal(24,2)").alias("value"),
        )
        for section, metric, value in entries
    ]
    return cleaning_figures(cleaned).select(F.inline(F.array(*listed)))
