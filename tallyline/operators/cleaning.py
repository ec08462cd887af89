"""Raw lines to classified lines. No row is ever added, dropped or filtered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import contracts as C
from tallyline.functions.money import as_price, line_revenue
from tallyline.functions.status import row_flags, transaction_status
from tallyline.functions.text import stripped, stripped_or_null
from tallyline.operators.copies import expand_copies
from tallyline.operators.ordering import Ranges, rows_before
from tallyline.session import COMPRESSION

# Lines are numbered in this order, nulls first. It starts with the time, so ids are
# chronological and every task that writes a range touches only a few months.
LINE_ORDER = [
    "invoice_date",
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "unit_price",
    "customer_id",
    "country",
]


def _customer_id(df: DataFrame) -> Column:
    """Nullable whole number; a fractional id is an error, not something to truncate."""
    column = F.col("CustomerID")
    if isinstance(df.schema["CustomerID"].dataType, (T.DoubleType, T.FloatType)):
        column = F.nanvl(column, F.lit(None).cast("double"))
        broken = F.raise_error(F.concat(F.lit("CustomerID is not whole: "), column.cast("string")))
        return F.when(
            column.isNull() | (column == F.floor(column)), column.cast("bigint")
        ).otherwise(broken.cast("bigint"))
    return column.cast("bigint")


def normalise(raw: DataFrame) -> DataFrame:
    """The eight raw columns under their final names, types and spelling."""
    return raw.select(
        stripped(F.col("InvoiceNo").cast("string")).alias("invoice_no"),
        stripped(F.col("StockCode").cast("string")).alias("stock_code"),
        stripped_or_null(F.col("Description").cast("string")).alias("description"),
        F.col("Quantity").cast("int").alias("quantity"),
        F.col("InvoiceDate").try_cast("timestamp_ntz").alias("invoice_date"),
        as_price(F.col("UnitPrice")).alias("unit_price"),
        _customer_id(raw).alias("customer_id"),
        stripped(F.col("Country").cast("string")).alias("country"),
    )


def classify(lines: DataFrame) -> DataFrame:
    """Status, revenue and the row-local flags. Needs no shuffle."""
    return lines.withColumns(
        {
            "transaction_status": transaction_status(
                F.col("invoice_no"), F.col("quantity"), F.col("unit_price"), F.col("invoice_date")
            ),
            "line_revenue": line_revenue(F.col("quantity"), F.col("unit_price")),
            **row_flags(),
        }
    )


def line_groups(lines: DataFrame) -> DataFrame:
    """One row per distinct line with the number of its copies. Copies are counted before
    the shuffle, so a line repeated a billion times arrives as one row per task."""
    return lines.groupBy(*C.LINE_COLUMNS).agg(F.count("*").alias("copies"))


# Ranges for each shuffle partition, so that hashing range numbers spreads them evenly.
RANGES_A_PARTITION = 4

# A line with more copies than this, and than four mean ranges hold, is written out by several tasks.
COPIES_A_TASK = 1_000_000


def line_ranges(lines: DataFrame, count: int) -> Ranges:
    """Ranges of lines in their order. The time alone bounds them, so that sampling and counting read one column and
    most often its cell tells the range, unless a time is shared by so many lines that it would fill a range; then all columns do."""
    times = Ranges.sampled(lines, LINE_ORDER[:1], count)
    return times.on_cells() if times.size == count - 1 else Ranges.sampled(lines, LINE_ORDER, count)


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``source_row_id`` (0-based, contiguous) and ``flag_duplicate_candidate``.

    Lines equal on all eight columns are interchangeable. Bounds of ranges come from a sample and are kept as
    values: one pass counts the lines of each range, a second one sorts and numbers each range and adds the lines of
    the ranges before. Where a range is too large for a task, equal lines are counted first and the groups are
    numbered. Lines are never stored on the way; ``lines`` must give the same rows each time it is read.
    """
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = line_ranges(lines, RANGES_A_PARTITION * partitions)
    starts = rows_before(lines, ranges)
    sizes = starts.agg(F.max("_rows").alias("most"), F.avg("_rows").alias("mean")).first()
    limit = max(COPIES_A_TASK, int(4 * (sizes["mean"] or 0)))
    # A line with more copies than the limit makes its range as large.
    heavy = (sizes["most"] or 0) > limit
    return _number_groups(lines, ranges, starts, limit) if heavy else _number_each(lines, ranges, starts)


def _in_line_order() -> WindowSpec:
    return Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_first() for c in LINE_ORDER])


def _number_each(lines: DataFrame, ranges: Ranges, starts: DataFrame) -> DataFrame:
    """Lines numbered along their ranges. Equal lines share a range and lie together in it, so one shuffle and
    one sort serve both windows."""
    alike = Window.partitionBy("_range", *LINE_ORDER)
    numbered = (
        ranges.place(lines)
        .withColumn("_within", F.row_number().over(_in_line_order()))
        .withColumn("copies", F.count("*").over(alike))
        .join(F.broadcast(starts), "_range", "left")  # a row a range
    )
    return numbered.select(
        (F.col("_before") + F.col("_within") - 1).alias("source_row_id"),
        *C.LINE_COLUMNS,
        (F.col("copies") > 1).alias("flag_duplicate_candidate"),
    )


def _number_groups(lines: DataFrame, ranges: Ranges, starts: DataFrame, limit: int) -> DataFrame:
    """Lines numbered by groups of equal ones, counted before the shuffle; a group's copies follow from its first number."""
    earlier = _in_line_order().rowsBetween(Window.unboundedPreceding, -1)
    groups = (
        ranges.place(line_groups(lines))
        .withColumn("_within", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
        .join(F.broadcast(starts), "_range", "left")  # a row a range
    )
    copies = expand_copies(groups, "copies", "copy_no", limit, heavy=True)
    return copies.select(
        (F.col("_before") + F.col("_within") + F.col("copy_no") - 1).alias("source_row_id"),
        *C.LINE_COLUMNS,
        (F.col("copies") > 1).alias("flag_duplicate_candidate"),
    )


def clean(raw: DataFrame) -> DataFrame:
    """The full cleaned table in contract order."""
    return classify(number_lines(normalise(raw))).select(*C.CLEANED_COLUMNS)


def with_month(df: DataFrame, at: str) -> DataFrame:
    """Storage partition columns."""
    return df.withColumns({"year": F.year(at), "month": F.month(at)})


def save_cleaned(cleaned: DataFrame, path: str) -> None:
    """Parquet by month. Ids follow time, so the ranges are already clustered by month."""
    with_month(cleaned, "invoice_date").write.mode("errorifexists").options(**COMPRESSION).partitionBy(
        "year", "month"
    ).parquet(path)
