"""Row numbers, ranks, tiles and percentiles over data of any size.

A window without PARTITION BY moves every row into one task. These operators range-partition
instead: each task sorts one range, and the number of rows in the ranges before it (one small
row per range) turns local positions into global ones. The order always ends in a unique
tiebreak, so a value shared by many rows is spread over as many ranges as it needs.

There are two ways to fix the ranges. :func:`number_rows` lets Spark choose them for any order of columns; Spark's bounds
may differ between executions, so the ranges are written once and every later step reads that same table.
:class:`Ranges` takes its bounds from one sample and keeps them as values, so that a plan can tell a row's range from the row
alone, as often as it likes, and no table of rows is written.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, time, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.session import stash

# Stored groups up to this many rows are ordered by a plain window in one task.
ONE_TASK_ROWS = 1_000_000

# monotonically_increasing_id() = partition index << 33 | position in the partition
_POSITION_BITS = 33


def _ascending(names: Sequence[str]) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


def _match(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[f"_k_{name}"])
    return condition


def _join_back(df: DataFrame, small: DataFrame, keys: Sequence[str], added: Sequence[str]):
    """Attach ``added`` from ``small``, which has one row per null-safe ``keys``."""
    side = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *added)
    return df.join(side, _match(df, side, keys)).select(*df.columns, *added)


def fits_one_task(
    stored: DataFrame, within: Sequence[str] = (), limit: int | None = None
) -> bool:
    """Whether every ``within`` group of a stored (not merely planned) table is small enough
    for a plain window."""
    most = ONE_TASK_ROWS if limit is None else limit
    sizes = stored.groupBy(*within).agg(F.count("*").alias("rows"))
    return sizes.filter(F.col("rows") > most).isEmpty()


#: Rows that fix the bounds of ranges, about; they are sorted in one task.
SAMPLE_ROWS = 100_000


def _sql(value, kind: T.DataType) -> str:
    """A value as the text of a literal."""
    if value is None:
        return f"CAST(NULL AS {kind.simpleString()})"
    text = f"X'{str(value).encode().hex()}'"
    return f"CAST(CAST({text} AS STRING) AS {kind.simpleString()})"


#: Cells of time for each range; most cells then hold no bound.
CELLS_A_RANGE = 8


@dataclass(frozen=True)
class Cells:
    """Equal spans of time, and how the bounds of ranges lie among them: what a time alone tells about a row's range."""

    begin: datetime
    seconds: int
    #: For each cell, bounds in earlier cells and bounds in it; the first and last cell stand for all times outside.
    before: tuple[int, ...]
    inside: tuple[int, ...]

    @classmethod
    def among(cls, times: Sequence[datetime | None], count: int) -> Cells | None:
        """``times`` ascend, nulls first."""
        known = [t for t in times if t is not None]
        if not known:
            return None
        begin = datetime.combine(known[0].date(), time())
        places = [(t - begin) // timedelta(seconds=1) for t in known]
        seconds = places[-1] // (CELLS_A_RANGE * count) + 1
        unit = next(u for u in (86400, 3600, 1) if seconds >= u)
        seconds = math.ceil(seconds / unit) * unit
        inside = [0] * (places[-1] // seconds + 3)
        for place in places:
            inside[place // seconds + 1] += 1
        nulls = len(times) - len(known)
        return cls(begin, seconds, tuple(nulls + sum(inside[:i]) for i in range(len(inside))), tuple(inside))

    def at(self, column: str) -> Column:
        """A row's cell, null for a null time. No finer part of the time is looked at than cells need."""
        place = F.datediff(F.col(column), F.lit(self.begin.date())).cast("bigint")
        unit = 86400
        if self.seconds % unit:
            place, unit = place * 24 + F.hour(column), 3600
        if self.seconds % unit:
            place, unit = place * 3600 + F.minute(column) * 60 + F.second(column).cast("int"), 1
        width = F.lit(self.seconds // unit)
        cell = F.call_function("div", place + width, width)
        last = F.lit(len(self.inside) - 1)
        return F.when(F.col(column).isNotNull(), F.least(F.greatest(cell, F.lit(0)), last).cast("int"))


def _whole_numbers(values: Sequence[int]) -> Column:
    return F.expr(f"array({', '.join(map(str, values))})")


@dataclass(frozen=True)
class Ranges:
    """Ranges of rows in ascending order of ``columns``, nulls first, by bounds that are values."""

    columns: tuple[str, ...]
    #: The bounds in order, cut into groups of ``width``: the text of a constant, which is folded into one literal
    #: of ``kind``, the type that rows have too, so that comparing casts nothing.
    bounds: str
    kind: str
    width: int
    #: Number of bounds; fewer than asked for where equal rows fill whole ranges.
    size: int
    #: Where the first column is a time without zone.
    cells: Cells | None = None
    #: Whether ranges are made of whole cells: a cell that holds a bound then belongs to the range below it.
    whole_cells: bool = False

    @classmethod
    def sampled(cls, rows: DataFrame, columns: Sequence[str], count: int) -> Ranges:
        """About ``count`` ranges with equally many of ``rows`` each, unless equal rows are more than that."""
        share = min(1.0, SAMPLE_ROWS / max(rows.count(), 1))
        keys = rows.select(*columns)
        sample = keys.sample(share, seed=11).select(F.struct(*columns).alias("key"))
        ordered = sample.agg(F.sort_array(F.collect_list("key")).alias("keys"))
        step = F.size("keys") / F.lit(count)
        chosen = F.transform(F.sequence(F.lit(1), F.lit(max(count - 1, 1))), lambda i: F.get("keys", F.floor(i * step).cast("int")))
        bounds = ordered.select(F.array_distinct(F.filter(chosen, lambda b: b.isNotNull()))).first()[0]
        kinds = [field.dataType for field in keys.schema.fields]
        structs = [
            "named_struct(" + ", ".join(f"'{c}', {_sql(v, k)}" for c, v, k in zip(columns, bound, kinds, strict=True)) + ")"
            for bound in bounds
        ]
        width = math.ceil(math.sqrt(count))
        groups = [f"array({', '.join(structs[i : i + width])})" for i in range(0, len(structs), width)]
        kind = T.ArrayType(T.ArrayType(keys.schema)).simpleString()
        timed = isinstance(kinds[0], T.TimestampNTZType)
        cells = Cells.among([bound[0] for bound in bounds], count) if timed else None
        return cls(tuple(columns), f"array({', '.join(groups)})" if groups else "", kind, width, len(bounds), cells)

    def on_cells(self) -> Ranges:
        """These ranges with their bounds moved to the next end of a cell, so that the cell alone tells a row's range;
        unchanged where a cell holds several bounds."""
        spread = self.cells is not None and max(self.cells.inside) <= 1
        return replace(self, whole_cells=True) if spread else self

    def place(self, rows: DataFrame) -> DataFrame:
        """Add ``_range``, the number of a row's range. Of ranges with exact bounds, a time whose cell holds no bound tells it alone, others
        compare with the bounds of their cell, and rows without a time or in a crowded cell with all bounds."""
        if self.cells is None:
            return rows.withColumn("_range", self.number())
        if self.whole_cells:
            found = F.get(_whole_numbers(self.cells.before), self.cells.at(self.columns[0]))
            return rows.withColumn("_range", F.coalesce(found, F.lit(0)))  # nulls come first
        before, inside = (F.get(_whole_numbers(v), F.col("_cell")) for v in (self.cells.before, self.cells.inside))
        bounds = F.flatten(F.expr(self.bounds).cast(self.kind))
        key = F.struct(*self.columns)
        below = F.size(F.filter(F.slice(bounds, before + 1, inside), lambda b: b <= key))
        crowded = F.col("_cell").isNull() | (inside > self.width)
        number = F.when(crowded, self.number()).when(inside == 0, before).otherwise(before + below)
        return rows.withColumn("_cell", self.cells.at(self.columns[0])).withColumn("_range", number).drop("_cell")

    def number(self) -> Column:
        """The number of a row's range with exact bounds, from 0: how many bounds are not above it. Looked up in two steps."""
        if not self.bounds:
            return F.lit(0)
        groups = F.expr(self.bounds).cast(self.kind)

        def inside(key: Column, passed: Column) -> Column:
            below = F.size(F.filter(F.get(groups, passed - 1), lambda b: b <= key))
            return F.when(passed > 0, (passed - 1) * self.width + below).otherwise(0)

        def found(key: Column) -> Column:
            return _bound(F.size(F.filter(groups, lambda g: F.get(g, F.lit(0)) <= key)), lambda p: inside(key, p))

        return _bound(F.struct(*self.columns), found)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def rows_before(rows: DataFrame, ranges: Ranges) -> DataFrame:
    """``(_range, _rows, _before)``, stored: the rows of each range and of all ranges before it. One pass over ``rows``,
    counted before the shuffle."""
    counts = stash(ranges.place(rows).groupBy("_range").agg(F.count("*").alias("_rows")), "range-counts")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    return counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))


def distinct_ids(rows: DataFrame, column: str) -> DataFrame:
    """One row: how many distinct whole numbers a column holds. 64 neighbours are the bits of one word, combined
    before the shuffle, so ids that lie together travel as a few words."""
    ids = rows.select(F.col(column).cast("bigint").alias("_id")).filter("_id IS NOT NULL")
    bit = F.expr("shiftleft(1L, CAST(_id & 63L AS INT))")
    words = ids.groupBy(F.shiftright("_id", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return words.agg(F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("bigint").alias("ids"))


def number_rows(
    df: DataFrame,
    name: str,
    order: Sequence[Column],
    within: Sequence[str] = (),
    total: str | None = None,
    keep_block: bool = False,
    single: bool = False,
) -> DataFrame:
    """Add 1-based row numbers ``name`` in ``order``, restarting for each ``within`` group.

    ``order`` must end in columns that make rows unique. ``total`` names an optional column
    with the number of rows of the group. ``single`` states that the caller measured the
    table with :func:`fits_one_task`.
    """
    if single:
        whole = Window.partitionBy(*within)
        numbered = df.withColumn(name, F.row_number().over(whole.orderBy(*order)).cast("bigint"))
        return numbered.withColumn(total, F.count("*").over(whole)) if total else numbered
    keys = [*_ascending(within), *order]
    placed = stash(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ranges",
    ).withColumn("_block", F.shiftright("_slot", _POSITION_BITS))

    blocks = placed.groupBy(*within, "_block").agg(
        F.min("_slot").alias("_first"), F.count("*").alias("_rows")
    )
    group = Window.partitionBy(*within)
    before = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        *within,
        "_block",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_rows").over(group).alias("_total"),
    )
    if not within:
        starts = F.broadcast(starts)  # one row per range, so at most the partition count

    joined = _join_back(placed, starts, [*within, "_block"], ["_shift", "_total"])
    columns = [*df.columns, (F.col("_slot") + F.col("_shift")).alias(name)]
    if total:
        columns.append(F.col("_total").alias(total))
    if keep_block:
        columns.append(F.col("_block"))
    return joined.select(*columns)


def rank_rows(
    df: DataFrame,
    name: str,
    by: str,
    tiebreak: Sequence[str],
    descending: bool = True,
    within: Sequence[str] = (),
    single: bool = False,
) -> DataFrame:
    """RANK: one plus the number of rows of the group that sort strictly before.

    Equal values take the smallest row number among them. The first row number is looked up
    per (value, range): a value held by many rows meets one small row per range it spans.
    """
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    if single:
        window = Window.partitionBy(*within).orderBy(first)
        return df.withColumn(name, F.rank().over(window).cast("bigint"))
    numbered = number_rows(
        df, "_n", [first, *_ascending(tiebreak)], within=within, keep_block=True
    )
    spans = numbered.groupBy(*within, by, "_block").agg(F.min("_n").alias("_n"))
    ranks = spans.select(
        *within, by, "_block", F.min("_n").over(Window.partitionBy(*within, by)).alias(name)
    )
    return _join_back(numbered, ranks, [*within, by, "_block"], [name]).drop("_n", "_block")


#: Buckets that a round of :func:`ranked_values` counts for each value it looks for.
BUCKETS = 1024


def ranked_values(stored: DataFrame, value: str, ranks: Sequence[int]) -> dict[int, Decimal]:
    """Exact values of a stored decimal column at 0-based ascending positions among its non-null values, without sorting them.

    Each round counts the values in equal buckets of the interval that holds a position, map-side, and goes on in the bucket
    that holds it, until a bucket is one value wide: a few rounds, whatever the number of rows or how many are
    equal. A round returns at most ``BUCKETS`` counts for each position."""
    scale = getattr(stored.schema[value].dataType, "scale", 0)
    units = stored.select((F.col(value) * 10**scale).cast("decimal(38,0)").cast("bigint").alias("u")).filter("u IS NOT NULL")
    ends = units.agg(F.min("u").alias("low"), F.max("u").alias("high")).first()
    open_ = {rank: (ends["low"], ends["high"], rank) for rank in set(ranks)}
    while any(low < high for low, high, _ in open_.values()):
        searched = {rank: at for rank, at in open_.items() if at[0] < at[1]}
        width = {rank: -(-(high - low + 1) // BUCKETS) for rank, (low, high, _) in searched.items()}
        hits = [
            F.when(F.col("u").between(low, high), F.struct(F.lit(rank).cast("bigint").alias("rank"), F.expr(f"(u - {low}L) div {width[rank]}L").alias("bucket")))
            for rank, (low, high, _) in searched.items()
        ]
        counted = units.select(F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("h")).groupBy("h.rank", "h.bucket").count()
        found: dict[int, list] = {rank: [] for rank in searched}
        for row in counted.collect():  # BUCKETS rows a position
            found[row["rank"]].append((row["bucket"], row["count"]))
        for rank, (low, high, left) in searched.items():
            for bucket, count in sorted(found[rank]):
                if left < count:
                    begin = low + bucket * width[rank]
                    open_[rank] = (begin, min(begin + width[rank] - 1, high), left)
                    break
                left -= count
    return {rank: Decimal(low).scaleb(-scale) for rank, (low, _, _) in open_.items()}


def tile(position: Column, rows: Column, tiles: int) -> Column:
    """NTILE bucket of a row number: the first ``rows % tiles`` buckets hold one row more."""
    size = F.floor(rows / tiles)
    extra = rows % tiles
    in_large = extra * (size + 1)
    return (
        F.when(position <= in_large, F.ceil(position / (size + 1)))
        .otherwise(extra + F.ceil((position - in_large) / F.greatest(size, F.lit(1))))
        .cast("int")
    )


def tile_rows(
    df: DataFrame, name: str, tiles: int, order: Sequence[Column], single: bool = False
) -> DataFrame:
    """NTILE(``tiles``) over the whole table in ``order`` (which ends in a unique key)."""
    numbered = number_rows(df, "_n", order, total="_of", single=single)
    return numbered.withColumn(name, tile(F.col("_n"), F.col("_of"), tiles)).drop("_n", "_of")


def percentile_at(value: str, position: Column, rows: Column, fraction: str) -> Column:
    """Interpolated percentile as an aggregate over numbered rows.

    ``position`` counts from 1 in ascending order of ``value``. Picks the two neighbouring
    order statistics, so no value table is ever held in one buffer.
    """
    target = (rows - 1) * F.lit(fraction).cast("decimal(6,4)")
    low, high = F.floor(target), F.ceil(target)
    at_low = F.max(F.when(position - 1 == low, F.col(value)))
    at_high = F.max(F.when(position - 1 == high, F.col(value)))
    weight = F.max(target - low)
    return (at_low + (at_high - at_low) * weight).cast("double")
