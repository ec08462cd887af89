"""Versioned star schema: load, guard, publish, read.

A version is a set of dimension tables and a list of month folders, most of which it shares with the
version before: a load finds the months that changed lines leave or enter, writes these anew, and points to the
old folders for the rest. Readers follow a log of published versions, and a load adds its entry to that log
last: a load that fails at any point leaves readers on the version they had. Two loads that start from one
version cannot both be published.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline import store
from tallyline.contracts import ContractError, Star
from tallyline.operators.cleaning import with_month
from tallyline.plans import star as build
from tallyline.plans.rules import check_staging, reconcile
from tallyline.session import COMPRESSION, concurrently, path_missing, scratch_scope, shuffles_removed, stash

# Dimensions up to this stored size are broadcast to the fact build; larger ones shuffle.
BROADCAST_BYTES = 32 * 1024 * 1024

# Lines that shuffle joins build into the fact at a time; their shuffle files, some 170 bytes a line, go before the next ones are made.
LINES_A_BATCH = 24_000_000

DIMENSIONS = ["dim_date", "dim_country", "dim_customer", "dim_product"]


#: The log: a row for each month of each version, and where that month is stored. A version without lines has
#: one row without a month.
LOG = "version bigint, year int, month int, folder string"

Month = tuple[int | None, int | None]


@dataclass(frozen=True)
class Loaded:
    version: int
    star: Star
    reconciliation: DataFrame
    #: The months that this load wrote anew.
    rewritten: list[Month]


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    # --- reading ------------------------------------------------------------------------------

    def _log(self) -> DataFrame | None:
        with path_missing():
            return self.spark.read.schema(LOG).parquet(f"{self.root}/published")
        return None

    def current_version(self) -> int | None:
        log = self._log()
        return None if log is None else log.agg(F.max("version")).first()[0]

    def months(self, version: int) -> dict[Month, str]:
        """The month folders a version consists of; as many entries as the data have months."""
        log = self._log()
        rows = [] if log is None else log.filter(F.col("version") == version).collect()
        if not rows:
            raise ContractError(f"version {version} has not been published in {self.root}")
        return {(r["year"], r["month"]): r["folder"] for r in rows if r["folder"] is not None}

    def _path(self, version: int, table: str) -> str:
        return f"{self.root}/v={version}/{table}"

    def _read(self, version: int, table: str) -> DataFrame:
        return self.spark.read.parquet(self._path(version, table))

    def _by_month(self, folders: list[str]) -> DataFrame:
        """Lines of some month folders, with their storage columns."""
        if not folders:
            return self.spark.createDataFrame([], C.FACT_BY_MONTH)
        reader = self.spark.read.schema(C.FACT_BY_MONTH).option("basePath", f"{self.root}/fact_sales")
        lines = reader.parquet(*[f"{self.root}/fact_sales/{f}" for f in folders])
        return lines.select(*C.FACT_BY_MONTH.names)

    def _star(self, version: int, folders: list[str]) -> Star:
        by_month = self._by_month(folders)
        dimensions = [self._read(version, name) for name in DIMENSIONS]
        return Star(by_month.select(*C.FACT_COLUMNS), *dimensions, by_month=by_month)

    def star(self, version: int | None = None) -> Star:
        version = self.current_version() if version is None else version
        if version is None:
            raise ContractError(f"nothing has been published in {self.root}")
        return self._star(version, sorted(self.months(version).values()))

    # --- loading ------------------------------------------------------------------------------

    def _small(self, version: int, tables: list[str]) -> bool:
        """Whether stored dimensions may be broadcast, all together."""
        return store.size(self.spark, [self._path(version, t) for t in tables]) <= BROADCAST_BYTES

    def _fact_folder(self, version: int) -> str:
        return f"{self.root}/fact_sales/v={version}"

    def _write_months(self, version: int, lines: DataFrame, gather: bool, mode: str = "errorifexists") -> dict[Month, str]:
        """Write lines under their months; the folders made so far, by month."""
        if gather:
            # A shuffle join loses the order by time; gather months again. Rebalancing
            # splits a large month over several tasks instead of writing it in one.
            lines = lines.hint("rebalance", F.col("year"), F.col("month"))
        # Rare statuses then lie together, so that their row groups can be told by their bounds.
        lines = lines.sortWithinPartitions("year", "month", "transaction_status", "source_row_id")
        lines.write.mode(mode).options(**COMPRESSION).partitionBy("year", "month").parquet(self._fact_folder(version))
        return self._written(version)

    def _written(self, version: int) -> dict[Month, str]:
        found = {}
        for path in store.matching(self.spark, f"{self._fact_folder(version)}/year=*/month=*"):
            folder = "/".join(path.split("/")[-3:])
            year, month = (part.split("=")[1] for part in folder.split("/")[1:])
            found[None if year.startswith("__") else int(year), None if month.startswith("__") else int(month)] = folder
        return found

    def _write_fact(self, version: int, cleaned: DataFrame, old: dict[Month, str]) -> dict[Month, str]:
        """Write the months that change; all months of the new version and where they are."""
        countries, customers, products = (self._read(version, t) for t in DIMENSIONS[1:])
        small = self._small(version, DIMENSIONS[1:])

        def fact(lines: DataFrame) -> DataFrame:
            return with_month(build.build_fact(lines, countries, customers, products, broadcast=small), "invoice_timestamp")

        if not old:
            first, *others = [cleaned] if small else _batches(cleaned, LINES_A_BATCH)
            made = self._write_months(version, fact(first), gather=not small)
            for part in others:
                made = self._write_months(version, fact(part), gather=True, mode="append")
            return made
        incoming = stash(fact(cleaned), "incoming-lines")
        touched = self._touched(incoming, old)
        if not touched:
            return old
        kept = self._by_month([old[m] for m in touched if m in old])
        merged = build.merge_fact(kept, incoming.filter(_in_months(touched)), incoming)
        made = self._write_months(version, merged, gather=True)
        return {m: f for m, f in old.items() if m not in touched} | made

    def _touched(self, incoming: DataFrame, old: dict[Month, str]) -> list[Month]:
        """Months that lines enter or leave: those of new and changed lines, before and after. Lines are compared
        by a hash of all their columns with the one of the same id, so only ids and hashes are shuffled."""
        content = F.xxhash64(*[F.col(c) for c in C.FACT_COLUMNS])
        stored = self._by_month(list(old.values())).select(
            "source_row_id", content.alias("was"), F.struct("year", "month").alias("left")
        )
        offered = incoming.select("source_row_id", content.alias("is"), F.struct("year", "month").alias("entered"))
        changed = offered.join(stored, "source_row_id", "left").filter("was IS NULL OR was <> is OR left <> entered")
        months = changed.select(F.explode(F.array("left", "entered")).alias("m")).filter("m IS NOT NULL")
        return [(r["year"], r["month"]) for r in months.select("m.year", "m.month").distinct().collect()]

    def load(self, cleaned: DataFrame, allow_vanished: bool = False) -> Loaded:
        """Merge a cleaned table into the model and publish the result.

        Broken references stop the load, and so does a fact that does not reconcile with its source
        line by line. Lines that vanished from the source stay in the fact; a load that is meant to
        leave some out says so with ``allow_vanished``. The comparison is stored with the version.
        Guards read the months this load wrote: older ones were guarded when they were written, and
        dimension rows are never removed. If another load is published meanwhile, this one fails.
        """
        with scratch_scope(self.spark), shuffles_removed(self.spark):
            return self._load(cleaned, allow_vanished)

    def _load(self, cleaned: DataFrame, allow_vanished: bool) -> Loaded:
        check_staging(cleaned)
        current = self.current_version()
        old = None if current is None else self.star(current)
        folders = {} if current is None else self.months(current)
        version = self._next_version(current)
        previous = (None,) * 4 if old is None else (
            old.dates, old.countries, old.customers, old.products
        )
        makers = [build.dim_date, build.dim_country, build.dim_customer, build.dim_product]

        def build_dimension(name, maker, existing):
            return lambda: maker(cleaned, existing).write.parquet(self._path(version, name))

        concurrently(
            [build_dimension(*job) for job in zip(DIMENSIONS, makers, previous, strict=True)]
        )
        months = self._write_fact(version, cleaned, folders)
        fresh = {m: f for m, f in months.items() if folders.get(m) != f}
        guards = build.broken_references(self._star(version, sorted(fresh.values())), self._small(version, DIMENSIONS))
        broken = guards.filter("rows > 0").collect()  # one row per guard
        if broken:
            raise ContractError("; ".join(f"{r['guard']}: {r['rows']} rows" for r in broken))
        star = self._star(version, sorted(months.values()))
        reconcile(cleaned, star.fact, per_line=True).write.parquet(self._path(version, "reconciliation"))
        checks = self._read(version, "reconciliation")
        failed = checks.filter("NOT passed").collect()  # one row per check
        if failed and not allow_vanished:
            names = ", ".join(sorted(r["check_name"] for r in failed))
            raise ContractError(f"the fact does not reconcile with its source: {names}")
        self._publish(version, current, months)
        return Loaded(version, star, checks, sorted(fresh, key=str))

    # --- publishing ---------------------------------------------------------------------------

    def _next_version(self, current: int | None) -> int:
        """The first number that nobody has claimed: failed loads and loads under way keep theirs, so two
        loads never write below one number."""
        version = (current or 0) + 1
        while not store.claim(self.spark, f"{self.root}/claims/version-{version}"):
            version += 1
        return version

    def _publish(self, version: int, base: int | None, months: dict[Month, str]) -> None:
        """Add the version's entry to the log, as the only successor of ``base``."""
        rows = [(version, y, m, f) for (y, m), f in months.items()] or [(version, None, None, None)]
        with store.sole_successor(self.spark, self._succession(base), lambda: self.current_version() == base, "load"):
            entry = self.spark.createDataFrame(rows, LOG).coalesce(1)  # one file, so it appears at once
            entry.write.mode("append").parquet(f"{self.root}/published")

    def _succession(self, base: int | None) -> str:
        return f"{self.root}/claims/after-{base or 0}"

    def release(self) -> None:
        """Let loads follow the current version again after a writer died while publishing."""
        store.remove(self.spark, self._succession(self.current_version()))

    def drop_before(self, version: int) -> list[str]:
        """Remove what only versions before ``version`` need, and what loads with such numbers left that were never
        published (one that is still running cannot be published any more). Returns the folders removed.
        Readers of those versions must be done; the log keeps their entries."""
        log = self._log()
        if log is None or log.filter(F.col("version") == version).isEmpty():
            raise ContractError(f"version {version} has not been published in {self.root}")
        needed = {r["folder"] for r in log.filter(F.col("version") >= version).select("folder").distinct().collect()}
        gone = []
        for pattern in ("v=*", "fact_sales/v=*/year=*/month=*"):
            for path in store.matching(self.spark, f"{self.root}/{pattern}"):
                parts = path.split("/")
                number = next(int(p[2:]) for p in reversed(parts) if p.startswith("v="))
                if number < version and "/".join(parts[-3:]) not in needed:
                    store.remove(self.spark, path)
                    gone.append(path)
        return gone


def _batches(lines: DataFrame, rows: int) -> list[DataFrame]:
    """``lines`` cut by their ids into parts of about ``rows`` each, if ids are spread evenly; together they are all of
    them. Ids follow time, so a part reads the files of its months."""
    ends = lines.agg(F.count("*").alias("rows"), F.min("source_row_id").alias("low"), F.max("source_row_id").alias("high")).first()
    parts = -(-ends["rows"] // rows)
    bounds = [ends["low"] + (ends["high"] - ends["low"] + 1) * i // parts for i in range(1, parts)]
    row_id, cuts = F.col("source_row_id"), [None, *bounds, None]
    return [
        lines.filter((F.lit(True) if low is None else row_id >= low) & (F.lit(True) if high is None else row_id < high))
        for low, high in zip(cuts, cuts[1:], strict=False)
    ]


def _in_months(months: list[Month]) -> Column:
    """Whether a line lies in one of ``months``; a condition on storage columns alone. Lines without a time have no month."""
    condition = F.lit(False)
    for year, month in months:
        condition = condition | (F.col("year").eqNullSafe(F.lit(year)) & F.col("month").eqNullSafe(F.lit(month)))
    return condition
