"""Checks on incoming extracts: content fingerprints, landing decisions, structure."""

from __future__ import annotations

import re
from dataclasses import dataclass
from posixpath import normpath
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import contracts as C
from tallyline import store
from tallyline.session import path_missing
from tallyline.sources.files import CSV, WHOLE_CSV

LOG = "place bigint, folder string, rows bigint, fingerprint string"


_SCHEME = r"^\w+:(//[^/]*)?"


def _plain(path: str) -> str:
    """A path without scheme and host, and without redundant slashes and dots."""
    return normpath(re.sub(_SCHEME, "", path))


def _fingerprint() -> Column:
    """Row count and two independent order-free sums of row hashes. One rule for files of any
    size and format: the same rows give the same fingerprint however they are stored."""
    row = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    short = F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("decimal(38,0)")
    long = F.xxhash64(row).cast("decimal(38,0)")
    sums = [F.coalesce(F.sum(h), F.lit(0)).cast("string") for h in (long, short)]
    return F.concat_ws(":", F.count("*").cast("string"), *sums)


def file_manifest(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row per file of the extract at ``path``: its place below ``path``, length, rows and
    content fingerprint."""
    rows = read_raw(spark, path, fmt)
    root = _plain(path)
    file = F.regexp_replace(F.col("_metadata.file_path"), _SCHEME, "")
    below = F.substring(file, F.locate(root, file) + len(root) + 1, F.length(file))
    tagged = rows.select("*", below.alias("_file"), F.col("_metadata.file_size").alias("_length"))
    kept = [c for c in tagged.columns if c not in ("_file", "_length")]
    row = F.to_json(F.struct(*kept), {"ignoreNullFields": "false"})
    short = F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("decimal(38,0)")
    sums = [F.sum(h).cast("string") for h in (F.xxhash64(row).cast("decimal(38,0)"), short)]
    return tagged.groupBy(F.col("_file").alias("file"), F.col("_length").alias("length")).agg(
        F.count("*").alias("rows"), F.concat_ws(":", F.count("*").cast("string"), *sums).alias("fingerprint")
    )


def extract_fingerprint(rows: DataFrame) -> tuple[int, str]:
    """Rows and fingerprint of a whole extract."""
    found = rows.select(*C.RAW_COLUMNS).agg(F.count("*").alias("rows"), _fingerprint().alias("fingerprint")).first()
    return found["rows"], found["fingerprint"]


def read_raw(
    spark: SparkSession, path: str, fmt: str = "parquet", only: list[str] | None = None, breaks: bool = True
) -> DataFrame:
    """Raw extract under its declared schema; required columns are checked before any job. A CSV
    line that does not fit the schema stops the read. ``only`` names some of its files. ``breaks`` states
    whether fields of CSV files may hold line breaks: such a file is read by one task, without
    them several tasks share it."""
    files = [path] if only is None else only
    reader = spark.read if only is None else spark.read.option("basePath", path)
    if fmt == "csv":
        reader = reader.options(mode="FAILFAST", **(WHOLE_CSV if breaks else CSV))
        header = reader.csv(files)
        C.require_columns(header, C.RAW_COLUMNS, f"raw extract {path}")
        types = {f.name: f.dataType for f in C.RAW_SCHEMA.fields}
        schema = T.StructType(
            [T.StructField(c, types.get(c, T.StringType()), True) for c in header.columns]
        )
        return reader.schema(schema).csv(files)
    raw = reader.format(fmt).load(files)
    C.require_columns(raw, C.RAW_COLUMNS, f"raw extract {path}")
    return raw


PRINTS = "path string, length bigint, modified timestamp, rows bigint, sums array<decimal(38,0)>"


def known_fingerprint(spark: SparkSession, path: str, landing: str, fmt: str = "parquet") -> tuple[int, str]:
    """Rows and fingerprint of a whole extract, from those of its files.

    A fingerprint is made of sums, so it adds up over files. The figures of each file are kept
    beside the landing log under its path, length and time of change; only files that are new or changed
    are read, by one pass over all of them. A file that is rewritten within the store's time
    resolution, to the same length, is taken for the old one."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = listed.select("path", "length", F.col("modificationTime").alias("modified"))
    kept = f"{landing}/prints"
    known = spark.createDataFrame([], PRINTS)
    with path_missing():
        known = spark.read.schema(PRINTS).parquet(kept)
    same = ["path", "length", "modified"]
    fresh = [r["path"] for r in listed.join(known, same, "left_anti").select("path").collect()]  # names of new files
    if fresh:
        rows = read_raw(spark, path, fmt, only=fresh).select(*C.RAW_COLUMNS, F.col("_metadata.file_path").alias("_path"))
        row = F.to_json(F.struct(*C.RAW_COLUMNS), {"ignoreNullFields": "false"})
        short = F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("decimal(38,0)")
        sums = F.array(F.sum(F.xxhash64(row).cast("decimal(38,0)")).cast("decimal(38,0)"), F.sum(short).cast("decimal(38,0)"))
        counted = rows.groupBy("_path").agg(F.count("*").alias("rows"), sums.alias("sums"))
        zero = F.array(*[F.lit(0).cast("decimal(38,0)")] * 2)
        added = listed.filter(F.col("path").isin(fresh)).join(counted, _file(F.col("path")) == _file(F.col("_path")), "left")
        added = added.select(*same, F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"), F.coalesce("sums", zero).alias("sums"))
        added.coalesce(1).write.mode("append").parquet(kept)
        known = spark.read.schema(PRINTS).parquet(kept)
    whole = listed.join(known.dropDuplicates(same), same).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)).cast("string").alias(f"s{i}") for i in (0, 1)],
    ).first()
    return whole["rows"], f"{whole['rows']}:{whole['s0']}:{whole['s1']}"


def _file(path: Column) -> Column:
    """A file's path without scheme and host, with the escapes of addresses undone."""
    return F.url_decode(F.replace(F.regexp_replace(path, _SCHEME, ""), F.lit("+"), F.lit("%2B")))


@dataclass(frozen=True)
class Landing:
    """What was decided, and where the landed data are."""

    action: str
    rows: int
    folder: str


def decide(
    incoming: str, recorded: str | None, present: str | None, force: bool = False, in_place: bool = False
) -> str:
    """The action for an extract, from the fingerprints of what comes, what was recorded when it
    was landed, and what is there now."""
    if recorded is None:
        return "land"
    if present != recorded:
        return "overwrite" if force and not in_place else "refuse"
    if in_place:
        return "verified_in_place"
    if incoming == recorded:
        return "skip"
    return "overwrite" if force else "refuse"


def _recorded(spark: SparkSession, landing: str):
    """The last entry of the landing log, or None."""
    with path_missing():
        return spark.read.schema(LOG).parquet(f"{landing}/log").orderBy(F.desc("place")).first()
    return None


def landed(spark: SparkSession, landing: str) -> DataFrame:
    """The landed extract."""
    entry = _recorded(spark, landing)
    if entry is None:
        raise C.ContractError(f"nothing has been landed in {landing}")
    return spark.read.parquet(entry["folder"])


def land(
    spark: SparkSession, source: str, landing: str, force: bool = False, fmt: str = "parquet"
) -> Landing:
    """Copy an extract into its landing folder once, guarded by content fingerprints.

    Both sides are fingerprinted each time: the source, and what was landed, which is compared with the
    entry written when it was; files that were fingerprinted before are not read again. Identical content is skipped; other content, landed data that
    changed or vanished, are refused unless ``force``. Every copy goes to a folder of its own, and the
    entry in the log, written last, makes it the current one: a copy that fails leaves the old one.
    Of two landings that start from the same entry, the later one raises and removes its copy.
    """
    raw = read_raw(spark, source, fmt)
    rows, incoming = known_fingerprint(spark, source, landing, fmt)
    entry = _recorded(spark, landing)
    recorded = present = None
    if entry is not None:
        recorded = entry["fingerprint"]
        with path_missing():
            present = known_fingerprint(spark, entry["folder"], landing)[1]
    in_place = entry is not None and _plain(source) == _plain(entry["folder"])
    action = decide(incoming, recorded, present, force, in_place)
    if action == "refuse":
        why = "landed data changed since" if present != recorded else "content differs from what was landed"
        raise C.ContractError(f"{source}: {why} ({entry['rows']} rows then, {rows} offered); pass force to replace it")
    if action in ("skip", "verified_in_place"):
        return Landing(action, rows, entry["folder"])
    folder = f"{landing}/data-{uuid4().hex}"
    place = 1 if entry is None else entry["place"] + 1

    def unchanged() -> bool:
        now = _recorded(spark, landing)
        return (None if now is None else now["place"]) == (None if entry is None else entry["place"])

    try:
        raw.write.parquet(folder)
        with store.sole_successor(spark, f"{landing}/claims/place-{place}", unchanged, "landing"):
            spark.createDataFrame([(place, folder, rows, incoming)], LOG).coalesce(1).write.mode("append").parquet(f"{landing}/log")
    except BaseException:
        now = _recorded(spark, landing)
        if now is None or now["folder"] != folder:
            store.remove(spark, folder)
        raise
    return Landing(action, rows, folder)


def schema_findings(raw: DataFrame) -> list[str]:
    """Every structural fault at once: absent columns, wrong types, nulls where forbidden."""
    faults = [f"{c}: column is missing" for c in C.missing_columns(raw, C.RAW_COLUMNS)]
    present = [c for c in C.RAW_COLUMNS if c in raw.columns]
    for name in present:
        kind = raw.schema[name].dataType
        if not isinstance(kind, C.RAW_TYPES[name]):
            faults.append(f"{name}: type {kind.simpleString()} is not allowed")
    required = [c for c in C.RAW_REQUIRED if c in present]
    if required:
        nulls = null_counts(raw, required).first()
        faults += [f"{c}: {nulls[c]} null values" for c in required if nulls[c]]
    return faults


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the null count of each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def validate_schema(raw: DataFrame) -> None:
    faults = schema_findings(raw)
    if faults:
        raise C.ContractError(f"{len(faults)} structural fault(s): " + "; ".join(faults))
