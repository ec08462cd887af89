"""CSV and JSON sinks, and the readers that check what was written."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import contracts as C
from tallyline.session import concurrently

# Quotes are doubled inside quoted fields, as spreadsheets and pandas expect. Files without line breaks inside fields are
# read in parts, by several tasks; those of others may have some and then are read whole, each by one task.
CSV = {"header": "true", "quote": '"', "escape": '"'}
WHOLE_CSV = CSV | {"multiLine": "true"}

# How exported text spells characters that would break a line; every backslash is followed by one of these letters.
_SPELLED = [("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r")]


def _texts(table: DataFrame) -> list[str]:
    return [f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)]


def one_line(table: DataFrame) -> DataFrame:
    """Texts without line breaks: a backslash becomes ``\\s``, line breaks ``\\n`` and ``\\r``."""
    for name in _texts(table):
        for plain, spelled in _SPELLED:
            table = table.withColumn(name, F.replace(F.col(name), F.lit(plain), F.lit(spelled)))
    return table


def many_lines(table: DataFrame) -> DataFrame:
    """The texts that :func:`one_line` was given."""
    for name in _texts(table):
        for plain, spelled in reversed(_SPELLED):
            table = table.withColumn(name, F.replace(F.col(name), F.lit(spelled), F.lit(plain)))
    return table


@dataclass(frozen=True)
class Exported:
    name: str
    row_count: int
    column_count: int
    path: str


def export_table(name: str, table: DataFrame, folder: str) -> Exported:
    """SNK-1: write one table as CSV; rows are counted while they are written. Line breaks inside texts are
    spelled out, so that a file can be read by several tasks."""
    seen = Observation()
    path = f"{folder}/{name}.csv"
    one_line(table).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").options(**CSV).csv(path)
    return Exported(name, seen.get["rows"], len(table.columns), path)


def export_all(tables: Mapping[str, DataFrame], folder: str) -> list[Exported]:
    """Export independent tables side by side, two at a time: what each of them shuffles is on disk while it runs."""
    return concurrently([partial(export_table, n, t, folder) for n, t in tables.items()], at_once=2)


def export_manifest(spark: SparkSession, results: Iterable[Exported]) -> DataFrame:
    """SNK-10: what was exported and when."""
    rows = [(r.name, r.row_count, r.column_count, r.path) for r in results]
    schema = "name string, row_count bigint, column_count bigint, path string"
    return spark.createDataFrame(rows, schema).withColumn("exported_at", F.current_timestamp())


def verify_export(result: Exported, source: DataFrame) -> bool:
    """SNK-3: the file holds as many rows as its source has now."""
    written = source.sparkSession.read.options(**CSV).csv(result.path).count()
    return written == source.count() == result.row_count


def assert_no_customer_identifiers(spark: SparkSession, results: Iterable[Exported]) -> None:
    """SNK-6: read the headers back; a customer identifier in any of them is an error."""
    leaks = []
    for result in results:
        columns = spark.read.options(**CSV).csv(result.path).columns
        leaks += [f"{result.name}.{c}" for c in columns if c in C.CUSTOMER_IDENTIFIERS]
    if leaks:
        raise C.ContractError(f"customer identifiers in published files: {leaks}")


def check_extract(name: str, table: DataFrame) -> None:
    """Columns an extract must have. Names without a contract are accepted as they are."""
    if name in C.EXTRACT_SCHEMAS:
        C.require_columns(table, C.EXTRACT_SCHEMAS[name].fieldNames(), f"extract {name}")


def read_extract(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """SNK-7: an extract under its contract types. Columns are matched by name; further
    columns come as text. A large file is read by several tasks."""
    path = f"{folder}/{name}.csv"
    try:
        header = spark.read.options(**CSV).csv(path)
    except AnalysisException as problem:
        raise C.ContractError(f"extract {name} cannot be read from {path}") from problem
    if name not in C.EXTRACT_SCHEMAS:
        return many_lines(header)
    check_extract(name, header)
    types = {f.name: f.dataType for f in C.EXTRACT_SCHEMAS[name].fields}
    schema = T.StructType(
        [T.StructField(c, types.get(c, T.StringType()), True) for c in header.columns]
    )
    return many_lines(spark.read.options(**CSV).schema(schema).csv(path))


def read_all_extracts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """SNK-8: all extracts; the first bad one stops the load."""
    return {name: read_extract(spark, name, folder) for name in C.EXTRACT_SCHEMAS}


def save_report(report: DataFrame, path: str) -> None:
    """SNK-9: a small metric table as JSON lines."""
    report.write.mode("overwrite").json(path)
