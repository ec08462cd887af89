"""The whole flow: raw lines, cleaned lines, published star schema."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyline.contracts import CLEANED_COLUMNS, Star
from tallyline.operators.cleaning import clean, save_cleaned
from tallyline.plans import profile, rules
from tallyline.plans.rules import validate_cleaned
from tallyline.session import COMPRESSION, scratch_scope, shuffles_removed
from tallyline.sources.files import save_report
from tallyline.sources.landing import validate_schema
from tallyline.warehouse import Warehouse


@dataclass(frozen=True)
class Tables:
    folder: str
    make_raw: Callable[[], DataFrame]
    raw: DataFrame
    cleaned: DataFrame
    star: Star


def run(spark: SparkSession, make_raw: Callable[[], DataFrame], folder: str) -> Tables:
    """Store each stage below ``folder`` and hand the stored tables to the next stage.

    Every stage is checked before the next one begins: the structure of the raw table, row count
    and invariants of the cleaned one, and, before a version is published, the references and
    sums of the model. A check that fails raises and leaves what was published before. Scratch tables
    are removed on the way, whether a stage ends well or not, and so are the shuffle files of each step."""
    with shuffles_removed(spark):
        return _run(spark, make_raw, folder)


def _run(spark: SparkSession, make_raw: Callable[[], DataFrame], folder: str) -> Tables:
    make_raw().write.options(**COMPRESSION).parquet(f"{folder}/raw")
    stored = spark.read.parquet(f"{folder}/raw")
    validate_schema(stored)
    with scratch_scope(spark):
        save_cleaned(clean(stored), f"{folder}/cleaned")
    cleaned = spark.read.parquet(f"{folder}/cleaned").select(*CLEANED_COLUMNS)
    validate_cleaned(stored, cleaned)
    loaded = Warehouse(spark, f"{folder}/warehouse").load(cleaned)
    return Tables(folder, make_raw, stored, cleaned, loaded.star)


def save_reports(tables: Tables) -> dict[str, str]:
    """SNK-9: the profile of the raw lines, their warnings, and the summary of cleaning, as JSON below ``reports``; the paths
    by name. The reconciliation is stored with the version it belongs to."""
    reports = {
        "profile": profile.profile_figures(tables.raw),
        "raw_warnings": rules.raw_warnings(tables.raw),
        "cleaning": profile.cleaning_summary(tables.cleaned),
    }
    paths = {name: f"{tables.folder}/reports/{name}" for name in reports}
    for name, report in reports.items():
        save_report(report, paths[name])
    return paths
