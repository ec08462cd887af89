"""Insert and upsert by business key, without a table format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.ordering import fits_one_task, number_rows
from tallyline.session import stash


def insert_absent(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Existing rows plus the incoming rows whose key is new."""
    fresh = incoming.join(existing.select(key), key, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def upsert(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows replace existing rows of the same key; nothing is deleted."""
    kept = existing.join(incoming.select(key), key, "left_anti")
    return kept.select(*existing.columns).unionByName(incoming.select(*existing.columns))


def with_keys(members: DataFrame, surrogate: str, order: Sequence[Column]) -> DataFrame:
    """Dense surrogate keys from 1 in business-key order."""
    stored = stash(members, "members")
    numbered = number_rows(stored, surrogate, order, single=fits_one_task(stored))
    return numbered.select(surrogate, *members.columns)


def extend_keys(existing: DataFrame, members: DataFrame, surrogate: str, key: str) -> DataFrame:
    """Members with the surrogate key they already have, or the next free ones."""
    known = members.join(existing.select(key, surrogate), key)
    fresh = with_keys(
        members.join(existing.select(key), key, "left_anti"), surrogate, [F.col(key).asc()]
    )
    top = existing.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    fresh = fresh.withColumn(surrogate, F.col(surrogate) + top)
    return known.select(*fresh.columns).unionByName(fresh)
