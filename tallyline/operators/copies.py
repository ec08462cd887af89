"""Expanding counted rows back into individual rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expand_copies(
    stored: DataFrame, count: str, name: str, chunk: int = 1_000_000, heavy: bool | None = None
) -> DataFrame:
    """Emit each row of a stored table ``count`` times, numbered from 1 in ``name``.

    A row with more than ``chunk`` copies is first cut into chunks which are redistributed,
    so that one heavily repeated row is written out by many tasks. ``heavy`` states whether there
    may be such rows, for a table that is only planned; otherwise the table is looked through.
    """
    one, copies = F.lit(1).cast("bigint"), F.col(count)
    numbers = F.explode(F.sequence(one, copies))
    if heavy is None:
        heavy = not stored.filter(copies > chunk).isEmpty()
    if not heavy:
        return stored.withColumn(name, numbers)
    light = stored.filter(copies <= chunk).withColumn(name, numbers)
    heavy = (
        stored.filter(copies > chunk)
        .withColumn("_from", F.explode(F.sequence(one, copies, F.lit(chunk).cast("bigint"))))
        .repartition("_from", *[c for c in stored.columns if c != count])
    )
    last = F.least(F.col("_from") + (chunk - 1), copies)
    expanded = heavy.withColumn(name, F.explode(F.sequence("_from", last))).drop("_from")
    return light.unionByName(expanded)
