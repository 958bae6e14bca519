"""Positions in large rankings without a window over a group.

A window puts every row of a group into one task; a ranking of a catalogue-sized scope must
not. Here rows are range-partitioned by (group, order) and sorted, so a task holds a slice
of the ranking, and a row's position is its place in the slice plus the rows of its group
in the slices before, a sum over one row per (slice, group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchlens.session import scratch_path

_SLICE_BITS = 33  # fixed value: monotonically_increasing_id keeps the task number above these bits


def with_positions(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with the 1-based position of every row in its group by ``order``, which must not
    leave ties. Null group values are groups.

    The sorted slices are written to the shared folder: the counts and the rows must come
    from the same cut of the ranges, also when an executor is lost in between."""
    by = [*[F.col(g) for g in groups], *order]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    path = f"{scratch_path(df.sparkSession, 'ranking')}/slices"
    placed.write.parquet(path)
    placed = df.sparkSession.read.schema(placed.schema).parquet(path).withColumn("_slice", F.shiftright("_at", _SLICE_BITS))
    slices = placed.groupBy("_slice", *groups).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = slices.select("_slice", *groups, "_first", F.coalesce(before, F.lit(0)).alias("_before")).alias("s")
    rows = placed.alias("r")
    match = F.col("r._slice") == F.col("s._slice")
    for g in groups:
        match = match & F.col(f"r.{g}").eqNullSafe(F.col(f"s.{g}"))
    position = F.col("s._before") + F.col("r._at") - F.col("s._first") + 1
    return rows.join(starts, match).select(*[F.col(f"r.{c}") for c in df.columns], position.alias(name))
