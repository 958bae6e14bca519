"""Data-quality checks on marts and facts: key uniqueness, referential integrity,
not-null keys, accepted / rejected split and run counts. Each check is an aggregate
that returns a small DataFrame; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """mart, key, rows, duplicate_keys (keys seen more than once), duplicate_rows."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.when(F.col("n") > 1, F.lit(1))).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    ).select(F.lit(name).alias("mart"), F.lit(",".join(keys)).alias("key"), "rows", "duplicate_keys", "duplicate_rows")


def key_of(mart: str, key: str, *values: Column) -> Column:
    """One key of a table as (mart, key columns, values as text)."""
    return F.struct(F.lit(mart).alias("mart"), F.lit(key).alias("key"),
                    F.array(*[v.cast("string") for v in values]).alias("value"))


def key_repeats(rows: DataFrame) -> DataFrame:
    """``duplicate_keys`` of many tables at once, from their keys ``k`` (null: no key)."""
    per_key = rows.filter("k IS NOT NULL").select("k.*").groupBy("mart", "key", "value").agg(F.count("*").alias("n"))
    repeated = F.when(F.col("n") > 1, F.col("n"))
    return per_key.groupBy("mart", "key").agg(
        F.sum("n").alias("rows"), F.count(repeated).alias("duplicate_keys"),
        F.coalesce(F.sum(repeated), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def orphans(child: DataFrame, parent: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """check, orphan_keys: distinct non-null child keys absent from the parent."""
    ck = child.select(*keys).dropna().distinct()
    missing = ck.join(parent.select(*keys).dropna().distinct(), list(keys), "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("orphan_keys")).select(F.lit(name).alias("check"), "orphan_keys")


def reference_of(check: str, value: Column, child: bool) -> Column:
    """A key of the child or the parent side of a reference, as text."""
    return F.struct(F.lit(check).alias("check"), value.cast("string").alias("value"), F.lit(child).alias("child"))


def orphans_of(refs: DataFrame, checks: Sequence[str]) -> DataFrame:
    """``orphans`` of many references at once, from their keys ``k`` (null: no key): a key of the
    child side that the parent side does not have. One aggregate, no join; every one of
    ``checks`` has a row."""
    every = refs.sparkSession.range(1).select(F.explode(F.array(*[reference_of(c, F.lit(None), False) for c in checks])).alias("k"))
    keys = refs.filter("k IS NOT NULL").unionByName(every).select("k.*").groupBy("check", "value").agg(
        F.max("child").alias("child"), F.max(~F.col("child")).alias("parent"))
    orphan = F.col("value").isNotNull() & F.col("child") & ~F.col("parent")
    return keys.groupBy("check").agg(F.count(F.when(orphan, F.lit(1))).alias("orphan_keys"))


def null_counts(df: DataFrame, name: str, cols: Sequence[str]) -> DataFrame:
    """table, column, null_rows, rows: one aggregate pass, then unpivoted."""
    agg = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"n_{c}") for c in cols])
    long = agg.unpivot(["rows"], [f"n_{c}" for c in cols], "column", "null_rows")
    return long.select(F.lit(name).alias("table"), F.regexp_replace("column", "^n_", "").alias("column"),
                       F.col("null_rows").cast("bigint").alias("null_rows"), F.col("rows").cast("bigint").alias("rows"))


def accepted_rejected(pairs: DataFrame, key: str = "product", other: str = "category") -> DataFrame:
    """Split product -> category pairs by the mart constraints (non-null key, key unique):
    per key the first pair by ``other`` is accepted, later ones are rejected as
    duplicate_key, null keys are rejected as null_key. The window per key holds the
    categories of one product only."""
    return split_by_key(pairs.select(key, other), [key], [other])


def split_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with status (accepted / rejected) and reason by a table's key: rows with a null
    key are rejected as null_key, of several rows with one key all but the first by ``order``
    as duplicate_key. Null keys never reach the window, so they are not one task's group."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    first = F.col("_rn") == 1
    ranked = df.filter(whole).withColumn("_rn", F.row_number().over(w)).select(
        *df.columns, F.when(first, F.lit("accepted")).otherwise(F.lit("rejected")).alias("status"),
        F.when(first, F.lit(None).cast("string")).otherwise(F.lit("duplicate_key")).alias("reason"))
    return ranked.unionByName(df.filter(~whole).select(
        *df.columns, F.lit("rejected").alias("status"), F.lit("null_key").alias("reason")))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """fact, rows: one count aggregate per fact, unioned."""
    out = None
    for name, df in frames.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("fact"), "rows")
        out = part if out is None else out.unionByName(part)
    return out
