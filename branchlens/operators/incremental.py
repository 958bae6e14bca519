"""Keyed keep-last dedupe, upserts, high-water marks and incremental selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchlens.fixed_values import LOOKBACK_ROWS
from branchlens.functions.semantics import numeric_id

MARK_SALTS = 64  # parts of a branch's feed in the join with the marks


def _order(cols: Sequence) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in cols]


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key: the one that is last by ``order`` (e.g. ingest_seq, then a file
    position). Null keys are equal to each other.

    Planned as row_number() = 1: Spark pushes a partial per-key limit below the shuffle
    (WindowGroupLimit), so every map task sends at most one row per key, however hot.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def upsert(base: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence = ()) -> DataFrame:
    """Base then batch, by name (columns missing on either side become null); the batch
    wins on equal keys. ``ingest_seq`` 0 / 1 marks the origin unless already present."""
    if "ingest_seq" not in base.columns:
        base = base.withColumn("ingest_seq", F.lit(0))
    if "ingest_seq" not in batch.columns:
        batch = batch.withColumn("ingest_seq", F.lit(1))
    u = base.unionByName(batch, allowMissingColumns=True)
    return keep_last(u, keys, ["ingest_seq", *order])


def closed_only(sales: DataFrame) -> DataFrame:
    return sales.dropna(subset=["closed_at"])


def drop_tail(df: DataFrame, order: Sequence, keys: Sequence[str], n: int = LOOKBACK_ROWS) -> DataFrame:
    """Remove the last ``n`` rows by ``order`` (global, not per group), only when the
    frame holds more than ``n`` rows.

    The tail is a top-(n+1) (TakeOrderedAndProject: a per-task top-k, then a merge of
    at most (n+1) x tasks rows); the small window over those n+1 rows tells whether the
    frame is longer than n. The tail is then removed with an anti-join on the key.
    """
    top = df.select(*keys, *[c for c in order if isinstance(c, str) and c not in keys]) \
        .orderBy(*_order(order)).limit(n + 1)
    w_all = Window.partitionBy(F.lit(0))
    w_rank = w_all.orderBy(*_order(order))
    tail = top.withColumn("_rows", F.count(F.lit(1)).over(w_all)) \
        .withColumn("_rank", F.row_number().over(w_rank)) \
        .filter((F.col("_rows") > n) & (F.col("_rank") <= n)).select(*keys)
    d, t = df.alias("_d"), tail.alias("_t")
    cond = None
    for k in keys:  # null keys (e.g. a missing branch) still identify their row
        c = F.col(f"_d.{k}").eqNullSafe(F.col(f"_t.{k}"))
        cond = c if cond is None else cond & c
    return d.join(t, cond, "left_anti")


def high_water_marks(df: DataFrame, id_col: str, branches: DataFrame | None = None) -> DataFrame:
    """branch, last_id: the largest integer id per branch (non-numeric ids ignored, 0 when
    none). ``branches`` (one column ``branch``) lists branches that get a row even
    without data; otherwise every non-null branch present in ``df``."""
    marks = df.filter(F.col("branch").isNotNull()).groupBy("branch").agg(
        F.coalesce(F.max(numeric_id(id_col)), F.lit(0).cast("bigint")).alias("last_id"))
    if branches is None:
        return marks
    return branches.select("branch").distinct().join(marks, "branch", "left") \
        .select("branch", F.coalesce("last_id", F.lit(0).cast("bigint")).alias("last_id"))


def select_after_marks(feed: DataFrame, marks: DataFrame, id_col: str) -> DataFrame:
    """Feed rows whose integer id is above their branch's mark (branches without a mark
    start at 0).

    The marks frame has one row per branch, and a branch may hold a third of the feed, so
    the join key is the branch and one of ``MARK_SALTS`` parts of its ids; the marks are
    repeated for every part. Nothing is cached or counted while the plan is built."""
    salted = feed.withColumn("_part", F.pmod(F.xxhash64(id_col), F.lit(MARK_SALTS)).cast("int"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(MARK_SALTS - 1)))
    j = salted.join(marks.withColumn("_part", parts), ["branch", "_part"], "left").drop("_part")
    return j.filter(numeric_id(id_col) > F.coalesce(F.col("last_id"), F.lit(0).cast("bigint")))


def incremental_marks(sales: DataFrame, payments: DataFrame, branches: DataFrame | None = None):
    """Sales marks after dropping open sales and the 20-row lookback tail; payment marks
    over all payments (no lookback). The tail are the last rows in the order of arrival
    (``ingest_seq``, then the landing position) where the frame carries it, then by id."""
    arrival = [c for c in ("ingest_seq", "landed_at") if c in sales.columns]
    clean = drop_tail(closed_only(sales), [*arrival, numeric_id("sale_id"), "sale_id"], ["sale_id", "branch"])
    return (high_water_marks(clean, "sale_id", branches),
            high_water_marks(payments, "payment_id", branches))


def refresh_catalog(existing: DataFrame, products: DataFrame, categories: DataFrame,
                    how: str = "left") -> DataFrame:
    """Fetched products joined to their categories (left: uncategorised kept with a null
    category; inner for the bootstrap path), appended to the existing catalogue, keyed
    keep-last on (product_id, branch)."""
    fetched = products.join(categories, ["product_id", "branch"], how) \
        .select("product_id", "product_name", "product_category", "branch")
    return upsert(existing.select("product_id", "product_name", "product_category", "branch"),
                  fetched, ["product_id", "branch"]).drop("ingest_seq")
