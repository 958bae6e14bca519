"""Conform landed facts: live-row filters, day / month buckets, the two enrichment joins
(lines with their sale, lines with the catalogue) and the dwell subset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchlens.fixed_values import DINE_IN_SALE_TYPE, DWELL_MAX, DWELL_MIN
from branchlens.functions.semantics import (day_of, month_of, not_cancelled, to_double,
                                            truncate_name)


def live(df: DataFrame, flag: str = "canceled") -> DataFrame:
    """Rows not explicitly cancelled (null flags are kept)."""
    return df.filter(not_cancelled(flag))


def with_day_month(df: DataFrame, ts: str = "created_at") -> DataFrame:
    return df.withColumn("day", day_of(ts)).withColumn("month", month_of(ts))


def live_payments(payments: DataFrame) -> DataFrame:
    """Live payments with their calendar day and ``yyyy-MM`` month."""
    return with_day_month(live(payments))


def catalog_for_join(catalog: DataFrame, name_len: int = 20) -> DataFrame:
    """Catalogue with display names (long names truncated, so prefixes merge later), one
    row per product and branch: a product listed in several categories or delivered twice
    must not multiply its lines. The last row wins (``ingest_seq``, landing order, then
    category and name, so that the choice never depends on the partitioning)."""
    order = [c for c in ("ingest_seq", "landed_at") if c in catalog.columns]
    # The largest row by (order, category, name), nulls first: a partial aggregate, not a sorted window.
    last = F.max(F.struct(*order, "product_category", "product_name")).alias("_last")
    one = catalog.groupBy("product_id", "branch").agg(last)
    return one.select("product_id", "branch",
                      truncate_name("_last.product_name", name_len).alias("product_name"),
                      F.col("_last.product_category").alias("product_category"))


def enrich_lines(lines: DataFrame, sales: DataFrame, catalog: DataFrame, named: bool = False) -> DataFrame:
    """Live lines + sale attributes (left, on sale id and branch) + catalogue (left, on
    product id and branch; ``named``: it is already as ``catalog_for_join`` makes it).

    Branch may be null on landed rows, and a null branch matches a null branch, so the
    branch key uses null-safe equality; Spark still plans it as an equi-join key, so the
    joins hash-partition (or broadcast, when AQE measures a small side) on both keys.
    Orphan lines keep null sale attributes and fall out of every dated report.
    """
    l = live(lines).select("sale_id", "product_id", "branch", "price", "quantity").alias("l")
    s = sales.select("sale_id", "branch", "created_at", "closed_at", "sale_type").alias("s")
    j = l.join(s, (F.col("l.sale_id") == F.col("s.sale_id")) & F.col("l.branch").eqNullSafe(F.col("s.branch")), "left")
    return with_names(j, catalog) if named else with_catalog(j, catalog)


def with_catalog(j: DataFrame, catalog: DataFrame) -> DataFrame:
    """Lines ``l`` joined with their sale ``s``, with the catalogue's names (J2)."""
    return with_names(j, catalog_for_join(catalog))


def with_names(j: DataFrame, names: DataFrame) -> DataFrame:
    """The same with a catalogue of one row per product and branch."""
    c = names.alias("c")
    j = j.join(c, (F.col("l.product_id") == F.col("c.product_id")) & F.col("l.branch").eqNullSafe(F.col("c.branch")), "left")
    return j.select(
        F.col("l.sale_id").alias("sale_id"), F.col("l.product_id").alias("product_id"),
        F.col("l.branch").alias("branch"), "l.price", "l.quantity",
        "s.created_at", "s.closed_at", "s.sale_type",
        day_of("s.created_at").alias("day"), month_of("s.created_at").alias("month"),
        F.col("c.product_name").alias("product_name"), F.col("c.product_category").alias("product_category"),
    )


def dwell(sales: DataFrame, sale_type: str = DINE_IN_SALE_TYPE, low: str = DWELL_MIN, high: str = DWELL_MAX) -> DataFrame:
    """Sales of one type whose stay (closed - created) lies in [low, high); open sales
    (null close) have a null stay and drop out. ``stay_seconds`` (the difference of the
    landed instants) is used where a frame carries it; else the wall clocks differ."""
    stay = F.timestamp_diff("SECOND", F.col("created_at"), F.col("closed_at"))
    if "stay_seconds" in sales.columns:
        stay = F.coalesce("stay_seconds", stay)
    seconds = [F.unix_seconds(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {b}")) for b in (low, high)]
    return sales.filter((F.col("sale_type") == sale_type) & (stay >= seconds[0]) & (stay < seconds[1])).select(
        "sale_id", "branch", to_double("total").alias("total"),
        day_of("created_at").alias("created_day"), day_of("closed_at").alias("closed_day"),
        stay.alias("dwell_seconds"),
    )
