"""Daily, product, category and monthly marts.

Every mart is a hash aggregate: Spark aggregates partially inside each map task before
the shuffle, so a hot branch, day or product (even one holding a third of all rows)
reaches the shuffle as one partial row per task. Money stays ``decimal`` (exact and
order independent) until the output projection casts to DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchlens.functions.semantics import (drop_null_keys, round_half_even, sum_or_zero,
                                            to_double)

ALL_BRANCHES = "ALL"


def daily_revenue_all(payments: DataFrame) -> DataFrame:
    """day, revenue (bigint): live payments summed by day, positive days only, rounded."""
    agg = drop_null_keys(payments, ["day"]).groupBy("day").agg(F.sum("amount").alias("amount"))
    return agg.filter(F.col("amount") > 0).select(
        "day", round_half_even("amount").cast("bigint").alias("revenue"))


def daily_revenue_branch(payments: DataFrame) -> DataFrame:
    """branch, day, revenue (double, rounded to units)."""
    agg = drop_null_keys(payments, ["branch", "day"]).groupBy("branch", "day") \
        .agg(F.sum("amount").alias("amount"))
    return agg.filter(F.col("amount") > 0).select(
        "branch", "day", round_half_even("amount").alias("revenue"))


def _daily(lines: DataFrame, key: str, out: str) -> DataFrame:
    keys = ["branch", "day", key]
    agg = drop_null_keys(lines, keys).groupBy(*keys).agg(
        F.sum("quantity").alias("qty"), F.sum("price").alias("revenue"))
    return agg.filter(F.col("qty") > 0).withColumnRenamed(key, out)


def product_daily(lines: DataFrame) -> DataFrame:
    """branch, day, product, qty, revenue (decimal): days with quantity > 0."""
    return _daily(lines, "product_name", "product")


def category_daily(lines: DataFrame) -> DataFrame:
    """branch, day, category, qty, revenue (decimal); uncategorised lines drop."""
    return _daily(lines, "product_category", "category")


def daily_sums(daily: DataFrame, key: str) -> DataFrame:
    """branch, key, qty, revenue, days: the additive parts of the totals."""
    return daily.groupBy("branch", key).agg(F.sum("qty").alias("qty"), F.sum("revenue").alias("revenue"),
                                            F.count(F.lit(1)).alias("days"))


def _totals(sums: DataFrame, key: str) -> DataFrame:
    """Totals and per-active-day means (no self-join of two aggregates)."""
    return sums.select("branch", key, "qty", "revenue", (to_double("qty") / F.col("days")).alias("avg_daily_qty"),
                       (to_double("revenue") / F.col("days")).alias("avg_daily_revenue"))


def product_totals_of(sums: DataFrame) -> DataFrame:
    """``product_totals`` from ``daily_sums``."""
    t = _totals(sums, "product")
    cols = ["qty", "revenue", "avg_daily_qty", "avg_daily_revenue"]
    return t.select("branch", "product", *[round_half_even(c, 2).alias(c) for c in cols]) \
        .fillna(0, subset=cols)


def category_totals_of(sums: DataFrame) -> DataFrame:
    """``category_totals`` from ``daily_sums``."""
    t = _totals(sums, "category")
    return t.select("branch", "category", to_double("qty").alias("qty"),
                    to_double("revenue").alias("revenue"), "avg_daily_qty", "avg_daily_revenue")


def product_totals(daily: DataFrame) -> DataFrame:
    """branch, product, qty, revenue, avg_daily_qty, avg_daily_revenue, all rounded half-even
    to 2 digits; the mean divides by days with quantity > 0 only."""
    return product_totals_of(daily_sums(daily, "product"))


def category_totals(daily: DataFrame) -> DataFrame:
    """branch, category, qty, revenue, avg_daily_qty, avg_daily_revenue (not rounded)."""
    return category_totals_of(daily_sums(daily, "category"))


def monthly_revenue(payments: DataFrame) -> DataFrame:
    """branch, month, revenue (bigint); the all-branches row per month is the sum of the
    *rounded* branch values.

    Stage 1 aggregates the raw payments by (branch, month) and rounds; stage 2 runs one
    grouping-sets aggregate over that small result, so each (branch, month) passes
    through unchanged and the () set per month adds the rounded values.
    """
    per_branch = drop_null_keys(payments, ["branch", "month"]).groupBy("branch", "month") \
        .agg(round_half_even(F.sum("amount")).cast("bigint").alias("revenue"))
    both = per_branch.groupingSets([["month", "branch"], ["month"]], "month", "branch") \
        .agg(F.sum("revenue").alias("revenue"), F.grouping("branch").alias("g"))
    return both.select(F.when(F.col("g") == 1, F.lit(ALL_BRANCHES)).otherwise(F.col("branch")).alias("branch"),
                       "month", F.col("revenue").cast("bigint").alias("revenue"))


def monthly_line_revenue(lines: DataFrame) -> DataFrame:
    """month, line_revenue: line totals by the sale's month."""
    return drop_null_keys(lines, ["month"]).groupBy("month") \
        .agg(to_double(sum_or_zero("price")).alias("line_revenue"))


def product_category_pairs(lines: DataFrame) -> DataFrame:
    """Distinct (product, category) pairs seen on lines, both non-null."""
    return lines.select(F.col("product_name").alias("product"),
                        F.col("product_category").alias("category")).dropna().distinct()


def new_pairs(pairs: DataFrame, existing: DataFrame) -> DataFrame:
    """Pairs not yet in the existing mart (anti-join on the pair; keys are non-null)."""
    return pairs.join(existing.select("product", "category"), ["product", "category"], "left_anti")
