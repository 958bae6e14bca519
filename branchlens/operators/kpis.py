"""Per-branch KPIs for an as-of date, plus month-over-month growth.

Plan shape: live payments cut at ``as_of`` -> hash aggregate to (branch, day) (partial
aggregation before the shuffle, so skewed branches are harmless) -> one grouping-sets
aggregate over that small result giving a row per branch and the all-branches row.
All KPI windows are conditional sums of the same pass; no driver-side scalars.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchlens.functions.semantics import (growth_pct, month_of, previous_calendar_month,
                                            safe_ratio, sum_or_zero, to_double)
from branchlens.fixed_values import TRAILING_DAYS
from branchlens.operators.marts import ALL_BRANCHES


def cut_at(df: DataFrame, as_of: dt.date, day: str = "day") -> DataFrame:
    """Input as it stood at the end of ``as_of`` (rows without a day are kept)."""
    return df.filter(F.col(day).isNull() | (F.col(day) <= F.lit(as_of)))


def kpi_sums(payments: DataFrame, as_of: dt.date) -> DataFrame:
    """branch label + exact decimal sums: mtd, prev, today, last30, total, and months."""
    a = F.lit(as_of)
    daily = cut_at(payments, as_of).groupBy("branch", "day").agg(F.sum("amount").alias("amt"))
    m = month_of("day")
    zero = "decimal(38,4)"
    sums = daily.groupingSets([["branch"], []], "branch").agg(
        sum_or_zero(F.when(m == month_of(a), F.col("amt")), zero).alias("mtd"),
        sum_or_zero(F.when(m == previous_calendar_month(a), F.col("amt")), zero).alias("prev"),
        sum_or_zero(F.when(F.col("day") == a, F.col("amt")), zero).alias("today"),
        sum_or_zero(F.when(F.col("day") >= F.date_sub(a, TRAILING_DAYS), F.col("amt")), zero).alias("last30"),
        sum_or_zero("amt", zero).alias("total"),
        F.count_distinct(m).alias("months"),
        F.grouping("branch").alias("g"),
    )
    # A real null branch is not the total row: only grouping() tells them apart.
    sums = sums.filter((F.col("g") == 1) | F.col("branch").isNotNull())
    return sums.withColumn("branch", F.when(F.col("g") == 1, F.lit(ALL_BRANCHES)).otherwise(F.col("branch"))) \
        .drop("g")


def branch_kpis(payments: DataFrame, as_of: dt.date, branches: DataFrame | None = None) -> DataFrame:
    """branch ('ALL' for everything, null branches included), month_to_date,
    avg_per_month (total / distinct months), today, avg_per_day_30 (the window from
    as_of - 30 inclusive spans 31 days but divides by 30), previous_month.

    ``branches`` (one ``branch`` column) lists branches that get a row even without any
    payment (sums 0, average per month null); it is joined to the KPI rows, which hold
    one row per branch."""
    s = kpi_sums(payments, as_of)
    if branches is not None:
        zero = F.lit(0).cast("decimal(38,4)")
        listed = branches.select("branch").distinct().filter(F.col("branch").isNotNull())
        s = s.join(listed, "branch", "full_outer").select(
            "branch", *[F.coalesce(c, zero).alias(c) for c in ("mtd", "prev", "today", "last30", "total")],
            F.coalesce("months", F.lit(0).cast("bigint")).alias("months"))
    return s.select(
        "branch",
        to_double("mtd").alias("month_to_date"),
        safe_ratio("total", "months").alias("avg_per_month"),
        to_double("today").alias("today"),
        (to_double("last30") / F.lit(float(TRAILING_DAYS))).alias("avg_per_day_30"),
        to_double("prev").alias("previous_month"),
    )


def mom_growth(payments: DataFrame, as_of: dt.date) -> DataFrame:
    """branch, growth_pct = (month_to_date - previous_month) / previous_month * 100;
    null when the previous month is 0."""
    s = kpi_sums(payments, as_of)
    return s.select("branch", growth_pct("mtd", "prev").alias("growth_pct"))
