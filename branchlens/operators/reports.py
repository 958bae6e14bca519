"""Product rankings and revenue reconciliations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchlens.functions.semantics import drop_null_keys, sum_or_zero, to_double
from branchlens.operators.marts import ALL_BRANCHES
from branchlens.operators.ranking import with_positions

REPORTS = ("month", "today", "yesterday")


def top_products(lines: DataFrame, as_of: dt.date) -> DataFrame:
    """report (month / today / yesterday), scope (branch or 'ALL'), product, qty, revenue,
    in ranking order (report, scope, qty desc, product asc).

    One pass for all reports and scopes: each line is tagged with the periods it belongs
    to (a line of ``as_of`` is in 'month' and 'today'), then a grouping-sets aggregate
    yields the per-branch and all-branches rows together. The ranking is a global sort
    (range-partitioned, so every task holds a contiguous slice), not a window: a scope
    can list as many products as the catalogue holds, and no task has to hold them all.
    """
    a = F.lit(as_of)
    first = F.least(F.trunc(a, "MM"), F.date_sub(a, 1))
    l = lines.filter((F.col("day") >= first) & (F.col("day") <= a) & F.col("product_name").isNotNull())
    periods = F.array_compact(F.array(
        F.when(F.col("day") >= F.trunc(a, "MM"), F.lit("month")),
        F.when(F.col("day") == a, F.lit("today")),
        F.when(F.col("day") == F.date_sub(a, 1), F.lit("yesterday"))))
    tagged = l.select(F.explode(periods).alias("report"), "branch",
                      F.col("product_name").alias("product"), "quantity", "price")
    agg = tagged.groupingSets([["report", "branch", "product"], ["report", "product"]],
                              "report", "branch", "product").agg(
        F.sum("quantity").alias("qty"), F.sum("price").alias("revenue"), F.grouping("branch").alias("g"))
    agg = agg.filter((F.col("g") == 1) | F.col("branch").isNotNull()).select(
        "report", F.when(F.col("g") == 1, F.lit(ALL_BRANCHES)).otherwise(F.col("branch")).alias("scope"),
        "product", to_double("qty").alias("qty"), to_double("revenue").alias("revenue"))
    return agg.orderBy("report", "scope", F.col("qty").desc(), F.col("product").asc())


def top_products_ranked(lines: DataFrame, as_of: dt.date) -> DataFrame:
    """``top_products`` with the position of every product in its report and scope (quantity
    descending, then product)."""
    return with_positions(top_products(lines, as_of), ["report", "scope"], [F.col("qty").desc(), F.col("product").asc()])


def top_products_day(lines: DataFrame, branch: str, day: dt.date) -> DataFrame:
    """product, qty: quantity ranking of one branch on one day (qty desc, product asc)."""
    l = lines.filter((F.col("branch") == branch) & (F.col("day") == F.lit(day))
                     & F.col("product_name").isNotNull())
    agg = l.groupBy(F.col("product_name").alias("product")).agg(to_double(F.sum("quantity")).alias("qty"))
    return agg.orderBy(F.col("qty").desc(), F.col("product").asc())


def _tagged_union(parts: list[tuple[DataFrame, str, str]], measures: list[str]) -> DataFrame:
    """Union of (frame, day column, measure) parts into (branch, day, m1, m2, ...)."""
    out = None
    for df, measure_col, name in parts:
        cols = [F.col("branch"), F.col("day")]
        for m in measures:
            cols.append((F.col(measure_col) if m == name else F.lit(None)).cast("decimal(38,4)").alias(m))
        part = df.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


def daily_reconciliation(lines: DataFrame, payments: DataFrame, sales: DataFrame) -> DataFrame:
    """branch, day, line_revenue, payment_amount, sale_total (missing source = 0).

    The three sources are tagged and unioned, then one grouping by (branch, day) sums each
    measure: one shuffle (with partial aggregation per source) instead of two full outer
    joins. Null branches and days drop, as in a per-branch daily grouping.
    """
    measures = ["line_revenue", "payment_amount", "sale_total"]
    s = sales.withColumn("day", F.to_date("created_at"))
    u = _tagged_union([(lines, "price", "line_revenue"), (payments, "amount", "payment_amount"),
                       (s, "total", "sale_total")], measures)
    # The result has one row per branch and day (bounded by the calendar), so the final
    # day ordering of the published sheet is a small range-partitioned sort.
    return drop_null_keys(u, ["branch", "day"]).groupBy("branch", "day").agg(
        *[to_double(sum_or_zero(m, "decimal(38,4)")).alias(m) for m in measures]).orderBy("branch", "day")


def weekly_reconciliation(lines: DataFrame, sales: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """branch, day, line_revenue, sale_total for days in [start, end] (both inclusive),
    plus the week totals per branch."""
    rng = (F.col("day") >= F.lit(start)) & (F.col("day") <= F.lit(end))
    s = sales.withColumn("day", F.to_date("created_at"))
    measures = ["line_revenue", "sale_total"]
    u = _tagged_union([(lines.filter(rng), "price", "line_revenue"), (s.filter(rng), "total", "sale_total")], measures)
    daily = drop_null_keys(u, ["branch", "day"]).groupBy("branch", "day").agg(
        *[sum_or_zero(m, "decimal(38,4)").alias(m) for m in measures])
    w = Window.partitionBy("branch")  # at most 7 daily rows per branch
    return daily.select("branch", "day", *[to_double(m).alias(m) for m in measures],
                        *[to_double(F.sum(m).over(w)).alias(f"week_{m}") for m in measures]) \
        .orderBy("branch", "day")
