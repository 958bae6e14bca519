"""Invariants on the test tables."""
from pyspark.sql import functions as F

from branchlens.operators import bookings as B
from branchlens.operators import conform as C
from branchlens.operators import incremental as I
from branchlens.operators import marts as M
from branchlens.plans.catalog import Inputs


def test_branch_daily_sums_to_all_branches(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    p = x.payments_live.filter(F.col("day").isNotNull())
    by_branch = p.filter(F.col("branch").isNotNull()).groupBy("day").agg(F.sum("amount").alias("a"))
    overall = p.groupBy("day").agg(F.sum("amount").alias("b"))
    # every branch is non-null in the fixture, so before rounding and HAVING both agree
    assert by_branch.join(overall, "day").filter(F.col("a") != F.col("b")).count() == 0
    assert by_branch.count() == overall.count()


def test_enrichment_keeps_every_live_line(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    assert x.lines_enriched.count() == C.live(x.lines).count()


def test_booking_metrics_keeps_monthly_rows(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    from branchlens.plans.catalog import AS_OF
    assert B.booking_metrics(x.booking_monthly, AS_OF).count() == x.booking_monthly.count()


def test_monthly_all_row_equals_sum_of_branch_rows(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    m = M.monthly_revenue(x.payments_live)
    branches = m.filter("branch <> 'ALL'").groupBy("month").agg(F.sum("revenue").alias("s"))
    total = m.filter("branch = 'ALL'").select("month", F.col("revenue").alias("t"))
    assert branches.join(total, "month").filter("s <> t").count() == 0


def test_catalog_refresh_idempotent(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    prods = x.catalog.select("product_id", "product_name", "branch")
    cats = x.catalog.filter("product_category IS NOT NULL").select("product_id", "product_category", "branch")
    once = I.refresh_catalog(x.catalog, prods, cats)
    twice = I.refresh_catalog(once, prods, cats)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert once.count() == x.catalog.count()


def test_dedupe_leaves_unique_keys(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    keys = ["sale_id", "product_id", "branch"]
    d = I.keep_last(x.lines, keys, ["line_number", "ship_date", "price"])
    assert d.groupBy(*keys).count().filter("count > 1").count() == 0
    assert d.count() == x.lines.select(*keys).distinct().count()
