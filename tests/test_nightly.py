"""The nightly batch job end to end on the smallest tables."""
import tempfile

from branchlens.plans import catalog as Q
from branchlens.operators import conform as C
from branchlens.plans.nightly import facts_store, run_bookings_job, run_sales_job
from branchlens.sources import fixtures as fx
from branchlens.sources import sinks


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_nightly_outputs_match_queries(spark, sf_dir):
    out = tempfile.mkdtemp(prefix="branchlens-nightly-")
    lo, hi = fx.DWELL_DAYS
    summary = run_sales_job(spark, fx.fx_sales(spark, sf_dir), fx.fx_lines(spark, sf_dir),
                            fx.fx_payments(spark, sf_dir), fx.fx_catalog_with_gaps(spark, sf_dir), out, Q.AS_OF,
                            dine_in=fx.DINE_IN_TYPE, dwell_bounds=(f"{lo} days", f"{hi} days"))
    run_bookings_job(fx.fx_bookings(spark, sf_dir), out, Q.AS_OF)
    read = lambda p: sinks.read_published(spark, f"{out}/{p}")
    kinds = {"items": C.enrich_lines(*(f(spark, sf_dir) for f in (fx.fx_lines, fx.fx_sales, fx.fx_catalog_with_gaps)))}
    items = facts_store(spark, f"{out}/facts", kinds).read("items")
    assert summary["items_rows"] == items.count() > 0
    assert summary["dwell_rows"] == read("facts/dwell").count()
    for mart in ("daily_revenue_all", "daily_revenue_branch", "product_totals", "category_totals",
                 "branch_kpis", "monthly_revenue", "daily_reconciliation"):
        assert same(read(f"marts/{mart}"), Q.QUERIES[mart](spark, sf_dir)), mart
    top = read("reports/top_products").select("report", "scope", "product", "qty", "revenue")
    assert same(top, Q.QUERIES["top_products"](spark, sf_dir))
    accepted = Q.QUERIES["accepted_rejected"](spark, sf_dir).filter("status = 'accepted'").select("product", "category")
    assert same(spark.read.parquet(f"{out}/marts/product_category"), accepted)
    assert same(read("marts/booking_metrics"), Q.QUERIES["booking_metrics"](spark, sf_dir))
    # the months of the items facts are partition folders
    assert items.filter("month = '2001-07'").count() > 0
    # two reconciliation sheets per branch
    sheets = read("reports/reconciliation")
    daily = read("marts/daily_reconciliation")
    assert same(sheets.filter("sheet = 'all_days'").select(*daily.columns), daily)
    differs = daily.filter("NOT (line_revenue = payment_amount AND payment_amount = sale_total)")
    assert same(sheets.filter("sheet = 'differences'").select(*daily.columns), differs)


def test_facts_of_a_month_that_left_the_input_are_gone(spark):
    d = tempfile.mkdtemp(prefix="branchlens-facts-")
    df = spark.createDataFrame([("2025-01", i) for i in range(50)] + [("2025-02", 1)], "month string, v int").repartition(8)
    sinks.write_facts(df, d, dynamic=False)
    import glob
    assert len(glob.glob(f"{d}/month=2025-01/*.parquet")) == 1  # one file per small month, not one per task
    sinks.write_facts(df.filter("month = '2025-02'"), d, dynamic=False)
    assert {r.month for r in spark.read.parquet(d).collect()} == {"2025-02"}


def test_landing_to_marts(spark, sf_dir):
    """Bootstrap, incremental update and nightly job in one go equal the job on the tables."""
    from pyspark.sql import functions as F
    from branchlens.plans.nightly import run_all, run_from_raw
    from branchlens.operators import conform as C, marts as M
    from branchlens.sources import documents as D
    root = tempfile.mkdtemp(prefix="branchlens-all-")
    sales, lines = fx.fx_sales(spark, sf_dir), fx.fx_lines(spark, sf_dir)
    pays, cat = fx.fx_payments_ev(spark, sf_dir), fx.fx_catalog(spark, sf_dir)
    old = sales.filter(F.col("created_at") < F.lit(fx.SPLIT_DATE))
    old_lines = lines.join(old.select("sale_id", "branch"), ["sale_id", "branch"], "left_semi")
    for folder, s, ln in (("l0", old, old_lines), ("l1", sales, lines)):
        D.write_pages(D.build_sales_pages(s, ln), f"{root}/{folder}/sales")
        D.write_pages(D.build_payment_pages(pays), f"{root}/{folder}/payments")
        D.write_pages(D.build_product_pages(cat), f"{root}/{folder}/products")
        D.write_pages(D.build_category_pages(cat), f"{root}/{folder}/categories")
    run_all(spark, f"{root}/l0", f"{root}/raw", f"{root}/out", Q.AS_OF)
    got = run_all(spark, f"{root}/l1", f"{root}/raw", f"{root}/out", Q.AS_OF, seq=1)
    assert got["items_rows"] > 0 and got["rejected_pages"] == 0
    steps = sinks.read_runs(spark, f"{root}/out/_runs").collect()
    assert {(r.run, r.status) for r in steps} == {(0, "done"), (1, "done")}
    assert {"ingest", "facts", "mart branch_kpis", "reports", "product_category"} <= {r.step for r in steps}
    assert all(r.seconds > 0 and r.error is None for r in steps)
    paid = sinks.read_published(spark, f"{root}/out/marts/daily_revenue_branch")
    assert same(paid, M.daily_revenue_branch(C.live_payments(pays)).select(*paid.columns))
    again = run_from_raw(spark, f"{root}/raw", f"{root}/out2", Q.AS_OF)
    assert again["items_rows"] == got["items_rows"]
    for mart in ("daily_revenue_branch", "product_totals", "monthly_revenue"):
        assert same(sinks.read_published(spark, f"{root}/out/marts/{mart}"),
                    sinks.read_published(spark, f"{root}/out2/marts/{mart}"))


def test_a_failed_step_leaves_a_record(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="branchlens-runs-")
    log = sinks.RunLog(spark, f"{d}/_runs", 7)
    with log.step("one") as seen:
        seen["rows"] = 3
    with pytest.raises(ValueError):
        with log.step("two"):
            raise ValueError("no such branch")
    got = {r.step: (r.run, r.status, r.rows, r.error) for r in sinks.read_runs(spark, f"{d}/_runs").collect()}
    assert got == {"one": (7, "done", 3, None), "two": (7, "failed", None, "ValueError: no such branch")}
