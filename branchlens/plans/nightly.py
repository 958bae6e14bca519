"""The nightly batch job: conform -> facts -> marts -> KPIs -> reports -> quality.

The enriched lines and the live payments feed a dozen outputs each. They are written
first as month-partitioned facts in the output folder (a shared file system on a
cluster); each is then reduced once to a daily summary (lines by branch, day, product
and category; payments by branch and day), written too, and every mart reads those
summaries. The lineage is cut at each written table, so a lost executor costs a re-read
of parquet instead of recomputing the joins, and each large fact is scanned and
shuffled once for all marts.

usage: python -m branchlens.plans.nightly --sf-dir /root/testdata/sf0.01 --out /shared/out
       python -m branchlens.plans.nightly --landing /in/pages --raw /shared/raw --sheet /in/sheet.csv \\
           --seq 3 --out /shared/out
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.fixed_values import DINE_IN_SALE_TYPE, DWELL_MAX, DWELL_MIN
from branchlens.operators import bookings as B
from branchlens.operators import conform as C
from branchlens.operators import kpis as K
from branchlens.operators import marts as M
from branchlens.operators import quality as Q
from branchlens.operators import reports as R
from branchlens.operators.incremental import keep_last
from branchlens.plans import ingest
from branchlens.session import run_together
from branchlens.sources import readers, sinks
from branchlens.sources.snapshots import SnapshotStore


# Key of every published mart (null-free and unique): rows that break it are set aside.
MART_KEYS = {
    "daily_revenue_all": ["day"],
    "daily_revenue_branch": ["branch", "day"],
    "product_totals": ["branch", "product"],
    "category_totals": ["branch", "category"],
    "branch_kpis": ["branch"],
    "monthly_revenue": ["branch", "month"],
    "daily_reconciliation": ["branch", "day"],
}


def facts_store(spark: SparkSession, path: str, facts: dict[str, DataFrame]) -> SnapshotStore:
    """The processed facts (S14): one store by month. A run replaces all of them with one
    commit, so a crash leaves the facts of the run before."""
    return SnapshotStore(spark, path, {name: (df.schema, "month") for name, df in facts.items()})


def publish_accepted(df: DataFrame, name: str, keys: list[str], out: str) -> DataFrame:
    """Split by the mart's key, keep both sides under ``quality``, publish the accepted one."""
    split = Q.split_by_key(df, keys, [c for c in df.columns if c not in keys])
    path = f"{out}/quality/{name}"
    sinks.write_accepted_rejected(split, path)
    accepted = sinks.read_published(df.sparkSession, path).filter("status = 'accepted'").select(*df.columns)
    sinks.publish_mart(accepted, f"{out}/marts/{name}")
    return accepted


def run_sales_job(spark: SparkSession, sales: DataFrame, lines: DataFrame, payments: DataFrame,
                  catalog: DataFrame, out: str, as_of: dt.date, dine_in: str = DINE_IN_SALE_TYPE,
                  dwell_bounds: tuple[str, str] = (DWELL_MIN, DWELL_MAX), log: sinks.RunLog | None = None) -> dict:
    out = out.rstrip("/")
    log = log or sinks.RunLog(spark, f"{out}/_runs")
    with log.step("facts") as seen:
        # Full replaces: a month that has left the input leaves the facts as well.
        written = {"items": C.enrich_lines(lines, sales, catalog), "sales": C.with_day_month(sales),
                   "payments": C.live_payments(payments)}
        store = facts_store(spark, f"{out}/facts", written)
        changes = dict(zip(written, run_together(spark, [lambda n=name, d=df: store.replace(n, d) for name, df in written.items()])))
        at = store.commit(store.snapshot(), changes)
        n_items = seen["rows"] = store.written("items", changes["items"])
    dwell, n_dwell = sinks.observe_counts(C.dwell(sales, dine_in, *dwell_bounds), "dwell")
    sinks.publish_mart(dwell, f"{out}/facts/dwell")

    # One pass over each large fact: lines reduced to (branch, day, product, category) and
    # payments to (branch, day). Every mart below needs no finer grain, sums of exact
    # decimals re-aggregate exactly, and null keys stay groups of their own. Both
    # summaries are written (the lineage cut) and read back.
    facts = {name: store.read(name, at) for name in written}
    sinks.publish_mart(facts["items"].groupBy("branch", "day", "month", "product_name", "product_category")
                       .agg(F.sum("quantity").alias("quantity"), F.sum("price").alias("price")),
                       f"{out}/marts/items_daily")
    sinks.publish_mart(facts["payments"].groupBy("branch", "day", "month")
                       .agg(F.sum("amount").alias("amount")), f"{out}/marts/payments_daily")
    items = sinks.read_published(spark, f"{out}/marts/items_daily")
    pay = sinks.read_published(spark, f"{out}/marts/payments_daily")
    pd_ = M.product_daily(items)
    cd = M.category_daily(items)
    reconciliation = R.daily_reconciliation(items, pay, facts["sales"])
    marts = {
        "daily_revenue_all": M.daily_revenue_all(pay),
        "daily_revenue_branch": M.daily_revenue_branch(pay),
        "product_totals": M.product_totals(pd_),
        "category_totals": M.category_totals(cd),
        "branch_kpis": K.branch_kpis(pay, as_of),
        "monthly_revenue": M.monthly_revenue(pay),
        "daily_reconciliation": reconciliation,
    }
    published = {}
    for name, df in marts.items():
        with log.step(f"mart {name}"):
            published[name] = publish_accepted(df, name, MART_KEYS[name], out)
    with log.step("reports"):
        sinks.publish_reports(R.top_products(items, as_of), f"{out}/reports/top_products")
        sinks.publish_reconciliation(published["daily_reconciliation"], f"{out}/reports/reconciliation")
    # The pairs mart only grows, and its key is the product: accepted pairs of new products.
    with log.step("product_category"):
        split = Q.accepted_rejected(M.product_category_pairs(items))
        sinks.write_accepted_rejected(split, f"{out}/quality/product_category")
        accepted = sinks.read_published(spark, f"{out}/quality/product_category").filter("status = 'accepted'")
        sinks.append_new_pairs(spark, accepted.select("product", "category"), f"{out}/marts/product_category")
    return {"items_rows": n_items, "dwell_rows": n_dwell.get.get("rows", 0)}


def run_from_raw(spark: SparkSession, raw: str, out: str, as_of: dt.date, log: sinks.RunLog | None = None) -> dict:
    """The sales job on the raw tables that ``ingest`` keeps: the last row of every key."""
    store, tables = ingest.raw_store(spark, raw), {}
    at = store.snapshot()  # one version for all tables, whatever is published meanwhile
    for name in ("sales", "lines", "payments", "products"):
        df = keep_last(store.read(name, at), ingest.KEYS[name], ingest.ORDER)
        tables[name] = df if name == "products" else df.drop("month")
    return run_sales_job(spark, tables["sales"], tables["lines"], tables["payments"], tables["products"], out, as_of,
                         log=log)


def run_all(spark: SparkSession, landing: str, raw: str, out: str, as_of: dt.date, sheet: str | None = None,
            seq: int = 0, branches: list[str] | None = None) -> dict:
    """Landing to marts in one run: the bootstrap (``seq`` 0) or an incremental update (of the
    configured ``branches``), the sales job on the raw tables, and the bookings job if a sheet
    is given. Every step's status, time, rows and error go to ``<out>/_runs``."""
    log = sinks.RunLog(spark, f"{out.rstrip('/')}/_runs", seq)
    with log.step("ingest") as seen:
        counts = ingest.bootstrap(spark, landing, raw) if seq == 0 else \
            ingest.incremental(spark, landing, raw, seq, branches)
        seen["rows"] = sum(counts.values())
    counts = counts | run_from_raw(spark, raw, out, as_of, log)
    if sheet:
        with log.step("bookings"):
            run_bookings_job(readers.read_sheet(spark, sheet), out, as_of)
    return counts


def run_bookings_job(sheet: DataFrame, out: str, as_of: dt.date) -> None:
    out = out.rstrip("/")
    clean = B.clean_bookings(sheet)
    sinks.publish_mart(clean, f"{out}/marts/bookings")
    sinks.publish_mart(B.oversized_amounts(clean), f"{out}/quality/bookings_oversized")
    sinks.publish_mart(B.booking_metrics(B.booking_monthly(clean), as_of), f"{out}/marts/booking_metrics")


def main(argv=None) -> None:
    from branchlens.session import build_session
    from branchlens.sources import fixtures as fx
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", help="test tables in place of landed data")
    ap.add_argument("--landing", help="folder of landed pages")
    ap.add_argument("--raw", help="folder of the raw tables (with --landing)")
    ap.add_argument("--sheet", help="exported bookings sheet (with --landing)")
    ap.add_argument("--seq", type=int, default=0, help="0: full bootstrap; above: this incremental run's number")
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", default=fx.AS_OF.isoformat())
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    as_of = dt.date.fromisoformat(a.as_of)
    if a.landing:
        print(run_all(spark, a.landing, a.raw, a.out, as_of, a.sheet, a.seq))
        return
    lo, hi = fx.DWELL_DAYS
    summary = run_sales_job(spark, fx.fx_sales(spark, a.sf_dir), fx.fx_lines(spark, a.sf_dir),
                            fx.fx_payments(spark, a.sf_dir), fx.fx_catalog_with_gaps(spark, a.sf_dir), a.out, as_of,
                            dine_in=fx.DINE_IN_TYPE, dwell_bounds=(f"{lo} days", f"{hi} days"))
    run_bookings_job(fx.fx_bookings(spark, a.sf_dir), a.out, as_of)
    print(summary)


if __name__ == "__main__":
    main()
