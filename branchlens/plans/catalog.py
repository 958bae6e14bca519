"""The query catalogue: every query of SURVEY §2.11 as ``(spark, sf_dir) -> DataFrame``.

Queries read the test tables through the fixture bindings and compose the operators;
each output column is aliased to the name used by the SQL oracle (``plans.oracle``).
Money is exact decimal inside and DOUBLE at the output.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.fixed_values import CURRENCY_PREFIX, DAY_FIRST_DATE_PATTERN
from branchlens.functions import semantics as S
from branchlens.operators import bookings as B
from branchlens.operators import conform as C
from branchlens.operators import incremental as I
from branchlens.operators import kpis as K
from branchlens.operators import marts as M
from branchlens.operators import quality as Q
from branchlens.operators import reports as R
from branchlens.plans.raw_queries import (bootstrap_raw, incremental_upsert, marts_incremental, upsert_moved_keys,
                                           upsert_raw_rows)
from branchlens.plans import sink_queries as SQ
from branchlens.sources import documents as D
from branchlens.sources import fixtures as fx

AS_OF = fx.AS_OF
RANK_BRANCH = "AMERICA"
RANK_DAY = dt.date(2001, 7, 18)
WEEK = (AS_OF - dt.timedelta(days=6), AS_OF)


def doubles(df: DataFrame) -> DataFrame:
    """Cast every decimal column to DOUBLE (the output contract)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


class Inputs:
    """Lazily built fixture frames for one (session, data folder)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def sales(self):
        return fx.fx_sales(self.spark, self.sf_dir)

    @cached_property
    def lines(self):
        return fx.fx_lines(self.spark, self.sf_dir)

    @cached_property
    def payments(self):
        return fx.fx_payments(self.spark, self.sf_dir)

    @cached_property
    def payments_ev(self):
        return fx.fx_payments_ev(self.spark, self.sf_dir)

    @cached_property
    def catalog(self):
        return fx.fx_catalog(self.spark, self.sf_dir)

    @cached_property
    def lines_enriched(self):
        return C.enrich_lines(self.lines, self.sales, fx.fx_catalog_with_gaps(self.spark, self.sf_dir))

    @cached_property
    def payments_live(self):
        return C.live_payments(self.payments)

    @cached_property
    def product_daily(self):
        return M.product_daily(self.lines_enriched)

    @cached_property
    def category_daily(self):
        return M.category_daily(self.lines_enriched)

    @cached_property
    def pairs(self):
        return M.product_category_pairs(self.lines_enriched)

    @cached_property
    def bookings_clean(self):
        return B.clean_bookings(fx.fx_bookings(self.spark, self.sf_dir))

    @cached_property
    def booking_monthly(self):
        return B.booking_monthly(self.bookings_clean)

    @cached_property
    def branches(self):
        return fx.table(self.spark, self.sf_dir, "region").select(F.col("r_name").alias("branch"))


# Text formats of published days and timestamps.
DAY_TEXT = "yyyy-MM-dd"
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def publishable(df: DataFrame) -> DataFrame:
    """The publish format of query results: days as ``yyyy-MM-dd`` text and timestamps as
    ``yyyy-MM-dd HH:mm:ss.ffffff`` text (the published sheets carry text days), flags
    as ``true`` / ``false`` text. Measures stay DOUBLE / BIGINT. The operators themselves
    return typed columns; this projection is applied only to the catalogue outputs, so
    every engine renders the same values the same way."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, DAY_TEXT)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TS_TEXT)
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _q(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return publishable(fn(Inputs(spark, sf_dir)))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# ---------------------------------------------------------------- conform

def lines_enriched(x: Inputs):
    return doubles(x.lines_enriched.select("sale_id", "product_id", "branch", "price", "quantity",
                                          "sale_type", "day", "month", "product_name", "product_category"))


def dwell_filtered(x: Inputs):
    lo, hi = fx.DWELL_DAYS
    return C.dwell(x.sales, fx.DINE_IN_TYPE, f"{lo} days", f"{hi} days")


def payments_live(x: Inputs):
    p = C.live_payments(x.payments_ev)
    return doubles(p.select("payment_id", "branch", "amount", "method", "created_at", "day", "month"))


# ---------------------------------------------------------------- marts

def daily_revenue_all(x: Inputs):
    return M.daily_revenue_all(x.payments_live)


def daily_revenue_branch(x: Inputs):
    return M.daily_revenue_branch(x.payments_live)


def product_daily(x: Inputs):
    return doubles(x.product_daily)


def product_totals(x: Inputs):
    return M.product_totals(x.product_daily)


def category_daily(x: Inputs):
    return doubles(x.category_daily)


def category_totals(x: Inputs):
    return M.category_totals(x.category_daily)


def monthly_revenue(x: Inputs):
    return M.monthly_revenue(x.payments_live)


def monthly_line_revenue(x: Inputs):
    return M.monthly_line_revenue(x.lines_enriched)


def product_category_pairs(x: Inputs):
    return x.pairs


def new_product_categories(x: Inputs):
    return M.new_pairs(x.pairs, fx.fx_known_pairs(x.spark, x.sf_dir))


# ---------------------------------------------------------------- KPIs and reports

def branch_kpis(x: Inputs):
    return K.branch_kpis(x.payments_live, AS_OF)


def branch_kpis_edges(x: Inputs):
    out = None
    for d in fx.AS_OF_EDGES:
        part = K.branch_kpis(x.payments_live, d).withColumn("as_of", F.lit(d))
        out = part if out is None else out.unionByName(part)
    return out


def mom_growth(x: Inputs):
    return K.mom_growth(x.payments_live, AS_OF)


def top_products(x: Inputs):
    return R.top_products(x.lines_enriched, AS_OF)


def top_products_ranked(x: Inputs):
    return R.top_products_ranked(x.lines_enriched, AS_OF)


def top_products_edges(x: Inputs):
    """The rankings at the edge dates (a 1st of the month: 'yesterday' falls in the
    previous month; a 31st; the end of January)."""
    out = None
    for d in fx.AS_OF_EDGES:
        part = R.top_products(x.lines_enriched, d).withColumn("as_of", F.lit(d))
        out = part if out is None else out.unionByName(part)
    return out


def top_products_day(x: Inputs):
    return R.top_products_day(x.lines_enriched, RANK_BRANCH, RANK_DAY)


def daily_reconciliation(x: Inputs):
    return R.daily_reconciliation(x.lines_enriched, x.payments_live, x.sales)


def weekly_reconciliation(x: Inputs):
    return R.weekly_reconciliation(x.lines_enriched, x.sales, *WEEK)


# ---------------------------------------------------------------- scalars

# The zone offsets written on the landed event timestamps, by user_id % 4.
EVENT_OFFSETS = ("-03:00", "Z", "+05:30", "+0000")


def timestamps_normalised(x: Inputs):
    ev = fx.table(x.spark, x.sf_dir, "events")
    off = F.element_at(F.array(*[F.lit(o) for o in EVENT_OFFSETS]), (F.col("user_id") % 4 + 1).cast("int"))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), off)
    local = S.strip_zone(text)
    return ev.select("event_id", local.alias("local_ts"), S.day_of(local).alias("day"),
                     S.month_of(local).alias("month"))


def scalar_suite(x: Inputs):
    ob = fx.orders_branch(x.spark, x.sf_dir)
    k = F.col("o_orderkey")
    date_text = F.when(k % 97 == 0, F.lit("n/a")).otherwise(F.date_format("o_orderdate", DAY_FIRST_DATE_PATTERN))
    id_text = F.when(k % 11 == 0, F.concat(k.cast("string"), F.lit("a"))).otherwise(k.cast("string"))
    total_text = F.when(k % 89 == 0, F.lit("-")).otherwise(
        F.concat(F.lit(CURRENCY_PREFIX + " "), F.replace(F.format_number(F.col("o_totalprice"), 2), F.lit(","), F.lit("|")))
    )
    total_text = F.replace(F.replace(total_text, F.lit("."), F.lit(",")), F.lit("|"), F.lit("."))
    iso = S.iso_date_text(S.parse_day_first_date(date_text))
    return ob.select(
        k.alias("o_orderkey"),
        S.numeric_id(id_text).cast("string").alias("id_num"),
        iso.alias("date_iso"),
        F.substring(iso, 1, 7).alias("month"),
        S.parse_currency(total_text).alias("total_num"),
        S.title_case(F.concat_ws(" ", F.lower("c_name"), F.col("o_orderpriority"))).alias("client_title"),
        S.coerce_int(F.when(k % 7 == 0, F.lit("x")).otherwise((k % 60 / 7).cast("string"))).alias("guests_int"),
        S.round_half_even(F.col("o_totalprice") / 1000, 0).alias("rounded0"),
        S.round_half_even(F.col("o_totalprice") / 7, 2).alias("rounded2"),
        S.growth_pct(F.col("o_totalprice"), F.col("c_acctbal")).alias("growth"),
        S.truncate_name(F.concat_ws(" ", "c_name", "o_orderpriority")).alias("name_short"),
        S.day_of("o_orderdate").alias("day"),
    )


# ---------------------------------------------------------------- catalogue

def _products(x: Inputs):
    return x.catalog.select("product_id", "product_name", "branch")


def _categories(x: Inputs):
    return x.catalog.filter(F.col("product_category").isNotNull()).select("product_id", "product_category", "branch")


def catalog_inner(x: Inputs):
    return _products(x).join(_categories(x), ["product_id", "branch"], "inner") \
        .select("product_id", "product_name", "product_category", "branch")


def catalog_left(x: Inputs):
    return _products(x).join(_categories(x), ["product_id", "branch"], "left") \
        .select("product_id", "product_name", "product_category", "branch")


def _even(col: str):
    return S.numeric_id(col) % 2 == 0


def catalog_refresh(x: Inputs):
    existing = x.catalog.withColumn("product_name", F.lower("product_name"))
    fetched_products = _products(x).filter(_even("product_id"))
    fetched_categories = _categories(x).filter(_even("product_id"))
    return I.refresh_catalog(existing, fetched_products, fetched_categories, "left")


# ---------------------------------------------------------------- dedupe / upsert

SALE_KEYS = ["sale_id", "branch"]
LINE_KEYS = ["sale_id", "product_id", "branch"]
LINE_ORDER = ["line_number", "ship_date", "price"]
PAYMENT_KEYS = ["payment_id", "branch"]
CATALOG_KEYS = ["product_id", "branch"]

SALE_COLS = ["sale_id", "total", "sale_type", "created_at", "closed_at", "customer_id", "branch"]
LINE_COLS = ["sale_id", "product_id", "price", "quantity", "canceled", "branch"]
PAYMENT_COLS = ["payment_id", "amount", "created_at", "method", "canceled", "branch"]


def _sales_split(x):
    return fx.split_old_new(x.sales, "created_at", fx.SPLIT_DATE, "total")


def _lines_split(x):
    return fx.split_old_new(x.lines, "ship_date", fx.SPLIT_DATE, "price")


def _payments_split(x):
    return fx.split_old_new(x.payments_ev, "created_at", fx.EVENTS_SPLIT_DATE, "amount")


def dedupe_sales(x: Inputs):
    old, new = _sales_split(x)
    return doubles(I.keep_last(old.unionByName(new), SALE_KEYS, ["ingest_seq"]).select(*SALE_COLS))


def dedupe_lines(x: Inputs):
    return doubles(I.keep_last(x.lines, LINE_KEYS, LINE_ORDER).select(*LINE_COLS))


def dedupe_payments(x: Inputs):
    old, new = _payments_split(x)
    return doubles(I.keep_last(old.unionByName(new), PAYMENT_KEYS, ["ingest_seq"]).select(*PAYMENT_COLS))


def dedupe_catalog(x: Inputs):
    refetch = x.catalog.filter(_even("product_id")).withColumn("product_name", F.upper("product_name"))
    u = x.catalog.withColumn("ingest_seq", F.lit(0)).unionByName(refetch.withColumn("ingest_seq", F.lit(1)))
    return I.keep_last(u, CATALOG_KEYS, ["ingest_seq"]).drop("ingest_seq")


def upsert_sales(x: Inputs):
    old, new = _sales_split(x)
    return doubles(I.upsert(old.drop("ingest_seq"), new.drop("ingest_seq"), SALE_KEYS).select(*SALE_COLS))


def upsert_lines(x: Inputs):
    old, new = _lines_split(x)
    return doubles(I.upsert(old.drop("ingest_seq"), new.drop("ingest_seq"), LINE_KEYS, LINE_ORDER)
                   .select(*LINE_COLS))


def upsert_payments(x: Inputs):
    old, new = _payments_split(x)
    return doubles(I.upsert(old.drop("ingest_seq"), new.drop("ingest_seq"), PAYMENT_KEYS).select(*PAYMENT_COLS))


# ---------------------------------------------------------------- incremental load

def closed_sales_trimmed(x: Inputs):
    clean = I.drop_tail(I.closed_only(x.sales), [S.numeric_id("sale_id"), "sale_id"], SALE_KEYS)
    return doubles(clean.select(*SALE_COLS))


def highwater_marks(x: Inputs):
    sales_marks, pay_marks = I.incremental_marks(x.sales, x.payments_ev)
    return sales_marks.select(F.lit("sales").alias("source"), "branch", "last_id") \
        .unionByName(pay_marks.select(F.lit("payments").alias("source"), "branch", "last_id"))


def incremental_selection(x: Inputs):
    s_old, _ = _sales_split(x)
    p_old, _ = _payments_split(x)
    s_marks, p_marks = I.incremental_marks(s_old, p_old)
    s = I.select_after_marks(x.sales, s_marks, "sale_id").select(
        F.lit("sales").alias("source"), F.col("sale_id").alias("id"), "branch",
        F.coalesce("last_id", F.lit(0).cast("bigint")).alias("mark"))
    p = I.select_after_marks(x.payments_ev, p_marks, "payment_id").select(
        F.lit("payments").alias("source"), F.col("payment_id").alias("id"), "branch",
        F.coalesce("last_id", F.lit(0).cast("bigint")).alias("mark"))
    return s.unionByName(p)


# ---------------------------------------------------------------- landed documents

def json_sales_flat(x: Inputs):
    pages = D.parse_pages(D.build_sale_docs(x.sales), D.SALES_PAGE)
    return doubles(D.flatten_sales(pages).select(*SALE_COLS))


def json_items_flat(x: Inputs):
    pages = D.parse_pages(D.build_item_docs(x.lines), D.SALES_PAGE)
    return doubles(D.flatten_items(pages).select(*LINE_COLS))


def json_payments_flat(x: Inputs):
    docs = D.build_payment_pages(x.payments_ev)
    return doubles(D.flatten_payments(D.parse_pages(docs, D.PAYMENTS_PAGE)).select(*PAYMENT_COLS))


def json_sale_single(x: Inputs):
    """Items of single-sale documents: each belongs to the sale that encloses it."""
    docs = D.parse_pages(D.build_sale_single_docs(x.sales, x.lines), D.SALE_DOC)
    return doubles(D.flatten_sale_doc_items(docs).select(*LINE_COLS))


def json_payment_single(x: Inputs):
    docs = D.parse_pages(D.build_payment_single_docs(x.payments_ev), D.PAYMENT_DOC)
    return doubles(D.flatten_payment_docs(docs).select(*PAYMENT_COLS))


def json_categories_flat(x: Inputs):
    return D.flatten_categories(D.parse_pages(D.build_category_pages(x.catalog), D.CATEGORIES_PAGE))


def json_products_flat(x: Inputs):
    return D.flatten_products(D.parse_pages(D.build_product_pages(x.catalog), D.PRODUCTS_PAGE))


# ---------------------------------------------------------------- bookings

def bookings_clean(x: Inputs):
    return x.bookings_clean


def booking_monthly(x: Inputs):
    return x.booking_monthly


def booking_metrics(x: Inputs):
    return B.booking_metrics(x.booking_monthly, AS_OF)


def booking_metrics_edges(x: Inputs):
    out = None
    for d in fx.AS_OF_EDGES:
        part = B.booking_metrics(x.booking_monthly, d).withColumn("as_of", F.lit(d))
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- quality

def quality_unique(x: Inputs):
    """Repeats of the published tables' keys: one row per day and product, day and category,
    product, day, month and branch. With several branches most of them repeat. The lines
    and the payments are each read once, by grouping sets of all their keys."""
    kept = F.col("qty") > 0
    by = x.lines_enriched.groupingSets(
        [["branch", "day", "product_name"], ["branch", "day", "product_category"], ["product_name", "product_category"]],
        "branch", "day", "product_name", "product_category").agg(
        F.sum("quantity").alias("qty"), F.grouping("product_name").alias("no_product"),
        F.grouping("product_category").alias("no_category"))
    product, category = F.col("product_name"), F.col("product_category")
    dated = F.col("branch").isNotNull() & F.col("day").isNotNull() & kept
    day = F.col("day").cast("string")
    lines = by.select(F.when((F.col("no_category") == 1) & dated & product.isNotNull(),
                             Q.key_of("product_daily", "day,product", day, product))
                      .when((F.col("no_product") == 1) & dated & category.isNotNull(),
                            Q.key_of("category_daily", "day,category", day, category))
                      .when((F.col("no_product") == 0) & (F.col("no_category") == 0) & product.isNotNull()
                            & category.isNotNull(), Q.key_of("product_category", "product", product)).alias("k"))
    paid = x.payments_live.filter("branch IS NOT NULL").groupingSets(
        [["branch", "day"], ["branch", "month"], ["branch"]], "branch", "day", "month").agg(
        F.sum("amount").alias("amount"), F.grouping("day").alias("no_day"), F.grouping("month").alias("no_month"))
    payments = paid.select(F.when((F.col("no_day") == 0) & F.col("day").isNotNull() & (F.col("amount") > 0),
                                  Q.key_of("daily_revenue_branch", "day", day))
                           .when((F.col("no_month") == 0) & F.col("month").isNotNull(),
                                 Q.key_of("monthly_revenue", "month", F.col("month")))
                           .when((F.col("no_day") == 1) & (F.col("no_month") == 1),
                                 Q.key_of("branch_kpis", "branch", F.col("branch"))).alias("k"))
    booked = x.booking_monthly.select(Q.key_of("booking_monthly", "branch,month", F.col("branch"),
                                               F.col("month")).alias("k"))
    return Q.key_repeats(lines.unionByName(payments).unionByName(booked))


def quality_fk(x: Inputs):
    """References of the published tables and of the lines. The enriched lines are read once, by
    grouping sets of the keys that the checks need."""
    to_pairs, to_catalog = "product_daily.product->product_category", "category_daily.category->categories"
    paid, booked = "daily_revenue_branch.branch->branches", "booking_monthly.branch->branches"
    by = x.lines_enriched.groupingSets(
        [["branch", "day", "product_name"], ["branch", "day", "product_category"], ["product_name", "product_category"]],
        "branch", "day", "product_name", "product_category").agg(
        F.sum("quantity").alias("qty"), F.grouping("product_name").alias("no_product"),
        F.grouping("product_category").alias("no_category"))
    product, category = F.col("product_name"), F.col("product_category")
    dated = F.col("branch").isNotNull() & F.col("day").isNotNull() & (F.col("qty") > 0)
    lines = by.select(F.when((F.col("no_category") == 1) & dated & product.isNotNull(), Q.reference_of(to_pairs, product, True))
                      .when((F.col("no_product") == 1) & dated & category.isNotNull(), Q.reference_of(to_catalog, category, True))
                      .when((F.col("no_product") == 0) & (F.col("no_category") == 0) & product.isNotNull()
                            & category.isNotNull(), Q.reference_of(to_pairs, product, False)).alias("k"))
    branch = F.col("branch")
    parts = [x.catalog.filter("product_category IS NOT NULL").select(
                 Q.reference_of(to_catalog, F.col("product_category"), False).alias("k")),
             M.daily_revenue_branch(x.payments_live).select(Q.reference_of(paid, branch, True).alias("k")),
             x.booking_monthly.select(Q.reference_of(booked, branch, True).alias("k"))]
    parts += [x.branches.select(Q.reference_of(c, branch, False).alias("k")) for c in (paid, booked)]
    for p in parts:
        lines = lines.unionByName(p)
    keys = fx.table(x.spark, x.sf_dir, "lineitem").select(F.col("l_orderkey").alias("sale_id"))
    sales = fx.table(x.spark, x.sf_dir, "orders").select(F.col("o_orderkey").alias("sale_id"))
    return Q.orphans_of(lines, [to_pairs, to_catalog, paid, booked]).unionByName(
        Q.orphans(keys, sales, "lines.sale_id->sales", ["sale_id"]))


def quality_nulls(x: Inputs):
    return Q.null_counts(x.lines_enriched, "lines_enriched", ["branch", "day", "product_name", "product_category"]) \
        .unionByName(Q.null_counts(x.sales, "sales", ["branch", "closed_at", "customer_id"]))


def accepted_rejected(x: Inputs):
    return Q.accepted_rejected(x.pairs)


def run_summary(x: Inputs):
    lo, hi = fx.DWELL_DAYS
    return Q.row_counts({"sales": x.sales, "items": x.lines_enriched,
                         "dwell": C.dwell(x.sales, fx.DINE_IN_TYPE, f"{lo} days", f"{hi} days"),
                         "payments": x.payments_live})


def stream_upsert_payments(x: Inputs):
    """The payments upsert run as a file stream: old slice landed as batch 0, new as
    batch 1, consumed with availableNow in several micro-batches."""
    from branchlens.schemas import PAYMENT
    from branchlens.session import scratch_path
    from branchlens.streaming.upsert_stream import stream_upsert
    old, new = _payments_split(x)
    res = stream_upsert(x.spark, [old.drop("ingest_seq"), new.drop("ingest_seq")], PAYMENT,
                        PAYMENT_KEYS, [], scratch_path(x.spark, "stream-upsert"))
    return doubles(res.select(*PAYMENT_COLS))


def mart_published(x: Inputs):
    return SQ.mart_published(x)


def pairs_appended(x: Inputs):
    return SQ.pairs_appended(x)


def reports_published(x: Inputs):
    return SQ.reports_published(x, AS_OF)


def facts_published(x: Inputs):
    return SQ.facts_published(x)


def lines_enriched_bucketed(x: Inputs):
    return SQ.lines_enriched_bucketed(x)


def sheet_read(x: Inputs):
    return SQ.sheet_read(x)


def raw_csv_read(x: Inputs):
    return SQ.raw_csv_read(x)


def stream_keyed_state(x: Inputs):
    """The same upsert by keyed state: each landed slice is one delivery, a day apart; only
    changed rows are written."""
    from branchlens.schemas import PAYMENT
    from branchlens.session import scratch_path
    from branchlens.streaming import keyed_state as KS
    root = scratch_path(x.spark, "stream-keyed")
    for n, slice_ in enumerate(_payments_split(x)):
        day = F.lit(dt.datetime(2024, 2, 1 + n)).cast("timestamp")
        slice_.select(*[F.col(f.name).cast(f.dataType) for f in PAYMENT.fields], F.lit(n).cast("long").alias("seq"),
                      day.alias("delivered_at")).write.parquet(f"{root}/in/batch={n}")
        KS.run_keyed_stream(x.spark, f"{root}/in", PAYMENT, f"{root}/table", PAYMENT_KEYS, "seq", root)
    store = KS.change_store(x.spark, f"{root}/table", PAYMENT, "seq")
    return doubles(KS.current_rows(store, PAYMENT_KEYS, "seq").select(*PAYMENT_COLS))


QUERY_FUNCS = [
    lines_enriched, dwell_filtered, payments_live,
    daily_revenue_all, daily_revenue_branch, product_daily, product_totals, category_daily, category_totals,
    branch_kpis, branch_kpis_edges, mom_growth, monthly_revenue, top_products, top_products_edges,
    top_products_day, top_products_ranked, marts_incremental,
    daily_reconciliation, weekly_reconciliation, monthly_line_revenue,
    product_category_pairs, new_product_categories, timestamps_normalised, scalar_suite,
    catalog_inner, catalog_left, catalog_refresh,
    dedupe_sales, dedupe_lines, dedupe_payments, dedupe_catalog,
    upsert_sales, upsert_lines, upsert_payments,
    highwater_marks, closed_sales_trimmed, incremental_selection,
    json_sales_flat, json_items_flat, json_payments_flat, json_sale_single, json_payment_single,
    json_categories_flat, json_products_flat,
    bootstrap_raw, upsert_raw_rows, incremental_upsert, upsert_moved_keys,
    bookings_clean, booking_monthly, booking_metrics, booking_metrics_edges,
    quality_unique, quality_fk, quality_nulls, accepted_rejected, run_summary,
    stream_upsert_payments, stream_keyed_state,
    mart_published, pairs_appended, reports_published, facts_published, sheet_read, raw_csv_read,
    lines_enriched_bucketed,
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _q(f) for f in QUERY_FUNCS}
