"""Operators on literal rows: null keys, null-safe joins, dwell bounds, tail trimming,
keep-last, rounding order of the monthly total, KPIs and bookings windows."""
import contextlib
import datetime as dt
import io
from decimal import Decimal

from pyspark.sql import functions as F

from branchlens.operators import bookings as B
from branchlens.operators import conform as C
from branchlens.operators import incremental as I
from branchlens.operators import kpis as K
from branchlens.operators import marts as M
from branchlens.operators import reports as R
from branchlens.schemas import LINE, PAYMENT, PRODUCT, SALE

D = Decimal
T0 = dt.datetime(2025, 1, 10, 12, 0)


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def payments(spark, rows):
    df = spark.createDataFrame([(str(i), D(a), ts, "cash", None, b) for i, (a, ts, b) in enumerate(rows)], PAYMENT)
    return C.live_payments(df)


def test_null_branch_dropped_from_groups_but_in_all_kpi(spark):
    p = payments(spark, [("10.00", T0, "A"), ("5.00", T0, None)])
    daily = {(r.branch, r.day): r.revenue for r in M.daily_revenue_branch(p).collect()}
    assert daily == {("A", T0.date()): 10.0}
    k = {r.branch: r.today for r in K.branch_kpis(p, T0.date()).collect()}
    assert k == {"A": 10.0, "ALL": 15.0}


def test_kpi_windows(spark):
    as_of = dt.date(2025, 3, 31)
    rows = [("1.00", dt.datetime(2025, 3, 31), "A"),
            ("2.00", dt.datetime(2025, 3, 1), "A"),   # as_of - 30: first day of the trailing window
            ("4.00", dt.datetime(2025, 2, 28), "A"),  # previous month, outside the trailing window
            ("8.00", dt.datetime(2025, 2, 27), "A"),
            ("16.00", dt.datetime(2025, 4, 1), "A")]  # after as_of: cut
    k = K.branch_kpis(payments(spark, rows), as_of).filter("branch = 'A'").first()
    assert k.month_to_date == 3.0 and k.today == 1.0 and k.previous_month == 12.0
    assert k.avg_per_day_30 == 3.0 / 30 and k.avg_per_month == 15.0 / 2
    g = K.mom_growth(payments(spark, rows), as_of).filter("branch = 'A'").first()
    assert g.growth_pct == (3.0 - 12.0) / 12.0 * 100


def test_growth_null_when_previous_zero(spark):
    g = K.mom_growth(payments(spark, [("1.00", T0, "A")]), T0.date()).collect()
    assert {r.branch: r.growth_pct for r in g} == {"A": None, "ALL": None}


def test_monthly_total_is_sum_of_rounded(spark):
    p = payments(spark, [("0.50", T0, "A"), ("0.50", T0, "B")])
    got = {(r.branch, r.month): r.revenue for r in M.monthly_revenue(p).collect()}
    assert got == {("A", "2025-01"): 0, ("B", "2025-01"): 0, ("ALL", "2025-01"): 0}


def test_null_branch_join_matches_null(spark):
    lines = spark.createDataFrame([("1", "p", D("3.00"), D("1.00"), False, None)], LINE)
    sales = spark.createDataFrame([("1", D("3.00"), 1, "EAT-IN", T0, T0, None, None)], SALE)
    cat = spark.createDataFrame([("p", "Coffee", "Drinks", None)], PRODUCT)
    r = C.enrich_lines(lines, sales, cat).first()
    assert r.day == T0.date() and r.product_name == "Coffee" and r.product_category == "Drinks"


def test_dwell_bounds(spark):
    def sale(i, minutes):
        closed = None if minutes is None else T0 + dt.timedelta(minutes=minutes)
        return (str(i), D("1.00"), 1, "EAT-IN", T0, closed, None, "A")
    mins = [49 + 59 / 60, 50, 3 * 60 + 59 + 59 / 60, 240, None]
    sales = spark.createDataFrame([sale(i, m) for i, m in enumerate(mins)], SALE)
    kept = sorted(r.sale_id for r in C.dwell(sales, "EAT-IN").collect())
    assert kept == ["1", "2"]


def test_drop_tail(spark):
    def sales(n):
        return spark.createDataFrame([(str(i), D("1.00"), 1, "x", T0, T0, None, "A") for i in range(1, n + 1)], SALE)
    order = [F.col("sale_id").try_cast("bigint"), "sale_id"]
    assert I.drop_tail(sales(20), order, ["sale_id", "branch"]).count() == 20
    kept = sorted(int(r.sale_id) for r in I.drop_tail(sales(25), order, ["sale_id", "branch"]).collect())
    assert kept == [1, 2, 3, 4, 5]


def test_mixed_id_origins_dedupe(spark):
    from branchlens.sources.readers import conform
    ints = spark.createDataFrame([(1, "10.00", "A")], "payment_id bigint, amount string, Sucursal string")
    texts = spark.createDataFrame([("1", "11.00", "A")], "payment_id string, amount string, Sucursal string")
    a = conform(ints, PAYMENT, {"Sucursal": "branch"})
    b = conform(texts, PAYMENT, {"Sucursal": "branch"})
    out = I.upsert(a, b, ["payment_id", "branch"]).collect()
    assert len(out) == 1 and out[0].amount == D("11.00")


def test_upsert_idempotent(spark):
    base = spark.createDataFrame([(str(i), D(i), T0, "m", None, "A") for i in range(10)], PAYMENT)
    batch = spark.createDataFrame([(str(i), D(i + 100), T0, "m", None, "A") for i in range(5, 15)], PAYMENT)
    once = I.upsert(base, batch, ["payment_id", "branch"]).drop("ingest_seq")
    twice = I.upsert(once, batch, ["payment_id", "branch"]).drop("ingest_seq")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == 15


def test_keep_last_hot_key_plans_partial_limit(spark):
    # one key holds a third of all rows
    rows = [("hot" if i % 3 == 0 else f"k{i}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, seq int")
    out = I.keep_last(df, ["k"], ["seq"])
    got = {r.k: r.seq for r in out.collect()}
    assert got["hot"] == 2997 and len(got) == 2001
    assert "WindowGroupLimit" in plan_text(out)


def test_product_mean_divides_by_active_days(spark):
    daily = spark.createDataFrame([("A", dt.date(2025, 1, 1), "p", D("2.00"), D("10.00")),
                                   ("A", dt.date(2025, 1, 3), "p", D("4.00"), D("20.00"))],
                                  "branch string, day date, product string, qty decimal(28,2), revenue decimal(28,2)")
    r = M.product_totals(daily).first()
    assert (r.qty, r.revenue, r.avg_daily_qty, r.avg_daily_revenue) == (6.0, 30.0, 3.0, 15.0)


def test_top_products_periods(spark):
    as_of = dt.date(2025, 3, 1)
    lines = spark.createDataFrame(
        [("A", as_of, "p", D("2.00"), D("4.00")), ("A", as_of - dt.timedelta(days=1), "q", D("5.00"), D("1.00")),
         (None, as_of, "p", D("1.00"), D("1.00"))],
        "branch string, day date, product_name string, quantity decimal(18,2), price decimal(18,2)")
    rows = R.top_products(lines, as_of).collect()
    got = {(r.report, r.scope, r.product): r.qty for r in rows}
    assert got == {("month", "A", "p"): 2.0, ("today", "A", "p"): 2.0, ("yesterday", "A", "q"): 5.0,
                   ("month", "ALL", "p"): 3.0, ("today", "ALL", "p"): 3.0, ("yesterday", "ALL", "q"): 5.0}
    assert [(r.report, r.scope) for r in rows] == sorted((r.report, r.scope) for r in rows)


def test_ranking_order(spark):
    as_of = dt.date(2025, 3, 1)
    lines = spark.createDataFrame(
        [("A", as_of, p, D(q), D("1.00")) for p, q in (("b", "2.00"), ("a", "2.00"), ("c", "9.00"), ("d", "1.00"))],
        "branch string, day date, product_name string, quantity decimal(18,2), price decimal(18,2)")
    rows = R.top_products(lines, as_of).filter("report = 'today' AND scope = 'A'").collect()
    assert [r.product for r in rows] == ["c", "a", "b", "d"]
    assert [r.product for r in R.top_products_day(lines, "A", as_of).collect()] == ["c", "a", "b", "d"]


def test_booking_metrics_attach_branch_months(spark):
    monthly = spark.createDataFrame([("A", "2025-01", 1, 10, 100.0), ("A", "2025-02", 2, 20, 200.0),
                                     ("B", "2025-02", 3, 30, 300.0)],
                                    "branch string, month string, events bigint, guests bigint, income double")
    out = B.booking_metrics(monthly, dt.date(2025, 2, 10)).collect()
    assert len(out) == 3
    a = [r for r in out if r.branch == "A"][0]
    assert (a.events_prev, a.events_cur, a.events_next, a.income_cur) == (1, 2, 0, 200.0)
    b = [r for r in out if r.branch == "B"][0]
    assert (b.events_prev, b.events_cur) == (0, 3)


def test_listed_branch_without_payments_gets_zero_row(spark):
    p = payments(spark, [("10.00", T0, "A")])
    listed = spark.createDataFrame([("A",), ("B",)], "branch string")
    got = {r.branch: (r.today, r.avg_per_month) for r in K.branch_kpis(p, T0.date(), listed).collect()}
    assert got == {"A": (10.0, 10.0), "B": (0.0, None), "ALL": (10.0, 10.0)}


def test_numeric_money_columns_pass_unchanged(spark):
    raw = spark.createDataFrame([("3/1/2025", "ana", "A", "m", "2", "s", 1234.5, 99.0, "Ganado")],
                                "event_date string, client string, branch string, menu string, guests string, "
                                "slot string, price_per_guest double, total double, status string")
    r = B.clean_bookings(raw).first()
    assert (r.price_per_guest, r.total, r.client) == (1234.5, 99.0, "Ana")
