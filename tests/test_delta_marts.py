"""Marts by deltas equal a full refresh after every delivery; positions of large rankings."""
import datetime as dt
import random
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from branchlens.operators import conform as C
from branchlens.operators import marts as M
from branchlens.operators.incremental import keep_last
from branchlens.operators.ranking import with_positions
from branchlens.plans import ingest, raw_queries
from branchlens.plans.delta_marts import DeltaMarts
from branchlens.schemas import LINE, PAYMENT, PRODUCT, SALE


def delivery(spark, rng, ids, catalog=None):
    day = lambda: dt.datetime(2024, rng.randint(1, 4), rng.randint(1, 28), 12)
    money = lambda: Decimal(rng.randint(-500, 2000)) / 100
    branch = lambda i: [None, "A", "B"][i % 3]
    sales = [(str(i), money(), 1, "EAT-IN", day(), day(), None, branch(i)) for i in ids]
    lines = [(str(i), str(p), money(), Decimal(rng.randint(-1, 3)), rng.choice([None, False, True]), branch(i))
             for i in ids for p in rng.sample(range(6), rng.randint(0, 4))]
    pays = [(str(i), money(), day(), "m", rng.choice([None, False, True]), branch(i)) for i in ids]
    frames = {"sales": spark.createDataFrame(sales, SALE), "lines": spark.createDataFrame(lines, LINE),
              "payments": spark.createDataFrame(pays, PAYMENT)}
    if catalog:
        frames["catalog"] = spark.createDataFrame(
            [(str(p), f"{catalog} product number {p}", rng.choice(["x", "y", None]), b) for p in range(5) for b in (None, "A", "B")],
            PRODUCT)
    return frames


def full_refresh(raw):
    t = {n: keep_last(raw.read(n), ingest.KEYS[n], ingest.ORDER) for n in ("sales", "lines", "payments", "products")}
    items, pay = C.enrich_lines(t["lines"], t["sales"], t["products"]), C.live_payments(t["payments"])
    product, category = M.product_daily(items), M.category_daily(items)
    return {"daily_revenue_all": M.daily_revenue_all(pay), "daily_revenue_branch": M.daily_revenue_branch(pay),
            "monthly_revenue": M.monthly_revenue(pay), "product_daily": product, "category_daily": category,
            "product_totals": M.product_totals(product), "category_totals": M.category_totals(category),
            "monthly_line_revenue": M.monthly_line_revenue(items)}


def test_deltas_equal_a_full_refresh_after_every_delivery(spark):
    rng, root = random.Random(3), tempfile.mkdtemp(prefix="branchlens-delta-")
    raw = ingest.raw_store(spark, f"{root}/raw")
    marts = DeltaMarts(spark, f"{root}/marts", raw)
    deliveries = [delivery(spark, rng, range(20), "first"), delivery(spark, rng, range(15, 30)),
                  delivery(spark, rng, [3]), delivery(spark, rng, range(28, 31), "second")]
    for seq, batch in enumerate(deliveries):
        raw_queries.deliver(raw, batch, seq, f"{root}/b{seq}")
        seen = marts.refresh()
        rows = lambda m: sorted(map(str, raw_queries.mart_rows(m).collect()))
        assert rows(marts.marts()) == rows(full_refresh(raw)), seq
        if seq == 2:
            assert 0 < seen["items"] <= 2 and 0 < seen["payments"] <= 2  # one sale: its old and its new month
    version = marts.store.snapshot().version
    assert marts.refresh() == {"items": 0, "payments": 0} and marts.store.snapshot().version == version


def test_positions_equal_a_window(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.randint(0, 30), i) for i in range(500)] + [("hot", 1, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, q int, id int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_positions(df, ["g"], [F.col("q").desc(), F.col("id").asc()]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    for g, q, i in sorted(rows, key=lambda r: (str(r[0]), -r[1], r[2])):
        want[g, i, q] = want.get(("n", g), 0) + 1
        want["n", g] = want[g, i, q]
    assert len(got) == len(rows) and all(want[r.g, r.id, r.q] == r["rank"] for r in got)
    assert with_positions(df.limit(0), ["g"], [F.col("id").asc()]).collect() == []
