"""Queries that run the life of the raw tables: landings, commits and merges.

Their tables are written under the shared scratch folder when the query is built: they run
the production code, which is made of writes. The deliveries are made from the test tables
(``deliveries``): a first landing of the older records, a second one of all records in which
the newer ones have changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.functions.semantics import month_of, numeric_id
from branchlens.operators.conform import live
from branchlens.operators.incremental import keep_last
from branchlens.plans import ingest
from branchlens.plans.delta_marts import DeltaMarts
from branchlens.session import drop_folder, run_together, scratch_path, shuffles_freed
from branchlens.sources import documents as D
from branchlens.sources import fixtures as fx
from branchlens.sources.snapshots import COMPRESSION, KeyIndex

MOVE_DAYS, RETURN_DAYS = 40, 70  # shifts of re-delivered sales, longer than a month


def land(spark: SparkSession, folder: str, **feeds: DataFrame) -> None:
    """Write page files of several feeds side by side."""
    with shuffles_freed(spark):
        run_together(spark, [lambda f=feed, d=docs: D.write_pages(d, f"{folder}/{f}") for feed, docs in feeds.items()])


def raw_rows(read: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of the four raw tables in one form."""
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    columns = {
        "sales": ("sale_id", text, F.col("total").cast("double"), "month"),
        "lines": ("sale_id", F.col("product_id"), F.col("price").cast("double"), "month"),
        "payments": ("payment_id", F.col("method"), F.col("amount").cast("double"), "month"),
        "products": ("product_id", F.col("product_category"), none, "branch"),
    }
    out = None
    for name, (key, second, amount, part) in columns.items():
        rows = read(name).select(
            F.lit(name).alias("raw_table"), F.col(key).alias("id"), second.alias("detail"), "branch",
            amount.alias("amount"), F.col(part).alias("part"))
        out = rows if out is None else out.unionByName(rows)
    return out


def bootstrap_raw(x) -> DataFrame:
    """Every row of the four raw tables that ``ingest.bootstrap`` builds from landed pages:
    raw_table, id, product, branch, amount, partition."""
    root = scratch_path(x.spark, "bootstrap")
    land(x.spark, f"{root}/landing", sales=D.build_sales_pages(x.sales, x.lines),
         payments=D.build_payment_pages(x.payments_ev), products=D.build_product_pages(x.catalog),
         categories=D.build_category_pages(x.catalog))
    ingest.bootstrap(x.spark, f"{root}/landing", f"{root}/raw")
    return raw_rows(ingest.raw_store(x.spark, f"{root}/raw").read)


def written(x, root: str, **entities: DataFrame) -> list[DataFrame]:
    """Entities written once under ``root`` and read again: every delivery takes its rows from
    them, and the joins that bind the test tables are not run anew for each."""

    def one(name: str, df: DataFrame) -> DataFrame:
        df.write.option("compression", COMPRESSION).parquet(f"{root}/{name}")
        return x.spark.read.schema(df.schema).parquet(f"{root}/{name}")
    with shuffles_freed(x.spark):
        return run_together(x.spark, [lambda n=name, d=df: one(n, d) for name, df in entities.items()])


def newer(df: DataFrame, id_col: str):
    """Whether a record is of the newer quarter of the ids (a fixture: it says what is delivered
    when, every record takes part)."""
    return numeric_id(id_col) * 4 > df.agg(F.max(numeric_id(id_col)) * 3).scalar()


def deliveries(x, scratch: str | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Entities of the first and of the second landing; they are read from ``scratch``."""
    lines = x.lines.groupBy("sale_id", "product_id", "branch").agg(
        F.sum("price").cast("decimal(18,2)").alias("price"), F.sum("quantity").cast("decimal(18,2)").alias("quantity")) \
        .withColumn("canceled", F.lit(None).cast("boolean"))
    sales, lines = written(x, scratch or scratch_path(x.spark, "deliveries"), sales=x.sales, lines=lines)
    late_sale, late_payment = newer(sales, "sale_id"), newer(x.payments_ev, "payment_id")
    first = {"sales": sales.filter(~late_sale), "payments": x.payments_ev.filter(~late_payment), "catalog": x.catalog,
             "lines": lines.filter(~late_sale)}

    def raised(df, col, late):
        return df.withColumn(col, (F.col(col) + F.when(late, 1).otherwise(0)).cast("decimal(18,2)"))

    second = {"sales": raised(sales, "total", late_sale), "payments": raised(x.payments_ev, "amount", late_payment),
              "catalog": x.catalog.withColumn("product_name", F.upper("product_name")), "lines": lines}
    return first, second


def _two_landings(x, single: bool) -> DataFrame:
    """A landing is made when the one before is in the raw tables; what no later step reads is
    deleted."""
    root = scratch_path(x.spark, "incremental")
    first, second = deliveries(x, f"{root}/entities")

    def land_one(folder: str, d: dict[str, DataFrame], one: bool) -> None:
        land(x.spark, folder, sales=(D.build_sale_single_docs if one else D.build_sales_pages)(d["sales"], d["lines"]),
             payments=(D.build_payment_single_docs if one else D.build_payment_pages)(d["payments"]),
             products=D.build_product_pages(d["catalog"]), categories=D.build_category_pages(d["catalog"]))

    land_one(f"{root}/landing0", first, False)
    ingest.bootstrap(x.spark, f"{root}/landing0", f"{root}/raw")
    drop_folder(x.spark, f"{root}/landing0")
    land_one(f"{root}/landing1", second, single)
    drop_folder(x.spark, f"{root}/entities")
    ingest.incremental(x.spark, f"{root}/landing1", f"{root}/raw", seq=1)
    drop_folder(x.spark, f"{root}/landing1")
    store = ingest.raw_store(x.spark, f"{root}/raw")
    store.collect_garbage(keep=1, min_age_s=0)  # nobody else reads an earlier version
    return raw_rows(store.read)


def upsert_raw_rows(x) -> DataFrame:
    """Every row of the four raw tables after a bootstrap and an incremental run over pages."""
    return _two_landings(x, single=False)


def incremental_upsert(x) -> DataFrame:
    """The same, where the second landing has one document per sale and per payment."""
    return _two_landings(x, single=True)


def moved_batches(x) -> list[DataFrame]:
    """Sales, then a batch in which every third sale has moved to a later month, then every
    fifth sale of that batch back to an earlier one."""
    old, new = fx.split_old_new(x.sales, "created_at", fx.SPLIT_DATE, "total")

    def shifted(df, every, days, seq):
        some = numeric_id("sale_id") % every == 0
        at = F.when(some, F.col("created_at") + F.expr(f"INTERVAL {days} DAYS")).otherwise(F.col("created_at"))
        return df.withColumn("created_at", at).withColumn("ingest_seq", F.lit(seq))

    moved = shifted(new, 3, MOVE_DAYS, 1)
    back = shifted(moved.filter(numeric_id("sale_id") % 5 == 0), 5, -RETURN_DAYS, 2)
    return [b.withColumn("month", month_of("created_at")) for b in (old, moved, back)]


def upsert_moved_keys(x) -> DataFrame:
    """The sales after upserts that move keys to other months: each is in its last one only."""
    store = ingest.raw_store(x.spark, f"{scratch_path(x.spark, 'moved')}/raw")
    index = KeyIndex(store, "sales", ingest.KEYS["sales"])
    for seq, batch in enumerate(moved_batches(x)):
        base = index.ensure(store.snapshot())
        if seq == 0:
            store.commit(base, {"sales": store.replace("sales", batch)}, seq=seq)
            continue
        last = keep_last(batch, ingest.KEYS["sales"], ["ingest_seq"])
        change = store.merge("sales", last, ingest.KEYS["sales"], ["ingest_seq"], base, also=index.moves(last, base))
        changes = {index.name: index.update(last, base, seq)}
        store.commit(base, changes if change is None else changes | {"sales": change}, seq=seq)
    return store.read("sales").select("sale_id", F.col("total").cast("double").alias("total"), "created_at", "month", "branch")



def mart_batches(x) -> list[dict[str, DataFrame]]:
    """Three deliveries that end in the test tables: first every second sale and payment, with
    wrong months, amounts and names, then the right values of one half of all records, then
    those of the other half and the right catalogue."""
    lines = live(x.lines).groupBy("sale_id", "product_id", "branch").agg(
        F.sum("price").cast("decimal(18,2)").alias("price"), F.sum("quantity").cast("decimal(18,2)").alias("quantity"))
    catalog = fx.fx_catalog_with_gaps(x.spark, x.sf_dir)
    sales, lines = written(x, scratch_path(x.spark, "mart-batches"), sales=x.sales, lines=lines)
    part = {"sales": sales, "lines": lines, "payments": x.payments_ev}
    ids = {"sales": "sale_id", "lines": "sale_id", "payments": "payment_id"}

    def of(*rests: int) -> dict[str, DataFrame]:
        return {n: df.filter((numeric_id(ids[n]) % 4).isin(*rests)) for n, df in part.items()}

    wrong = of(0, 2)
    wrong["sales"] = wrong["sales"].withColumn("created_at", F.col("created_at") + F.expr(f"INTERVAL {MOVE_DAYS} DAYS"))
    wrong["lines"] = wrong["lines"].withColumn("price", (F.col("price") + 1).cast("decimal(18,2)"))
    wrong["payments"] = wrong["payments"].withColumn("amount", (F.col("amount") + 3).cast("decimal(18,2)"))
    return [wrong | {"catalog": catalog.withColumn("product_name", F.upper("product_name"))},
            of(0, 1), of(2, 3) | {"catalog": catalog}]


def deliver(store, batch: dict[str, DataFrame], seq: int, scratch: str) -> None:
    """Commit one delivery of entities to the raw tables."""
    with shuffles_freed(store.spark):
        _deliver(store, batch, seq, scratch)
    drop_folder(store.spark, scratch)


def _deliver(store, batch: dict[str, DataFrame], seq: int, scratch: str) -> None:
    nowhere = F.lit(None).cast("struct<file:string,block:bigint,line:bigint,pos:int>")
    placed = {n: df.withColumns({"landed_at": nowhere, "ingest_seq": F.lit(seq).cast("bigint")}) for n, df in batch.items()}
    frames = dict(zip(("sales", "lines", "payments"), ingest.with_months(*[placed[n] for n in ("sales", "lines", "payments")])))
    for name, df in frames.items():
        df.write.option("compression", COMPRESSION).parquet(f"{scratch}/{name}")
        frames[name] = store.spark.read.schema(df.schema).parquet(f"{scratch}/{name}")
    base = store.snapshot()
    if seq == 0:
        changes = {name: store.replace(name, df) for name, df in frames.items()}
    else:
        base, changes = ingest.merge_batch(store, base, frames, seq)
    if "catalog" in placed:
        changes["products"] = store.merge("products", placed["catalog"], ingest.KEYS["products"], ["ingest_seq"], base)
    store.commit(base, changes, seq=seq)


def mart_rows(marts: dict[str, DataFrame]) -> DataFrame:
    """The rows of several marts in one form: mart, branch, key, detail, and up to four measures."""
    form = {
        "daily_revenue_all": (None, "day", None, ["revenue"]), "daily_revenue_branch": ("branch", "day", None, ["revenue"]),
        "monthly_revenue": ("branch", "month", None, ["revenue"]), "monthly_line_revenue": (None, "month", None, ["line_revenue"]),
        "product_daily": ("branch", "day", "product", ["qty", "revenue"]),
        "category_daily": ("branch", "day", "category", ["qty", "revenue"]),
        "product_totals": ("branch", "product", None, ["qty", "revenue", "avg_daily_qty", "avg_daily_revenue"]),
        "category_totals": ("branch", "category", None, ["qty", "revenue", "avg_daily_qty", "avg_daily_revenue"]),
    }
    out = None
    for name, (branch, key, detail, measures) in form.items():
        texts = [(F.col(c) if c else F.lit(None)).cast("string").alias(a) for c, a in ((branch, "branch"), (key, "key"), (detail, "detail"))]
        numbers = [(F.col(measures[i]) if i < len(measures) else F.lit(None)).cast("double").alias(f"m{i + 1}") for i in range(4)]
        rows = marts[name].select(F.lit(name).alias("mart"), *texts, *numbers)
        out = rows if out is None else out.unionByName(rows)
    return out


def marts_incremental(x) -> DataFrame:
    """The marts after three deliveries, each followed by a refresh by deltas."""
    root = scratch_path(x.spark, "delta-marts")
    store = ingest.raw_store(x.spark, f"{root}/raw")
    marts = DeltaMarts(x.spark, f"{root}/marts", store)
    for seq, batch in enumerate(mart_batches(x)):
        deliver(store, batch, seq, f"{root}/batch{seq}")
        marts.refresh()
        for owned in (store, marts.store):  # nobody else reads an earlier version
            owned.collect_garbage(keep=1, min_age_s=0)
    return mart_rows(marts.marts())
