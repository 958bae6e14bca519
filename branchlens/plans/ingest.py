"""Landing -> raw tables: the full bootstrap and the incremental update.

The raw tables are one ``SnapshotStore`` (``raw_store``): sales, lines and payments
partitioned by month (lines carry their sale's month), the catalogue by branch, the documents
that could not be read by run, and the high-water marks that a run started from. A run reads
one version, writes data folders that no reader sees, and publishes all tables with one
commit. A run that dies has changed nothing and is simply run again; readers see the version
before or the version after it.

Every raw row carries ``ingest_seq`` (0 for the bootstrap, the run's sequence number
afterwards) and ``landed_at`` (file, block, line, place in the page): on equal keys the row
that landed last wins, as in a keep-last append. File names must sort in the order of
delivery.

* ``stage``: every landed document is read and parsed once, whether it is a page or holds a
  single record, and kept as nested parquet; all tables are made from that.
* ``bootstrap``: all tables from the staged documents; the catalogue keeps only categorised
  products (inner join).
* ``incremental``: marks from the raw tables (closed sales minus the 20-row lookback; all
  payments), landed records above their branch's mark, merged by key into the months they
  touch and the months their keys had before; the catalogue is refreshed (left join,
  keep-last) only when new lines arrived.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.functions.semantics import month_of
from branchlens.operators import incremental as I
from branchlens.schemas import RAW_TABLES
from branchlens.session import drop_folder, run_together, scratch_path, shuffles_freed
from branchlens.sources import documents as D
from branchlens.sources.snapshots import COMPRESSION, Change, KeyIndex, Snapshot, SnapshotStore, slice_count, sliced

KEYS = {
    "sales": ["sale_id", "branch"],
    "lines": ["sale_id", "product_id", "branch"],
    "payments": ["payment_id", "branch"],
    "products": ["product_id", "branch"],
}
PARTITION = {"sales": "month", "lines": "month", "payments": "month", "products": "branch"}
ORDER = ["ingest_seq", "landed_at"]

_TEXT, _LONG = T.StringType(), T.LongType()
REJECTS = T.StructType([T.StructField("feed", _TEXT), T.StructField("branch", _TEXT), T.StructField("doc", _TEXT),
                        T.StructField("run", _TEXT)])
MARKS = T.StructType([T.StructField("branch", _TEXT), T.StructField("last_id", _LONG), T.StructField("source", _TEXT)])


def raw_store(spark: SparkSession, raw: str) -> SnapshotStore:
    """The store of the raw tables under ``raw``."""
    tables = {name: (RAW_TABLES[name], PARTITION[name]) for name in KEYS}
    return SnapshotStore(spark, raw, tables | {"rejects": (REJECTS, "run"), "marks": (MARKS, "source")})


def indexes(store: SnapshotStore) -> dict[str, KeyIndex]:
    """The month of every sale and payment; lines follow their sale."""
    return {name: KeyIndex(store, name, KEYS[name]) for name in ("sales", "payments")}


def stage(spark: SparkSession, landing: str, out: str) -> dict[str, DataFrame]:
    """Parse every document of ``landing/{sales,payments,products,categories}`` once and keep
    the result under ``out``: the (branch, landed_at, page, doc) rows of each feed."""
    def one(feed: str) -> DataFrame:
        parsed = D.parse_feed(spark, f"{landing}/{feed}", feed)
        parsed.write.option("compression", COMPRESSION).parquet(f"{out}/{feed}")
        return spark.read.schema(parsed.schema).parquet(f"{out}/{feed}")
    return dict(zip(D.FEEDS, run_together(spark, [lambda f=feed: one(f) for feed in D.FEEDS])))


def landed(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Records of the staged documents."""
    pages = {feed: df.filter("page IS NOT NULL") for feed, df in staged.items()}
    return {
        "sales": D.flatten_sales(pages["sales"]),
        "lines": D.flatten_items(pages["sales"]),
        "payments": D.flatten_payments(pages["payments"]),
        "products": D.flatten_products(pages["products"]),
        "categories": D.flatten_categories(pages["categories"]),
    }


def rejects(staged: dict[str, DataFrame], run: int) -> DataFrame:
    """The documents of all feeds that could not be read."""
    out = None
    for feed, df in staged.items():
        bad = df.filter("page IS NULL").select(F.lit(feed).alias("feed"), "branch", "doc", F.lit(str(run)).alias("run"))
        out = bad if out is None else out.unionByName(bad)
    return out


def same_key(a: DataFrame, b: DataFrame, keys: list[str]):
    """Equality of keys in which null equals null."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def with_months(sales: DataFrame, lines: DataFrame, payments: DataFrame):
    """The month of each row; lines take it from their sale, of which the last delivery
    counts (a sale that came twice must not double its lines)."""
    s = sales.withColumn("month", month_of("created_at"))
    one = I.keep_last(s, KEYS["sales"], ["landed_at"]).select(
        F.col("sale_id").alias("_sale"), F.col("branch").alias("_branch"), "month")
    match = lines["sale_id"].eqNullSafe(one["_sale"]) & lines["branch"].eqNullSafe(one["_branch"])
    return s, lines.join(one, match, "left").drop("_sale", "_branch"), \
        payments.withColumn("month", month_of("created_at"))


def catalogue(products: DataFrame, categories: DataFrame, how: str) -> DataFrame:
    """Products with their categories on (product, branch), null branches included."""
    c = categories.select(F.col("product_id").alias("_product"), F.col("branch").alias("_branch"),
                          "product_category")
    match = (products["product_id"] == c["_product"]) & products["branch"].eqNullSafe(c["_branch"])
    return products.join(c, match, how).drop("_product", "_branch")


def _as_table(df: DataFrame, name: str, seq: int) -> DataFrame:
    """The columns of a raw table, in its order and types."""
    df = df.withColumn("ingest_seq", F.lit(seq).cast("bigint"))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_TABLES[name].fields])


def _set_aside(store: SnapshotStore, staged: dict[str, DataFrame], run: int) -> tuple[Change, int]:
    change = store.append("rejects", rejects(staged, run))
    return change, store.written("rejects", change)


def merge_batch(store: SnapshotStore, base: Snapshot, batch: dict[str, DataFrame], seq: int) -> tuple[Snapshot, dict]:
    """The changes that merge selected ``sales``, ``lines`` and ``payments`` (whichever there
    are; written frames, they are read several times) into the tables of ``base``, and the
    version they start from (key indexes that are missing are built first)."""
    changes, moved = {}, {}
    for name, index in indexes(store).items():
        if name in batch:
            base = index.ensure(base, order=ORDER)
    for name, index in indexes(store).items():
        if name in batch:
            last_rows = I.keep_last(batch[name], KEYS[name], ORDER)
            moved[name] = index.moves(last_rows, base)
            changes[index.name] = index.update(last_rows, base, seq)
    for name, df in batch.items():
        months = moved.get("sales" if name == "lines" else name, [])
        change = store.merge(name, df, KEYS[name], ORDER, base, also=months)
        if change is not None:
            changes[name] = change
    return base, changes


def bootstrap(spark: SparkSession, landing: str, raw: str) -> dict[str, int]:
    """Full rebuild of the raw tables from every landed document, published as one version.
    What earlier runs published stays readable until it is collected."""
    scratch = scratch_path(spark, "bootstrap-pages")
    with shuffles_freed(spark):
        counts = _bootstrap(spark, landing, raw, scratch)
    drop_folder(spark, scratch)
    return counts


def _bootstrap(spark: SparkSession, landing: str, raw: str, scratch: str) -> dict[str, int]:
    store = raw_store(spark, raw)
    base = store.snapshot()
    staged = stage(spark, landing, scratch)
    src = landed(staged)
    sales, _, payments = with_months(src["sales"], src["lines"], src["payments"])
    # Lines meet their sale in slices of sales: the shuffle files of one are on the disks at a time.
    n = slice_count(staged["sales"])
    slices = zip(*[sliced(src[name], KEYS["sales"], n) for name in ("sales", "lines")])
    lines = [with_months(s, l, src["payments"])[1] for s, l in slices]
    catalog = catalogue(src["products"], src["categories"], "inner")

    def write(name: str, parts: list[DataFrame]) -> tuple[Change, int]:
        change = store.replace(name, [_as_table(df, name, 0) for df in parts])
        return change, store.written(name, change)

    tables = {"sales": [sales], "lines": lines, "payments": [payments], "products": [catalog]}
    jobs = [lambda n=name, p=parts: write(n, p) for name, parts in tables.items()]
    *written, (bad, n_bad) = run_together(spark, [*jobs, lambda: _set_aside(store, staged, 0)])
    counts = {name: n for name, (_, n) in zip(tables, written)} | {"rejected_pages": n_bad}
    changes = {name: change for name, (change, _) in zip(tables, written)} | {"rejects": Change(bad.commit, bad.folders, None)}
    # Marks and key indexes described the tables before; the next incremental run makes them anew.
    changes |= {name: Change("", [], None) for name in base.tables if name not in changes}
    store.commit(base, changes, seq=0, counts=counts)
    return counts


def incremental(spark: SparkSession, landing: str, raw: str, seq: int,
                branches: Sequence[str] | None = None) -> dict[str, int]:
    """One incremental run (``seq`` > every earlier run's): select landed records above the
    per-branch marks and merge them; refresh the catalogue when new lines arrived.
    ``branches`` lists the configured branches, which have a mark even without rows. A run
    whose number is already published returns its counts and changes nothing."""
    store = raw_store(spark, raw)
    base = store.snapshot()
    last = base.meta.get("seq", -1)
    if seq == last:
        return base.meta["counts"]
    if seq < last:
        raise ValueError(f"run {seq} is older than the published run {last}")
    scratch = scratch_path(spark, f"ingest-{seq}")
    with shuffles_freed(spark):
        counts = _incremental(spark, landing, store, base, seq, branches, scratch)
    drop_folder(spark, scratch)
    return counts


def _incremental(spark: SparkSession, landing: str, store: SnapshotStore, base: Snapshot, seq: int,
                 branches: Sequence[str] | None, scratch: str) -> dict[str, int]:
    configured = spark.createDataFrame([(b,) for b in branches], "branch string") if branches else None
    sale_marks, pay_marks = I.incremental_marks(store.read("sales", base), store.read("payments", base), configured)
    marks = sale_marks.withColumn("source", F.lit("sales")).unionByName(pay_marks.withColumn("source", F.lit("payments")))
    marks.write.parquet(f"{scratch}/marks")
    marks = spark.read.schema(marks.schema).parquet(f"{scratch}/marks")
    sale_marks, pay_marks = (marks.filter(F.col("source") == s).drop("source") for s in ("sales", "payments"))

    staged = stage(spark, landing, f"{scratch}/pages")
    src = landed(staged)
    counts, selected = {}, {}

    def keep(name: str, df: DataFrame) -> DataFrame:  # written: the steps below read it several times
        _as_table(df, name, seq).write.option("compression", COMPRESSION).parquet(f"{scratch}/{name}")
        selected[name] = spark.read.schema(RAW_TABLES[name]).parquet(f"{scratch}/{name}")
        counts[name] = selected[name].count()  # from the footers
        return selected[name]

    new_sales = I.select_after_marks(src["sales"], sale_marks, "sale_id").drop("last_id")
    new_sales = keep("sales", new_sales.withColumn("month", month_of("created_at")))
    # The incremental path takes a sale's items together with the sale. Items below the mark, which
    # their sale is below too, are left out before the join shuffles them.
    above = I.select_after_marks(src["lines"], sale_marks, "sale_id").drop("last_id")
    new_lines = above.join(new_sales.select("sale_id", "branch"), same_key(above, new_sales, ["sale_id", "branch"]), "left_semi")
    new_payments = I.select_after_marks(src["payments"], pay_marks, "payment_id").drop("last_id")
    _, new_lines, new_payments = with_months(new_sales, new_lines, new_payments)
    run_together(spark, [lambda: keep("lines", new_lines), lambda: keep("payments", new_payments)])

    changes = {"marks": store.replace("marks", marks)}
    changes["rejects"], counts["rejected_pages"] = _set_aside(store, staged, seq)
    batch, counts["products"] = {n: df for n, df in selected.items() if counts[n]}, 0
    if counts["lines"] > 0:
        fetched = keep("products", catalogue(src["products"], src["categories"], "left"))
    drop_folder(spark, f"{scratch}/pages")  # all that is needed of them is written
    base, merged = merge_batch(store, base, batch, seq)
    changes |= merged
    if counts["products"]:
        changes["products"] = store.merge("products", fetched, KEYS["products"], ORDER, base)
    store.commit(base, changes, seq=seq, counts=counts)
    return counts
