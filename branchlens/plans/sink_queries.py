"""Queries that write through the sinks, read back through the readers and return the rows.

Files are written under the shared scratch folder when the query is built.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchlens.fixed_values import RAW_COLUMN_NAMES, SHEET_COLUMN_NAMES
from branchlens.operators import marts as M
from branchlens.operators import reports as R
from branchlens.plans import nightly
from branchlens.schemas import SALE
from branchlens.session import scratch_path
from branchlens.sources import bucketed, readers, sinks
from branchlens.sources import fixtures as fx

#: What the exported names hold beside the client: quotes, separators and line ends.
CELL_END = '\n"a, b",\nc'


def mart_published(x) -> DataFrame:
    """A mart published twice: readers get the second version, whole."""
    path = f"{scratch_path(x.spark, 'mart')}/daily_revenue_branch"
    mart = M.daily_revenue_branch(x.payments_live)
    sinks.publish_mart(mart.withColumn("revenue", F.col("revenue") + 1), path)
    sinks.publish_mart(mart, path)
    return sinks.read_published(x.spark, path)


def pairs_appended(x) -> DataFrame:
    """The product -> category mart after appending the pairs of new products, twice."""
    path = f"{scratch_path(x.spark, 'pairs')}/product_category"
    fx.fx_known_pairs(x.spark, x.sf_dir).write.parquet(path)
    for _ in range(2):
        sinks.append_new_pairs(x.spark, x.pairs, path)
    return readers.read_mart(x.spark, path)


def reports_published(x, as_of) -> DataFrame:
    """The ranking sheets, read back."""
    path = f"{scratch_path(x.spark, 'reports')}/top_products"
    sinks.publish_reports(R.top_products(x.lines_enriched, as_of), path)
    return sinks.read_published(x.spark, path).select("report", "scope", "product", "qty", "revenue")


def facts_published(x) -> DataFrame:
    """The items facts, replaced by a second commit, read back from their months."""
    store = nightly.facts_store(x.spark, f"{scratch_path(x.spark, 'facts')}/facts", {"items": x.lines_enriched})
    for _ in range(2):
        store.commit(store.snapshot(), {"items": store.replace("items", x.lines_enriched)})
    return store.read("items").select(
        "sale_id", "product_id", "branch", F.col("price").cast("double").alias("price"),
        F.col("quantity").cast("double").alias("quantity"), "sale_type", "day", "month", "product_name", "product_category")


def lines_enriched_bucketed(x, buckets: int | None = None) -> DataFrame:
    """The enriched lines from tables bucketed by sale: J1 without an exchange. A bucket is
    sorted by one task, so there are as many as the session has shuffle partitions, 16 at least."""
    buckets = buckets or max(16, int(x.spark.conf.get("spark.sql.shuffle.partitions")))
    tag = uuid.uuid4().hex
    root = scratch_path(x.spark, "bucketed")
    lines = x.lines.select("sale_id", "product_id", "branch", "price", "quantity", "canceled")
    lines = bucketed.write_bucketed(lines, f"lines_{tag}", f"{root}/lines", buckets)
    sales = bucketed.write_bucketed(x.sales, f"sales_{tag}", f"{root}/sales", buckets)
    rows = bucketed.enrich_bucketed(lines, sales, fx.fx_catalog_with_gaps(x.spark, x.sf_dir))
    return rows.select("sale_id", "product_id", "branch", F.col("price").cast("double").alias("price"),
                       F.col("quantity").cast("double").alias("quantity"), "sale_type", "day", "month", "product_name",
                       "product_category")


def sheet_read(x) -> DataFrame:
    """The bookings sheet as exported CSV, with line ends and quotes in its names, read by many
    tasks."""
    path = f"{scratch_path(x.spark, 'sheet')}/sheet"
    names = {v: k for k, v in SHEET_COLUMN_NAMES.items()}
    sheet = fx.fx_bookings(x.spark, x.sf_dir).withColumn("client", F.concat("client", F.lit(CELL_END)))
    sheet.select(*[F.col(c).alias(names[c]) for c in sheet.columns]).write.option("header", True) \
        .option("escape", '"').option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_sheet(x.spark, path, split=True)


def raw_csv_read(x) -> DataFrame:
    """Sales as an exported CSV table in the landed names, without its optional columns, read
    back by many tasks."""
    path = f"{scratch_path(x.spark, 'raw-csv')}/ventas"
    names = {v: k for k, v in RAW_COLUMN_NAMES.items()}
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-03:00'"
    out = x.sales.withColumns({c: F.date_format(c, stamp) for c in ("created_at", "closed_at")})
    out.select(*[F.col(c).cast("string").alias(names.get(c, c)) for c in out.columns]).write.option("header", True).csv(path)
    rows = readers.read_raw_csv(x.spark, path, SALE, split=True)
    return rows.select("sale_id", F.col("total").cast("double").alias("total"), "sale_type", "created_at",
                       "closed_at", "customer_id", "branch")
