"""Landed JSON:API pages: schemas, flattening, and page builders for tests.

Production reads landed page files with ``spark.read.schema(...).json(path)`` (one page
per line, branch taken from the folder) and flattens them with ``explode``; the same
flatten functions accept a (branch, doc) frame of JSON text parsed with ``from_json``.
Every page holds a bounded number of records, whatever ids they carry, so building or
parsing a page never gathers an unbounded group in one task. Pages that cannot be read are
set aside and counted (``read_rejects``), never dropped silently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.fixed_values import API_PAGE_SIZE
from branchlens.functions.semantics import MONEY, stay_seconds, strip_zone

PAGE_IDS = API_PAGE_SIZE  # ids per landed page

_ID = T.StructType([T.StructField("id", T.StringType())])
_REF = T.StructType([T.StructField("data", _ID)])

SALES_PAGE = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("attributes", T.StructType([
            T.StructField("total", T.DoubleType()), T.StructField("people", T.IntegerType()),
            T.StructField("saleType", T.StringType()), T.StructField("createdAt", T.StringType()),
            T.StructField("closedAt", T.StringType())])),
        T.StructField("relationships", T.StructType([T.StructField("customer", _REF)])),
    ]))),
    T.StructField("included", T.ArrayType(T.StructType([
        T.StructField("attributes", T.StructType([
            T.StructField("price", T.DoubleType()), T.StructField("quantity", T.DoubleType()),
            T.StructField("canceled", T.BooleanType())])),
        T.StructField("relationships", T.StructType([
            T.StructField("sale", _REF), T.StructField("product", _REF)])),
    ]))),
])

PAYMENTS_PAGE = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("attributes", T.StructType([
            T.StructField("amount", T.DoubleType()), T.StructField("createdAt", T.StringType()),
            T.StructField("canceled", T.BooleanType())])),
        T.StructField("relationships", T.StructType([T.StructField("paymentMethod", _REF)])),
    ]))),
])

CATEGORIES_PAGE = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("attributes", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("relationships", T.StructType([
            T.StructField("products", T.StructType([T.StructField("data", T.ArrayType(_ID))]))])),
    ]))),
])

PRODUCTS_PAGE = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("attributes", T.StructType([T.StructField("name", T.StringType())])),
    ]))),
])

# One record per document: ``data`` is an object, and a sale's items name no sale.
SALE_DOC = T.StructType([T.StructField("data", SALES_PAGE["data"].dataType.elementType),
                         T.StructField("included", SALES_PAGE["included"].dataType)])
PAYMENT_DOC = T.StructType([T.StructField("data", PAYMENTS_PAGE["data"].dataType.elementType)])

# Fixed value: the offset written on landed timestamps (local wall clock is kept).
LANDED_OFFSET = "-03:00"


# Feeds of a landing: the form of their pages, and of documents that hold one record.
FEEDS = {"sales": (SALES_PAGE, SALE_DOC), "payments": (PAYMENTS_PAGE, PAYMENT_DOC),
         "products": (PRODUCTS_PAGE, None), "categories": (CATEGORIES_PAGE, None)}


# --------------------------------------------------------------------------- reading

_CORRUPT = "_corrupt_record"
_ONE_RECORD = r'^\s*\{\s*"data"\s*:\s*\{'  # text that is no page, whose ``data`` is an array


def _parsed(doc: str, schema: T.StructType):
    """JSON text as a struct; null where it is not JSON of that form."""
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(doc, full, {"columnNameOfCorruptRecord": _CORRUPT})


def _one_as_page(doc: str, feed: str):
    """The page that a document of one record stands for: its record in an array, its items
    naming the sale that encloses them."""
    d = F.col(doc)
    data = F.when(d["data"].isNotNull(), F.array(d["data"]))
    if feed != "sales":
        return F.struct(data.alias("data"))
    owner = F.struct(F.struct(d["data"]["id"].alias("id")).alias("data"))
    items = F.transform(d["included"], lambda r: F.struct(
        r["attributes"].alias("attributes"),
        F.struct(owner.alias("sale"), r["relationships"]["product"].alias("product")).alias("relationships")))
    return F.struct(data.alias("data"), items.alias("included"))


def parse_feed(spark, path: str, feed: str) -> DataFrame:
    """Every document of a landed feed, parsed once: (branch, landed_at, page, doc). Pages and
    documents of one record (which are tried where the text is no page) have one form
    afterwards; ``page`` is null and ``doc`` the text where it is neither. Text that begins like
    a document of one record is not tried as a page, which would read all of it in vain."""
    schema, single = FEEDS[feed]
    as_page = _parsed("value", schema)
    if single is not None:
        as_page = F.when(~F.col("value").rlike(_ONE_RECORD), as_page)
    lines = spark.read.schema("value string, branch string").text(path)
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                  F.monotonically_increasing_id().alias("line"))
    docs = lines.select("branch", F.col("value").alias("doc"), at.alias("landed_at"), as_page.alias("_page"))
    bad = F.col("_page").isNull() | F.col(f"_page.{_CORRUPT}").isNotNull()
    form = F.struct(*[F.col(f"_page.{f.name}").alias(f.name) for f in schema.fields]).cast(schema)
    if single is None:
        page = F.when(~bad, form)
    else:
        docs = docs.withColumn("_one", F.when(bad, _parsed("doc", single)))
        good = bad & F.col("_one").isNotNull() & F.col(f"_one.{_CORRUPT}").isNull()
        page = F.when(~bad, form).when(good, _one_as_page("_one", feed).cast(schema))
    parsed = docs.select("branch", "landed_at", page.alias("page"), "doc")
    return parsed.withColumn("doc", F.when(F.col("page").isNull(), F.col("doc")))


def read_landing(spark, path: str, schema: T.StructType) -> DataFrame:
    """Landed page files (JSON lines) under ``path/branch=<name>/`` -> (branch, doc, page,
    corrupt, landed_at). The branch is the folder's name as text; ``landed_at`` orders the
    pages as they landed (file, block, line); ``corrupt`` marks text that is not JSON of
    the page's form, such as a page that was cut off."""
    lines = spark.read.schema("value string, branch string").text(path)
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                  F.monotonically_increasing_id().alias("line"))
    return lines.select("branch", F.col("value").alias("doc"), at.alias("landed_at"),
                        F.from_json("value", full, {"columnNameOfCorruptRecord": _CORRUPT}).alias("page")) \
        .withColumn("corrupt", F.col("page").isNull() | F.col(f"page.{_CORRUPT}").isNotNull())


def read_pages(spark, path: str, schema: T.StructType) -> DataFrame:
    """The readable pages of a landing folder: (branch, page, landed_at)."""
    return read_landing(spark, path, schema).filter(~F.col("corrupt")).select("branch", "page", "landed_at")


def read_rejects(spark, path: str, schema: T.StructType) -> DataFrame:
    """The pages that could not be read: (branch, doc), to be kept and counted."""
    return read_landing(spark, path, schema).filter("corrupt").select("branch", "doc")


def write_pages(docs: DataFrame, path: str) -> None:
    """(branch, doc) -> JSON-lines page files partitioned by branch (landing format). Pages repeat
    their field names in every record: compressed they take about a tenth of the disk, and the
    reader takes files either way."""
    docs.select(F.col("doc").alias("value"), "branch").write.mode("overwrite") \
        .partitionBy("branch").option("compression", "gzip").text(path)


def parse_pages(docs: DataFrame, schema: T.StructType) -> DataFrame:
    """(branch, doc JSON text) -> (branch, page struct)."""
    return docs.select("branch", F.from_json("doc", schema).alias("page"))


# --------------------------------------------------------------------------- flattening

def _exploded(rows: DataFrame, path: str, *keep: str) -> DataFrame:
    """(keep..., _pos, r) per element of the array ``path``. The rows without elements are dropped
    after the outer explode: an inner one would have its filter on the array pushed below the
    projections that make it, and a document would be built and parsed again for the filter."""
    return rows.select(*keep, F.posexplode_outer(path).alias("_pos", "r")).filter("_pos IS NOT NULL")


def _records(pages: DataFrame, path: str) -> tuple[DataFrame, list[str]]:
    """(branch, r) per record of an array, with its place in the landing order if known."""
    if "landed_at" not in pages.columns:
        return _exploded(pages, path, "branch").select("branch", "r"), []
    p = _exploded(pages, path, "branch", "landed_at")
    place = F.struct(F.col("landed_at.file").alias("file"), F.col("landed_at.block").alias("block"),
                     F.col("landed_at.line").alias("line"), F.col("_pos").alias("pos"))
    return p.select("branch", "r", place.alias("landed_at")), ["landed_at"]


def _sale_columns(r: str) -> list:
    return [F.col(f"{r}.id").alias("sale_id"),
            F.col(f"{r}.attributes.total").cast(MONEY).alias("total"),
            F.col(f"{r}.attributes.people").alias("people"),
            F.col(f"{r}.attributes.saleType").alias("sale_type"),
            strip_zone(f"{r}.attributes.createdAt").alias("created_at"),
            strip_zone(f"{r}.attributes.closedAt").alias("closed_at"),
            F.col(f"{r}.relationships.customer.data.id").alias("customer_id"),
            stay_seconds(f"{r}.attributes.createdAt", f"{r}.attributes.closedAt").alias("stay_seconds"), "branch"]


def _item_columns(r: str, sale_id) -> list:
    return [sale_id.alias("sale_id"),
            F.col(f"{r}.relationships.product.data.id").alias("product_id"),
            F.col(f"{r}.attributes.price").cast(MONEY).alias("price"),
            F.col(f"{r}.attributes.quantity").cast(MONEY).alias("quantity"),
            F.col(f"{r}.attributes.canceled").alias("canceled"), "branch"]


def _payment_columns(r: str) -> list:
    return [F.col(f"{r}.id").alias("payment_id"),
            F.col(f"{r}.attributes.amount").cast(MONEY).alias("amount"),
            strip_zone(f"{r}.attributes.createdAt").alias("created_at"),
            F.col(f"{r}.relationships.paymentMethod.data.id").alias("method"),
            F.col(f"{r}.attributes.canceled").alias("canceled"), "branch"]


def flatten_sales(pages: DataFrame) -> DataFrame:
    """sale_id, total, people, sale_type, created_at, closed_at, customer_id, stay_seconds,
    branch. A missing customer link gives a null customer_id (struct paths propagate null)."""
    s, place = _records(pages, "page.data")
    return s.select(*_sale_columns("r"), *place)


def flatten_items(pages: DataFrame) -> DataFrame:
    """sale_id (from the item's own sale link), product_id, price, quantity, canceled, branch.
    Pages without items emit nothing."""
    i, place = _records(pages, "page.included")
    return i.select(*_item_columns("r", F.col("r.relationships.sale.data.id")), *place)


def flatten_payments(pages: DataFrame) -> DataFrame:
    """payment_id, amount, created_at, method, canceled, branch."""
    p, place = _records(pages, "page.data")
    return p.select(*_payment_columns("r"), *place)


def flatten_sale_docs(docs: DataFrame) -> DataFrame:
    """``flatten_sales`` for documents of one sale each (``SALE_DOC``)."""
    place = ["landed_at"] if "landed_at" in docs.columns else []
    return docs.filter(F.col("page.data").isNotNull()).select(*_sale_columns("page.data"), *place)


def flatten_sale_doc_items(docs: DataFrame) -> DataFrame:
    """``flatten_items`` for documents of one sale each: the items belong to the enclosing
    sale, whatever link they carry."""
    sales = docs.withColumn("_sale", F.col("page.data.id"))
    place = ["landed_at"] if "landed_at" in docs.columns else []
    i = _exploded(sales, "page.included", "branch", "_sale", *place)
    at = [F.struct(*[F.col(f"landed_at.{c}").alias(c) for c in ("file", "block", "line")],
                   F.col("_pos").alias("pos")).alias("landed_at")] if place else []
    return i.select(*_item_columns("r", F.col("_sale")), *at)


def flatten_payment_docs(docs: DataFrame) -> DataFrame:
    """``flatten_payments`` for documents of one payment each (``PAYMENT_DOC``)."""
    place = ["landed_at"] if "landed_at" in docs.columns else []
    return docs.filter(F.col("page.data").isNotNull()).select(*_payment_columns("page.data"), *place)


def flatten_categories(pages: DataFrame) -> DataFrame:
    """product_category, product_id, branch: one row per (category, linked product)."""
    c, place = _records(pages, "page.data")
    return c.select("branch", F.col("r.attributes.name").alias("product_category"), *place,
                    F.explode("r.relationships.products.data").alias("p")) \
        .select("product_category", F.col("p.id").alias("product_id"), "branch", *place)


def flatten_products(pages: DataFrame) -> DataFrame:
    """product_id, product_name, branch."""
    p, place = _records(pages, "page.data")
    return p.select(F.col("r.id").alias("product_id"), F.col("r.attributes.name").alias("product_name"), "branch",
                    *place)


# --------------------------------------------------------------------------- page builders

def _landed_ts(c: str):
    return F.date_format(F.col(c), f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'{LANDED_OFFSET}'")


def _page(per_page: int):
    """Page number of a row: consecutive rows of a scan partition fill a page, so every page
    has at most ``per_page`` records, whatever ids they carry, and nothing is counted first."""
    return F.floor(F.monotonically_increasing_id() / F.lit(per_page)).alias("page_no")


def _to_docs(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.select("branch", F.to_json(F.struct(*fields)).alias("doc"))


def _bounded_pages(recs: DataFrame, keys: list[str], out: str) -> DataFrame:
    """(keys..., rec) rows -> arrays of records per page. Null keys are groups as well."""
    return recs.groupBy(*keys).agg(F.collect_list("rec").alias(out))


def _pages_in_place(recs: DataFrame, per_page: int, before: str, after: str) -> DataFrame:
    """(branch, rec) rows -> (branch, doc): pages of at most ``per_page`` records of one branch
    between the texts ``before`` and ``after``. A page is filled from consecutive rows of a task,
    so no record is shuffled. Null branches have pages as well."""
    def fill(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for branch in pc.unique(rows["branch"]).to_pylist():
                mine = pc.is_null(rows["branch"]) if branch is None else pc.fill_null(pc.equal(rows["branch"], branch), False)
                texts = rows["rec"].filter(mine).combine_chunks().cast(pa.string())
                ends = [*range(0, len(texts), per_page), len(texts)]
                pages = pc.binary_join(pa.ListArray.from_arrays(ends, texts), ",")
                docs = pc.binary_join_element_wise(before, pages, after, "")
                yield pa.RecordBatch.from_arrays([pa.array([branch] * len(docs), pa.string()), docs], ["branch", "doc"])
    return recs.select("branch", F.to_json("rec").alias("rec")).mapInArrow(fill, "branch string, doc string")


def build_sale_docs(sales: DataFrame, page_ids: int = PAGE_IDS) -> DataFrame:
    """(branch, doc): sales pages (``data``) of at most ``page_ids`` sales."""
    s = sales.select("branch", F.struct(
        F.col("sale_id").alias("id"),
        F.struct(F.col("total").cast("double").alias("total"), F.lit(None).cast("int").alias("people"),
                 F.col("sale_type").alias("saleType"), _landed_ts("created_at").alias("createdAt"),
                 _landed_ts("closed_at").alias("closedAt")).alias("attributes"),
        F.struct(F.struct(F.when(F.col("customer_id").isNotNull(),
                                 F.struct(F.col("customer_id").alias("id"))).alias("data")).alias("customer"))
        .alias("relationships")).alias("rec"))
    return _pages_in_place(s, page_ids, '{"data":[', '],"included":[]}')


def build_item_docs(lines: DataFrame, items_per_page: int = PAGE_IDS) -> DataFrame:
    """(branch, doc): line-item pages (``included``; each item names its sale)."""
    i = lines.select("branch", F.struct(
        F.struct(F.col("price").cast("double").alias("price"), F.col("quantity").cast("double").alias("quantity"),
                 F.col("canceled").alias("canceled")).alias("attributes"),
        F.struct(F.struct(F.struct(F.col("sale_id").alias("id")).alias("data")).alias("sale"),
                 F.struct(F.struct(F.col("product_id").alias("id")).alias("data")).alias("product"))
        .alias("relationships")).alias("rec"))
    return _pages_in_place(i, items_per_page, '{"data":[],"included":[', ']}')


def build_sales_pages(sales: DataFrame, lines: DataFrame, page_ids: int = PAGE_IDS,
                      items_per_page: int = PAGE_IDS) -> DataFrame:
    """The landed sales feed: sale pages and their line-item pages."""
    return build_sale_docs(sales, page_ids).unionByName(build_item_docs(lines, items_per_page))


def build_payment_pages(payments: DataFrame, page_ids: int = PAGE_IDS) -> DataFrame:
    p = payments.select("branch", F.struct(
        F.col("payment_id").alias("id"),
        F.struct(F.col("amount").cast("double").alias("amount"), _landed_ts("created_at").alias("createdAt"),
                 F.col("canceled").alias("canceled")).alias("attributes"),
        F.struct(F.struct(F.struct(F.col("method").alias("id")).alias("data")).alias("paymentMethod"))
        .alias("relationships")).alias("rec"))
    return _pages_in_place(p, page_ids, '{"data":[', ']}')


def build_category_pages(catalog: DataFrame, page_ids: int = PAGE_IDS) -> DataFrame:
    """A category with many products is split over several entries, each listing at most
    ``page_ids`` products."""
    c = catalog.filter(F.col("product_category").isNotNull()).select(
        "branch", "product_category", _page(page_ids),
        F.struct(F.col("product_id").alias("id")).alias("rec"))
    entries = _bounded_pages(c, ["branch", "product_category", "page_no"], "refs")
    rec = F.struct(F.col("product_category").alias("id"),
                   F.struct(F.col("product_category").alias("name")).alias("attributes"),
                   F.struct(F.struct(F.col("refs").alias("data")).alias("products")).alias("relationships"))
    return _to_docs(entries.select("branch", F.array(rec).alias("data")), ["data"])


def build_product_pages(catalog: DataFrame, page_ids: int = PAGE_IDS) -> DataFrame:
    p = catalog.select("branch", F.struct(
        F.col("product_id").alias("id"), F.struct(F.col("product_name").alias("name")).alias("attributes")).alias("rec"))
    return _pages_in_place(p, page_ids, '{"data":[', ']}')


def build_sale_single_docs(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """(branch, doc): one document per sale with its items, which name no sale; lines
    without a sale are not delivered this way."""
    sale = sales.select("branch", "sale_id", F.struct(
        F.col("sale_id").alias("id"),
        F.struct(F.col("total").cast("double").alias("total"), F.lit(None).cast("int").alias("people"),
                 F.col("sale_type").alias("saleType"), _landed_ts("created_at").alias("createdAt"),
                 _landed_ts("closed_at").alias("closedAt")).alias("attributes"),
        F.struct(F.struct(F.when(F.col("customer_id").isNotNull(),
                                 F.struct(F.col("customer_id").alias("id"))).alias("data")).alias("customer"))
        .alias("relationships")).alias("data"))
    items = lines.groupBy(F.col("sale_id").alias("_sale"), F.col("branch").alias("_branch")).agg(F.collect_list(F.struct(
        F.struct(F.col("price").cast("double").alias("price"), F.col("quantity").cast("double").alias("quantity"),
                 F.col("canceled").alias("canceled")).alias("attributes"),
        F.struct(F.struct(F.struct(F.col("product_id").alias("id")).alias("data")).alias("product"))
        .alias("relationships"))).alias("included"))
    both = sale.join(items, (F.col("sale_id") == F.col("_sale")) & F.col("branch").eqNullSafe(F.col("_branch")), "left")
    return _to_docs(both, ["data", "included"])


def build_payment_single_docs(payments: DataFrame) -> DataFrame:
    """(branch, doc): one document per payment."""
    return _to_docs(payments.select("branch", F.struct(
        F.col("payment_id").alias("id"),
        F.struct(F.col("amount").cast("double").alias("amount"), _landed_ts("created_at").alias("createdAt"),
                 F.col("canceled").alias("canceled")).alias("attributes"),
        F.struct(F.struct(F.struct(F.col("method").alias("id")).alias("data")).alias("paymentMethod"))
        .alias("relationships")).alias("data")), ["data"])
