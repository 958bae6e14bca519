"""What keeps tasks and the driver small when tables grow, and documents parsed once."""
import pytest

from branchlens import session as S
from branchlens.plans import sink_queries as SQ
from branchlens.plans.catalog import QUERIES, Inputs
from branchlens.sources import bucketed
from branchlens.sources import documents as D
from branchlens.sources import fixtures as fx


def _plan(df, kind):
    return getattr(df._jdf.queryExecution(), kind)()


def test_catalogue_is_planned_by_its_rows_not_by_its_file(spark, tmp_path):
    """A query that needs only the catalogue's keys took a fraction of a small file for its size."""
    spark.range(4).selectExpr("cast(id as int) r_regionkey", "if(id = 3, null, concat('B', id)) r_name").coalesce(1) \
        .write.parquet(f"{tmp_path}/region.parquet")
    spark.range(50_000).selectExpr("id p_partkey", "'n' p_name", "'b' p_brand", "concat('t', id % 40) p_type",
                                   "cast(1 as int) p_size", "cast(id as double) p_retailprice").coalesce(1) \
        .write.parquet(f"{tmp_path}/part.parquet")
    rows = fx.fx_catalog(spark, str(tmp_path))
    assert rows.count() == 150_000 and rows.filter("branch IS NULL").count() == 0
    keys = rows.select("product_id", "branch")
    assert int(str(_plan(keys, "optimizedPlan").stats().sizeInBytes())) >= 8 * 150_000


@pytest.mark.parametrize("name", ["json_sale_single", "json_sales_flat", "json_items_flat", "json_payments_flat"])
def test_documents_are_parsed_once(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir), "optimizedPlan").toString()
    assert plan.count("from_json(") == 1


def test_documents_without_items_emit_nothing_and_null_items_stay(spark):
    docs = [("a", '{"data":{"id":"1"},"included":[{"attributes":{"price":2.0}},null]}'), ("a", '{"data":{"id":"2"},"included":[]}'),
            ("a", '{"data":{"id":"3"}}'), (None, '{"data":{"id":"4"},"included":[{"attributes":{"price":5.0}}]}'), ("a", "x")]
    pages = D.parse_pages(spark.createDataFrame(docs, "branch string, doc string"), D.SALE_DOC)
    got = [(r.sale_id, r.branch, r.price and float(r.price)) for r in D.flatten_sale_doc_items(pages).collect()]
    assert sorted(got, key=str) == sorted([("1", "a", 2.0), ("1", "a", None), ("4", None, 5.0)], key=str)


def test_buckets_follow_the_shuffle_partitions(spark, sf_dir, monkeypatch):
    seen, key = [], "spark.sql.shuffle.partitions"
    write, old = bucketed.write_bucketed, spark.conf.get(key)

    def noted(df, table, path, buckets):
        seen.append(buckets)
        return write(df, table, path, buckets)
    monkeypatch.setattr(bucketed, "write_bucketed", noted)
    try:
        spark.conf.set(key, "20")
        SQ.lines_enriched_bucketed(Inputs(spark, sf_dir))
    finally:
        spark.conf.set(key, old)
    assert seen == [20, 20]


def test_partitions_are_bounded_below_the_rows_they_unpack_to(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "16m")
        S.apply_defaults(spark)
        assert spark.conf.get(key) == "4m"
    finally:
        spark.conf.set(key, old)


@pytest.fixture(scope="module")
def wide_catalogue(spark, tmp_path_factory):
    """Few lines, and a catalogue of 160,000 rows (5 branches, one without a name) in a small file."""
    at = str(tmp_path_factory.mktemp("wide_catalogue"))
    tables = {
        "region": (5, ["cast(id as int) r_regionkey", "if(id = 4, null, concat('B', id)) r_name"]),
        "nation": (5, ["cast(id as int) n_nationkey", "concat('n', id) n_name", "cast(id as int) n_regionkey"]),
        "customer": (50, ["id c_custkey", "concat('c', id) c_name", "cast(id % 5 as int) c_nationkey",
                          "cast(1 as double) c_acctbal", "'m' c_mktsegment"]),
        "part": (40_000, ["id p_partkey", "concat('part ', id) p_name", "'b' p_brand", "concat('t', id % 40) p_type",
                          "cast(1 as int) p_size", "cast(id as double) p_retailprice"]),
        "orders": (1_000, ["id o_orderkey", "id % 50 o_custkey", "'F' o_orderstatus", "cast(id as double) o_totalprice",
                           "timestamp_ntz'2001-07-20' - make_dt_interval(cast(id % 3 as int)) o_orderdate",
                           "'1-URGENT' o_orderpriority"]),
        "lineitem": (4_000, ["id % 1000 l_orderkey", "id * 7 l_partkey", "id l_suppkey", "cast(id / 1000 as int) l_linenumber",
                             "cast(id % 5 + 1 as double) l_quantity", "cast(2 as double) l_extendedprice",
                             "cast(0 as double) l_discount", "cast(0 as double) l_tax", "'A' l_returnflag",
                             "'O' l_linestatus", "timestamp_ntz'2001-09-20' l_shipdate"]),
    }
    for name, (n, columns) in tables.items():
        spark.range(n).selectExpr(*columns).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return at


@pytest.mark.parametrize("name", ["product_daily", "product_totals", "quality_nulls", "quality_unique",
                                  "reports_published", "top_products"])
def test_the_catalogue_does_not_pass_through_the_driver(spark, wide_catalogue, name):
    """The driver builds every table that is broadcast: one of more than a memory page, the least
    that Spark counts, fails the query here. Collected, as a count would need no catalogue."""
    key = "spark.sql.maxBroadcastTableSize"
    old = spark.conf.get(key)
    page = spark._jvm.org.apache.spark.SparkEnv.get().memoryManager().pageSizeBytes()
    S.apply_defaults(spark)
    try:
        spark.conf.set(key, str(page + 2**20))
        assert QUERIES[name](spark, wide_catalogue).collect()
    finally:
        spark.conf.set(key, old)
