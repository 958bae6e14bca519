"""Lines and sales bucketed by sale: J1 without an exchange, equal rows."""
import tempfile
import uuid

from branchlens.operators import conform as C
from branchlens.sources import bucketed as B
from branchlens.sources import fixtures as fx


def test_join_of_bucketed_tables_moves_nothing(spark, sf_dir):
    root, tag = tempfile.mkdtemp(prefix="branchlens-bucketed-"), uuid.uuid4().hex
    lines, sales = fx.fx_lines(spark, sf_dir), fx.fx_sales(spark, sf_dir)
    catalog = fx.fx_catalog_with_gaps(spark, sf_dir)
    plain = C.enrich_lines(lines, sales, catalog)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        l = B.write_bucketed(lines, f"l_{tag}", f"{root}/l", 8)
        s = B.write_bucketed(sales, f"s_{tag}", f"{root}/s", 8)
        j1 = C.live(l).select(B.KEY, "price").join(s.select(B.KEY, "created_at"), B.KEY, "left")
        plan = j1._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        got = B.enrich_bucketed(l, s, catalog)
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        for t in (f"l_{tag}", f"s_{tag}"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_null_branches_meet_and_null_sales_do_not(spark):
    root, tag = tempfile.mkdtemp(prefix="branchlens-bucketed-"), uuid.uuid4().hex
    cols = "sale_id string, branch string, product_id string, price double, quantity double, canceled boolean"
    lines = spark.createDataFrame([("1", None, "p", 1.0, 1.0, None), ("1", "", "p", 2.0, 1.0, None), (None, "A", "p", 3.0, 1.0, None),
                                   ("1", "=", "p", 4.0, 1.0, None)], cols)
    sales = spark.sql("SELECT '1' AS sale_id, CAST(NULL AS STRING) AS branch, TIMESTAMP_NTZ '2024-01-01' AS created_at, "
                      "TIMESTAMP_NTZ '2024-01-01' AS closed_at, 'n' AS sale_type UNION ALL "
                      "SELECT NULL, 'A', TIMESTAMP_NTZ '2024-01-02', TIMESTAMP_NTZ '2024-01-02', 'a'")
    catalog = spark.createDataFrame([], "product_id string, branch string, product_name string, product_category string")
    l = B.write_bucketed(lines, f"l_{tag}", f"{root}/l", 3)
    s = B.write_bucketed(sales, f"s_{tag}", f"{root}/s", 3)
    got = {float(r.price): r.sale_type for r in B.enrich_bucketed(l, s, catalog).collect()}
    assert got == {1.0: "n", 2.0: None, 3.0: None, 4.0: None}
    for t in (f"l_{tag}", f"s_{tag}"):
        spark.sql(f"DROP TABLE {t}")
