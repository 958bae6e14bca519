"""Hot keys: one product / one branch holding a third of all rows."""
import contextlib
import io
from decimal import Decimal

from pyspark.sql import functions as F

from branchlens.operators import conform as C
from branchlens.operators import marts as M
from branchlens.schemas import LINE, PRODUCT, SALE


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def skewed_inputs(spark, n=30000):
    import datetime as dt
    t0 = dt.datetime(2025, 1, 1)
    lines = spark.range(n).select(
        (F.col("id") % 3000).cast("string").alias("sale_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("product_id"),
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("price"),
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("quantity"),
        F.lit(None).cast("boolean").alias("canceled"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("b"), (F.col("id") % 7).cast("string")))
        .alias("branch"))
    sales = lines.select("sale_id", "branch").distinct().select(
        "sale_id", F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("total"), F.lit(1).alias("people"),
        F.lit("EAT-IN").alias("sale_type"), F.lit(t0).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("closed_at"), F.lit(None).cast("string").alias("customer_id"), "branch")
    cat = lines.select("product_id", "branch").distinct().select(
        "product_id", F.concat(F.lit("name "), "product_id").alias("product_name"),
        F.lit("cat").alias("product_category"), "branch")
    return (spark.createDataFrame(lines.rdd, LINE), spark.createDataFrame(sales.rdd, SALE),
            spark.createDataFrame(cat.rdd, PRODUCT))


def test_enrichment_splits_skewed_join_partitions(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        lines, sales, cat = skewed_inputs(spark)
        enriched = C.enrich_lines(lines, sales, cat)
        plan = final_plan(enriched)
        assert "skew=true" in plan  # AQE split the hot product's / branch's partitions
        assert enriched.count() == 30000
        assert enriched.filter("product_name IS NULL OR day IS NULL").count() == 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_branch_aggregates_exactly(spark):
    lines, sales, cat = skewed_inputs(spark)
    daily = M.product_daily(C.enrich_lines(lines, sales, cat))
    hot = daily.filter("branch = 'HOT'").agg(F.sum("qty")).first()[0]
    assert hot == Decimal(10000)
    assert daily.filter("product = 'name hot'").agg(F.sum("qty")).first()[0] == Decimal(10000)
