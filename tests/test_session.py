"""Scratch folders and jobs that run side by side."""
import os
import tempfile
import uuid

import pytest

from branchlens import session as S


def test_clean_scratch_deletes_old_scratch_folders_only(spark):
    root = tempfile.mkdtemp(prefix="branchlens-scratch-")
    old, new = (f"{root}/{name}-{uuid.uuid4().hex}" for name in ("old", "new"))
    for path in (old, new, f"{root}/raw", f"{root}/results-of-mine"):
        spark.range(3).write.parquet(f"{path}/data")
    for folder in (f"{old}/data", old, f"{root}/raw", f"{root}/results-of-mine"):
        os.utime(folder, (0, 0))
    assert S.clean_scratch(spark, 3600, root) == 1
    assert sorted(os.listdir(root)) == sorted([os.path.basename(new), "raw", "results-of-mine"])


def test_jobs_run_together_in_order_and_errors_reach_the_caller(spark):
    assert S.run_together(spark, [lambda n=n: spark.range(n).count() for n in (3, 0, 7)]) == [3, 0, 7]

    def fails():
        raise ValueError("no")
    with pytest.raises(ValueError):
        S.run_together(spark, [lambda: 1, fails])


def test_bounds_lower_a_session_and_never_raise_it(spark):
    keys = list(S.SESSION_BOUNDS)
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for given, found in (("100m", None), ("-1", "-1"), ("64k", "64k")):
            for k in keys:
                spark.conf.set(k, "64k" if given == "-1" and k.endswith("PartitionSizeInBytes") else given)
            S.apply_defaults(spark)
            for k in keys:
                wanted = S.SESSION_BOUNDS[k] if found is None else found
                assert spark.conf.get(k) == ("64k" if given == "-1" and k.endswith("PartitionSizeInBytes") else wanted)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_large_catalogue_is_neither_broadcast_nor_one_tasks(spark, tmp_path):
    """200 000 parts are a small file and a million rows of the catalogue."""
    import __spark_entry__ as entry
    from branchlens.sources import fixtures as fx
    key, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    old = {k: spark.conf.get(k, None) for k in (key, adaptive)}
    spark.range(5).selectExpr("cast(id as int) r_regionkey", "concat('B', id) r_name").coalesce(1) \
        .write.parquet(f"{tmp_path}/region.parquet")
    spark.range(200_000).selectExpr("id p_partkey", "md5(cast(id as string)) p_name", "'b' p_brand", "concat('t', id % 40) p_type",
                                    "cast(1 as int) p_size", "cast(id as double) p_retailprice").coalesce(1) \
        .write.parquet(f"{tmp_path}/part.parquet")
    try:
        spark.conf.unset(adaptive)
        spark.conf.set(key, "10m")  # Spark's default
        rows = entry.queries()["catalog_inner"](spark, str(tmp_path))
        assert rows.count() == 5 * 195_000
        assert "BroadcastHashJoin" not in rows._jdf.queryExecution().executedPlan().toString()
        tasks = fx.fx_catalog(spark, str(tmp_path)).selectExpr("spark_partition_id() p", "product_name") \
            .groupBy("p").agg({"product_name": "max"}).collect()
        assert len(tasks) > 1
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
