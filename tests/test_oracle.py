"""Every catalogue query against its DuckDB formulation on the smallest test tables."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, compare, strict_equal  # noqa: E402

from branchlens.plans.catalog import QUERIES as CATALOGUE  # noqa: E402

ORACLE = E.oracle_sql()
# The catalogue's queries all have SQL; of the optional training-data queries some have.
QUERIES = {name: f for name, f in E.queries().items() if name in CATALOGUE or name in ORACLE}


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) >= set(CATALOGUE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    sdf = QUERIES[name](spark, sf_dir).toPandas()
    odf = con.sql(ORACLE[name]).df()
    assert compare(sdf, odf) is None
    assert strict_equal(sdf, odf)  # same pandas dtypes and str() of every value, no normalisation


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["branch", "month_to_date", "avg_per_month", "today", "avg_per_day_30", "previous_month"]


TEXT_SAFE = {"object", "float64", "int64", "int32"}


@pytest.mark.parametrize("name", ["daily_revenue_branch", "json_items_flat", "payments_live", "scalar_suite",
                                  "dedupe_sales", "branch_kpis_edges"])
def test_published_types_are_engine_neutral(spark, sf_dir, con, name):
    """Published results use only types both engines hand to pandas identically."""
    from pyspark.sql import types as T
    df = QUERIES[name](spark, sf_dir)
    assert not any(isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))
                   for f in df.schema.fields)
    odf = con.sql(ORACLE[name]).df()
    assert {str(t) for t in odf.dtypes} <= TEXT_SAFE


@pytest.mark.parametrize("name", ["lines_enriched", "daily_reconciliation", "incremental_selection",
                                  "catalog_left", "new_product_categories", "upsert_lines"])
def test_shuffle_join_plans_give_the_same_rows(spark, sf_dir, con, name):
    """With every size-based broadcast disabled, joins run as the sort-merge joins of a
    large cluster (null-safe keys included); the rows must not change."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        sdf = QUERIES[name](spark, sf_dir).toPandas()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert compare(sdf, con.sql(ORACLE[name]).df()) is None
