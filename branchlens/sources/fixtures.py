"""Bindings of the read-only test tables to the sales entities (FIXTURES.md part B).

Each function returns a lazily defined DataFrame; nothing is collected. The branch of a
sale is the region of its customer's nation: the nation -> region dimension is turned into
one small map (a scalar subquery), customers look their branch up in it, and the
orders / customer / lineitem joins are planned from their scan sizes (broadcast while
small, shuffled when large).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.fixed_values import CURRENCY_PREFIX, DAY_FIRST_DATE_PATTERN, WON_STATUS
from branchlens.functions.semantics import MONEY, truncate_name

# Fixed values of the fixture definition (FIXTURES.md part B).
DINE_IN_TYPE = "1-URGENT"
LOST_STATUS = "Perdido"
CANCELLED_FLAG = "R"          # l_returnflag meaning canceled = true
NOT_CANCELLED_FLAG = "A"      # l_returnflag meaning canceled = false (N -> null)
SPLIT_DATE = dt.date(2000, 1, 1)          # old / new split of sales and lines
EVENTS_SPLIT_DATE = dt.date(2024, 1, 20)  # old / new split of payment events
OVERLAP_DAYS = 15
AS_OF = dt.date(2001, 7, 20)
AS_OF_EDGES = (dt.date(1998, 7, 31), dt.date(1998, 3, 1), dt.date(1999, 1, 31))
DWELL_DAYS = (50, 240)


# Declared schemas of the test tables: scans skip the footer-reading inference job and a
# file with a drifted schema fails at read time instead of changing results.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _canceled(flag: Column) -> Column:
    return (F.when(flag == CANCELLED_FLAG, F.lit(True))
            .when(flag == NOT_CANCELLED_FLAG, F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def nation_branch(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("branch"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left") \
        .select("n_nationkey", "branch")


def branch_of_nation(spark, sf_dir) -> Column:
    """nation key -> branch map as a scalar subquery (one map of the nation dimension,
    25 entries in this schema), so resolving a customer's branch is a projection, not
    a join, and the customer scan keeps its own size for join planning."""
    nb = nation_branch(spark, sf_dir)
    return nb.agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "branch")))).scalar()


def customer_branch(spark, sf_dir) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name", "c_acctbal")
    return cust.select("c_custkey", "c_name", "c_acctbal",
                       F.try_element_at(branch_of_nation(spark, sf_dir), F.col("c_nationkey")).alias("branch"))


def orders_branch(spark, sf_dir) -> DataFrame:
    """orders + branch (+ customer name / balance for the bookings sheet)."""
    orders = table(spark, sf_dir, "orders")
    cb = customer_branch(spark, sf_dir)
    return orders.join(cb, orders.o_custkey == cb.c_custkey, "left").drop("c_custkey")


def lineitem_branch(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ob = orders_branch(spark, sf_dir).select("o_orderkey", "branch")
    return li.join(ob, li.l_orderkey == ob.o_orderkey, "left").drop("o_orderkey")


def fx_sales(spark, sf_dir) -> DataFrame:
    """sale_id, total, sale_type, created_at, closed_at (null = open), customer_id, branch."""
    closed = table(spark, sf_dir, "lineitem").groupBy("l_orderkey") \
        .agg(F.max("l_shipdate").alias("closed_at"))
    ob = orders_branch(spark, sf_dir)
    return ob.join(closed, ob.o_orderkey == closed.l_orderkey, "left").select(
        F.col("o_orderkey").cast("string").alias("sale_id"),
        F.col("o_totalprice").cast(MONEY).alias("total"),
        F.col("o_orderpriority").alias("sale_type"),
        F.col("o_orderdate").alias("created_at"),
        F.col("closed_at"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("branch"),
    )


def fx_lines(spark, sf_dir) -> DataFrame:
    """sale_id, product_id, price (line total), quantity, canceled, branch
    (+ line_number, ship_date: a complete file-order tiebreak)."""
    return lineitem_branch(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("sale_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_quantity").cast(MONEY).alias("quantity"),
        _canceled(F.col("l_returnflag")).alias("canceled"),
        F.col("branch"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_shipdate").alias("ship_date"),
    )


def fx_payments(spark, sf_dir) -> DataFrame:
    """amount, created_at, method, canceled, branch (one payment per line item)."""
    return lineitem_branch(spark, sf_dir).select(
        (F.col("l_extendedprice").cast(MONEY) * (F.lit(1) - F.col("l_discount").cast(MONEY))).alias("amount"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_linestatus").alias("method"),
        _canceled(F.col("l_returnflag")).alias("canceled"),
        F.col("branch"),
    )


def fx_payments_ev(spark, sf_dir) -> DataFrame:
    """payment_id, amount, created_at (with time part), method, canceled, branch."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("payment_id"),
        F.col("value").cast(MONEY).alias("amount"),
        F.col("ts").alias("created_at"),
        F.col("event_type").alias("method"),
        (F.col("event_type") == "error").alias("canceled"),
        F.concat(F.lit("B"), (F.col("user_id") % 3).cast("string")).alias("branch"),
    )


def catalog_name(p: str = "") -> Column:
    return F.concat_ws(" ", F.col(f"{p}p_name"), F.col(f"{p}p_brand"), F.col(f"{p}p_type"))


def fx_catalog(spark, sf_dir) -> DataFrame:
    """product_id, product_name, product_category, branch: every part in every branch, written as
    the product of both tables. The planner then knows that it has a row per pair; of an array
    that each part explodes it would take the size of the part file alone, and broadcast the
    rows of a catalogue of which a query needs few columns."""
    branches = table(spark, sf_dir, "region").select(F.col("r_name").alias("branch")).filter("branch IS NOT NULL")
    # Parts are a few bytes in their file: dealt out before each becomes a row per branch, so
    # that no task sorts the product of a whole file.
    part = table(spark, sf_dir, "part").repartition("p_partkey")
    return part.crossJoin(branches).select(
        F.col("p_partkey").cast("string").alias("product_id"),
        catalog_name().alias("product_name"),
        F.when(F.col("p_partkey") % 40 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("product_category"),
        "branch",
    )


def fx_catalog_with_gaps(spark, sf_dir) -> DataFrame:
    """The catalogue that lines are joined with: one part in fifty is not in it, so that the
    left join has lines without a match."""
    return fx_catalog(spark, sf_dir).filter(F.col("product_id").cast("bigint") % 50 != 0)


def fx_known_pairs(spark, sf_dir) -> DataFrame:
    """The existing product -> category mart: (product, category) of even part keys."""
    part = table(spark, sf_dir, "part").filter(F.col("p_partkey") % 2 == 0)
    return part.select(
        truncate_name(catalog_name()).alias("product"),
        F.when(F.col("p_partkey") % 40 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("category"),
    ).dropna().distinct()


def _comma_money(c: Column) -> Column:
    return F.concat(F.lit(CURRENCY_PREFIX + " "), F.replace(c.cast(MONEY).cast("string"), F.lit("."), F.lit(",")))


def fx_bookings(spark, sf_dir) -> DataFrame:
    """The quoted-events sheet, every column text (as exported)."""
    ob = orders_branch(spark, sf_dir)
    k = F.col("o_orderkey")
    return ob.select(
        F.when(k % 97 == 0, F.lit("n/a")).otherwise(F.date_format("o_orderdate", DAY_FIRST_DATE_PATTERN)).alias("event_date"),
        F.upper("c_name").alias("client"),
        F.col("branch"),
        F.col("o_orderpriority").alias("menu"),
        F.when(k % 7 == 0, F.lit("x")).otherwise((k % 60).cast("string")).alias("guests"),
        F.concat(F.lit("turno "), (k % 3).cast("string")).alias("slot"),
        _comma_money(F.col("c_acctbal")).alias("price_per_guest"),
        F.when(k % 83 == 0, F.lit(None).cast("string"))
         .when(k % 89 == 0, F.lit("-"))
         .otherwise(_comma_money(F.col("o_totalprice"))).alias("total"),
        F.when(F.col("o_orderstatus") == "F", F.lit(WON_STATUS)).otherwise(F.lit(LOST_STATUS)).alias("status"),
    )


def split_old_new(df: DataFrame, date_col: str, split: dt.date, bump: str | None,
                  overlap_days: int = OVERLAP_DAYS) -> tuple[DataFrame, DataFrame]:
    """old = rows before ``split`` (ingest_seq 0); new = rows from ``split - overlap`` on
    with ``bump`` + 1 so overwritten rows are visible (ingest_seq 1)."""
    d = F.to_date(F.col(date_col))
    old = df.filter(d < F.lit(split)).withColumn("ingest_seq", F.lit(0))
    new = df.filter(d >= F.date_sub(F.lit(split), overlap_days)).withColumn("ingest_seq", F.lit(1))
    if bump:
        new = new.withColumn(bump, (F.col(bump) + F.lit(1)).cast(df.schema[bump].dataType))
    return old, new
