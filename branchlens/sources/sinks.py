"""Sinks: versioned full-refresh tables, partitioned facts, marts, append-only pairs,
ranking reports, accepted / rejected splits and run counts.

Full-refresh tables (marts, reports) are published as immutable versions
(``VersionedTable``), so a crash leaves the version before. Tables that are merged by key or
change together are snapshots (``sources.snapshots``).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException



class VersionedTable:
    """Parquet table under ``base``: immutable ``base/v-<id>/`` folders plus an
    append-only version log ``base/_versions`` (one small JSON file per publish).

    A publish first writes the data folder, then appends its log record; appending
    adds a file and never deletes one, so a crash at any point leaves the previous
    version readable. The current version is the latest logged record.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    @property
    def log(self) -> str:
        return f"{self.base}/_versions"

    def current(self) -> dict | None:
        try:
            log = self.spark.read.schema("path string, published string, meta string").json(self.log)
            rows = log.orderBy(F.col("published").desc(), F.col("path").desc()).limit(1).collect()
        except AnalysisException:  # nothing published yet
            return None
        return rows[0].asDict() if rows else None

    def read(self, schema=None) -> DataFrame | None:
        cur = self.current()
        if cur is None:
            return None if schema is None else self.spark.createDataFrame([], schema)
        # The schema is part of the version: folder names must not change a column's type.
        stored = json.loads(cur["meta"] or "{}").get("schema")
        schema = schema or (T.StructType.fromJson(stored) if stored else None)
        return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(cur["path"])

    def publish(self, df: DataFrame, partition_by: list[str] | None = None, **meta) -> str:
        now = dt.datetime.now(dt.timezone.utc)
        path = f"{self.base}/v-{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        record = [(path, now.isoformat(), json.dumps({**meta, "schema": json.loads(df.schema.json())}, default=str))]
        self.spark.createDataFrame(record, "path string, published string, meta string") \
            .coalesce(1).write.mode("append").json(self.log)
        return path


def write_facts(df: DataFrame, path: str, partition_col: str = "month", dynamic: bool = True,
                max_records_per_file: int = 5_000_000) -> None:
    """Processed facts partitioned by month (S14). With ``dynamic`` only the months
    present in ``df`` are replaced, so a daily increment rewrites one or two months;
    without it the table is replaced and months that left the input are gone.

    The rows are rebalanced by month: adaptive execution gives a small month one task and
    one file, and splits a month that holds a large share of all rows over several.
    """
    mode = "dynamic" if dynamic else "static"
    df.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", mode) \
        .option("maxRecordsPerFile", max_records_per_file).partitionBy(partition_col).parquet(path)


def publish_mart(df: DataFrame, path: str) -> str:
    """Full-refresh mart (S15): a true replace (rows with a 0 measure do not survive),
    published as a new version. Returns the version's folder."""
    return VersionedTable(df.sparkSession, path).publish(df)


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of a mart; None before the first one."""
    return VersionedTable(spark, path).read()


def append_new_pairs(spark: SparkSession, pairs: DataFrame, path: str) -> DataFrame:
    """Append only pairs not yet in the product -> category mart (S16). Appending adds
    files next to the ones being read, so reading and appending the same path is safe."""
    from branchlens.operators.marts import new_pairs
    from branchlens.schemas import KNOWN_PAIR
    from branchlens.sources.readers import read_or_empty
    existing = read_or_empty(spark, path, KNOWN_PAIR, fmt="parquet")
    # The mart's key is the product: a product that is there keeps its category.
    new = new_pairs(pairs, existing).join(existing.select("product").distinct(), "product", "left_anti") \
        .select("product", "category")
    new.write.mode("append").parquet(path)
    return new


def publish_reports(reports: DataFrame, path: str) -> None:
    """Ranking sheets (S17): one folder per (report, scope), rows in ranking order.

    The rows are globally sorted (range partitioning), so each task writes a contiguous
    slice of the ranking and part files of a folder follow each other in rank order."""
    VersionedTable(reports.sparkSession, path).publish(
        reports.orderBy("report", "scope", F.col("qty").desc(), F.col("product").asc()), ["report", "scope"])


def publish_reconciliation(daily: DataFrame, path: str) -> None:
    """Reconciliation sheets (S17): per branch one sheet with all days and one with the days
    on which the three sources differ, newest day first."""
    amounts = [c for c in daily.columns if c not in ("branch", "day")]
    differs = F.size(F.array_distinct(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in amounts]))) > 1
    sheets = daily.withColumn("sheet", F.explode(F.when(differs, F.array(F.lit("all_days"), F.lit("differences")))
                                                 .otherwise(F.array(F.lit("all_days")))))
    VersionedTable(daily.sparkSession, path).publish(
        sheets.orderBy("sheet", "branch", F.col("day").desc()), ["sheet", "branch"])


def write_accepted_rejected(split: DataFrame, path: str) -> None:
    """Both sides of the constraint split (S18), partitioned by status."""
    VersionedTable(split.sparkSession, path).publish(split, ["status"])


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter (S19) computed by the job that consumes ``df`` (no extra pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


RUN_STEP = "run bigint, step string, status string, started string, seconds double, rows bigint, error string"


class RunLog:
    """Status, time, rows and error of every step of a run, one JSON record per step."""

    def __init__(self, spark: SparkSession, path: str, run: int = 0):
        self.spark, self.path, self.run = spark, path, run

    @contextlib.contextmanager
    def step(self, name: str):
        """Run a step; its record is written whether it succeeds or fails, and an error goes on
        to the caller. The step may put its number of rows into the dictionary it gets."""
        began, clock, seen = dt.datetime.now(dt.timezone.utc), time.monotonic(), {}
        status, error = "failed", None
        try:
            yield seen
            status = "done"
        except BaseException as e:
            error = f"{type(e).__name__}: {e}"[:2000]
            raise
        finally:
            record = (self.run, name, status, began.isoformat(), time.monotonic() - clock, seen.get("rows"), error)
            self.spark.createDataFrame([record], RUN_STEP).coalesce(1).write.mode("append").json(self.path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The records of all runs."""
    return spark.read.schema(RUN_STEP).json(path)
