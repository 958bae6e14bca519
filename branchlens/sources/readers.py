"""Readers: raw CSV tables, tolerant scans with schema evolution, the bookings sheet,
marts and processed facts. All scans declare their schema (no inference pass)."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from branchlens.functions.semantics import stay_seconds, strip_zone
from branchlens.schemas import BOOKING_RAW, RAW_COLUMN_NAMES, SHEET_COLUMN_NAMES
from branchlens.sources import csv_split

log = logging.getLogger("branchlens")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Project a text-typed landed frame onto an entity schema: rename raw columns,
    add absent columns as null (schema evolution), parse timestamps keeping the wall
    clock, and cast with ``try_cast`` (unparsable values become null)."""
    renames = renames or {}
    present = {renames.get(c, c): c for c in df.columns}
    cols = []
    for f in schema.fields:
        if f.name not in present:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = F.col(f"`{present[f.name]}`")
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            v = strip_zone(src.cast("string"))
        elif isinstance(f.dataType, T.StringType):
            # ids may arrive as integers from one source and text from another
            v = src.cast("string")
        else:
            v = src.cast("string").try_cast(f.dataType)
        cols.append(v.alias(f.name))
    return df.select(*cols)


def _csv(spark: SparkSession, path: str, split: bool = False) -> DataFrame:
    """Headered CSV as text: a cell with commas, quotes or line ends is quoted, and quotes
    inside it are doubled. Cells with line ends keep Spark's reader from splitting a file;
    with ``split`` large files are read by many tasks (``csv_split``), which takes two passes."""
    if split:
        return csv_split.read_csv(spark, path)
    return spark.read.option("header", True).option("inferSchema", False).option("quote", '"') \
        .option("escape", '"').option("multiLine", True).csv(path)


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType, split: bool = False) -> DataFrame:
    """A headered raw CSV table in the export format -> entity schema (S1, S3).

    Read as text (every column a string, no inference job), then conformed: a file
    without a branch column gets a null branch, ids become strings whatever their origin.
    Sales get the length of their stay from the landed instants, before zones are dropped.
    """
    raw = _csv(spark, path, split)
    if "stay_seconds" in schema.fieldNames() and {"createdAt", "closedAt"} <= set(raw.columns):
        raw = raw.withColumn("stay_seconds", stay_seconds("createdAt", "closedAt"))
    return conform(raw, schema, RAW_COLUMN_NAMES)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Tolerant scan (S2): a missing path yields an empty frame with the entity schema."""
    try:
        if fmt == "csv":
            df = read_raw_csv(spark, path, schema)
        else:
            df = conform(spark.read.format(fmt).load(path), schema)
        df.schema  # noqa: B018  (resolves the path now)
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return empty(spark, schema)
        raise


def read_sheet(spark: SparkSession, path: str, split: bool = False) -> DataFrame:
    """Exported bookings sheet (S10): header row + rows, all text; no row cap."""
    return conform(_csv(spark, path, split), BOOKING_RAW, SHEET_COLUMN_NAMES)


def read_mart(spark: SparkSession, location: str, warn_if_empty: bool = False) -> DataFrame:
    """A published mart (S11): a catalog table name or a parquet folder. With
    ``warn_if_empty`` an empty mart is logged (``isEmpty`` reads at most one row).
    Transient read failures are retried by Spark's task retries."""
    df = spark.read.parquet(location) if ("/" in location or ":" in location) else spark.read.table(location)
    if warn_if_empty and df.isEmpty():
        log.warning("mart %s is empty", location)
    return df


def read_facts(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Processed facts written by ``sinks.write_facts`` (S12); month partitions prune. With
    ``schema`` an empty or missing table is an empty frame and partition values keep their
    declared type (a branch ``01`` stays text)."""
    return spark.read.parquet(path) if schema is None else read_table(spark, path, schema)


def read_table(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """A table with its declared schema; a missing folder is an empty table."""
    return spark.read.schema(schema).format(fmt).load(path) if path_exists(spark, path) else empty(spark, schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, by the file system that Spark itself uses."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
