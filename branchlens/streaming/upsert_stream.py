"""Continuous keyed upsert of landed files with Structured Streaming.

Landed files (``<landing>/batch=<n>/...``) are read as a file stream; each micro-batch
is merged into a snapshot table: only the partitions (months) that the micro-batch touches,
or that its keys had before, are read and written again, and one commit publishes them
together with the micro-batch's number, so each counts once (foreachBatch is at-least-once).
The landing batch number, not the micro-batch id, decides which version of a key wins, so the
result does not depend on how files are grouped into micro-batches. The streaming checkpoint
records which files were consumed; it replaces the id high-water mark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.functions.semantics import month_of
from branchlens.operators.incremental import keep_last
from branchlens.sources.snapshots import KeyIndex, SnapshotStore


def land_batch(df: DataFrame, landing: str, batch: int) -> None:
    """Write one landed batch (parquet) under ``landing/batch=<batch>``."""
    df.write.mode("overwrite").parquet(f"{landing.rstrip('/')}/batch={batch}")


def stream_store(spark: SparkSession, target: str, schema: T.StructType, part_col: str) -> SnapshotStore:
    """The store that the stream publishes to: one table, ``rows``."""
    return SnapshotStore(spark, target, {"rows": (table_schema(schema, part_col), part_col)})


def merge_batch(store: SnapshotStore, schema: T.StructType, keys: Sequence[str], order: Sequence[str],
                part_expr: Column, stream: str):
    """The foreachBatch function: merge one micro-batch and publish it together with its
    number, so a micro-batch that is replayed after it was published changes nothing."""
    part_col, index = store.tables["rows"][1], KeyIndex(store, "rows", keys)

    def merge(batch_df: DataFrame, batch_id: int) -> None:
        base = store.snapshot()
        if base.meta.get("stream") == stream and base.meta.get("micro_batch", -1) >= batch_id:
            return
        base = index.ensure(base, F.col("batch"))
        incoming = batch_df.select(*[f.name for f in schema.fields], "batch").withColumn(part_col, part_expr)
        last = keep_last(incoming, keys, ["batch", *order])
        change = store.merge("rows", last, keys, ["batch", *order], base, also=index.moves(last, base))
        changes = {} if change is None else {"rows": change, index.name: index.update(last, base, F.col("batch"))}
        store.commit(base, changes, stream=stream, micro_batch=batch_id)
    return merge


def table_schema(schema: T.StructType, part_col: str) -> T.StructType:
    """The target: the landed columns, the landing batch and the partition column last."""
    fields = [f for f in schema.fields if f.name != part_col]
    return T.StructType([*fields, T.StructField("batch", T.IntegerType()), T.StructField(part_col, T.StringType())])


def run_upsert_stream(spark: SparkSession, landing: str, schema: T.StructType, target: str, keys: Sequence[str],
                      order: Sequence[str], workdir: str, part_col: str = "month",
                      part_expr: Column | None = None, files_per_trigger: int | None = None,
                      bytes_per_trigger: int = 8 << 30):
    """Consume everything landed so far (``availableNow``) and stop.

    A micro-batch takes about ``bytes_per_trigger`` of landed files (or a number of files),
    so a month is rewritten once per that much input, not once per file."""
    part_expr = month_of("created_at") if part_expr is None else part_expr
    full = T.StructType(schema.fields + [T.StructField("batch", T.IntegerType())])
    limit = ("maxBytesPerTrigger", bytes_per_trigger) if files_per_trigger is None \
        else ("maxFilesPerTrigger", files_per_trigger)
    stream = spark.readStream.schema(full).option(*limit).parquet(landing)
    q = (stream.writeStream
         .foreachBatch(merge_batch(stream_store(spark, target, schema, part_col), schema, list(keys), list(order),
                                   part_expr, f"{workdir}/checkpoint"))
         .option("checkpointLocation", f"{workdir}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def stream_upsert(spark: SparkSession, batches: list[DataFrame], schema: T.StructType, keys: Sequence[str],
                  order: Sequence[str], workdir: str, files_per_trigger: int | None = None) -> DataFrame:
    """Land ``batches`` in order, run the stream to completion, return the merged table."""
    landing, target = f"{workdir}/landing", f"{workdir}/table"
    for i, b in enumerate(batches):
        land_batch(b.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), landing, i)
    run_upsert_stream(spark, landing, schema, target, keys, order, workdir, files_per_trigger=files_per_trigger)
    return stream_store(spark, target, schema, "month").read("rows")
