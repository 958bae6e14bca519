"""Keep-last as a stream with keyed state: a micro-batch writes what it changes, no more.

``upsert_stream`` rewrites the months that a micro-batch touches. Here the last sequence
number of every key is state (RocksDB, by buckets of keys, checkpointed with the stream), a delivery that is not
newer than its key's state is dropped before it is written, and the rest is appended to a
change table by month. Readers take the last change of a key (``current_rows``), and
``compact`` replaces changes by their last ones.

Deliveries carry an event time. Those later than the watermark allows are dropped by Spark
and counted (``late_rows``). A key that was not delivered for ``keep`` is forgotten by a
timer, so the state holds recent keys only; if it does come back, its change is written as
that of a new key, and reading by sequence number gives the same rows.

A micro-batch is published together with its number: one that is replayed after a failure is
recognised and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from branchlens.functions.semantics import month_of
from branchlens.operators.incremental import keep_last
from branchlens.sources.snapshots import SnapshotStore

# Fixed value: the state store that keyed state needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
BUCKETS = 4096  # groups of keys that share an entry of the state; a checkpoint keeps its number
KEY, BUCKET = "_key", "_bucket"  # a key as one text, null values left out; its bucket


class LastDelivery(StatefulProcessor):
    """Per bucket of keys: emit the newest row of every key of a micro-batch if it is newer than
    everything before. A call to the state costs far more than a row, so the keys of a bucket
    share one entry: their texts, last sequence numbers and times to be forgotten. A bucket with
    keys has one timer, never later than the first of these times."""

    def __init__(self, names: list[str], seq: str, keep_ms: int):
        self.names, self.seq, self.keep_ms = names, seq, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "key array<string>, seq array<bigint>, forget_at array<bigint>")

    def _known(self) -> dict[str, tuple[int, int]]:
        found = self.last.get()
        return {} if found is None else {k: (s, f) for k, s, f in zip(*found)}

    def _keep(self, known: dict[str, tuple[int, int]]) -> None:
        self.last.update((list(known), [s for s, _ in known.values()], [f for _, f in known.values()]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = {}
        for r in rows:
            if (best := newest.get(r[KEY])) is None or r[self.seq] > best[self.seq]:
                newest[r[KEY]] = r
        known = self._known()
        idle = not known
        newer = {k: r for k, r in newest.items() if k not in known or r[self.seq] > known[k][0]}
        if not newer:
            return
        forget_at = timerValues.getCurrentWatermarkInMs() + self.keep_ms  # not before that of any known key
        if idle:
            self.handle.registerTimer(forget_at)
        self._keep(known | {k: (r[self.seq], forget_at) for k, r in newer.items()})
        for r in newer.values():
            yield Row(**{n: r[n] for n in self.names})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        known = {k: (s, f) for k, (s, f) in self._known().items() if f > now}
        if known:
            self._keep(known)
            self.handle.registerTimer(min(f for _, f in known.values()))
        else:
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def change_store(spark: SparkSession, target: str, schema: T.StructType, seq: str) -> SnapshotStore:
    """The store of the change table: ``changes``, by month."""
    fields = [*schema.fields, T.StructField(seq, T.LongType()), T.StructField("month", T.StringType())]
    return SnapshotStore(spark, target, {"changes": (T.StructType(fields), "month")})


def current_rows(store: SnapshotStore, keys: Sequence[str], seq: str) -> DataFrame:
    """The last change of every key."""
    return keep_last(store.read("changes"), keys, [seq])


def compact(store: SnapshotStore, keys: Sequence[str], seq: str) -> None:
    """Replace the changes by the last one of every key."""
    at = store.snapshot()
    store.commit(at, {"changes": store.replace("changes", keep_last(store.read("changes", at), keys, [seq]))}, **at.meta)


def run_keyed_stream(spark: SparkSession, landing: str, schema: T.StructType, target: str, keys: Sequence[str], seq: str,
                     workdir: str, event_time: str = "delivered_at", late: str = "1 day", keep: str = "30 days",
                     files_per_trigger: int = 64):
    """Consume what has landed under ``landing`` (parquet with the columns of ``schema``, ``seq``
    and ``event_time``) and stop. Returns the finished query."""
    full = T.StructType([*schema.fields, T.StructField(seq, T.LongType()), T.StructField(event_time, T.TimestampType())])
    out = T.StructType([*schema.fields, T.StructField(seq, T.LongType())])
    store, stream = change_store(spark, target, schema, seq), f"{workdir}/checkpoint"
    keep_ms = int(spark.range(1).select(F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {keep}"))).first()[0])

    def publish(changes: DataFrame, micro_batch: int) -> None:
        base = store.snapshot()
        if base.meta.get("stream") == stream and base.meta.get("micro_batch", -1) >= micro_batch:
            return
        change = store.append("changes", changes.withColumn("month", month_of("created_at")))
        store.commit(base, {"changes": change}, stream=stream, micro_batch=micro_batch)

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        landed = spark.readStream.schema(full).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
        keyed = landed.withColumns({KEY: F.to_json(F.struct(*keys)), BUCKET: F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))})
        changed = keyed.withWatermark(event_time, late).groupBy(BUCKET).transformWithState(
            LastDelivery(out.fieldNames(), seq, keep_ms), out, "Update", "EventTime")
        query = (changed.writeStream.outputMode("update").foreachBatch(publish)
                 .option("checkpointLocation", stream).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
    return query


def late_rows(query) -> int:
    """Deliveries that came later than the watermark allows."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
