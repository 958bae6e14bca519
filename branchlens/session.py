"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from contextlib import contextmanager

from pyspark import InheritableThread
from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (timestamps are stored without zone),
# ANSI arithmetic (errors instead of silent overflow) and adaptive execution, which
# re-plans joins from runtime sizes (broadcast only after the build side is measured),
# coalesces small shuffle partitions and splits skewed ones.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Upper bounds: a session that has a smaller value keeps it. Tables grow behind both. A table
# planned for a broadcast passes through the driver, and its size is guessed from its files,
# which may be thirty times smaller than its rows. The size of shuffle partitions is that of
# compressed bytes, and sorts hold a partition's rows many times as large (catalogue rows: 30).
SESSION_BOUNDS = {
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
}
_OPTIONAL = {"spark.sql.adaptive.autoBroadcastJoinThreshold"}  # unset, it follows the static threshold


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "branchlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the project defaults.

    On a cluster leave ``master`` unset (spark-submit decides) and size
    ``shuffle_partitions`` to the data (AQE coalesces what is too fine).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the runtime-settable defaults to an existing session (e.g. the driver's)."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.ui."):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf in a foreign session: keep theirs
            pass
    for k, bound in SESSION_BOUNDS.items():
        now = spark.conf.get(k, None) if k in _OPTIONAL else spark.conf.get(k)
        if now is not None and _bytes(spark, now) > _bytes(spark, bound):
            spark.conf.set(k, bound)


def _bytes(spark: SparkSession, size: str) -> int:
    """A size of Spark's settings in bytes; negative ones switch a feature off."""
    return -1 if size.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and job scratch tables.

    The cluster names it in ``spark.checkpoint.dir``. Where it is unset a job on one
    machine (master ``local``) gets a fresh temporary folder; on several machines there is
    no folder that all of them share, and the job does not start.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="branchlens-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001  (a core conf some sessions refuse at run time)
            pass
    spark.sparkContext.setCheckpointDir(d)
    return d


def run_together(spark: SparkSession, jobs: list) -> list:
    """Run independent Spark jobs (functions without arguments) side by side and return their
    results in order. While the last tasks of one write finish, the others use the cores."""
    results, failed = [None] * len(jobs), []

    def run(at: int) -> None:
        try:
            results[at] = jobs[at]()
        except BaseException as error:  # noqa: BLE001  (raised again below, in the caller's thread)
            failed.append(error)

    threads = [InheritableThread(target=run, args=(at,), session=spark) for at in range(len(jobs))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failed:
        raise failed[0]
    return results


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Executions that begin inside delete their shuffle files when they end. Otherwise those of
    all steps of a job lie on the disks until the driver happens to collect its garbage. For
    writes and counts: a frame that is made inside and run twice shuffles anew. To be entered by
    the thread that begins a job, not by those of ``run_together``."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """Path of a fresh sub-folder of the shared checkpoint folder; Spark's writers create it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_SCRATCH_NAME = re.compile(r".+-[0-9a-f]{32}")


def clean_scratch(spark: SparkSession, min_age_s: float = 7 * 86400.0, folder: str | None = None) -> int:
    """Delete the scratch folders of the shared checkpoint folder (or ``folder``) that nothing was written to for
    ``min_age_s``: results of finished queries that were read or given up. To be run by the
    cluster's housekeeping, with an age above that of the longest job. Returns their number."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder or checkpoint_dir(spark))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    before, deleted = (time.time() - min_age_s) * 1000, 0
    for status in fs.listStatus(root) if fs.exists(root) else ():
        if status.isDirectory() and _SCRATCH_NAME.fullmatch(status.getPath().getName()):
            newest = max([status.getModificationTime(), *(c.getModificationTime() for c in fs.listStatus(status.getPath()))])
            if newest < before:
                fs.delete(status.getPath(), True)
                deleted += 1
    return deleted
