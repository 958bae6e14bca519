"""Reading the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from branchlens.session import scratch_path

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


#: Rows of one Arrow batch between Spark and a Python worker. Texts are large rows: the
#: usual 10 000 of them are tens of MB in the worker and, outside the heap, in the executor.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to BATCH_ROWS; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared scratch folder and read it back (cuts the lineage)."""
    bound_batches(df.sparkSession)
    path = f"{scratch_path(df.sparkSession, name)}/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
