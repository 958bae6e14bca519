"""Corpus pipeline: quality filter, line dedup, near-duplicate removal, mixing, packing.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir), works on
all rows its predecessor kept and returns a DataFrame. ``run`` applies them to the table
``documents``, writing each result as Parquet in the shared scratch folder and reading it
again, so a lost executor costs a re-read of one stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from branchlens.llm import line_winnow, mixing, packing, prefix_tree_join, quality_fm
from branchlens.llm.queries import tokeniser_paths
from branchlens.llm.tables import materialise, table
from branchlens.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Near copies share this percentage of their shingles of so many words (op8's own are 85 and 4).
NEAR_PERCENT = 80
NEAR_SHINGLE = 5

#: A line of so many words is a passage of its own (the window of op2).
LONG_LINE_WORDS = 50


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below 0.5 go.

    The classifier learns from the given tables ``documents`` and ``labels`` (without the
    held-out fold), whatever the stage's own input holds.
    """
    labels = table(spark, sf_dir, "labels").where(~quality_fm.is_held_out())
    model = quality_fm.train(table(spark, sf_dir, "documents"), labels)
    return quality_fm.score(docs.select(*COLUMNS), model).where("score >= 0.5").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats are deleted, first of runs of lines, then of single long lines; a document
    that loses all its lines goes.

    ``n_chars`` follows the text. Documents without any line (null, empty, blank) stay.
    """
    runs = _without_lines(line_winnow.drop_repeated_lines(docs.select(*COLUMNS)))
    return without_long_repeats(materialise(runs, "line-runs"))


def without_long_repeats(docs: DataFrame) -> DataFrame:
    """Later repeats of single lines of at least ``LONG_LINE_WORDS`` words are deleted too.

    A passage that is one line between other lines is no run of lines, and its documents need
    not be similar.
    """
    return _without_lines(line_winnow.drop_repeated_lines(docs.select(*COLUMNS), run=1, min_words=LONG_LINE_WORDS))


def _without_lines(cut: DataFrame) -> DataFrame:
    cut = cut.where("n_lines = 0 OR n_removed < n_lines")
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of similar documents the one with the smallest id stays.

    Rows that repeat id and text are one document; rows with a null id, which cannot name a
    group, stay.
    """
    groups = prefix_tree_join.similar_documents(docs.select("doc_id", "text"), percent=NEAR_PERCENT,
                                               shingle=NEAR_SHINGLE)
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.select(*COLUMNS).where("doc_id is not null").join(first.hint("merge"), "doc_id", "left_semi")
    return named.dropDuplicates(["doc_id", "text"]).unionByName(docs.select(*COLUMNS).where("doc_id is null"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it (0, 1 or 2)."""
    docs = docs.select(*COLUMNS)
    mixed = mixing.apply_mix(docs, mixing.plan_mix(docs)).where("taken > 0")
    copies = F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))
    return mixed.select(*COLUMNS, F.explode(copies).alias("_copy")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a sequence of at most 2048 tokens."""
    return packing.pack(packing.tokenise(docs, *tokeniser_paths()))


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Not expressible in SQL (trained classifier, tokeniser); the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    scratch = scratch_path(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{scratch}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
