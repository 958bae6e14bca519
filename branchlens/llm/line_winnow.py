"""Line dedup by winnowing over line hashes.

A document is the sequence of its non-blank lines, compared without the white space at
their ends. A run of at least ``RUN`` consecutive lines that also occurs at an earlier
place (smaller document id, or earlier in the same document without overlap) is deleted;
the first occurrence stays.

1. Select: in every window of RUN line hashes the minimum (the rightmost of equal ones) is
   a fingerprint. The choice depends on the window alone, so two occurrences of a run of
   RUN lines always share a fingerprint: nothing of that length is missed.
2. Join positions: hashes that are selected at two places or more (a count per hash, with
   partial aggregation) mark the positions that can belong to a repeated run.
3. Extend: around such a position, to both sides, every window of RUN lines is named by
   128 bits of hash; the earliest place of each window is its minimum place. Windows that
   have an earlier place are repeated, and the union of overlapping ones is the run.
4. Delete the lines of repeated windows from the text; all else stays byte for byte.

Only fingerprints (two integers and 2 * RUN - 1 line hashes each) are shuffled by hash. A
very common line is reduced to one count per task; its rows are joined to that one row.

With ``min_words`` only lines of at least that many words take part; run=1 and 50 words
delete long passages that are one line each, between whatever other lines.

Edge cases: null text stays null, empty text stays empty; documents with fewer lines than
RUN have no run; a null id counts as smaller than all others; rows that repeat id and text
are the same place and keep all their lines; an empty table gives an empty result; columns
called n_lines or n_removed are replaced, all other columns pass through.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .tables import materialise

RUN = 2
_ENDS = " \t\x0b\x0c\r"


def _lines(text: str, min_words: int):
    """Non-blank lines of at least ``min_words`` words: (hash, raw line number)."""
    trimmed = F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(
        F.btrim(x, F.lit(_ENDS)).alias("line"), i.alias("raw")))

    def taken(s):
        filled = s["line"] != ""
        return filled if min_words <= 1 else filled & (
            F.regexp_count(s["line"], F.lit(r"[\x20\x09-\x0D]+")) >= min_words - 1)

    return F.transform(F.filter(trimmed, taken),
                       lambda s: F.struct(F.xxhash64(s["line"]).alias("h"), s["raw"].alias("raw")))


def repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", run: int = RUN,
                   min_words: int = 1) -> DataFrame:
    """(id, version, lines): raw numbers of the lines to delete, for documents that have any."""
    base = (docs.where(F.col(text).isNotNull())
            .select(F.col(key).alias("id"), F.xxhash64(text).alias("version"), _lines(text, min_words).alias("s"))
            .where(F.size("s") >= run))
    starts = F.sequence(F.lit(0), F.size("s") - run)
    picks = F.array_distinct(F.transform(starts, lambda i: -F.array_min(F.transform(
        F.slice("s", i + 1, F.lit(run)), lambda x, j: F.struct(x["h"], (-(i + j)).alias("at"))))["at"]))
    # A fingerprint carries the lines that windows around it can hold.
    around = F.transform(picks, lambda p: F.struct(
        p.alias("at"), F.element_at("s", p + 1)["h"].alias("h"), F.greatest(F.lit(0), p - (run - 1)).alias("from"),
        F.slice("s", F.greatest(F.lit(0), p - (run - 1)) + 1,
                F.least(p + run, F.size("s")) - F.greatest(F.lit(0), p - (run - 1))).alias("near")))
    prints = materialise(base.select("id", "version", F.inline(around)).distinct(), "line-prints")

    # Counts are written before they are joined back: two plain shuffles meet in that join,
    # and adaptive execution can split the rows of a very common line over several tasks.
    shared = materialise(prints.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "line-shared")
    candidates = prints.join(shared, "h", "left_semi")
    windows = candidates.select("id", "version", F.inline(F.transform(
        F.sequence(F.lit(0), F.size("near") - run), lambda i: F.struct(
            (F.col("from") + i).alias("start"),
            F.transform(F.slice("near", i + 1, F.lit(run)), lambda x: x["raw"]).alias("raws"),
            F.xxhash64(F.transform(F.slice("near", i + 1, F.lit(run)), lambda x: x["h"])).alias("w1"),
            F.xxhash64(F.lit(1), F.transform(F.slice("near", i + 1, F.lit(run)), lambda x: x["h"])).alias("w2")))))
    windows = materialise(windows.dropDuplicates(["id", "version", "start"]), "line-windows")
    first = windows.groupBy("w1", "w2").agg(F.min(F.struct("id", "version", "start")).alias("first"),
                                            F.count("*").alias("n")).where("n > 1").select("w1", "w2", "first")
    first = materialise(first, "line-first")
    same_text = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("version") == F.col("first.version"))
    repeated = windows.join(first, ["w1", "w2"]).where(
        ~same_text | (F.col("first.start") + run <= F.col("start")))
    return (repeated.select("id", "version", F.explode("raws").alias("raw"))
            .groupBy("id", "version").agg(F.collect_set("raw").alias("lines")))


def drop_repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", run: int = RUN,
                        min_words: int = 1) -> DataFrame:
    """All rows of ``docs``, texts without repeated runs, and n_lines (non-blank lines of the
    input) and n_removed (lines deleted)."""
    docs = docs.drop("n_lines", "n_removed")
    # A merge join at any size: how the texts move must not depend on how many lines repeat.
    gone = materialise(repeated_lines(docs, text, key, run, min_words), "line-repeats").toDF("_id", "_version", "_lines").hint("merge")
    joined = (docs.join(gone, docs[key].eqNullSafe(gone["_id"]) & (F.xxhash64(docs[text]) == gone["_version"]), "left")
              .drop("_id", "_version"))
    at, width = docs.columns.index(text), len(docs.columns)

    def run_batches(batches):
        for b in batches:
            texts, lines, total, removed = b.column(at).to_pylist(), b.column(width).to_pylist(), [], []
            for i, (t, drop) in enumerate(zip(texts, lines)):
                parts = (t or "").split("\n")
                total.append(sum(1 for x in parts if x.strip(_ENDS)))
                removed.append(len(drop or ()))
                if drop:
                    drop = set(drop)
                    texts[i] = "\n".join([x for n, x in enumerate(parts) if n not in drop])
            columns = list(b.columns[:-1])
            columns[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
                                             names=[*b.schema.names[:-1], "n_lines", "n_removed"])

    return joined.mapInArrow(run_batches, T.StructType([
        *docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())]))
