"""Headered CSV files with line ends inside quoted cells, read by many tasks.

Where such a record ends depends on all quotes before it, so a reader that cuts files at
arbitrary bytes cannot tell; Spark's own ``multiLine`` reads a file in one task. Two passes:

1. Every read split counts its lines with an odd number of quotes. The parity of the counts
   of the splits before it (a window over the splits of one file) tells whether a split
   begins inside a quoted cell. A doubled quote counts twice and changes nothing.
2. With that, a split's lines are put together to records. A record that crosses the end of
   its split is a chain of fragments (its beginning, splits that lie inside it altogether,
   its end); chains are numbered by the split they begin in and joined by that number.

The records are parsed by Spark's CSV parser with the options of the one-task reader, and
equal it. One row per split and one fragment per split and side is all that is shuffled.

Edge cases: an empty folder of files has no rows; a last record without a line end counts;
blank lines are skipped; a carriage return before the line end belongs to the line end; a
cell that is never closed takes the rest of its file; a header must fit into the first split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from branchlens.session import scratch_path

OPTIONS = {"quote": '"', "escape": '"'}
MAX_BROADCAST = 50_000  # splits up to which their table (50 bytes a row) is sent to every task

_PIECES = "file string, chain long, block long, record string, kind string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("line"))


def _splits(lines: DataFrame) -> DataFrame:
    """(file, block, odd, chain): whether a split begins inside a quoted cell, and the split in
    which a record that is open at its beginning began."""
    spark = lines.sparkSession
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # A line with an odd number of quotes ends on the other side of a cell's border than it begins.
    counted = lines.groupBy("file", "block").agg(F.sum(quotes % 2).alias("flips"))
    path = f"{scratch_path(spark, 'csv-splits')}/splits"
    counted.write.parquet(path)
    counted = spark.read.schema(counted.schema).parquet(path)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    told = counted.withColumn("odd", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2 == 1)
    # A split that begins inside a cell and has no such line ends inside it: its record began earlier.
    begins = ~F.col("odd") | (F.col("flips") > 0)
    return told.withColumn("chain", F.last(F.when(begins, F.col("block")), ignorenulls=True).over(before)) \
        .select("file", "block", "odd", "chain")


def _assemble(batches):
    """Whole records (kind 'whole', a file's first one 'head'), and the fragments ('part') of
    records that cross a split's end."""
    import numpy as np
    import pyarrow.compute as pc
    out: list[tuple] = []
    place, held, chain, inside, kind = None, [], None, False, "whole"

    def flush_tail():
        # The split ends inside a record: it began here, or this whole split lies inside it.
        if held:
            out.append((place[0], place[1] if chain is None else chain, place[1], "\n".join(held), "part"))

    for b in batches:
        files, blocks = b.column("file"), b.column("block").to_numpy()
        values, odd, chains = b.column("value"), b.column("odd"), b.column("chain")
        flips = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
        texts = values.to_pylist()
        new_place = np.ones(len(blocks), dtype=bool)
        new_place[1:] = (blocks[1:] != blocks[:-1])
        names = files.to_pylist()
        for i, text in enumerate(texts):
            if new_place[i] or names[i] != (place and place[0]):
                if place != (names[i], int(blocks[i])):
                    flush_tail()
                    place, held = (names[i], int(blocks[i])), []
                    inside = bool(odd[i].as_py())
                    chain = chains[i].as_py() if inside else None
                    kind = "head" if blocks[i] == 0 else "whole"
            held.append(text)
            inside ^= bool(flips[i])
            if not inside:
                if chain is None:
                    out.append((place[0], None, place[1], "\n".join(held), kind))
                    kind = "whole"
                else:
                    out.append((place[0], chain, place[1], "\n".join(held), "part"))
                held, chain = [], None
        if out:
            yield _batch(out)
            out.clear()
    flush_tail()
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]):
    import pyarrow as pa
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      names=["file", "chain", "block", "record", "kind"])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, kind, record): the text of every CSV record; kind 'head' is a file's first."""
    lines = _lines(spark, path)
    splits = _splits(lines)
    where = f"{scratch_path(spark, 'csv-starts')}/starts"
    splits.write.parquet(where)
    splits = spark.read.schema(splits.schema).parquet(where)
    if splits.count() <= MAX_BROADCAST:
        placed = lines.join(F.broadcast(splits), ["file", "block"])  # keeps the order of the lines
    else:
        placed = lines.join(splits, ["file", "block"]).repartition("file", "block") \
            .sortWithinPartitions("file", "block", "line")
    pieces = placed.select("file", "block", "value", "odd", "chain").mapInArrow(_assemble, _PIECES)
    where = f"{scratch_path(spark, 'csv-pieces')}/pieces"
    pieces.write.parquet(where)  # the lines are assembled once
    pieces = spark.read.schema(pieces.schema).parquet(where)
    whole = pieces.filter("kind <> 'part'").select("file", F.col("block").alias("at"), "kind", "record")
    parts = F.array_sort(F.collect_list(F.struct("block", "record")))
    joined = pieces.filter("kind = 'part'").groupBy("file", "chain").agg(parts.alias("p")).select(
        "file", F.col("chain").alias("at"), F.lit("whole").alias("kind"), F.array_join(F.col("p.record"), "\n").alias("record"))
    return whole.unionByName(joined)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the headered CSV files under ``path`` as text columns. The files' headers
    must be equal (the one-task reader goes by the first file's)."""
    records = read_records(spark, path)
    text = F.regexp_replace("record", "\r$", "")
    heads = [r[0] for r in records.filter("kind = 'head'").select(text.alias("h")).distinct().limit(2).collect()]
    if not heads:
        return spark.createDataFrame([], "value string").select()
    if len(heads) > 1:
        raise ValueError(f"the files under {path} have different headers")
    parsed = spark.createDataFrame([(heads[0],)], "h string").select(F.from_csv(
        "h", ", ".join(f"c{i} string" for i in range(heads[0].count(",") + 1)), OPTIONS).alias("c")).first()[0]
    names = [n for n in parsed if n is not None]
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = records.filter((F.col("kind") != "head") & (text != "")).select(F.from_csv(text, schema, OPTIONS).alias("c")).select("c.*")
    return rows.toDF(*names)
