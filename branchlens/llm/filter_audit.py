"""Filter interaction audit: what each order of the filters removes, by Lehmer ranks.

Five filters can run in 120 orders. A document is removed at the first filter of the order
that it fails, so all that counts is the set of filters it fails, its mask:

1. Every document gets its mask; documents are counted by (part, mask), with partial
   aggregation: at most 32 rows a part leave this step.
2. Permutations are numbered by their Lehmer rank, which is their place in lexicographic
   order, so all orders that begin with the same letters are one interval of ranks. A mask
   is removed at step s by exactly those orders whose first s - 1 letters are outside the
   mask and whose s-th letter is in it: a fixed list of (mask, step, first rank, end rank),
   made from that rule (840 intervals over all masks).
3. The counts of a (part, mask) are added where its intervals begin and subtracted where
   they end; the prefix sum of these differences over the 120 ranks is what every order
   removes at that step. Everything else (kept, redundant, the sum over all orders) follows
   from these totals.

The filters, on the whole text (null counts as empty; words are maximal runs of characters
other than space and 0x09-0x0D): A fewer than 200 words; B less than half of the words are
distinct; C more than 2 % of the code points are A-Z; D a character of ``#$%&*|``; E the
text of a document with a smaller id, wherever that one ends up.

Scale: texts are read twice (masks, digests) and never shuffled; rows of a few bytes are
joined to the digests that occur more than once and to the labels, both written first, so
that adaptive execution can split the rows of a text that very many documents share.

Edge cases: a null or empty source is the part named by the empty string; a null id is not
smaller than any and has no smaller one (its E never fails) and no label; rows that repeat
an id count each, and with equal texts are not copies of each other; labels that repeat an
id count as 1 where any of them is 1; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .tables import materialise

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITALS_PERCENT = 2
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MEASURES = ("n", "good", "toxic")


def removal_intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """(mask, step, lo, hi): ranks lo..hi-1 remove documents of that mask at that step."""
    size, found = len(filters), []
    for mask in range(1, 1 << size):
        inside = [i for i in range(size) if mask >> i & 1]
        outside = [i for i in range(size) if not mask >> i & 1]
        for step in range(1, len(outside) + 2):
            for head in permutations(outside, step - 1):
                for last in inside:
                    lo, free = 0, list(range(size))
                    for at, letter in enumerate((*head, last)):
                        lo += free.index(letter) * factorial(size - 1 - at)
                        free.remove(letter)
                    found.append((mask, step, lo, lo + factorial(size - step)))
    return found


def _text_bits(text):
    """Bits of the filters A to D, which look at one text alone."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    failed = (F.size(words) < MIN_WORDS,
              F.size(F.array_distinct(words)) * 100 < F.size(words) * DISTINCT_PERCENT,
              capitals.cast("long") * 100 > F.length(text).cast("long") * CAPITALS_PERCENT,
              text.rlike(r"[#$%&*|]"))
    bits = [F.when(cond, 1 << i).otherwise(0) for i, cond in enumerate(failed)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def masks(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          part: str = "source") -> DataFrame:
    """(id, part, mask, good, toxic) of every document; bit i of the mask is filter i."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.unhex(F.sha2(body, 256)).alias("digest"), _text_bits(body).alias("bits"))
    copies = materialise(rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
                         .where("n > 1").select("digest", "first"), "audit-copies")
    marks = materialise(labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic")), "audit-labels")
    joined = rows.join(copies, "digest", "left").join(marks, "id", "left")
    copied = F.when(F.col("id") > F.col("first"), 1 << 4).otherwise(0)
    return joined.select("id", "part", (F.col("bits") + copied).alias("mask"),
                         *[F.coalesce(m, F.lit(0)).alias(m) for m in ("good", "toxic")])


def audit(masked: DataFrame) -> DataFrame:
    """Removals of every order, step and part from (part, mask, good, toxic) rows."""
    spark, size = masked.sparkSession, len(FILTERS)
    orders = ["".join(p) for p in permutations(FILTERS)]  # in lexicographic order: the place is the rank
    counts = materialise(masked.groupBy("part", "mask").agg(
        F.count("*").alias("n"), *[F.sum(F.col(m).cast("long")).alias(m) for m in ("good", "toxic")]), "audit-counts")

    def with_bit(i):
        return F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0))

    parts = counts.groupBy("part").agg(
        F.sum("n").alias("total"), F.array(*[with_bit(i) for i in range(size)]).alias("failing"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(size)]).alias("alone"))

    # Difference arrays: every part, step and rank has a zero entry, and each interval two more.
    names = ("mask", "step", "lo", "hi")
    intervals = spark.createDataFrame(pa.table({n: pa.array(c, pa.int32()) for n, c in zip(names, zip(*removal_intervals()))}))
    ends = F.explode(F.array(*[F.struct(F.col(at).alias("rank"), *[(F.col(m) * sign).alias(m) for m in _MEASURES])
                               for at, sign in (("lo", 1), ("hi", -1))]))
    differences = (counts.join(F.broadcast(intervals), "mask").select("part", "step", ends.alias("e"))
                   .select("part", "step", "e.*").where(F.col("rank") < len(orders)))
    zeros = (parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step"))
             .select("*", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("rank"),
                     *[F.lit(0).cast("long").alias(m) for m in _MEASURES]))
    summed = differences.unionByName(zeros).groupBy("part", "step", "rank").agg(*[F.sum(m).alias(m) for m in _MEASURES])
    along = W.partitionBy("part", "step").orderBy("rank")
    removed = summed.select("part", "step", "rank", *[F.sum(m).over(along).alias(m) for m in _MEASURES])

    order = F.element_at(F.array(*[F.lit(o) for o in orders]), F.col("rank") + 1)
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    steps = removed.join(parts, "part").withColumn("filter_order", order).withColumn("at", F.ascii(letter) - ord("A") + 1)
    so_far = F.sum("n").over(W.partitionBy("part", "rank").orderBy("step"))
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - so_far).alias("kept"), F.col("n").alias("removed"),
        (F.element_at("failing", F.col("at")) - F.col("n")).alias("redundant"),
        F.element_at("alone", F.col("at")).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(W.partitionBy("part", "at")).alias("shapley"))
