"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: its weight's share of the mix, at most
``cap`` times its own words, the excess shared among the other sources by weight. A
source whose target is r times its words takes floor(r) certain copies of each of its
documents. The rest of the target is a fixed-size sample in words with unequal inclusion
probabilities pi_i = min(1, c * sqrt(size_i)), c such that sum pi_i * size_i is the rest:
longer documents get higher odds, so the sample's end falls on a short document and the
total lands close to the target. Documents are ranked by

    q_i = (u_i / (1 - u_i)) / (pi_i / (1 - pi_i)),   u_i uniform from a hash of the id

and taken from the smallest q on until the rest is reached; the last one is taken if that
comes closer to the target.

No source is ever sorted in one task: the cut is found from sums per bin of log2(q), then
per sub-bin of the bin in question, and only documents of that one sub-bin are ranked row
by row. The result is one row of numbers per source, applied to the documents as a
projection: texts are not shuffled.

Edge cases: a null text has size 0 and takes 0; a null source is a source of its own,
last in order; empty sources get target 0; repeated rows are documents of their own: rows of a
source that share an id take text and a number into their hash, so each has a random number
of its own, however many they are (they are numbered per task and moved up by the counts of
the tasks before; which of two equal rows has which number does not change the result as a
bag); an empty table gives an empty result; the result has exactly
the given columns and those named in ``apply``, which replace equal names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .tables import materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = 20_231
BROADCAST_SOURCES = 100_000
_CERTAIN = -(10 ** 6)  # bin of documents with inclusion probability 1


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per source: source_size, target. ``sizes`` has one row per source: source, source_size.

    The fixed point of the re-sharing is target = min(level * weight, cap * size) with one
    common level: the largest of the levels that arise when sources are capped one after
    the other in the order of cap * size / weight. The window runs over one row per source.
    """
    numbered = sizes.withColumn("_n", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighted = numbered.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                      (F.col("_n") % len(weights) + 1).cast("int")))
    by_ratio = W.orderBy(F.col("source_size") / F.col("_w"), "_n")
    upto = by_ratio.rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.partitionBy(F.lit(1))
    rest_w = F.sum("_w").over(everything) - F.sum("_w").over(upto) + F.col("_w")
    rest = (share * F.sum("source_size").over(everything)
            - cap * (F.sum("source_size").over(upto) - F.col("source_size")))
    levels = weighted.withColumn("_level", rest / rest_w)
    return (levels.withColumn("_level", F.max("_level").over(everything))
            .select("source", "source_size",
                    F.least(F.col("_level") * F.col("_w"), cap * F.col("source_size")).alias("target")))


def _numbered(rows: DataFrame, shared: list[str], same: list[str], name: str) -> DataFrame:
    """``rows`` with ``_j``: null for a row that is alone in the columns ``shared``, else its
    number, 0 up, among the rows that agree in the columns ``same`` as well.

    Rows that are not alone are found by a count. They are written with an id that tells
    their task, numbered within their task, and moved up by the counts of the tasks before:
    no window holds more of them than one task wrote."""
    none, same = F.lit(None).cast("long"), [*shared, *same]
    again = materialise(rows.groupBy(*shared).agg(F.count("*").alias("_n")).where("_n > 1").select(
        *[F.col(c).alias(f"_again{i}") for i, c in enumerate(shared)], F.lit(True).alias("_repeated")), f"{name}-repeats")
    if not again.limit(1).count():
        return rows.withColumn("_j", none)
    match = F.lit(True)
    for i, c in enumerate(shared):
        match = match & F.col(c).eqNullSafe(F.col(f"_again{i}"))
    told = rows.join(again, match, "left").drop(*[f"_again{i}" for i in range(len(shared))])
    single = told.where("_repeated IS NULL").drop("_repeated").withColumn("_j", none)
    several = materialise(told.where("_repeated").drop("_repeated").withColumn("_row", F.monotonically_increasing_id()),
                          f"{name}-several")
    light = several.select(*same, "_row", F.shiftright("_row", 33).alias("_task"))
    counts = materialise(light.groupBy(*same, "_task").agg(F.count("*").alias("_n")), f"{name}-counts")
    before = F.sum("_n").over(W.partitionBy(*same).orderBy("_task").rowsBetween(W.unboundedPreceding, -1))
    starts = materialise(counts.withColumn("_start", F.coalesce(before, F.lit(0))).drop("_n"), f"{name}-starts")
    starts = starts.select(*[F.col(c).alias(f"_at{i}") for i, c in enumerate(same)], F.col("_task").alias("_of"), "_start")
    inside = light.withColumn("_within", F.row_number().over(W.partitionBy(*same, "_task").orderBy("_row")) - 1)
    match = F.col("_task") == F.col("_of")
    for i, c in enumerate(same):
        match = match & F.col(c).eqNullSafe(F.col(f"_at{i}"))
    numbers = inside.join(starts, match).select(F.col("_row").alias("_number_of"), (F.col("_start") + F.col("_within")).alias("_j"))
    numbered = several.join(numbers, F.col("_row") == F.col("_number_of")).drop("_row", "_number_of")
    return single.unionByName(numbered)


def _odds_rank(row: str, scale: Column, seed: int) -> Column:
    """q of a row; ``row`` prefixes its columns id, h (of the text), _j and size."""
    key, text, number, size = (F.col(row + c) for c in ("id", "h", "_j", "size"))
    own = F.when(number.isNull(), F.xxhash64(F.lit(seed), key)).otherwise(F.xxhash64(F.lit(seed), key, text, number))
    u = (F.pmod(own, F.lit(1 << 52)) + 0.5) / float(1 << 52)
    pi = F.least(F.lit(1.0), scale * F.sqrt(size))
    return F.when(pi >= 1, 0.0).when(pi <= 0, 1e300).otherwise((u / (1 - u)) / (pi / (1 - pi)))


def _bin(q: Column) -> Column:
    return F.when(q <= 0, F.lit(_CERTAIN)).otherwise(F.floor(F.log2(q) * 32)).cast("long")


def _sub_bin(q: Column) -> Column:
    x = F.log2(q) * 32
    return F.when(q <= 0, F.lit(0)).otherwise(F.floor((x - F.floor(x)) * 4096)).cast("long")


def _boundary(sums: DataFrame, rest: str, at: str, keep: list[str]) -> DataFrame:
    """Per source the bin in which the running sum passes ``rest``, and the sum before it."""
    upto = W.partitionBy("source").orderBy(at).rowsBetween(W.unboundedPreceding, W.currentRow)
    run = sums.withColumn("_cum", F.sum("_words").over(upto))
    return (run.where((F.col("_cum") > F.col(rest) + 0.5) & (F.col("_cum") - F.col("_words") < F.col(rest)))
            .groupBy("source", *keep)  # the first such bin
            .agg(F.min_by(F.struct(F.col(at).alias("at"), (F.col("_cum") - F.col("_words")).alias("before")), at)
                 .alias("_b")))


def _with(docs: DataFrame, plan: DataFrame, n_sources: int) -> DataFrame:
    """Join on the null-safe source; the side of one row per source is broadcast up to a checked size."""
    plan = plan.withColumnRenamed("source", "_source")
    side = F.broadcast(plan) if n_sources <= BROADCAST_SOURCES else plan
    return docs.join(side, docs["source"].eqNullSafe(F.col("_source")), "left").drop("_source")


def plan_mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
             weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """One row per source: source, source_size, target, copies, scale, cut."""
    sized = docs.select(F.col(source).alias("source"), F.col(key).alias("id"), word_count(text).alias("size"),
                        F.xxhash64(text).alias("h"))
    sized = materialise(_numbered(materialise(sized, "mix-lengths"), ["source", "id"], ["h"], "mix"), "mix-sizes")
    by_size = materialise(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-by-size")
    want = targets(by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
                   weights, share, cap)
    want = (want.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(
                F.col("target") / F.col("source_size") + 1e-9)).otherwise(0).cast("long"))
            .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("copies") * F.col("source_size"))))
    want = materialise(want, "mix-targets")
    n_sources = want.count()

    # The scale of the inclusion probabilities: largest documents are certain first.
    sizes = _with(by_size.where("size > 0"), want, n_sources)
    upto = W.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("source")
    mass, pull = F.col("size") * F.col("n"), F.sqrt("size") * F.col("size") * F.col("n")
    left = F.col("rest") - (F.sum(mass).over(upto) - mass)
    scales = (sizes.withColumn("_scale", left / (F.sum(pull).over(whole) - F.sum(pull).over(upto) + pull))
              .groupBy("source").agg(F.greatest(F.lit(0.0), F.max("_scale")).alias("scale")))
    plan = materialise(_with(want, scales, n_sources), "mix-scales")

    q = _odds_rank("", F.col("scale"), seed)
    ranked = (_with(sized.where("size > 0"), plan.select("source", "rest", "scale").where("rest > 0"), n_sources)
              .where("rest > 0").withColumn("q", q).withColumn("b1", _bin(F.col("q"))))
    bins = ranked.groupBy("source", "rest", "b1").agg(F.sum("size").alias("_words"))
    first = (_boundary(bins, "rest", "b1", ["rest"])
             .select("source", F.col("_b.at").alias("at1"), (F.col("rest") - F.col("_b.before")).alias("rest1")))
    first = materialise(first, "mix-bins")
    inside = (_with(ranked, first, n_sources).where("b1 = at1").withColumn("b2", _sub_bin(F.col("q"))))
    bins2 = inside.groupBy("source", "rest1", "b2").agg(F.sum("size").alias("_words"))
    second = (_boundary(bins2, "rest1", "b2", ["rest1"])
              .select("source", F.col("_b.at").alias("at2"), (F.col("rest1") - F.col("_b.before")).alias("rest2")))
    second = materialise(second, "mix-sub-bins")
    last = _with(inside, second, n_sources).where("b2 = at2")
    order = W.partitionBy("source").orderBy("q", "id", "h", "_j")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranks = last.withColumn("_before", before).withColumn("_taken", F.col("_before") + F.col("size") / 2 <= F.col("rest2"))
    # The first document not taken ends the sample.
    cut = (ranks.where("not _taken").groupBy("source")
           .agg(F.min(F.struct("q", "id", "h", "_j")).alias("cut")))
    plan = _with(plan, cut, n_sources)
    plan = _with(plan, second.select("source", "at2"), n_sources)
    plan = _with(plan, first.select("source", "at1"), n_sources)
    return materialise(plan, "mix-plan")


def apply_mix(docs: DataFrame, plan: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
              seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and taken (words taken, repeats counted)."""
    added = ["size", "source_size", "target", "taken"]
    docs = docs.drop(*[c for c in added if c not in (text, key, source)])
    rows = docs.select(*docs.columns, F.col(source).alias("_s"), F.col(key).alias("_id"), F.xxhash64(text).alias("_h"),
                       word_count(text).alias("_size"))
    rows = _numbered(rows, ["_s", "_id"], ["_h"], "mix-rows")
    rows = rows.select(*docs.columns, "_s", F.struct(F.col("_size").alias("size"), F.col("_id").alias("id"),
                                                     F.col("_h").alias("h"), "_j").alias("_d"))
    side = plan.select(F.struct(*plan.columns).alias("_p"))
    side = F.broadcast(side) if plan.count() <= BROADCAST_SOURCES else side
    rows = rows.join(side, F.col("_s").eqNullSafe(F.col("_p.source")), "left")
    q = _odds_rank("_d.", F.col("_p.scale"), seed)
    b1, b2 = _bin(q), _sub_bin(q)
    at1, at2 = F.col("_p.at1"), F.col("_p.at2")
    place = F.struct(q.alias("q"), F.col("_d.id").alias("id"), F.col("_d.h").alias("h"), F.col("_d._j").alias("_j"))
    before_cut = F.col("_p.cut").isNull() | (place < F.col("_p.cut"))
    # No boundary bin: the running sum never passes the rest, all documents are in the sample.
    sampled = (F.col("_p.rest") > 0) & (
        at1.isNull() | (b1 < at1) | ((b1 == at1) & (at2.isNull() | (b2 < at2) | ((b2 == at2) & before_cut))))
    taken = F.col("_d.size") * (F.col("_p.copies") + F.coalesce(sampled, F.lit(False)).cast("long"))
    return rows.select(*docs.columns, F.col("_d.size").alias("size"), F.col("_p.source_size").alias("source_size"),
                       F.col("_p.target").alias("target"), taken.alias("taken"))
