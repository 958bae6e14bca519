import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from branchlens.llm import mixing, packing, prefix_tree_join, quality_fm
from branchlens.llm.queries import op1_quality, op8_jaccard, op9_mix
from branchlens.llm.tables import table

from test_lines import brute as brute_lines
from test_packing import check

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def jaccard_components(rows):
    """rows: (id, text); component by brute force over all pairs."""
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k: k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    ids = sorted(sets)
    part = {i: i for i in ids}

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            x, y = sets[i], sets[j]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                part[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in ids}


def variants(seed, n=90, words=40):
    rng = random.Random(seed)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, words))] for _ in range(8)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 5)}"
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w).upper() if rng.random() < 0.2 else " ".join(w)))
    return rows


@pytest.mark.parametrize("seed, block_sets", [(1, 4000), (2, 4000), (3, 3), (4, 5)])
def test_join_equals_brute_force_also_in_slices(spark, seed, block_sets):
    join_in_slices(spark, seed, block_sets, {})


@pytest.mark.parametrize("seed, block_sets, hot_sets", [(5, 3, 0), (6, 5, 2), (7, 8, 4)])
def test_first_shingles_that_many_sets_share(spark, seed, block_sets, hot_sets):
    """Shingles above the bound are compared in tries of two blocks, the others pair by pair."""
    join_in_slices(spark, seed, block_sets, {"hot_sets": hot_sets})


def join_in_slices(spark, seed, block_sets, more):
    rows = variants(seed) + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two")]
    want = jaccard_components(rows)
    got = prefix_tree_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"),
                                             block_sets=block_sets, chunk_bytes=2000, bucket_bytes=3000, **more).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)


def test_join_of_repeated_and_unnamed_rows(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "A b c d e"), (None, "a b c d e"), (None, "z"), (3, "q r s t u")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = prefix_tree_join.similar_documents(df).collect()
    assert sorted(((r.doc_id or 0), r.component_id or 0) for r in got) == [(0, 0), (0, 1), (1, 1), (1, 1), (2, 1), (3, 3)]
    assert prefix_tree_join.similar_documents(df.limit(0)).collect() == []


def test_trie_walk_finds_all_links():
    rng = np.random.default_rng(5)
    for _ in range(40):
        sets = [np.unique(rng.integers(0, 30, rng.integers(1, 25))) for _ in range(rng.integers(3, 20))]
        sizes = np.array([len(s) + rng.integers(0, 3) for s in sets])
        root = prefix_tree_join.linked([s.astype(np.uint64) for s in sets], sizes, 60)
        part = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 60 * (sizes[i] + sizes[j] - both):
                    lo, hi = sorted((part[i], part[j]))
                    part = [lo if p == hi else p for p in part]
        assert root.tolist() == part


def test_quality_learns_and_needs_only_texts(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    got = op1_quality(spark, sf_dir).collect()
    right = [r.predicted == labels[r.doc_id] for r in got if r.held_out and labels.get(r.doc_id) is not None]
    assert len(right) > 10 and sum(right) / len(right) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_quality_edges(spark):
    rows = [(i, ("good words here and there " * 5) if i % 2 else "### %%% ### " * 9) for i in range(60)]
    docs = spark.createDataFrame([*rows, (100, None), (101, ""), (102, "w " * 100_000), (None, "x")],
                                 "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0), (None, 1), (4, None), (5, 7)],
                                   "doc_id long, quality int")
    out = quality_fm.score(docs, quality_fm.train(docs, labels)).collect()
    assert len(out) == 64 and all(0 <= r.score <= 1 for r in out)
    assert all((r.score >= 0.5) == bool(r.doc_id % 2) for r in out if r.doc_id is not None and r.doc_id < 60)
    assert quality_fm.score(docs.limit(0), quality_fm.train(docs, labels.limit(0))).collect() == []
    assert {r.score for r in quality_fm.score(docs, quality_fm.train(docs, labels.limit(0))).collect()} == {0.5}


def test_factorisation_identity():
    rng = np.random.default_rng(1)
    n = quality_fm.BUCKETS + quality_fm.DENSE
    m = quality_fm.FactorisationMachine(0.1, rng.normal(size=n), rng.normal(size=(n, quality_fm.RANK)) * 0.1)
    data = np.frombuffer("some words, some MORE words!\nand lines".encode(), np.uint8)
    key_doc, bucket, weight, dense = quality_fm.features(data, np.array([0, len(data)]))
    idx = np.concatenate([bucket, quality_fm.BUCKETS + np.arange(quality_fm.DENSE)])
    x = np.concatenate([weight, dense[0]])
    y = m.bias + m.linear[idx] @ x + sum(m.factors[idx[i]] @ m.factors[idx[j]] * x[i] * x[j]
                                         for i in range(len(x)) for j in range(i))
    assert m.scores(key_doc, bucket, weight, dense)[0] == pytest.approx(1 / (1 + math.exp(-y)))


def mix_brute(spark, rows, weights=mixing.WEIGHTS):
    """rows: (id, size, source). Targets by re-sharing in rounds, samples by plain sorting."""
    names = sorted({s for *_, s in rows if s is not None}) + [None] * any(s is None for *_, s in rows)
    total = {s: sum(n for _, n, t in rows if t == s) for s in names}
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    want, capped = {}, set()
    while True:
        left = 1.5 * sum(total.values()) - sum(2.0 * total[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        want = {s: 2.0 * total[s] if s in capped else left * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and want[s] > 2.0 * total[s]}
        if not over:
            break
        capped |= over
    ids = spark.createDataFrame([(i,) for i, *_ in rows], "id long").distinct()
    u = {r.id: (r.h + 0.5) / (1 << 52) for r in ids.select(
        "id", F.pmod(F.xxhash64(F.lit(mixing.SEED), "id"), F.lit(1 << 52)).alias("h")).collect()}
    taken = {}
    for s in names:
        own = [(i, n) for i, n, t in rows if t == s]
        copies = math.floor(want[s] / total[s] + 1e-9) if total[s] else 0
        rest = max(0.0, want[s] - copies * total[s])
        lo, hi = 0.0, 1.0
        for _ in range(200):
            c = (lo + hi) / 2
            lo, hi = (c, hi) if sum(min(1, c * math.sqrt(n)) * n for _, n in own) < rest else (lo, c)
        ranked = []
        for i, n in own:
            pi = min(1.0, lo * math.sqrt(n))
            q = 0.0 if pi >= 1 - 1e-12 else math.inf if pi <= 0 else u[i] / (1 - u[i]) / (pi / (1 - pi))
            ranked.append((q, i, n))
        run = 0
        sample = set()
        for q, i, n in sorted(ranked):
            if n and (run + n / 2 > rest or not rest):
                break
            sample.add(i)
            run += n
        for i, n in own:
            taken[i] = n * (copies + (i in sample))
    return total, want, taken


def mix_same(spark, got, rows):
    total, want, taken = mix_brute(spark, rows)
    source = {i: s for i, _, s in rows}
    assert len(got) == len(rows)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == total[s] and r.target == pytest.approx(want[s]) and r.taken <= 2 * r.size
        assert r.taken == taken[r.doc_id], (r, s)


def test_op9_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, len(WORD.findall(r.text or "")), r.source) for r in table(spark, sf_dir, "documents").collect()]
    mix_same(spark, op9_mix(spark, sf_dir).collect(), rows)
    again = [sorted(map(tuple, op9_mix(spark, sf_dir).collect())) for _ in range(2)]
    assert again[0] == again[1]


def test_mix_edges(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["b", "a", "é", "Z", None]), 5)
            for i in range(400)]
    docs += [(1000, None, "a", 1), (1001, "one", "tiny", 1), (1002, "", "empty", 1), (1003, "w " * 5000, "giant", 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, taken int")
    got = mixing.apply_mix(df, mixing.plan_mix(df)).collect()
    mix_same(spark, got, [(i, len(WORD.findall(t or "")), s) for i, t, s, _ in docs])
    assert mixing.apply_mix(df.limit(0), mixing.plan_mix(df.limit(0))).collect() == []


def test_mix_of_rows_that_share_an_id(spark):
    """Each row of an id has its own random number, so targets are met, and reruns agree."""
    docs = [(7, "w " * (25 if i % 2 else 30), "a") for i in range(100)] + [(7, "v " * 20, "a")] * 100
    docs += [(i, "w " * 40, "b") for i in range(100, 160)] + [(None, "x " * 15, "c")] * 90
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(7)
    got = [mixing.apply_mix(d, mixing.plan_mix(d)).collect() for d in (df, df.repartition(3, F.rand(5)))]
    assert len(got[0]) == len(docs)
    for s in "abc":
        rows = [r for r in got[0] if r.source == s]
        total, target, taken = sum(r.size for r in rows), rows[0].target, sum(r.taken for r in rows)
        assert rows[0].source_size == total and abs(taken - target) <= 30
        assert all(r.taken <= 2 * r.size for r in rows)
    bag = [sorted((str(r.doc_id), r.text, r.taken) for r in g) for g in got]
    assert bag[0] == bag[1]


def without_long_lines(rows):
    """Texts without the lines of 50 words and more that an earlier place has; empty ones go."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        lines, kept = (t or "").split("\n"), []
        for line in lines:
            bare = line.strip(" \t\x0b\x0c\r")
            if len(WORD.findall(bare)) >= 50 and bare in seen:
                continue
            seen.add(bare)
            kept.append(line)
        if len(kept) == len(lines) or any(x.strip(" \t\x0b\x0c\r") for x in kept):
            out[i] = None if t is None else "\n".join(kept)
    return out


def test_stages_and_run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = {r.doc_id: r.score for r in op1_quality(spark, sf_dir).collect()}
    one = P.quality_stage(spark, docs, sf_dir).cache()
    assert {r.doc_id for r in one.collect()} == {i for i, s in scored.items() if s >= 0.5}
    two = P.line_stage(spark, one, sf_dir).cache()
    runs = [(i, t) for i, t, n, k in brute_lines([(r.doc_id, r.text) for r in one.collect()], 2) if n == 0 or k < n]
    assert {r.doc_id: r.text for r in two.collect()} == without_long_lines(runs)
    three = P.near_duplicate_stage(spark, two, sf_dir).cache()
    parts = jaccard_components([(r.doc_id, r.text) for r in two.collect()])
    assert sorted(r.doc_id for r in three.collect()) == sorted(i for i, (_, c) in parts.items() if i == c)
    four = P.mixing_stage(spark, three, sf_dir).cache()
    rows = [(r.doc_id, len(WORD.findall(r.text or "")), r.source) for r in three.collect()]
    _, _, taken = mix_brute(spark, rows)
    times = {i: taken[i] // n for i, n, _ in rows if taken[i]}
    got = {}
    for r in four.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == times
    assert all(x.columns == P.COLUMNS for x in (one, two, three, four))
    final = P.run(spark, sf_dir).collect()
    first = {}
    for r in final:
        first[r.doc_id] = first.get(r.doc_id, 0) + (r.piece == 0)
    assert first == times
    lengths = np.array([r.length for r in final])
    assert check(final, 2048) <= packing.lower_bound(lengths) + 1


def test_stages_take_odd_rows(spark, sf_dir):
    text = "first line here\nsecond line here\nthird line here"
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (None, "some words", None, None, None),
            (2, None, "en", None, 0), (3, "", "en", "s", 0), (4, "long words here " * 30_000, "en", "t", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in P.STAGES:
            docs = stage(spark, docs, sf_dir).cache()
            docs.count()


def near_copy_survivors(rows, words, percent):
    """Smallest ids of the components that brute force finds at ``words`` and ``percent``."""
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k: k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    ids = sorted(sets)
    part = {i: i for i in ids}
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            x, y = sets[i], sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y) and part[i] != part[j]:
                lo, hi = sorted((part[i], part[j]))
                part = {k: lo if p == hi else p for k, p in part.items()}
    return sorted(i for i in ids if part[i] == i)


def test_near_duplicate_stage_takes_five_words_and_four_fifths(spark, sf_dir):
    # One word of 50 differs: 41 of 51 shingles of five words are common (0.804), 43 of 51 of four words (0.843).
    words = [f"w{k}" for k in range(50)]
    rows = [(900, " ".join(words)), (901, " ".join([*words[:25], "other", *words[26:]])), *variants(6)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(r.doc_id for r in P.near_duplicate_stage(spark, docs, sf_dir).collect())
    assert 900 in got and 901 not in got
    assert got == near_copy_survivors(rows, 5, 80)


def test_long_single_lines_go_between_other_lines(spark, sf_dir):
    def passage(name, n):
        return " ".join(f"{name}{k}" for k in range(n))

    texts = [(1, f"one\n{passage('p', 50)}\nend"), (2, f"two\n\t{passage('p', 50)} \nlast"), (3, passage("p", 50)),
             (4, f"four\n{passage('q', 49)}"), (5, f"five\n{passage('q', 49)}"), (6, None), (7, ""),
             (8, f"{passage('r', 200)}\nmid\n{passage('r', 200)}"), (9, passage("s", 60).replace(" ", " \t ", 20))]
    docs = spark.createDataFrame([(i, t, "en", "s", 7) for i, t in texts],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in P.without_long_repeats(docs).collect()}
    want = {i: (t, 7) for i, t in texts if i != 3}
    want[2] = ("two\nlast", 8)
    want[8] = (f"{passage('r', 200)}\nmid", len(passage("r", 200)) + 4)
    assert got == want
    assert {r.doc_id: (r.text, r.n_chars) for r in P.line_stage(None, docs, None).collect()} == want
    assert [name for name, _ in P.STAGES] == ["quality", "lines", "near duplicates", "mixing", "packing"]
