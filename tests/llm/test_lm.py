import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from branchlens.llm import lm_automaton as L
from branchlens.llm.queries import op4_lm
from branchlens.llm.tables import table


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(rows, order=L.ORDER, mu=L.MU):
    """Scores by plain dictionaries; rows are (id, text, train)."""
    counts = [Counter() for _ in range(order + 1)]
    for _, text, train in rows:
        if train:
            t = ["<s>"] * (order - 1) + tokens(text)
            for n in range(1, order + 1):
                counts[n].update(tuple(t[i - n + 1: i + 1]) for i in range(order - 1, len(t)))
    starts = sum(1 for r in rows if r[2])
    n_all, v = sum(counts[1].values()), len(counts[1])
    z = n_all + 0.5 * (v + 1)

    def history(h):
        return starts if set(h) == {"<s>"} else counts[len(h)][h]

    def p(w, h):
        if not h:
            return (counts[1][w,] + 0.5) / z
        return (counts[len(h) + 1][*h, w] + mu * p(w, h[1:])) / (history(h) + mu)

    for key, text, train in rows:
        t = ["<s>"] * (order - 1) + tokens(text)
        at = range(order - 1, len(t))
        yield (key, not train, len(at), sum(counts[1][t[i],] > 0 for i in at), n_all,
               sum(math.log10(p(t[i], ())) for i in at),
               sum(math.log10(p(t[i], tuple(t[i - order + 1: i]))) for i in at))


def same(got, want):
    def order(r):
        return (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_op4_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 5 != 1)
            for r in table(spark, sf_dir, "documents").collect()]
    same(op4_lm(spark, sf_dir).collect(), brute(rows))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders_edges_and_small_chunks(spark, order):
    texts = ["a b a b c", "A b\tC a", None, "", "   ", "a a a a", "zz yy xx", "a b a b c", "é É b"]
    rows = [(i if i else None, t, i % 3 != 1) for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    for sizes in ({}, {"chunk_bytes": 8, "bucket_bytes": 8}, {"piece": 1}, {"piece": 2}):
        got = L.score_documents(df, ~F.col("learn"), order=order, mu=2.0, **sizes).collect()
        same(got, brute(rows, order, 2.0))


def test_arcs_and_failures_of_a_state_sum_to_one():
    rows = [(1, "a b a c a b", True), (2, "b a", True)]
    words = ["a", "b", "c", None, "unknown"]
    for state in ("a", "b", "c", "unknown"):
        # the score of a text is the sum over its tokens, so a text's last-but-one step can be read off
        total = 0.0
        for w in words:
            path = [*brute([*rows, (9, state, False)])][-1], [*brute([*rows, (9, f"{state} {w}", False)])][-1]
            end = 10 ** (path[0][6] - _step(rows, "<s>", state))  # p(end | state)
            total += end if w is None else 10 ** (path[1][6] - _step(rows, "<s>", state) - _step(rows, w, None))
        assert total == pytest.approx(1.0)


def _step(rows, before, token):
    """log10 p(token | before) by its definition, order 2."""
    seq = [t for _, text, _ in rows for t in [["<s>", *tokens(text)]]]
    pairs = Counter(p for t in seq for p in zip(t, t[1:]))
    uni, hist = Counter(x for t in seq for x in t[1:]), Counter(x for t in seq for x in t[:-1])
    base = (uni[token] + 0.5) / (sum(uni.values()) + 0.5 * (len(uni) + 1))
    return math.log10((pairs[before, token] + L.MU * base) / (hist[before] + L.MU))


def test_no_rows_and_no_training(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert L.score_documents(df.limit(0)).collect() == []
    r = L.score_documents(df, F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.base_score == pytest.approx(0.0)
