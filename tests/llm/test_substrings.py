import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from branchlens.llm import chunked as C, substring_anchors as S, textops as X
from branchlens.llm.queries import op2_substrings
from branchlens.llm.tables import table


def brute(rows, window):
    """rows: (id, text). (id, words, removed, kept) with every window judged on the input."""
    words = [(t or "").encode().split() for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        if i is not None:
            for p in range(len(w) - window + 1):
                k = tuple(w[p: p + window])
                least[k] = min(least.get(k, i), i)
    for (i, _), w in zip(rows, words):
        gone = set()
        for p in range(len(w) - window + 1 if i is not None else 0):
            if least[tuple(w[p: p + window])] < i:
                gone.update(range(p, p + window))
        yield i, len(w), len(gone), b" ".join(x for n, x in enumerate(w) if n not in gone).decode()


def order(r):
    return (r[0] is None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("window, seed", [(5, 1), (5, 2), (6, 3), (2, 4), (1, 5)])
def test_random_documents_equal_brute_force(spark, window, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 50), rng.choice([" ", "\n", " \t "]).join(
        rng.choice("abé") for _ in range(rng.randint(0, 30)))) for _ in range(80)]
    rows += [(None, "a b a b a b a"), (60, None), (61, ""), (62, "  ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(brute(rows, window), key=order)
    for sizes in ({}, {"chunk_bytes": 100, "bucket_bytes": 200}):
        got = S.remove_repeats(df, window=window, **sizes).collect()
        assert sorted(map(tuple, got), key=order) == want


def test_op2_on_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    want = sorted((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute(rows, 50))
    assert sorted(map(tuple, op2_substrings(spark, sf_dir).collect())) == want


def test_long_text_empty_table_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(2, long, 1, "x"), (1, " ".join(f"w{i}" for i in range(1000, 1100)), 2, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, chunk string")
    got = {r.doc_id: r.n_removed for r in S.remove_repeats(df).collect()}
    assert got == {1: 0, 2: 100}
    assert S.remove_repeats(df.limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), max_size=40), st.lists(st.integers(-2 ** 63, 2 ** 63 - 1), max_size=20))
def test_packing_round_trips(unsigned, signed):
    a = np.sort(np.array(unsigned, dtype=np.uint64))
    assert (X.unpack(X.pack(a)) == a).all()
    b = np.array(signed, dtype=np.int64)
    assert (X.unplanes(X.planes(b)) == b).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aB é\t\n\x0b\x1c ß", max_size=20), max_size=6))
def test_words_equal_split(texts):
    import pyarrow as pa
    data, offs = X.text_bytes(pa.array(texts, pa.string()))
    w = X.Words(data, offs)
    got = [bytes(data[s:e]) for s, e in zip(w.starts, w.ends)]
    assert got == [x for t in texts for x in t.encode().split()]
    assert w.counts.tolist() == [len(t.encode().split()) for t in texts]
    same = {}
    for x, h in zip(got, w.hashes.tolist()):
        assert same.setdefault(x, h) == h
    assert len(set(same.values())) == len(same)


def test_runs_and_bits():
    keys = np.array([5, 3, 5, 9, 3, 5], dtype=np.uint64)
    r = C.Runs(keys)
    assert r.keys.tolist() == [3, 5, 9] and r.spread(np.array([1, 2, 3])).tolist() == [2, 1, 2, 3, 1, 2]
    assert r.flagged(np.array([0, 1, 0, 0, 0, 0], bool)).tolist() == [True, False, False]
    assert C.from_bits(C.bits(np.array([1, 0, 1], bool)), 3).tolist() == [True, False, True]
