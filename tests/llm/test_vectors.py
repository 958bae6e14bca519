import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from branchlens.llm import rp_forest, topk_pivots
from branchlens.llm.components import components
from branchlens.llm.queries import op6_vectors, op10_topk
from branchlens.llm.tables import table


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def padded(vectors):
    n = max((len(v) for v in vectors), default=0)
    return np.array([[*v, *[0.0] * (n - len(v))] for v in vectors], dtype=np.float64).reshape(len(vectors), n)


def brute_links(rows, threshold=0.95):
    """rows: (id, vector). (id, links, component) per row over all pairs."""
    good = [k for k, (_, v) in enumerate(rows) if usable(v) and any(v)]
    x = padded([rows[k][1] for k in good])
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if len(good) else x
    link = x @ x.T >= threshold if len(good) else np.zeros((0, 0), bool)
    np.fill_diagonal(link, False)
    part, (a, b) = np.arange(len(good)), np.nonzero(link)
    while True:
        before = part.copy()
        np.minimum.at(part, a, before[b])
        if (part == before).all():
            break
    names = {p: min((rows[good[k]][0] for k in np.flatnonzero(part == p) if rows[good[k]][0] is not None), default=None)
             for p in set(part.tolist())}
    out = [[i, 0, i] for i, _ in rows]
    for k, g in enumerate(good):
        out[g][1:] = [int(link[k].sum()), names[part[k]]]
    return sorted(map(tuple, out), key=str)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in df.collect()), key=str)


def test_op6_on_the_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    got = op6_vectors(spark, sf_dir)
    assert found(got) == brute_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())


def clustered(seed, n=700, dims=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 5, dims))
    x = base[rng.integers(0, len(base), n)] + rng.normal(size=(n, dims)) * rng.choice([0.0, 0.05, 0.2], (n, 1))
    return x.astype(np.float32)


def test_forest_recall_and_precision(spark):
    """Many small leaves over several rounds: no wrong link, nearly all links, one count per pair."""
    x = clustered(3)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute_links(rows)
    got = found(rp_forest.near_duplicates(df, leaf=60, sample=300, levels=2))
    true = {i: n for i, n, _ in want}
    assert all(n <= true[i] for i, n, _ in got)
    assert sum(n for _, n, _ in got) >= 0.97 * sum(true.values())


def dense(n, dims=32, seed=11):
    """One cluster in which nearly all pairs reach the threshold, and some vectors beside it."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dims)
    x = centre + rng.normal(size=(n, dims)) * np.linalg.norm(centre) * 0.03
    return np.concatenate([x, rng.normal(size=(n // 10, dims))]).astype(np.float32)


def test_recall_in_a_cluster_larger_than_a_leaf(spark):
    """A cluster of five leaves, compared in blocks, loses no link."""
    x = dense(1000)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute_links(rows)
    assert sum(n for _, n, _ in want) > 0.9 * 1000 * 999
    assert found(rp_forest.near_duplicates(df, leaf=200, sample=600, pair_block=130)) == want


def test_recall_of_clusters_inside_many_rows(spark):
    """Clusters from 2 to some leaves, among rows that link with nothing."""
    rng = np.random.default_rng(5)
    parts = [dense(n, 16, n)[:n] for n in (2, 3, 10, 60, 150, 300)] + [rng.normal(size=(900, 16)).astype(np.float32)]
    x = np.concatenate(parts)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    true = {i: n for i, n, _ in brute_links(rows)}
    got = found(rp_forest.near_duplicates(df, leaf=100, sample=400, levels=3, pair_block=64))
    assert all(n <= true[i] for i, n, _ in got)
    assert sum(n for _, n, _ in got) >= 0.9 * sum(true.values())


def test_vector_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, []),
            (7, [float("nan"), 1.0]), (8, [None, 1.0]), (9, [float("inf"), 1.0]), (None, [1.0, 0.0]), (10, [1.0]),
            (11, [1e-30, 0.0]), (12, [0.0, 1.0]), (13, [-0.0, 1.0]), (14, [1.0, 0.3286841])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n_links", F.lit("clash"))
    assert found(rp_forest.near_duplicates(df)) == brute_links(rows)
    assert rp_forest.near_duplicates(df.limit(0)).collect() == []
    assert rp_forest.near_duplicates(df.where("embedding is null")).count() == 1


def brute_top(rows, k=5, every=50):
    """Every row with an id is a candidate; the rows of a query's id share one list."""
    good = [(i, v) for i, v in rows if i is not None and usable(v)]
    x = np.floor(256 * padded([v for _, v in good])).astype(np.int64).tolist()
    for q in sorted({i for i, _ in good if i % every == 0}):
        scores = sorted((-sum(a * b for a, b in zip(y, z)), j) for (i, _), y in zip(good, x) if i == q
                        for (j, _), z in zip(good, x) if j != q)
        yield from ((q, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1))


def test_op10_on_the_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    assert sorted(map(tuple, op10_topk(spark, sf_dir).collect())) == sorted(brute_top(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_small_annuli_blocks_and_ties(spark, seed):
    x = np.round(clustered(seed, 400, 4), 1)
    x[:130] = x[0]  # a third of all rows is one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk_pivots.top_k(df, F.col("vec_id") % 10 == 0, sample_rows=90, most_pivots=9, rings=6, block=20,
                            query_slice=1, first_rows=7).collect()
    assert sorted(map(tuple, got)) == sorted(brute_top(rows, every=10))


def test_top_edges(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, []), (3, None), (4, [None, 1.0]), (5, [float("nan"), 0.0]), (50, [3.0, 1.0]),
            (50, [3.0, 1.0]), (None, [9.0, 9.0]), (7, [-1.0, -2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = topk_pivots.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(brute_top(rows))
    assert topk_pivots.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert topk_pivots.top_k(df, F.lit(False)).collect() == []


def test_rows_that_share_an_id_are_all_candidates(spark):
    one, low, high = [1.0, 0.0], [1.0, 0.0], [3.0, 0.0]
    df = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(1, one), (2, low), (2, high), (3, [0.5, 1.0])]
    got = topk_pivots.top_k(df(rows), F.col("vec_id") == 1).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 2, 196608), (1, 2, 2, 65536), (1, 3, 3, 32768)]
    rng = np.random.default_rng(8)
    rows = [(int(rng.integers(0, 40)), rng.integers(-2, 3, 3).astype(float).tolist()) for _ in range(300)]
    got = topk_pivots.top_k(df(rows), F.col("vec_id") % 10 == 0, sample_rows=50, most_pivots=5, rings=4, block=15,
                            query_slice=2, first_rows=5).collect()
    assert sorted(map(tuple, got)) == sorted(brute_top(rows, every=10))


def test_components(spark):
    rng = np.random.default_rng(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (3, None), (None, 2)]
    links += [tuple(int(v) for v in rng.integers(200, 260, 2)) for _ in range(40)]
    part = {n: n for p in links for n in p if n is not None}
    for _ in range(len(links)):
        for a, b in links:
            if a is not None and b is not None:
                part[a] = part[b] = min(part[a], part[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {n for a, b in links if a is not None and b is not None and a != b for n in (a, b)}
    assert got == {n: part[n] for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
