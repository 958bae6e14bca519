"""Exact top-k inner product by a pivot-distance index.

Vectors are integers, floor(scale * x). Every vector is keyed by its nearest pivot and its
distance to it; equal-width distance rings of a pivot are the annuli of the index. The
pivots come from a bounded sample (``SAMPLE`` rows, smallest hash of the id), every row is
indexed.

For a query q and an annulus of pivot p with distances in [lo, hi] and squared norms up to
M, the triangle inequality gives |q - x| >= gap = max(0, |q-p| - hi, lo - |q-p|), and so

    q.x = (|q|^2 + |x|^2 - |q-x|^2) / 2 <= (|q|^2 + M - gap^2) / 2
    q.x <= q.p + |q| * hi,      q.x <= |q| * sqrt(M)

The search expands the annuli of a query in the order of that bound: first those that hold
``FIRST`` candidates together, which gives the k-th best score so far, then every annulus
whose bound still reaches that score. All others cannot hold a better or an equal score, so
the result is exact. The annulus table has at most ``PIVOTS * RINGS`` rows.

A task compares one block of an annulus (at most about ``BLOCK`` rows) with one slice of
the queries that ask for it (about ``QUERIES``): hot annuli, such as many copies of one
vector, are several blocks, and only (annulus, slice) pairs that occur meet.

Edge cases: vectors that are null or hold null or non-finite components, and rows with a
null id, take no part; shorter vectors are padded with zeros; an empty vector is zero; rows
that share an id are candidates of their own, none of them for a query of that id, and as
queries they share one list (a candidate is in it once for each of them); equal rows are
indexed once, with their number; ties go to the smaller id; with fewer than k candidates all
are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .tables import materialise
from .vectors import matrix, usable

SCALE = 256
SAMPLE = 4096
PIVOTS = 96
RINGS = 24
BLOCK = 8192
QUERIES = 4096
FIRST = 512


def _ints(column, dims: int) -> np.ndarray:
    return np.floor(matrix(column, dims) * SCALE).astype(np.int64)


def _blobs(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x, dtype="<i8")], pa.binary())


def _from_blobs(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i8").reshape(-1, dims)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles are exact up to 2**53."""
    if a.size and b.size and np.abs(a).max() * float(np.abs(b).max()) * a.shape[1] < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def fit_pivots(sample: np.ndarray, n: int, most: int = PIVOTS, rings: int = RINGS, seed: int = 5) -> tuple[np.ndarray, float]:
    """Pivots (a few rounds of k-means over the sample) and the width of a ring."""
    k = int(min(most, max(1, round(np.sqrt(n) / 10)), len(sample)))
    rng = np.random.default_rng(seed)
    pivots = sample[rng.choice(len(sample), k, replace=False)].astype(np.float64)
    for _ in range(6):
        near = _distances(sample, pivots).argmin(1)
        for j in range(k):
            if (near == j).any():
                pivots[j] = sample[near == j].mean(0)
    spread = _distances(sample, pivots).min(1)
    return pivots, max(float(np.quantile(spread, 0.98)) / max(rings - 1, 1), 1e-9)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    squared = (x ** 2).sum(1)[:, None] + (pivots ** 2).sum(1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squared, 0))


def _key(x: np.ndarray, pivots: np.ndarray, width: float, rings: int) -> tuple[np.ndarray, np.ndarray]:
    """Annulus number and exact distance to the nearest pivot."""
    near = _distances(x, pivots).argmin(1)
    dist = np.sqrt(((x - pivots[near]) ** 2).sum(1))
    return near * rings + np.minimum(dist // width, rings - 1).astype(np.int64), dist


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best per row: score descending, id ascending (ids are sorted)."""
    if scores.shape[1] <= k:
        return np.argsort(-scores, axis=1, kind="stable")
    kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
    out = np.empty((len(scores), k), dtype=np.int64)
    for r in range(len(scores)):
        at = np.flatnonzero(scores[r] >= kth[r])  # in order of id
        out[r] = at[np.argsort(-scores[r, at], kind="stable")[:k]]
    return out


def top_k(vectors: DataFrame, is_query, k: int = 5, vec: str = "embedding", key: str = "vec_id",
          sample_rows: int = SAMPLE, most_pivots: int = PIVOTS, rings: int = RINGS, block: int = BLOCK,
          query_slice: int = QUERIES, first_rows: int = FIRST) -> DataFrame:
    """query_id, rank, vec_id, score for the rows where the Column ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = (vectors.where(usable(vec) & F.col(key).isNotNull())
            .select(F.col(key).cast("long").alias("id"), F.col(vec).alias("v"), is_query.alias("ask"))
            .groupBy("id", "v").agg(F.max("ask").alias("ask"), F.count("*").alias("w")))
    rows = materialise(rows, "topk-vectors")
    n, dims, n_asking = rows.agg(F.count("*"), F.max(F.size("v")), F.count_if("ask")).first()
    dims = max(int(dims or 0), 1)
    result = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], result)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow()
    pivots, width = fit_pivots(_ints(sample["v"], dims), n, most_pivots, rings)

    def keyed(batches):
        for b in batches:
            if not len(b):
                continue
            x = _ints(b.column("v"), dims)
            cell, dist = _key(x, pivots, width, rings)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("w"), b.column("ask"), pa.array(cell), pa.array(dist),
                 pa.array((x.astype(np.float64) ** 2).sum(1)), _blobs(x)],
                names=["id", "w", "ask", "cell", "dist", "norm2", "x"])

    index = materialise(rows.mapInArrow(
        keyed, "id long, w long, ask boolean, cell long, dist double, norm2 double, x binary"), "topk-index")
    annuli = sorted(index.groupBy("cell").agg(F.count("*").alias("n"), F.min("dist").alias("lo"),
                                              F.max("dist").alias("hi"), F.max("norm2").alias("norm2"))
                    .collect(), key=lambda r: r.cell)  # at most PIVOTS * RINGS rows
    cells = np.array([r.cell for r in annuli], dtype=np.int64)
    count, lo, hi, norm2 = (np.array([getattr(r, c) for r in annuli], dtype=np.float64)
                            for c in ("n", "lo", "hi", "norm2"))
    centre = pivots[cells // rings]
    blocks = dict(zip(cells.tolist(), np.ceil(count / block).astype(int).tolist()))

    def bounds(x: np.ndarray) -> np.ndarray:
        size = (x.astype(np.float64) ** 2).sum(1)[:, None]
        away = np.sqrt(((x[:, None, :] - pivots[None]) ** 2).sum(2))[:, cells // rings]
        gap = np.maximum(0, np.maximum(away - hi, lo - away))
        top = np.minimum((size + norm2 - gap ** 2) / 2, x @ centre.T + np.sqrt(size) * hi)
        return np.minimum(top, np.sqrt(size * norm2)) * (1 + 1e-9) + 1e-3

    def asked(pick):
        """Requests (annulus, block, query) of a batch of queries; ``pick`` says which annuli."""
        def run(batches):
            for b in batches:
                for at in range(0, len(b), 256):
                    part = b.slice(at, 256)
                    x = _from_blobs(part.column("x"), dims)
                    q, c = np.nonzero(pick(bounds(x), part))
                    times = np.array([blocks[int(v)] for v in cells[c]], dtype=np.int64)
                    q, c = np.repeat(q, times), np.repeat(c, times)
                    part_of = np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times)
                    take = pa.array(q)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells[c]), pa.array(part_of, pa.int64()), part.column("id").take(take),
                         part.column("w").take(take), part.column("x").take(take)],
                        names=["cell", "block", "id", "w", "x"])
        return run

    def in_first(bound: np.ndarray) -> np.ndarray:
        """The annuli of highest bound that hold FIRST candidates together."""
        order = np.argsort(-bound, axis=1, kind="stable")
        before = np.cumsum(count[order], axis=1) - count[order]
        chosen = np.zeros(bound.shape, dtype=bool)
        np.put_along_axis(chosen, order, before < first_rows, axis=1)
        return chosen

    def compare(_, stored, asking):
        stored = stored.combine_chunks().sort_by("id")
        if not len(stored) or not len(asking):
            return empty
        ids, x, times = stored["id"].to_numpy(), _from_blobs(stored["x"], dims), stored["w"].to_numpy()
        who, y, asks = asking["id"].to_numpy(), _from_blobs(asking["x"], dims), asking["w"].to_numpy()
        out = []
        for at in range(0, len(who), 512):
            scores = _products(y[at: at + 512], x)
            scores[who[at: at + 512, None] == ids[None]] = np.iinfo(np.int64).min  # rows of the query's own id
            best = _best(scores, ids, k)
            got = np.take_along_axis(scores, best, axis=1)
            asker = np.broadcast_to(who[at: at + 512, None], best.shape)
            real = got != np.iinfo(np.int64).min
            n = np.minimum(times[best] * asks[at: at + 512, None], k)
            out.append(pa.table({"query_id": asker[real], "vec_id": ids[best][real], "score": got[real], "n": n[real]}))
        return pa.concat_tables(out)

    empty = pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score", "n")})
    request = "cell long, block long, id long, w long, x binary"
    slice_of = lambda: F.pmod(F.xxhash64("id", "x"), F.lit(max(1, -(-n_asking // query_slice))))
    # At most PIVOTS * RINGS rows: a proven bound for the broadcast.
    sizes = spark.createDataFrame(list(blocks.items()), "cell long, n_blocks int")
    stored = index.join(F.broadcast(sizes), "cell").select(
        "cell", F.pmod(F.xxhash64("id", "x"), F.col("n_blocks")).alias("block"), "id", "w", "x")

    def answers(requests: DataFrame, name: str) -> DataFrame:
        requests = materialise(requests.withColumn("part", slice_of()), name)
        wanted = requests.select("cell", "block", "part").distinct()
        left = stored.join(wanted, ["cell", "block"]).groupBy("cell", "block", "part")
        right = requests.toDF("ask_cell", "ask_block", "id", "w", "x", "ask_part").groupBy("ask_cell", "ask_block", "ask_part")
        return left.cogroup(right).applyInArrow(compare, "query_id long, vec_id long, score long, n long")

    def best(found: DataFrame) -> DataFrame:
        each = found.select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("col")
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
        return each.withColumn("rank", rank).where(F.col("rank") <= k)

    queries = index.where("ask").select("id", "w", "x")
    first = materialise(best(answers(queries.mapInArrow(asked(lambda bound, _: in_first(bound)), request),
                                     "topk-ask-1")).drop("rank"), "topk-first")
    reached = first.groupBy("query_id").agg(F.count("*").alias("_n"), F.min("score").alias("_s"))
    open_queries = queries.join(reached, F.col("id") == F.col("query_id"), "left").select(
        "id", "w", "x", F.when(F.col("_n") >= k, F.col("_s").cast("double")).otherwise(float("-inf")).alias("score"))

    def remaining(bound, part):
        return ~in_first(bound) & (bound >= part.column("score").to_numpy()[:, None])

    second = answers(open_queries.mapInArrow(asked(remaining), request), "topk-ask-2")
    merged = best(first.select("query_id", "vec_id", "score", F.lit(1).cast("long").alias("n")).unionByName(second))
    return merged.select("query_id", "rank", "vec_id", "score")
