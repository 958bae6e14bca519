"""Near-duplicate embeddings by a forest of random-projection trees with spill overlap.

Equal vectors are one class first (partial aggregation), so a group of copies of any size
is one vector with a count. The distinct vectors are split by ``TREES`` trees: a level of a
tree projects on one random direction; a node's 45 % and 55 % quantiles bound the spill
band, and vectors inside the band go both ways, so close pairs rarely part. Quantiles come
from a bounded sample of each node's vectors (about ``SAMPLE``); every vector is routed.
Nodes that are still larger than ``LEAF`` rows after one round of levels are split further
in another round, by the same code. Splitting a node in which most vectors link with many
others would part linked pairs at every level, whatever the direction: a node whose sampled
pairs reach the threshold in at least ``DENSE`` of the cases is a leaf of whatever size.

Inside a leaf all pairs are compared by cosine in double precision. A leaf of more than
``PAIR_BLOCK`` rows is dealt to blocks, and every pair of its blocks is one task: in a dense
leaf at least one comparison in 1 / DENSE finds a link. A pair that meets in several leaves is counted in one of them: the first in the order of (tree,
leaf) that both share, which the task knows from the leaf codes that travel with a vector.
So degrees are sums, no pair leaves a task, and a task only sends one star link per vector
for the union. Nothing below the threshold is linked; the forest's recall of pairs at the
threshold is measured in the tests and stated in the README.

Edge cases: vectors that are null, zero, empty or hold null or non-finite components link
with nothing; shorter vectors are padded with zeros; repeated rows and equal vectors under
different ids link with each other; rows with a null id count as links of others and keep
their row; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .tables import materialise
from .vectors import matrix, usable

THRESHOLD = 0.95
TREES = 6
LEAF = 1500
SAMPLE = 6000
LEVELS = 7          # levels split in one round
MIN_NODE = 32       # sampled vectors below which a node is not split further
MAX_ROUNDS = 8
OVERLAP = 0.05      # share of a node on each side of its median that goes both ways
DENSE = 0.05        # share of linked pairs from which a node is not split
PAIR_BLOCK = 4096   # rows of a leaf on each side of one comparison
_PROBE = 400        # sampled vectors whose pairs tell the share


def _directions(tree: int, turn: int, dims: int, levels: int) -> np.ndarray:
    rng = np.random.default_rng([17, tree, turn])
    d = rng.normal(size=(dims, levels))
    return d / np.linalg.norm(d, axis=0)


def _unit(column, dims: int) -> np.ndarray:
    """Vectors of length one; scaled first, so that neither tiny nor huge components vanish."""
    x = matrix(column, dims)
    if not len(x):
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x ** 2).sum(axis=1, keepdims=True))


def _is_dense(x: np.ndarray, threshold: float) -> bool:
    x = x[:_PROBE]
    links = np.count_nonzero(x @ x.T >= threshold) - len(x)
    return links >= DENSE * len(x) * (len(x) - 1)


def _fit(x: np.ndarray, projected: np.ndarray, rows: float, leaf: int, threshold: float) -> np.ndarray:
    """Spill bands (lo, hi) of the nodes of one subtree in heap order; lo is nan where a node is
    a leaf, and hi is infinite where it is one because it is dense."""
    levels = projected.shape[1]
    bands = np.full((2 ** levels - 1, 2), np.nan)
    nodes = {0: np.arange(len(projected))}
    scale = rows / max(len(projected), 1)
    for level in range(levels):
        below = {}
        for node, at in nodes.items():
            if len(at) * scale <= leaf or len(at) < MIN_NODE:
                continue
            if _is_dense(x[at], threshold):
                bands[node] = np.nan, np.inf
                continue
            p = projected[at, level]
            lo, hi = np.quantile(p, [0.5 - OVERLAP, 0.5 + OVERLAP])
            if (p <= hi).all() or (p >= lo).all():
                continue  # equal projections: no progress
            bands[node] = lo, hi
            below[2 * node + 1], below[2 * node + 2] = at[p <= hi], at[p >= lo]
        nodes = below
    return bands


def _route(projected: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) of every leaf a row reaches."""
    row, node = np.arange(len(projected)), np.zeros(len(projected), dtype=np.int64)
    done_row, done_node, levels = [], [], projected.shape[1]
    for level in range(levels + 1):
        band = bands[node] if level < levels else np.full((len(node), 2), np.nan)
        stop = np.isnan(band[:, 0])
        done_row.append(row[stop])
        done_node.append(node[stop])
        row, node, band = row[~stop], node[~stop], band[~stop]
        if not len(row):
            break
        p = projected[row, level]
        left, right = p <= band[:, 1], p >= band[:, 0]
        row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
    return np.concatenate(done_row), np.concatenate(done_node)


def _split(rows: DataFrame, turn: int, dims: int, leaf: int, sample: int, levels: int, threshold: float) -> DataFrame:
    """One round: split every (tree, leaf) of ``rows`` (id, v, tree, leaf) into smaller leaves;
    ``dense`` marks rows of a leaf that must not be split."""
    sizes = rows.groupBy("tree", "leaf").agg(F.count("*").alias("n"))
    share = F.pmod(F.xxhash64(F.lit(turn), "id", "tree"), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.join(sizes, ["tree", "leaf"]).where(share < float(sample) / F.col("n"))

    def fit(group):
        tree, at, n = (group[c][0].as_py() for c in ("tree", "leaf", "n"))
        x = _unit(group["v"], dims)
        bands = _fit(x, x @ _directions(tree, turn, dims, levels), n, leaf, threshold)
        return pa.table({"tree": pa.array([tree], pa.int32()), "leaf": [at],
                         "bands": pa.array([bands.astype("<f8").tobytes()], pa.binary())})

    models = materialise(picked.groupBy("tree", "leaf").applyInArrow(fit, "tree int, leaf long, bands binary"),
                         "forest-models")

    def route(batches):
        for b in batches:
            if not len(b):
                continue
            x = _unit(b.column("v"), dims)
            trees, leaves = b.column("tree").to_numpy(), b.column("leaf").to_numpy()
            row, at, dense = [], [], []
            for key in np.unique(np.stack([trees, leaves]), axis=1).T:
                own = np.flatnonzero((trees == key[0]) & (leaves == key[1]))
                blob = b.column("bands")[int(own[0])].as_py()
                bands = (np.frombuffer(blob, "<f8").reshape(-1, 2) if blob
                         else np.full((2 ** levels - 1, 2), np.nan))
                r, node = _route(x[own] @ _directions(int(key[0]), turn, dims, levels), bands)
                row.append(own[r])
                at.append(key[1] * (2 ** (levels + 1)) + node)
                dense.append(np.isinf(np.append(bands[:, 1], np.full(2 ** levels, np.nan)))[node])
            row = np.concatenate(row)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(take), b.column("w").take(take), b.column("v").take(take),
                 b.column("tree").take(take), pa.array(np.concatenate(at)), pa.array(np.concatenate(dense))],
                names=["id", "w", "v", "tree", "leaf", "dense"])

    few = models.count() <= 64  # at most 64 models of 2 kB; more are joined by key
    joined = rows.join(F.broadcast(models) if few else models, ["tree", "leaf"], "left")
    return joined.mapInArrow(route, rows.select("id", "w", "v", "tree", "leaf", F.lit(False).alias("dense")).schema)


def _roots(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row (ids a) and column (ids b) reaches over the links of a block."""
    root_a, root_b = a.copy(), b.copy()
    open_a = linked.any(1)
    across = np.ascontiguousarray(linked.T)
    for start in np.flatnonzero(open_a):
        if not open_a[start]:
            continue
        rows, cols = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        edge = np.array([start])
        rows[start] = True
        while len(edge):
            seen = linked[edge].any(0) & ~cols
            cols |= seen
            reached = across[seen].any(0) & ~rows
            rows |= reached
            edge = np.flatnonzero(reached)
        open_a &= ~rows
        low = min(a[rows].min(), b[cols].min())
        root_a[rows], root_b[cols] = low, low
    return root_a, root_b


def _leaf_links(dims: int, threshold: float):
    """Per leaf and pair of its blocks: (id, degree counted here, smallest id linked here)."""

    def run(group):
        group = group.combine_chunks().sort_by("id")
        own, first, second = (group[c][0].as_py() for c in ("code", "low", "high"))
        block = group["block"].to_numpy()
        at_a, at_b = np.flatnonzero(block == first), np.flatnonzero(block == second)
        ids, weight, x = group["id"].to_numpy(), group["w"].to_numpy(), _unit(group["v"], dims)
        linked = np.empty((len(at_a), len(at_b)), dtype=bool)
        for at in range(0, len(at_a), 1024):
            linked[at: at + 1024] = x[at_a[at: at + 1024]] @ x[at_b].T >= threshold
        if first == second:
            np.fill_diagonal(linked, False)
        root_a, root_b = _roots(linked, ids[at_a], ids[at_b])
        # Members of this leaf that share an earlier leaf: their pairs are counted there.
        codes = [np.frombuffer(c, "<i8") for c in group["codes"].to_pylist()]
        flat = np.concatenate(codes)
        member = np.repeat(np.arange(len(ids)), [len(c) for c in codes])
        flat, member = flat[flat < own], member[flat < own]
        order = np.argsort(flat, kind="stable")
        cuts = np.flatnonzero(np.diff(flat[order])) + 1
        for m in (np.split(member[order], cuts) if len(order) else []):
            linked[np.ix_(np.flatnonzero(np.isin(at_a, m)), np.flatnonzero(np.isin(at_b, m)))] = False
        degree = linked @ weight[at_b]
        out_id, out_degree, out_root = [ids[at_a]], [degree], [root_a]
        if first != second:
            out_id.append(ids[at_b])
            out_degree.append(linked.T @ weight[at_a])
            out_root.append(root_b)
        out_id, out_degree, out_root = map(np.concatenate, (out_id, out_degree, out_root))
        used = (out_degree > 0) | (out_root != out_id)
        return pa.table({"id": out_id[used], "degree": out_degree[used], "root": out_root[used]})

    return run


def near_duplicates(vectors: DataFrame, vec: str = "embedding", key: str = "vec_id", threshold: float = THRESHOLD,
                    trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE,
                    levels: int = LEVELS, pair_block: int = PAIR_BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    ok = usable(vec) & F.exists(F.col(vec), lambda x: x != 0)
    rows = vectors.select(F.col(key).alias("row_id"), F.when(ok, F.col(vec)).alias("v"))
    # + 0.0 turns -0.0 into 0.0, so that equal vectors have equal hashes.
    same = F.transform("v", lambda x: x + F.lit(0.0).cast("float"))
    rows = rows.withColumns({"k1": F.when(F.col("v").isNotNull(), F.xxhash64(same)),
                             "k2": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(7), same, F.lit(13)))})
    classes = (rows.where("v is not null").groupBy("k1", "k2")
               .agg(F.min("row_id").alias("least"), F.count("*").alias("w"), F.min("v").alias("v")))
    # A class is named by a hash; its smallest id is only a label.
    classes = materialise(classes.withColumn("id", F.xxhash64("k1", "k2")), "forest-classes")
    dims = max(int(classes.agg(F.max(F.size("v"))).first()[0] or 1), 1)

    routed = classes.select("id", "w", "v", F.explode(F.array(*[F.lit(t) for t in range(trees)])).alias("tree"),
                            F.lit(0).cast("long").alias("leaf"))
    settled = None
    for turn in range(MAX_ROUNDS):
        routed = materialise(_split(routed, turn, dims, leaf, sample, levels, threshold), f"forest-{turn}")
        large = (routed.where("not dense").groupBy("tree", "leaf").agg(F.count("*").alias("n"))
                 .where(F.col("n") > 2 * leaf).select("tree", "leaf"))
        large = materialise(large, "forest-large")
        if not large.limit(1).count():
            break
        small = routed.join(large, ["tree", "leaf"], "left_anti")
        settled = small if settled is None else settled.unionByName(small)
        routed = routed.join(large, ["tree", "leaf"])
    leaves = routed if settled is None else settled.unionByName(routed)
    # One number per (tree, leaf), ordered by tree: it names the leaf and decides which leaf counts a pair.
    leaves = materialise(leaves.withColumn("code", F.col("tree").cast("long") * (1 << 56) + F.pmod(
        F.xxhash64("tree", "leaf"), F.lit(1 << 56))), "forest-leaves")
    codes = leaves.groupBy("id").agg(F.sort_array(F.collect_set("code")).alias("codes"))

    def packed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([np.array(c, "<i8").tobytes() for c in b.column("codes").to_pylist()],
                                          pa.binary())], names=["id", "codes"])

    codes = codes.mapInArrow(packed, "id long, codes binary")
    n_blocks = materialise(leaves.groupBy("code").agg(F.ceil(F.count("*") / pair_block).cast("int").alias("n_blocks")),
                           "forest-blocks")
    dealt = (leaves.join(codes, "id").join(n_blocks, "code")
             .withColumn("block", F.pmod(F.xxhash64(F.lit(3), "id"), F.col("n_blocks")).cast("int"))
             .select("code", "id", "w", "v", "codes", "block",
                     F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")))
    found = (dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
             .groupBy("code", "low", "high")
             .applyInArrow(_leaf_links(dims, threshold), "id long, degree long, root long"))
    found = materialise(found, "forest-links")
    degrees = found.groupBy("id").agg(F.sum("degree").alias("degree"))
    parts = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_class = (classes.select("id", "k1", "k2", "least", "w").join(degrees, "id", "left")
                 .join(parts.withColumnRenamed("node", "id"), "id", "left")
                 .withColumn("component", F.coalesce("component", "id")))
    names = per_class.groupBy("component").agg(F.min("least").alias("smallest"))
    per_class = materialise(per_class.join(names, "component").select(
        "k1", "k2", (F.coalesce("degree", F.lit(0)) + F.col("w") - 1).alias("n_links"), "smallest"), "forest-result")
    out = rows.select("row_id", "k1", "k2").join(per_class, ["k1", "k2"], "left")
    component: Column = F.coalesce("smallest", "row_id")
    return out.select(F.col("row_id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (F.col("row_id") == component).alias("kept"))
