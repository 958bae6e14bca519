"""N-gram Jaccard join over prefix trees.

A document's set are its distinct shingles of ``SHINGLE`` words, A-Z in lower case. Two
documents link when 100 * |intersection| >= 85 * |union|.

1. Equal sets are one class (pre-aggregated by a hash of the set), so copies cost nothing
   beyond one row each.
2. All shingles get one global order: by the number of classes that hold them (counted
   over the whole corpus, see ``chunked``; 255 stands for 255 and more), then by hash. A
   set can only reach the threshold with another one if they share one of its first
   |x| - ceil(0.85 |x|) + 1 shingles in that order; sets whose first shingles nobody else
   has are alone, which settles most of a corpus without comparing anything.
3. Sets that share such a shingle, directly or over others, form a block (connected
   components of the shared first shingles), so every possible link is inside one block
   and every set is shuffled once.
4. Inside a block the ordered sets are a trie with shared edges. Each set walks down the
   trie level by level; the overlap with an edge is added once for all sets below it, and
   a subtree is left as soon as the overlap so far plus the shorter of both remainders, or
   the sizes below it, cannot reach the threshold, or when it is linked already. Overlaps
   are exact; shingles are compared by 56 bits of hash (and their frequency).
5. A block of more than ``BLOCK_SETS`` sets or ``BLOCK_TOKENS`` shingles is cut into slices.
   One set of every component of a slice goes on to a further round until they fit one slice;
   then the sets that share a first shingle across the remaining components are compared, so
   no link is lost: shingle by shingle, pair by pair where few sets have it, and in tries of
   two blocks of its sets, one task each, where more than ``HOT_SETS`` have it.

Only (set, smallest linked set) pairs leave a task; ``components`` unites them.

Edge cases: null, empty and blank texts have no shingle and link with nothing; fewer than
SHINGLE words are one shingle; repeated rows and texts that differ in case or white space
are one class; a null id never names a component and its row gets the component of its
class (null if alone); other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import chunked as C
from .components import components
from .tables import materialise
from .textops import Words, gram_hashes, mix, pack, planes, slices, span_hashes, text_bytes, unpack, unplanes

SHINGLE = 4
PERCENT = 85
BLOCK_SETS = 4000
BLOCK_TOKENS = 8 << 20
GROUP_SETS = 1500  # sets of small blocks that share a task's group
GROUP_TOKENS = 2 << 20
HOT_SETS = 200

_TAIL = np.uint64((1 << 56) - 1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every document: n_docs + 1 offsets and hashes, ascending per document."""
    w = Words(data, offsets, fold_case=True)
    _, docs, hashes = gram_hashes(w.hashes, w.first, n)
    for short in range(1, n):
        at = np.flatnonzero(w.counts == short)
        docs = np.concatenate([docs, at])
        hashes = np.concatenate([hashes, span_hashes(w.hashes, w.first[at], short)])
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    fresh = np.ones(len(docs), dtype=bool)
    fresh[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    docs, hashes = docs[fresh], hashes[fresh]
    return np.searchsorted(docs, np.arange(len(offsets))), hashes


def set_names(first: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set (0, 0 for the empty set)."""
    out = []
    for salt in (0x51, 0xA7):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)), dtype=np.uint64)])
        name = mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64))
        out.append(np.where(np.diff(first) > 0, name, 0).astype(np.uint64).view(np.int64))
    return out[0], out[1]


def least_overlap(a, b, percent: int = PERCENT):
    """Smallest intersection of sets of sizes a and b that links them."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n, percent: int = PERCENT):
    return n - -(-percent * n // 100) + 1


class Trie:
    """Path-compressed trie of sets given as ascending ranks; leaves are in sorted order."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        keys = [s.astype(">u4").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.sets, self.sizes = [sets[i] for i in self.order], sizes[self.order]
        # A node: parent, the set whose tokens label the edge, edge from / to depth, leaves from / to.
        nodes: list[list[int]] = [[-1, 0, 0, 0, 0, 0]]
        path = [0]
        for i, s in enumerate(self.sets):
            common = 0
            if i:
                before = self.sets[i - 1]
                k = min(len(before), len(s))
                differ = np.flatnonzero(before[:k] != s[:k])
                common = int(differ[0]) if len(differ) else k
            while nodes[path[-1]][3] > common:
                node = path.pop()
                nodes[node][5] = i
                parent = path[-1]
                if nodes[parent][3] < common:  # split the edge at the common depth
                    nodes.append([parent, nodes[node][1], nodes[node][2], common, nodes[node][4], 0])
                    nodes[node][0], nodes[node][2] = len(nodes) - 1, common
                    path.append(len(nodes) - 1)
            nodes.append([path[-1], i, common, len(s), i, 0])
            path.append(len(nodes) - 1)
        for node in path:
            nodes[node][5] = len(self.sets)
        a = np.array(nodes, dtype=np.int64)
        self.parent, self.label, self.top, self.bottom, self.low, self.high = a.T
        self._levels()
        spans = np.stack([self.low, self.high], axis=1).ravel()
        ends = np.append(self.sizes, 0)
        self.size_min = np.minimum.reduceat(np.append(self.sizes, np.iinfo(np.int64).max), spans)[::2]
        self.size_max = np.maximum.reduceat(ends, spans)[::2]
        lengths = np.append([len(s) for s in self.sets], 0)
        self.left_max = np.maximum.reduceat(lengths, spans)[::2] - self.bottom
        self.last = np.array([self.sets[i][b - 1] if b else -1 for i, b in zip(self.label, self.bottom)])
        self.leaf = self.bottom == lengths[self.low]
        pieces = [self.sets[i][t:b] for i, t, b in zip(self.label, self.top, self.bottom)]
        self.tokens = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.bottom - self.top)])

    def _levels(self) -> None:
        children: list[list[int]] = [[] for _ in self.parent]
        for node, p in enumerate(self.parent.tolist()):
            if p >= 0:
                children[p].append(node)
        level = [0]
        self.levels = []
        while level:
            self.levels.append(np.array(level, dtype=np.int64))
            level = [c for node in level for c in children[node]]

    def walk(self, x: int, labels: np.ndarray, mark: np.ndarray, percent: int) -> np.ndarray:
        """Sorted positions of sets after ``x`` that link with it and have another label."""
        mine, n = self.sets[x], int(self.sizes[x])
        change = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])
        settled = (change[self.high - 1] == change[self.low]) & (labels[self.low] == labels[x])
        reach = ((self.high > x + 1) & (100 * self.size_max >= percent * n) & (percent * self.size_min <= 100 * n)
                 & ~settled)
        overlap = np.zeros(len(self.parent), dtype=np.int64)
        mark[mine] = True
        after = np.searchsorted(mine, self.last, side="right")
        found = []
        alive = np.zeros(len(self.parent), dtype=bool)
        for depth, level in enumerate(self.levels):
            at = level[reach[level]] if depth == 0 else level[reach[level] & alive[self.parent[level]]]
            if not len(at):
                break
            lengths = self.offset[at + 1] - self.offset[at]
            base = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum())) - np.repeat(base - self.offset[at], lengths)
            hit = np.concatenate([[0], np.cumsum(mark[self.tokens[place]])])
            got = hit[base + lengths] - hit[base]
            overlap[at] = got + (overlap[self.parent[at]] if depth else 0)
            possible = overlap[at] + np.minimum(self.left_max[at], len(mine) - after[at])
            at = at[possible >= least_overlap(n, self.size_min[at], percent)]
            alive[at] = True
            ends = at[self.leaf[at]]
            # All sets of a leaf node that end at its depth (equal token lists) are next to each other.
            for node in ends.tolist():
                y = int(self.low[node])
                while y < len(self.sets) and len(self.sets[y]) == self.bottom[node] and y < self.high[node]:
                    if y > x and overlap[node] >= least_overlap(n, int(self.sizes[y]), percent):
                        found.append(y)
                    y += 1
        mark[mine] = False
        return np.array(found, dtype=np.int64)


def linked(sets: list[np.ndarray], sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """For every set the smallest index among the sets it is connected with."""
    m = len(sets)
    if m == 1:
        return np.zeros(1, dtype=np.int64)
    values, ranks = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    trie = Trie(np.split(ranks, cuts), sizes)
    labels = np.arange(m)
    mark = np.zeros(len(values) + 1, dtype=bool)
    for x in range(m - 1):
        found = trie.walk(x, labels, mark, percent)
        if len(found):
            old = np.unique(np.append(labels[found], labels[x]))
            labels[np.isin(labels, old)] = old[0]
    order = np.array(trie.order)
    least = np.full(m, m)
    np.minimum.at(least, labels, order)
    out = np.empty(m, dtype=np.int64)
    out[order] = least[labels]
    return out


class _Chunk:
    """Sets of the classes that a chunk represents, and their shingles' corpus keys."""

    def __init__(self, table: pa.Table, others: pa.Table, n_buckets: int, shingle: int):
        table = C.ordered(table, "id")
        data, offsets = text_bytes(table["t"])
        first, hashes = shingle_sets(data, offsets, shingle)
        name, _ = set_names(first, hashes)
        skip = set(n for n, k in zip(others["name"].to_pylist(), others["kind"].to_pylist()) if k == 1)
        chosen, seen = [], set(skip)
        for d, n in enumerate(name.tolist()):
            if first[d + 1] > first[d] and n not in seen:
                seen.add(n)
                chosen.append(d)
        self.name = name[chosen]
        self.counts = (first[1:] - first[:-1])[chosen]
        spans = [hashes[first[d]: first[d + 1]] for d in chosen]
        self.hashes = np.concatenate(spans) if spans else np.zeros(0, np.uint64)
        self.runs = C.Runs(C.bucket_keys(self.hashes, n_buckets))

    def requests(self, chunk: int) -> pa.Table:
        r = self.runs
        times = r.end - r.begin
        low = np.uint64((1 << C.VALUE_BITS) - 1)
        rows = [(bucket, pack(r.keys[a:b] & low), planes(np.minimum(times[a:b], 255)))
                for bucket, a, b in C.segments(r.keys)]
        return pa.table({"bucket": pa.array([x[0] for x in rows], pa.int64()),
                         "chunk": pa.array([chunk] * len(rows), pa.int64()),
                         "hashes": pa.array([x[1] for x in rows], pa.binary()),
                         "counts": pa.array([x[2] for x in rows], pa.binary())})

    def ordered_sets(self, answers: pa.Table, percent: int) -> pa.Table:
        """Sets with a first shingle that another class has: shared shingles in the global order."""
        by = {b: blob for b, k, blob in zip(*(answers[c].to_pylist() for c in ("bucket", "kind", "counts"))) if k == 0}
        parts = [unplanes(by[bucket]) for bucket, _, _ in C.segments(self.runs.keys)]
        classes = self.runs.spread(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        keys = (classes.astype(np.uint64) << np.uint64(56)) | (self.hashes & _TAIL)
        names, sizes, tokens, firsts = [], [], [], []
        at = 0
        for name, n in zip(self.name.tolist(), self.counts.tolist()):
            own = np.sort(keys[at: at + n])
            at += n
            prefix = own[: prefix_length(n, percent)]
            shared = prefix[prefix >> np.uint64(56) > 1]
            if len(shared):
                names.append(name)
                sizes.append(n)
                tokens.append(own[own >> np.uint64(56) > 1].astype("<u8").tobytes())
                firsts.append(shared.view(np.int64))
        lengths = [len(f) for f in firsts]
        firsts = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()),
            pa.array(np.concatenate(firsts) if firsts else np.zeros(0, np.int64)))
        return pa.table({"name": pa.array(names, pa.int64()), "size": pa.array(sizes, pa.int64()),
                         "tokens": pa.array(tokens, pa.binary()), "firsts": firsts})


def _count_classes(table: pa.Table) -> pa.Table:
    parts = [unpack(b) for b in table["hashes"].to_pylist()]
    runs = C.Runs(np.concatenate(parts))
    own = np.concatenate([unplanes(b) for b in table["counts"].to_pylist()])
    totals = runs.spread(np.minimum(np.add.reduceat(own[runs.order], runs.begin), 255))
    cuts = np.cumsum([0, *map(len, parts)]).tolist()
    n = len(parts)
    return pa.table({"at": table["chunk"], "kind": pa.array([0] * n, pa.int32()), "bucket": table["bucket"],
                     "name": pa.array([0] * n, pa.int64()),
                     "counts": pa.array([planes(totals[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())})


def _block_links(percent: int):
    def run(table):
        table = table.combine_chunks().sort_by([("block", "ascending"), ("name", "ascending")])
        names, sizes, blocks = (table[c].to_numpy() for c in ("name", "size", "block"))
        sets = [np.frombuffer(b, "<u8") for b in table["tokens"].to_pylist()]
        cuts = np.append(np.flatnonzero(np.diff(blocks)) + 1, len(blocks)).tolist()
        at, out_a, out_b = 0, [], []
        for end in cuts:
            root = linked(sets[at:end], sizes[at:end], percent) + at
            moved = root != np.arange(at, end)
            out_a.append(names[at:end][moved])
            out_b.append(names[root[moved]])
            at = end
        return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return run


def _slices(block_sets: int) -> Column:
    """Slices of a block of ``n`` sets with ``total`` shingles: bounded in both."""
    tokens = max(1, BLOCK_TOKENS * block_sets // BLOCK_SETS)
    return F.greatest(F.ceil(F.col("n") / block_sets), F.ceil(F.col("total") / tokens)).cast("int")


def _groups(rows: DataFrame) -> int:
    """Groups of small blocks, bounded in sets and shingles."""
    n, total = rows.agg(F.count("*"), F.sum("size")).first()
    return max(1, math.ceil(n / GROUP_SETS), math.ceil((total or 0) / GROUP_TOKENS))


def _join_blocks(members: DataFrame, percent: int, block_sets: int, salt: int) -> DataFrame:
    """Links inside the blocks of ``members`` (name, size, tokens, block, n, total); large ones by
    slices."""
    n_slices = _slices(block_sets)
    group = F.when(n_slices <= 1, F.pmod(F.xxhash64("block"), F.lit(_groups(members)))).otherwise(
        F.xxhash64("block", F.pmod(F.xxhash64(F.lit(salt), "name"), n_slices)))
    return members.select("name", "size", "tokens", "block", group.alias("grp")).groupBy("grp").applyInArrow(
        _block_links(percent), "a long, b long")


def _verify(members: DataFrame, firsts: DataFrame, parts: DataFrame, percent: int, block_sets: int,
            hot_sets: int) -> DataFrame:
    """Links of sets of different components that share a first shingle."""
    own = firsts.join(parts, "name").select("token", "name", "size", "part")
    mixed = materialise(own.groupBy("token").agg(
        F.min("part").alias("p1"), F.max("part").alias("p2"), F.count("*").alias("n"), F.sum("size").alias("total"))
        .where("p1 != p2").select("token", "n", "total"), "trie-mixed")
    sets = members.select("name", "size", "tokens")

    # A shingle that many sets begin with: every two blocks of its sets are one trie.
    hot = materialise(own.drop("part").join(mixed.where(F.col("n") > hot_sets), "token"), "trie-hot")
    dealt = hot.withColumn("blocks", _slices(max(1, block_sets // 2))).withColumn(
        "mine", F.pmod(F.xxhash64(F.lit(11), "name"), F.col("blocks")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")) \
        .where("blocks = 1 OR mine <> other")
    block = F.xxhash64("token", F.least("mine", "other"), F.greatest("mine", "other"))
    group = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("token"), F.lit(_groups(hot)))).otherwise(block)
    tries = dealt.select("name", block.alias("block"), group.alias("grp")).join(sets, "name").groupBy("grp").applyInArrow(
        _block_links(percent), "a long, b long")

    own = own.join(mixed.where(F.col("n") <= hot_sets).select("token"), "token")
    other = own.toDF("token", "name2", "size2", "part2")
    pairs = own.join(other, "token").where(
        (F.col("name") < F.col("name2")) & (F.col("part") != F.col("part2"))
        & (100 * F.least("size", "size2") >= percent * F.greatest("size", "size2"))).select("name", "name2").distinct()
    full = pairs.join(sets, "name").join(sets.toDF("name2", "size2", "tokens2"), "name2")

    def compare(batches):
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("name", "name2", "size", "size2", "tokens", "tokens2")]
            keep = [(a, c) for a, c, n, k, s, t in zip(*cols) if len(np.intersect1d(
                np.frombuffer(s, "<u8"), np.frombuffer(t, "<u8"), assume_unique=True)) >= least_overlap(n, k, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keep], pa.int64()),
                                              pa.array([k[1] for k in keep], pa.int64())], names=["a", "b"])

    return full.mapInArrow(compare, "a long, b long").unionByName(tries)


def similar_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT,
                      shingle: int = SHINGLE, block_sets: int = BLOCK_SETS, hot_sets: int = HOT_SETS, **sizes) -> DataFrame:
    """key, n_shingles, component_id for every row."""
    base, n = C.chunked(docs, text, F.col(key).cast("long").alias("id"), **sizes)

    def profile(batches):
        for b in batches:
            data, offs = text_bytes(b.column("t"))
            for i, j in slices(offs):
                first, hashes = shingle_sets(data[offs[i]: offs[j]], offs[i: j + 1] - offs[i], shingle)
                name, check = set_names(first, hashes)
                yield pa.RecordBatch.from_arrays(
                    [b.column("chunk").slice(i, j - i), b.column("id").slice(i, j - i),
                     pa.array(np.diff(first), pa.int64()), pa.array(name), pa.array(check)],
                    names=["chunk", "id", "n_shingles", "name", "check"])

    profiles = materialise(base.mapInArrow(profile, "chunk long, id long, n_shingles long, name long, check long"),
                           "trie-profiles")
    # One chunk represents a class; the other chunks that have it leave it out.
    present = profiles.where("n_shingles > 0").groupBy("name", "chunk").agg(F.count("*").alias("rows"))
    home = present.groupBy("name").agg(F.min("chunk").alias("home"), F.count("*").alias("chunks")).where("chunks > 1")
    skip = (present.join(home, "name").where("chunk != home")
            .select(F.col("chunk").alias("at"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("bucket"), "name",
                    F.lit(None).cast("binary").alias("counts")))
    skip = materialise(skip, "trie-copies")

    def ask(group_key, table, others):
        return _Chunk(table, others, n, shingle).requests(group_key[0].as_py()) if len(table) else no_requests

    def build(_, table, answers):
        return _Chunk(table, answers, n, shingle).ordered_sets(answers, percent) if len(table) else no_sets

    no_requests = pa.table({"bucket": pa.array([], pa.int64()), "chunk": pa.array([], pa.int64()),
                            "hashes": pa.array([], pa.binary()), "counts": pa.array([], pa.binary())})
    no_sets = pa.table({"name": pa.array([], pa.int64()), "size": pa.array([], pa.int64()),
                        "tokens": pa.array([], pa.binary()), "firsts": pa.array([], pa.list_(pa.int64()))})
    texts = base.groupBy("chunk")
    asked = texts.cogroup(skip.groupBy("at")).applyInArrow(ask, "bucket long, chunk long, hashes binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(
        _count_classes, "at long, kind int, bucket long, name long, counts binary")
    sets = texts.cogroup(answers.unionByName(skip).groupBy("at")).applyInArrow(
        build, "name long, size long, tokens binary, firsts array<long>")
    sets = materialise(sets, "trie-sets")

    firsts = sets.select("name", "size", F.explode("firsts").alias("token"))
    heads = firsts.groupBy("token").agg(F.min("name").alias("head"), F.count("*").alias("n")).where("n > 1")
    blocks = components(firsts.join(heads, "token").where("name != head")
                        .select(F.col("name").alias("a"), F.col("head").alias("b")).distinct())
    blocks = materialise(blocks, "trie-blocks").toDF("name", "block")
    sized = blocks.join(sets.select("name", "size"), "name").groupBy("block").agg(
        F.count("*").alias("n"), F.sum("size").alias("total"))
    members = sets.select("name", "size", "tokens").join(blocks.join(sized, "block"), "name")
    links = materialise(_join_blocks(members, percent, block_sets, 0), "trie-links")
    large = materialise(sized.where(_slices(block_sets) > 1), "trie-large")
    if large.limit(1).count():
        # Set by set to component, then representatives of components, until they fit one slice.
        inside = materialise(blocks.join(large, "block").select("name", "block"), "trie-inside")
        before, salt = None, 0
        while True:
            parts = components(links).toDF("name", "part")
            parts = materialise(inside.join(parts, "name", "left").select(
                "name", "block", F.coalesce("part", "name").alias("part")), "trie-parts")
            heads = parts.where("name = part").join(sets.select("name", "size"), "name").groupBy("block").agg(
                F.count("*").alias("n"), F.sum("size").alias("total"))
            left, most, cuts = heads.agg(F.sum("n"), F.max("n"), F.max(_slices(block_sets))).first()
            if most == 1 or left == before:
                break
            before, salt = left, salt + 1
            more = sets.select("name", "size", "tokens").join(
                parts.where("name = part").select("name", "block").join(heads, "block"), "name")
            links = materialise(links.unionByName(_join_blocks(more, percent, block_sets, salt)), "trie-links")
            if cuts <= 1:
                parts = components(links).toDF("name", "part")
                parts = materialise(inside.join(parts, "name", "left").select(
                    "name", "block", F.coalesce("part", "name").alias("part")), "trie-parts")
                break
        rest = _verify(sets, firsts, parts.select("name", "part"), percent, block_sets, hot_sets)
        links = materialise(links.unionByName(rest), "trie-links")
    parts = components(links).toDF("name", "part")
    labelled = profiles.join(parts, "name", "left").select(
        "id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("part", "name")).alias("part"))
    # Written before the join, so that a component of very many documents can be split there.
    least = materialise(labelled.where("part is not null").groupBy("part").agg(F.min("id").alias("least")),
                        "trie-names")
    out = labelled.join(least, "part", "left")
    return out.select(F.col("id").alias(key), "n_shingles", F.coalesce("least", "id").alias("component_id"))
