"""Language-model scores by a weighted backoff automaton.

Tokens are the words of a text, A-Z in lower case, then one end token. The model is an
n-gram model of order ``order`` learned from all training documents:

    p(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p(w | h) = (c(hw) + MU p(w | h')) / (c(h) + MU),     h' is h without its first token

As an automaton (``Automaton``): a state per history that occurs in training (h, down to the
empty one, and those of the beginning of a text); an arc for every n-gram that occurs, with
weight log10 p(w | h), to the state of the longest known history that then ends the text;
and a failure arc from h to h' with weight log10 (MU / (c(h) + MU)), taken when the state has
no arc for the next token. Every state's arcs and failure path sum to 1 over the words and
one unknown word. A text is read from left to right, carrying its state, and the weights on
its path are added up. All texts of a chunk are walked in step, in pieces of ``PIECE``
tokens: a state depends on the last order - 1 tokens alone, so a piece that begins inside a
text first walks those without adding.

The counts of all n-grams of all training documents cannot be in one place, so a chunk of
documents asks the buckets of the n-gram space for those arcs and states that its texts can
reach (see ``chunked``): one exchange both counts, adding what every chunk's training
documents contribute, and answers. The chunk then holds its own part of the automaton.
N and V come from one count of the distinct tokens before.

Edge cases: null and empty texts are the end token alone; without training documents
c, N and V are 0; a null id is learned from; repeated rows are learned from and scored
each; unknown words have p = 0.5 / (N + 0.5 (V + 1)); other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import chunked as C
from .textops import Words, mix, pack, planes, slices, text_bytes, unpack, unplanes

ORDER = 2
MU = 500.0  # best of 5, 50, 500 and 5000 on held-out documents
PIECE = 256
_END = np.uint64(0x6A09E667F3BCC909)
_START = np.uint64(0xBB67AE8584CAA73B)
_STEP = np.uint64(0x3C6EF372FE94F82B)


def is_held_out(key: str = "doc_id") -> Column:
    """Fold of a document that is never learned from: crc32 of the id's text modulo 5 is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 1, F.lit(False))


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes with an end token per document, and each document's first token."""
    w = Words(data, offsets, fold_case=True)
    counts = w.counts + 1
    first = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.empty(first[-1], dtype=np.uint64)
    last = first[1:] - 1
    inner = np.ones(len(tokens), dtype=bool)
    inner[last] = False
    tokens[inner] = w.hashes
    tokens[last] = _END
    return tokens, first


def _grams(tokens: np.ndarray, first: np.ndarray, order: int) -> list[np.ndarray]:
    """Hash of the n-gram that ends at each token, for n = 1 .. order; histories start with
    the start mark."""
    grams = [tokens]
    for n in range(2, order + 1):
        history = np.empty_like(tokens)
        history[1:] = grams[-1][:-1]
        history[first[:-1]] = _START + np.uint64(n)
        grams.append(mix(tokens + history * _STEP + np.uint64(n)))
    return grams


def _value_bits(n_buckets: int) -> int:
    """As many bits of a hash as fit beside the bucket number, at most 48."""
    return min(48, 63 - n_buckets.bit_length())


class Automaton:
    """States, arcs and failure arcs of the n-grams that the texts of a chunk can reach.

    ``grams[n - 1][i]`` numbers the n-gram that ends at token i, ``counts[n - 1][k]`` is the
    corpus count of n-gram number k, ``first`` the first token of every text (and the end)."""

    def __init__(self, grams: list[np.ndarray], counts: list[np.ndarray], first: np.ndarray, n_all: int, n_distinct: int,
                 mu: float):
        order, n_tokens = len(grams), len(counts[0])
        begins = np.zeros(len(grams[0]), dtype=bool)
        begins[first[:-1]] = True
        texts = float(counts[0][grams[0][first[1] - 1]])  # as many training texts begin as end
        # States: 0 the empty history, then the start histories by length, then known n-grams.
        self.start = order - 1
        size, state = order, []
        for n in range(1, order):
            known = counts[n - 1] > 0
            state.append(np.where(known, size + np.cumsum(known) - 1, -1))
            size += int(known.sum())
        weight_of = np.zeros(size)
        self.fail_to, self.fail_weight = np.zeros(size, dtype=np.int64), np.zeros(size)
        weight_of[1:order] = texts
        self.fail_to[1:order] = np.arange(order - 1)
        keys, weights, targets, below = [], [], [], None
        z = n_all + 0.5 * (n_distinct + 1)
        for n in range(1, order + 1):
            at = np.empty(len(counts[n - 1]), dtype=np.int64)  # a place of each n-gram
            at[grams[n - 1]] = np.arange(len(grams[n - 1]))
            if n == 1:
                p, have, origin = (counts[0] + 0.5) / z, np.arange(n_tokens), np.zeros(n_tokens, dtype=np.int64)
            else:
                have = np.flatnonzero(counts[n - 1] > 0)
                place = at[have]
                history = np.where(begins[place], 0, grams[n - 2][place - 1])
                origin = np.where(begins[place], n - 1, state[n - 2][history])
                p = np.zeros(len(counts[n - 1]))
                p[have] = (counts[n - 1][have] + mu * below[grams[n - 2][place]]) / (weight_of[origin] + mu)
            if n < order:
                own = np.flatnonzero(counts[n - 1] > 0)
                ids = state[n - 1][own]
                weight_of[ids] = counts[n - 1][own]
                self.fail_to[ids] = 0 if n == 1 else state[n - 2][grams[n - 2][at[own]]]
            keys.append(origin * n_tokens + grams[0][at[have]])
            weights.append(np.log10(p[have]))
            if n < order:
                targets.append(np.maximum(state[n - 1][have], 0))  # an unknown word leads to the empty history
            else:
                targets.append(np.zeros(len(have), dtype=np.int64) if n == 1 else state[n - 2][grams[n - 2][at[have]]])
            below = p
        self.fail_weight[1:] = np.log10(mu / (weight_of[1:] + mu))
        keys = np.concatenate(keys)
        by = np.argsort(keys, kind="stable")
        self.keys, self.weights, self.targets = keys[by], np.concatenate(weights)[by], np.concatenate(targets)[by]
        self.n_tokens, self.order = n_tokens, order

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a token each, and the weights of the arcs and failure arcs taken."""
        state, paid = state.copy(), np.zeros(len(state))
        open_ = np.arange(len(state))
        while len(open_):
            key = state[open_] * self.n_tokens + token[open_]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            done = open_[hit]
            paid[done] += self.weights[arc[hit]]
            state[done] = self.targets[arc[hit]]
            open_ = open_[~hit]
            paid[open_] += self.fail_weight[state[open_]]
            state[open_] = self.fail_to[state[open_]]
        return state, paid

    def walk(self, tokens: np.ndarray, first: np.ndarray, piece: int) -> np.ndarray:
        """Log-probability of every text."""
        sizes = np.diff(first)
        pieces = -(-sizes // piece)
        text = np.repeat(np.arange(len(sizes)), pieces)
        begin = first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * piece
        end = np.minimum(begin + piece, first[text + 1])
        at = np.maximum(begin - (self.order - 1), first[text])
        state = np.where(at == first[text], self.start, 0)
        total = np.zeros(len(text))
        lanes = np.arange(len(text))
        while len(lanes):
            state[lanes], paid = self.step(state[lanes], tokens[at[lanes]])
            total[lanes] += np.where(at[lanes] >= begin[lanes], paid, 0.0)
            at[lanes] += 1
            lanes = lanes[at[lanes] < end[lanes]]
        return np.bincount(text, total, len(sizes))


class _Chunk:
    def __init__(self, table: pa.Table, order: int, n_buckets: int):
        self.table, self.bits = C.ordered(table, "id", "train"), _value_bits(n_buckets)
        data, offsets = text_bytes(self.table["t"])
        self.tokens, self.first = _tokens(data, offsets)
        low = np.uint64((1 << self.bits) - 1)
        self.runs = [C.Runs(((g >> np.uint64(self.bits)) % np.uint64(n_buckets) << np.uint64(self.bits)) | (g & low))
                     for g in _grams(self.tokens, self.first, order)]

    def requests(self, chunk: int) -> pa.Table:
        train = np.repeat(self.table["train"].to_numpy().astype(np.int64), np.diff(self.first))
        low = np.uint64((1 << self.bits) - 1)
        rows = []
        for n, r in enumerate(self.runs, 1):
            counts = np.add.reduceat(train[r.order], r.begin) if len(r.begin) else np.zeros(0, np.int64)
            rows += [(bucket, n, pack(r.keys[a:b] & low), planes(counts[a:b]))
                     for bucket, a, b in C.segments(r.keys, self.bits)]
        return pa.table({"bucket": pa.array([x[0] for x in rows], pa.int64()),
                         "n": pa.array([x[1] for x in rows], pa.int32()),
                         "chunk": pa.array([chunk] * len(rows), pa.int64()),
                         "hashes": pa.array([x[2] for x in rows], pa.binary()),
                         "counts": pa.array([x[3] for x in rows], pa.binary())})

    def counts(self, answers: pa.Table) -> list[np.ndarray]:
        """Corpus count of every distinct n-gram of the chunk."""
        by = {(n, b): blob for n, b, blob in zip(*(answers[c].to_pylist() for c in ("n", "bucket", "counts")))}
        return [np.concatenate([unplanes(by[n, bucket]) for bucket, _, _ in C.segments(r.keys, self.bits)])
                for n, r in enumerate(self.runs, 1)]

    def scores(self, answers: pa.Table, n_all: int, n_distinct: int, mu: float, piece: int = PIECE) -> pa.Table:
        counts, first = self.counts(answers), self.first
        grams = [r.spread(np.arange(len(r.keys))) for r in self.runs]
        automaton = Automaton(grams, counts, first, n_all, n_distinct, mu)
        score = automaton.walk(grams[0], first, piece)
        base = np.log10((counts[0] + 0.5) / (n_all + 0.5 * (n_distinct + 1)))[grams[0]]
        total = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every text has a token
        size = len(self.table)
        return pa.table({
            "id": self.table["id"], "held_out": pa.array(~self.table["train"].to_numpy(), pa.bool_()),
            "n_tokens": pa.array(np.diff(first), pa.int64()),
            "n_known": pa.array(total((counts[0] > 0)[grams[0]].astype(np.int64)), pa.int64()),
            "train_tokens": pa.array(np.full(size, n_all), pa.int64()),
            "base_score": pa.array(total(base), pa.float64()), "score": pa.array(score, pa.float64())})


def _add_up(table: pa.Table) -> pa.Table:
    """Corpus counts of a bucket's n-grams, for every chunk that asked."""
    parts = [unpack(b) for b in table["hashes"].to_pylist()]
    runs = C.Runs(np.concatenate(parts))
    own = np.concatenate([unplanes(b) for b in table["counts"].to_pylist()])
    totals = runs.spread(np.add.reduceat(own[runs.order], runs.begin))
    cuts = np.cumsum([0, *map(len, parts)]).tolist()
    return pa.table({"at": table["chunk"], "n": table["n"], "bucket": table["bucket"],
                     "counts": pa.array([planes(totals[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())})


def _size_of_training(train: DataFrame, n_buckets: int) -> tuple[int, int]:
    """Tokens and distinct tokens of the training texts."""
    def distinct(batches):
        for batch in batches:
            data, offs = text_bytes(batch.column(0))
            for i, j in slices(offs, C.CHUNK_BYTES):
                tokens, _ = _tokens(data[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                bucket = tokens % np.uint64(n_buckets)
                kept = np.unique(tokens)
                bucket = kept % np.uint64(n_buckets)
                order = np.argsort(bucket, kind="stable")
                kept, bucket = kept[order], bucket[order].astype(np.int64)
                cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
                spans = list(zip(cuts, cuts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(bucket[a]) for a, _ in spans], pa.int64()),
                     pa.array([len(tokens)] + [0] * (len(spans) - 1), pa.int64()),
                     pa.array([pack(kept[a:b]) for a, b in spans], pa.binary())], names=["bucket", "n", "hashes"])

    def count(table):
        seen = np.unique(np.concatenate([unpack(b) for b in table["hashes"].to_pylist()]))
        return pa.table({"n": pa.array([sum(table["n"].to_pylist())], pa.int64()),
                         "v": pa.array([len(seen)], pa.int64())})

    row = (train.select("t").mapInArrow(distinct, "bucket long, n long, hashes binary")
           .groupBy("bucket").applyInArrow(count, "n long, v long").agg(F.sum("n"), F.sum("v")).first())
    return int(row[0] or 0), int(row[1] or 0)


def score_documents(docs: DataFrame, held_out: Column | None = None, text: str = "text", key: str = "doc_id",
                    order: int = ORDER, mu: float = MU, piece: int = PIECE, **sizes) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    train = ~(is_held_out(key) if held_out is None else held_out)
    base, n = C.chunked(docs, text, F.col(key).alias("id"), train.alias("train"), **sizes)
    n_all, n_distinct = _size_of_training(base.where("train"), n)
    kind = docs.schema[key].dataType.simpleString()

    def ask(group_key, table):
        return _Chunk(table, order, n).requests(group_key[0].as_py())

    def finish(_, table, answers):
        if not len(table):
            return nothing
        return _Chunk(table, order, n).scores(answers, n_all, n_distinct, mu, piece)

    numbers = {"n_tokens": pa.int64(), "n_known": pa.int64(), "train_tokens": pa.int64(),
               "base_score": pa.float64(), "score": pa.float64()}
    nothing = pa.table({"id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()),
                        **{c: pa.array([], t) for c, t in numbers.items()}})
    texts = base.groupBy("chunk")
    asked = texts.applyInArrow(ask, "bucket long, n int, chunk long, hashes binary, counts binary")
    answers = asked.groupBy("bucket", "n").applyInArrow(_add_up, "at long, n int, bucket long, counts binary")
    out = texts.cogroup(answers.groupBy("at")).applyInArrow(
        finish, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
    return out.withColumnRenamed("id", key)
