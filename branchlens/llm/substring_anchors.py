"""Substring dedup by fixed-block anchors.

A window of ``WINDOW`` consecutive words is a repeat if the same words also start at some
place of a document with a smaller id; the words that repeated windows cover are removed.

1. Anchors: every document's non-overlapping reference blocks of ``BLOCK`` words (at word
   0, BLOCK, 2 BLOCK, ...) are indexed by hash, and every rolling window of BLOCK words
   probes the index. WINDOW >= 2 BLOCK - 1, so each occurrence of a repeated window holds a
   whole reference block of the one document, and the other one probes it: no repeat is
   missed. A block that only its own place probes is no hit, and most text ends here.
2. Extension: around a hit, to both sides, all windows of WINDOW words that hold the hit
   block are named by 96 bits of hash and compared with those of all other documents; the
   smallest document that has a window is kept, in all others it is a repeat. Overlapping
   repeats unite to the maximal exact repeat, cut at the ends of documents.

Both steps exchange hashes between chunks of documents and buckets (see ``chunked``), with
one bit per hash in the answers. Windows are judged on the input.

Edge cases: null and empty texts have no words; documents of fewer than WINDOW words keep
all; rows that share an id never remove each other; a null id takes no part (nothing is
removed there, and it is no reference); equal texts of one id are rows of their own; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import chunked as C
from .textops import Words, gram_hashes, pack, planes, span_hashes, text_bytes, unpack, unplanes

WINDOW = 50


class _Chunk:
    """Words, probes and candidate windows of one chunk; computed alike in every round."""

    def __init__(self, table: pa.Table, window: int, n_buckets: int):
        self.table = C.ordered(table, "id")
        self.window, self.block, self.n_buckets = window, (window + 1) // 2, n_buckets
        data, offsets = text_bytes(self.table["t"])
        self.words = w = Words(data, offsets)
        named = np.asarray(self.table["id"].is_valid())
        self.ids = self.table["id"].fill_null(0).to_numpy()
        starts, docs, hashes = gram_hashes(w.hashes, w.first, self.block)
        use = named[docs]
        self.starts, self.docs = starts[use], docs[use]
        self.named = named
        self.probes = C.Runs(C.bucket_keys(hashes[use], n_buckets))

    def probe_rows(self, chunk: int) -> pa.Table:
        r = self.probes
        anchor = r.flagged((self.starts - self.words.first[self.docs]) % self.block == 0)
        # Equal ids are one document; ids ascend within a run of equal hashes.
        ids = self.ids[self.docs][r.order]
        several = ids[r.begin] != ids[r.end - 1] if len(r.begin) else np.zeros(0, bool)
        rows = [(bucket, pack(r.keys[a:b] & np.uint64((1 << C.VALUE_BITS) - 1)), C.bits(anchor[a:b]),
                 C.bits(several[a:b])) for bucket, a, b in C.segments(r.keys)]
        return pa.table({"bucket": pa.array([x[0] for x in rows], pa.int64()),
                         "chunk": pa.array([chunk] * len(rows), pa.int64()),
                         **{c: pa.array([x[i] for x in rows], pa.binary())
                            for i, c in enumerate(("hashes", "anchor", "several"), 1)}})

    def candidates(self, answers: dict[int, bytes]) -> None:
        """Windows that hold a hit block, and their distinct names."""
        hit = self.probes.spread(C.read_bits(self.probes.keys, answers))
        total = np.zeros(len(self.words.hashes) + 1, dtype=np.int64)
        np.add.at(total, self.starts[hit] + 1, 1)
        total = np.cumsum(total)
        counts = np.where(self.named, np.maximum(self.words.counts - self.window + 1, 0), 0)
        docs = np.repeat(np.arange(len(counts)), counts)
        starts = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + self.words.first[:-1][docs]
        near = total[starts + self.window - self.block + 1] > total[starts]
        self.win_starts, self.win_docs = starts[near], docs[near]
        first = span_hashes(self.words.hashes, self.win_starts, self.window, 0)
        second = span_hashes(self.words.hashes, self.win_starts, self.window, 1) >> np.uint64(32)
        # Sorted by the bucket of the first hash, then by both hashes; the document order stays inside.
        bucket = first % np.uint64(self.n_buckets)
        order = np.lexsort((second, first, bucket))
        first, second, bucket = first[order], second[order], bucket[order]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        self.win_order, self.win_run, self.win_begin = order, np.cumsum(fresh) - 1, np.flatnonzero(fresh)
        self.names = first[fresh], second[fresh], bucket[fresh]
        self.least = self.ids[self.win_docs[order[self.win_begin]]]

    def window_rows(self, chunk: int) -> pa.Table:
        first, second, bucket = self.names
        cuts = np.append(np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1)), len(bucket)).tolist()
        spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
        return pa.table({
            "bucket": pa.array([int(bucket[a]) for a, _ in spans], pa.int64()),
            "chunk": pa.array([chunk] * len(spans), pa.int64()),
            "first": pa.array([pack(first[a:b]) for a, b in spans], pa.binary()),
            "second": pa.array([second[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
            "least": pa.array([planes(self.least[a:b]) for a, b in spans], pa.binary())})

    def kept(self, answers: dict[int, bytes]) -> pa.Table:
        bucket = self.names[2].astype(np.int64)
        elsewhere = np.zeros(len(bucket), dtype=bool)
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
        for a, b in zip(cuts, cuts[1:]):
            if b > a and int(bucket[a]) in answers:
                elsewhere[a:b] = C.from_bits(answers[int(bucket[a])], b - a)
        repeat = np.empty(len(self.win_order), dtype=bool)
        repeat[self.win_order] = elsewhere[self.win_run] | (
            self.ids[self.win_docs[self.win_order]] > self.least[self.win_run])
        w = self.words
        cover = np.zeros(len(w.hashes) + 1, dtype=np.int64)
        np.add.at(cover, self.win_starts[repeat], 1)
        np.add.at(cover, self.win_starts[repeat] + self.window, -1)
        removed = np.cumsum(cover)[:-1] > 0
        total = np.concatenate([[0], np.cumsum(removed)])
        n_removed = total[w.first[1:]] - total[w.first[:-1]]
        texts = []
        raw, offs = w.data, w.offsets
        for d, n in enumerate(n_removed.tolist()):
            words = raw[offs[d]: offs[d + 1]].tobytes().split()
            if n:
                gone = removed[w.first[d]: w.first[d + 1]].tolist()
                words = [x for x, g in zip(words, gone) if not g]
            texts.append(b" ".join(words).decode())
        return pa.table({"id": self.table["id"], "n_words": pa.array(w.counts, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(texts, pa.string())})


def _answers(table: pa.Table, kind: int) -> dict[int, bytes]:
    rows = zip(table["kind"].to_pylist(), table["bucket"].to_pylist(), table["bits"].to_pylist())
    return {b: blob for k, b, blob in rows if k == kind}


def _reply(table: pa.Table, kind: int, flags: np.ndarray, lengths: list[int]) -> pa.Table:
    """One row of bits per row of a bucket; rows without a set bit are left out."""
    at, rows = 0, []
    for bucket, chunk, n in zip(table["bucket"].to_pylist(), table["chunk"].to_pylist(), lengths):
        part = flags[at: at + n]
        at += n
        if part.any():
            rows.append((chunk, kind, bucket, C.bits(part)))
    return pa.table({"at": pa.array([r[0] for r in rows], pa.int64()), "kind": pa.array([r[1] for r in rows], pa.int32()),
                     "bucket": pa.array([r[2] for r in rows], pa.int64()),
                     "bits": pa.array([r[3] for r in rows], pa.binary())})


def _hits(table: pa.Table) -> pa.Table:
    """Hashes that are a reference block somewhere and occur in two documents or more."""
    parts = [unpack(b) for b in table["hashes"].to_pylist()]
    lengths = [len(p) for p in parts]
    anchor, several = (np.concatenate([C.from_bits(b, n) for b, n in zip(table[c].to_pylist(), lengths)])
                       for c in ("anchor", "several"))
    runs = C.Runs(np.concatenate(parts))
    shared = runs.flagged(anchor) & ((runs.end - runs.begin > 1) | runs.flagged(several))
    return _reply(table, 0, runs.spread(shared), lengths)


def _repeats(table: pa.Table) -> pa.Table:
    """Windows that a document with a smaller id has, per chunk that asks."""
    parts = [unpack(b) for b in table["first"].to_pylist()]
    lengths = [len(p) for p in parts]
    first = np.concatenate(parts)
    second = np.frombuffer(b"".join(table["second"].to_pylist()), "<u4")
    least = np.concatenate([unplanes(b) for b in table["least"].to_pylist()])
    order = np.lexsort((second, first))
    f, s = first[order], second[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
    smallest = np.minimum.reduceat(least[order], np.flatnonzero(fresh))
    repeat = np.empty(len(order), dtype=bool)
    repeat[order] = least[order] > smallest[np.cumsum(fresh) - 1]
    return _reply(table, 1, repeat, lengths)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW,
                   **sizes) -> DataFrame:
    """key, n_words, n_removed, kept_text (kept words joined by one space) for every row."""
    base, n = C.chunked(docs, text, F.col(key).cast("long").alias("id"), **sizes)
    reply = "at long, kind int, bucket long, bits binary"

    def probe(group_key, table):
        return _Chunk(table, window, n).probe_rows(group_key[0].as_py())

    def extend(group_key, table, answers):
        if not len(table) or not len(answers):
            return empty
        chunk = _Chunk(table, window, n)
        chunk.candidates(_answers(answers, 0))
        return chunk.window_rows(group_key[0].as_py())

    def finish(_, table, answers):
        if not len(table):
            return empty_result
        chunk = _Chunk(table, window, n)
        chunk.candidates(_answers(answers, 0))
        return chunk.kept(_answers(answers, 1))

    empty = pa.table({"bucket": pa.array([], pa.int64()), "chunk": pa.array([], pa.int64()),
                      **{c: pa.array([], pa.binary()) for c in ("first", "second", "least")}})
    empty_result = pa.table({"id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()),
                             "n_removed": pa.array([], pa.int64()), "kept_text": pa.array([], pa.string())})
    texts = base.groupBy("chunk")
    probes = texts.applyInArrow(probe, "bucket long, chunk long, hashes binary, anchor binary, several binary")
    hits = probes.groupBy("bucket").applyInArrow(_hits, reply)
    windows = texts.cogroup(hits.groupBy("at")).applyInArrow(
        extend, "bucket long, chunk long, first binary, second binary, least binary")
    repeats = windows.groupBy("bucket").applyInArrow(_repeats, reply)
    answers = hits.unionByName(repeats).groupBy("at")
    out = texts.cogroup(answers).applyInArrow(finish, "id long, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("id", key)
