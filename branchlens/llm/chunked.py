"""Exchange of hashes between bounded chunks of documents and buckets of hashes.

Several operators need, for every n-gram of every document, something that only all
documents together know (how often it occurs, who has it first). Instead of one row per
n-gram, a *chunk* (a few megabytes of documents, dealt by a hash) sends each *bucket* of
the hash space one row with its distinct hashes, sorted and packed, so equal n-grams of a
chunk are sent once. A bucket joins what it got from all chunks and answers each chunk's
row in the same order; the chunk, computed again from the same documents, reads the answer
at the same places. A bucket holds about ``BUCKET_BYTES`` of text's n-grams, and a hash
that occurs everywhere is in one row per chunk, not per occurrence.

All rounds of an operator group the same frame by the same column, so Spark shuffles the
texts once and reuses that exchange.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .tables import bound_batches

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 12 << 20
VALUE_BITS = 40  # of a bucket key; the bits above are the bucket


def chunked(docs: DataFrame, text: str, *columns, chunk_bytes: int = CHUNK_BYTES,
            bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """Frame (chunk, t, the given columns) and the number of buckets.

    One pass over the texts' lengths sizes both.
    """
    bound_batches(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_chunks = max(1, math.ceil(total / chunk_bytes))
    base = docs.select(F.col(text).alias("t"), *columns)
    names = [c for c in base.columns if c != "t"]
    chunk = F.pmod(F.xxhash64("t", *names), F.lit(n_chunks)).alias("chunk")
    return base.select(chunk, *base.columns), max(1, math.ceil(total / bucket_bytes))


def ordered(table, *columns: str):
    """A chunk's rows in an order that every round shares."""
    return table.combine_chunks().sort_by([(c, "ascending") for c in (*columns, "t")])


def bucket_keys(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket number above the low VALUE_BITS of the hash."""
    low = np.uint64((1 << VALUE_BITS) - 1)
    return ((hashes >> np.uint64(VALUE_BITS)) % np.uint64(n_buckets) << np.uint64(VALUE_BITS)) | (hashes & low)


class Runs:
    """Distinct keys of an array in ascending order, with the places of each."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable")
        placed = keys[self.order]
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = placed[1:] != placed[:-1]
        self.begin = np.flatnonzero(fresh)
        self.end = np.append(self.begin[1:], len(keys))
        self.keys = placed[self.begin]
        self.run = np.cumsum(fresh) - 1

    def spread(self, per_key: np.ndarray) -> np.ndarray:
        """A value per distinct key, at every place."""
        out = np.empty(len(self.order), dtype=per_key.dtype)
        out[self.order] = per_key[self.run]
        return out

    def flagged(self, at_places: np.ndarray) -> np.ndarray:
        """Whether any place of a key is set."""
        return np.logical_or.reduceat(at_places[self.order], self.begin) if len(self.begin) else np.zeros(0, bool)


def segments(keys: np.ndarray, shift: int = VALUE_BITS):
    """(bucket, from, to) of ascending bucket keys."""
    if not len(keys):
        return
    buckets = (keys >> np.uint64(shift)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(keys)]
    for a, b in zip(cuts, cuts[1:]):
        yield int(buckets[a]), a, b


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def from_bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def read_bits(keys: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """Answer bits of all distinct keys; a bucket without an answer says no."""
    out = np.zeros(len(keys), dtype=bool)
    for bucket, a, b in segments(keys):
        if bucket in answers:
            out[a:b] = from_bits(answers[bucket], b - a)
    return out
