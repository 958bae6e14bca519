"""Bound-certified best-fit packing of tokenised documents into fixed-length sequences.

1. ``tokenise`` turns every document into its token ids and the end id 0 and cuts the
   ones longer than a sequence (the first piece takes the remainder, the others are full).
   Only lengths, positions and checksums leave the task.
2. ``pack`` deals the pieces into groups of bounded size. A group is packed by best-fit
   decreasing and compared with a lower bound from dual feasible functions; equality
   certifies that its number of sequences is minimal.
3. Groups with a gap exchange documents: their sequences that are not full are emptied and
   dealt anew among several groups together, and best-fit decreasing runs again. An exchange
   is kept only where the groups that took part need fewer sequences together.

Best-fit decreasing keeps one stack of open sequences per free length, so a group costs
time linear in its pieces. No group is larger than ``GROUP_PIECES`` pieces on average
(row numbers deal them), whatever the size of the input.

Edge cases: a null or empty text is the single id 0; repeated rows are packed each; texts
of any length are cut, never shortened; an empty table gives an empty result; pieces carry
the document's key only (other columns are not needed and cannot clash).
"""

from __future__ import annotations

import functools
import math
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import materialise

CAPACITY = 2048
GROUP_PIECES = 40_000
EXCHANGE_GROUPS = 2   # groups that exchange documents with each other
ROUNDS = 2
CACHE_UNITS = 400_000
TOKENISER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"  # the same vocabulary for the faster library

#: A unit is a run of spaces and line ends with the text up to the next one. The tokeniser's
#: own splitting never joins text across the start of a unit, if no other white space occurs.
_UNIT = re.compile(r"[ \n]*[^ \n]+|[ \n]+\Z")
_ODD = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")
_SPECIAL = "<|endoftext|>"


class Encoder:
    """Token ids of texts as little-endian uint32 bytes, with a bounded cache of units.

    Texts with unusual white space or the special token's name are encoded whole by
    ``tokenizers``, and so are units with characters beyond Latin; other units that are not
    in the cache are encoded by ``tiktoken`` from the same vocabulary. The tests compare
    the result with ``tokenizers`` on whole texts.
    """

    def __init__(self, tokeniser_path: str, ranks_path: str):
        import base64
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        self.tokeniser_path = tokeniser_path
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f)}
        self.fast = tiktoken.Encoding("fast", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self.cache: dict[str, bytes] = {}

    @functools.cached_property
    def tokeniser(self):
        """Loaded when the first text needs it: most workers never do."""
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.tokeniser_path)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokeniser.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _unit(self, unit: str) -> bytes:
        if _BEYOND_LATIN.search(unit):
            return self._whole(unit)
        ids = self.fast.encode_ordinary(unit)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _SPECIAL in text or _ODD.search(text):
            return self._whole(text)
        units, cache = _UNIT.findall(text), self.cache
        missing = set(units).difference(cache)
        if len(cache) + len(missing) > CACHE_UNITS:
            cache.clear()
            missing = set(units)
            if len(missing) > CACHE_UNITS:
                return b"".join(map(self._unit, units))
        for unit in missing:
            cache[unit] = self._unit(unit)
        return b"".join(map(cache.__getitem__, units))


@functools.cache
def _encoder(tokeniser_path: str, ranks_path: str) -> Encoder:
    """One per Python worker, shared by its tasks."""
    return Encoder(tokeniser_path, ranks_path)


def tokenise(docs: DataFrame, tokeniser_path: str, ranks_path: str, text: str = "text", key: str = "doc_id",
             capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents: key, piece, start, length, ids_crc32."""
    end = np.zeros(1, dtype="<u4").tobytes()

    def run(batches):
        encoder = _encoder(tokeniser_path, ranks_path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, len(ids), 256):
                rows, piece, start, length, crc = [], [], [], [], []
                for r, value in enumerate(texts.slice(at, 256).to_pylist(), at):
                    blob = encoder.encode(value) + end
                    n = len(blob) // 4
                    first = n % capacity or capacity
                    cuts = [0, *range(first, n + 1, capacity)]
                    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append(r)
                        piece.append(p)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(blob[4 * a: 4 * b]))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=[key, "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every length, and the number of bins.

    Open bins are stacks by free length; a bit per free length with an open bin finds the
    tightest fitting one. Ties in length keep the given order.
    """
    order = np.argsort(-lengths, kind="stable")
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_bits, n_bins = 0, 0
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    for i in order.tolist():
        need = int(lengths[i])
        fitting = open_bits >> need
        if fitting:
            free = need + (fitting & -fitting).bit_length() - 1
            b = stacks[free].pop()
            if not stacks[free]:
                open_bits ^= 1 << free
        else:
            free, b = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = b, capacity - free
        rest = free - need
        if rest:
            stacks[rest].append(b)
            open_bits |= 1 << rest
    return bins, offsets, n_bins


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Largest bound that two families of dual feasible functions give.

    For a threshold t <= capacity / 2: lengths above capacity - t count as a whole bin and
    lengths below t as nothing; and, for every k, lengths are rounded as
    floor((k + 1) * length / capacity) / k unless that product is whole. The sums of such
    values over the pieces never exceed the number of bins of any packing.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    n, words = np.cumsum(count), np.cumsum(count * size)
    best = -(-int(words[-1]) // capacity)
    t = np.arange(1, capacity // 2 + 1)
    whole = n[-1] - n[capacity - t]
    middle = words[capacity - t] - words[t - 1]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    for k in range(1, 101):
        scaled = (k + 1) * size
        # in units of 1 / (k * capacity)
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    return best


def _pack_group(group: pa.Table, capacity: int, column: str) -> tuple[pa.Table, np.ndarray, int]:
    """Rows with bin and offset; rows are first put in an order that reruns share."""
    group = group.combine_chunks().sort_by([(c, "ascending") for c in ("length", "_k", "piece", "ids_crc32")])
    lengths = group["length"].to_numpy()
    bins, offsets, n_bins = best_fit_decreasing(lengths, capacity)
    group = group.set_column(group.schema.get_field_index(column), column, pa.array(bins))
    group = group.set_column(group.schema.get_field_index("offset"), "offset", pa.array(offsets))
    return group, lengths, n_bins


def _exchange(turn: int, capacity: int):
    """The function that repacks one team of groups in round ``turn``."""

    def repack(team: pa.Table) -> pa.Table:
        """Empty the sequences with room of all groups of a team and pack them together."""
        team = team.combine_chunks()
        where, length = team["grp"].to_numpy(), team["length"].to_numpy()
        seq = np.unique(np.stack([team["round"].to_numpy(), where, team["bin"].to_numpy()]), axis=1,
                        return_inverse=True)[1].ravel()
        fill = np.bincount(seq, weights=length)
        loose = fill[seq] < capacity
        if not loose.any():
            return team
        old_bins = int((fill < capacity).sum())
        part, lengths, n_bins = _pack_group(team.filter(pa.array(loose)), capacity, "bin")
        proven = n_bins == lower_bound(lengths, capacity)
        if n_bins >= old_bins and not proven:
            return team
        for name, value in (("grp", int(where.min())), ("round", turn), ("done", proven)):
            field = part.schema.field(name)
            part = part.set_column(part.schema.get_field_index(name), name,
                                   pa.array(np.full(len(lengths), value), field.type))
        kept = team.filter(pa.array(~loose))
        kept = kept.set_column(kept.schema.get_field_index("done"), "done",
                               pa.array(np.ones(len(kept), dtype=bool)))
        return pa.concat_tables([kept, part])

    return repack


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES,
         rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    pieces = materialise(pieces, "pack-pieces")
    n = pieces.count()
    groups = max(1, math.ceil(n / group_pieces))
    rows = pieces.select(
        F.col(key).alias("_k"), "piece", "start", "length", "ids_crc32",
        # By row number, not by value: equal rows must not meet in one group.
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("grp"),
        F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"),
        F.lit(False).alias("done"), F.lit(0).cast("long").alias("team"), F.lit(0).alias("round"))
    schema = rows.schema

    def first(group: pa.Table) -> pa.Table:
        group, lengths, n_bins = _pack_group(group, capacity, "bin")
        proven = n_bins == lower_bound(lengths, capacity)
        return group.set_column(group.schema.get_field_index("done"), "done",
                                pa.array(np.full(len(lengths), proven)))

    packed = materialise(rows.groupBy("grp").applyInArrow(first, schema), "pack-0")
    for turn in range(1, rounds + 1):
        if groups < 2 or not packed.where("not done").limit(1).count():
            break

        # Groups meet other groups in every round; groups that are proven stay out.
        size = F.lit(EXCHANGE_GROUPS)
        gapped = packed.where("not done").withColumn("team", F.floor(
            F.pmod(F.col("grp") * (2 * turn - 1) + (turn - 1), F.lit(groups)) / size).cast("long"))
        packed = materialise(packed.where("done").unionByName(
            gapped.groupBy("team").applyInArrow(_exchange(turn, capacity), schema)), f"pack-{turn}")
    sequence = F.col("round").cast("long") * (1 << 58) + F.col("grp") * (1 << 26) + F.col("bin")
    return packed.select(F.col("_k").alias(key), "piece", "start", "length", "ids_crc32",
                         sequence.alias("sequence_id"), "offset")
