import itertools

import numpy as np
import pytest

from branchlens.llm import packing as K
from branchlens.llm.queries import op3_pack, tokeniser_paths
from branchlens.llm.tables import table


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_encoder_equals_tokeniser_on_whole_texts():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokeniser_paths()[0])
    texts = ["", None, " ", "\n\n", "a b", "a  b \n\n c\n", "tab\there x", "nb sp", "it's we'll 12 34x !!! a",
             "end <|endoftext|> in text", "été  ñandú\n \n", "x" * 3000, "a\r\nb", "a \x1c b", "​ zero", "日本 語 "]
    encoder = K.Encoder(*tokeniser_paths())
    for text in texts:
        blob = encoder.encode(text)
        assert np.frombuffer(blob, "<u4").tolist() == t.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_encoder_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(K, "CACHE_UNITS", 5)
    small, texts = K.Encoder(*tokeniser_paths()), ["one two three four five six seven", "nine ten", "a b c", "d e f"]
    got = [small.encode(t) for t in texts]
    assert len(small.cache) <= 5
    monkeypatch.setattr(K, "CACHE_UNITS", 10 ** 6)
    assert got == [K.Encoder(*tokeniser_paths()).encode(t) for t in texts]


def optimum(lengths, capacity):
    best = len(lengths)

    def place(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(lengths):
            best = len(room)
            return
        for b in {r: k for k, r in enumerate(room) if r >= lengths[i]}.values():
            room[b] -= lengths[i]
            place(i + 1, room)
            room[b] += lengths[i]
        place(i + 1, [*room, capacity - lengths[i]])

    place(0, [])
    return best


def test_bound_never_exceeds_optimum_and_bfd_is_valid():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths = np.sort(rng.integers(1, 21, rng.integers(1, 9)))[::-1]
        best = optimum(lengths.tolist(), 20)
        bins, offsets, n = K.best_fit_decreasing(lengths, 20)
        assert K.lower_bound(lengths, 20) <= best <= n
        assert max(np.bincount(bins, weights=lengths)) <= 20
    assert K.lower_bound(np.array([11, 11, 11, 9, 9]), 20) == 3
    assert K.lower_bound(np.array([], dtype=int), 20) == 0


def test_op3_on_the_table(spark, sf_dir):
    from tokenizers import Tokenizer
    import zlib
    t = Tokenizer.from_file(tokeniser_paths()[0])
    rows = op3_pack(spark, sf_dir).collect()
    n = check(rows, 2048)
    docs = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by.keys() == docs.keys()
    for d, pieces in by.items():
        ids = np.array([*t.encode(docs[d] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == [0, *itertools.accumulate(r.length for r in pieces)][:-1]
        assert all(r.length == 2048 for r in pieces[1:]) and sum(r.length for r in pieces) == len(ids)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start: r.start + r.length].tobytes())
    assert n <= K.lower_bound(np.array([r.length for r in rows])) + 1


def test_exchange_between_groups_saves_sequences(spark):
    rows = [(i, 0, 0, 5 + i % 7, i) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    counts = []
    for rounds in (0, 2):
        out = K.pack(df, capacity=20, group_pieces=25, rounds=rounds).collect()
        assert sorted(r.doc_id for r in out) == list(range(400))
        counts.append(check(out, 20))
    assert counts[1] < counts[0]


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "", 2), (3, "a b c", 3)],
                                 "doc_id long, text string, length int")
    out = K.pack(K.tokenise(docs, *tokeniser_paths())).collect()
    assert sorted((r.doc_id or 0, r.length) for r in out) == [(0, 1), (1, 1), (1, 1), (3, 4)]
    check(out, 2048)
    assert K.pack(K.tokenise(docs.limit(0), *tokeniser_paths())).collect() == []
