"""Quality classifier: a factorisation machine over hashed words and structure.

Features of a text: its distinct case-folded words hashed into ``BUCKETS`` slots with
weight sqrt(count / words), structure statistics (repetition, punctuation, letter case,
lines, lengths; the text's own size is its metadata), and each statistic's bin. The score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

so all pairwise interactions cost time linear in the text. Labels, language, source and
document id are never features.

The model is fitted on a bounded sample: at most ``TRAIN_ROWS`` labelled documents, the
ones with the smallest hash of their id. Its parameters have a fixed size (about 160 KB)
and travel with the scoring tasks, which read every text once and shuffle nothing.

Edge cases: null and empty texts have no words and zero statistics, and get the score of
that vector; repeated rows are scored each; documents whose labels contradict each other
and labels other than 0/1 are not learned from; without usable labels every score is 0.5;
an input column called ``score`` is replaced; all other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .textops import Words, gram_hashes, slices, text_bytes

BUCKETS = 4096
RANK = 8
BINS = 10
TRAIN_ROWS = 6000
EPOCHS = 14
BATCH = 96

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "!#$%&*+<=>?@[]^_`{|}~\\/"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_HIGH = np.arange(256) >= 0xC0
STATISTICS = 20


def _per_doc(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[offsets]).astype(np.float64)


def features(data: np.ndarray, offsets: np.ndarray):
    """Sparse words and dense statistics of a slice of texts.

    Returns (document of each distinct word, its bucket, its weight, dense matrix).
    """
    n = len(offsets) - 1
    w = Words(data, offsets, fold_case=True)
    words = np.maximum(w.counts, 1).astype(np.float64)
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    docs = w.docs()

    low = np.uint64((1 << 40) - 1)
    keys, counts = np.unique((docs.astype(np.uint64) << np.uint64(40)) | (w.hashes & low), return_counts=True)
    key_doc = (keys >> np.uint64(40)).astype(np.int64)
    bucket = (keys % np.uint64(BUCKETS)).astype(np.int64)
    weight = np.sqrt(counts / words[key_doc])
    distinct = np.bincount(key_doc, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, key_doc, counts)

    def share(per_word: np.ndarray) -> np.ndarray:
        return np.bincount(docs, weights=per_word, minlength=n) / words

    length = (w.ends - w.starts).astype(np.float64)
    same = np.zeros(len(docs))
    if len(docs) > 1:
        same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (docs[1:] == docs[:-1])
    _, gram_doc, grams = gram_hashes(w.hashes, w.first, 2)
    gram_keys = np.unique((gram_doc.astype(np.uint64) << np.uint64(40)) | (grams & low))
    distinct_grams = np.bincount((gram_keys >> np.uint64(40)).astype(np.int64), minlength=n)
    n_grams = np.maximum(w.counts - 1, 1)
    last = data[w.ends - 1] if len(w.ends) else np.zeros(0, np.uint8)
    lead = data[w.starts] if len(w.starts) else np.zeros(0, np.uint8)
    lines = _per_doc(data == 10, offsets)
    letters = np.maximum(_per_doc(_UPPER[data] | _LOWER[data], offsets), 1)
    mean_length = share(length)
    stats = np.stack([
        _per_doc(_UPPER[data], offsets) / letters,
        _per_doc(_DIGIT[data], offsets) / size,
        np.sqrt(_per_doc(_SYMBOLS[data], offsets) / size),
        _per_doc(_HIGH[data], offsets) / size,
        np.sqrt(_per_doc(data == ord("|"), offsets) / words),
        np.sqrt(_per_doc(data == ord("!"), offsets) / words),
        _per_doc(data == ord("."), offsets) / words,
        _per_doc(data == ord(","), offsets) / words,
        np.sqrt(lines / words),
        np.log1p(size) / 14,
        np.log1p(w.counts) / 12,
        mean_length / 16,
        np.sqrt(np.maximum(share(length ** 2) - mean_length ** 2, 0)) / 12,
        distinct / words,
        np.sqrt(top / words),
        np.sqrt(share(same)),
        distinct_grams / n_grams,
        share(length > 14),
        share(length <= 3),
        share(_SYMBOLS[last] | _SYMBOLS[lead]),
    ], axis=1) if n else np.zeros((0, STATISTICS))
    stats[w.counts == 0] = 0
    stats = np.clip(stats, 0, 1)
    slot = np.minimum((stats * BINS).astype(int), BINS - 1)
    binned = (slot[:, :, None] == np.arange(BINS)).reshape(n, STATISTICS * BINS)
    return key_doc, bucket, weight, np.concatenate([stats, binned * 0.5], axis=1)


DENSE = STATISTICS * (1 + BINS)


@dataclass(frozen=True)
class FactorisationMachine:
    bias: float
    linear: np.ndarray   # BUCKETS + DENSE
    factors: np.ndarray  # (BUCKETS + DENSE) x RANK

    def scores(self, key_doc, bucket, weight, dense) -> np.ndarray:
        """Scores in linear time by the sum-of-squares identity."""
        n = len(dense)
        y = np.full(n, self.bias)
        y += dense @ self.linear[BUCKETS:]
        y += np.bincount(key_doc, weights=self.linear[bucket] * weight, minlength=n)
        v = self.factors[BUCKETS:]
        sums = dense @ v
        squares = (dense ** 2) @ (v ** 2).sum(1)
        norms = (self.factors[:BUCKETS] ** 2).sum(1)
        squares += np.bincount(key_doc, weights=norms[bucket] * weight ** 2, minlength=n)
        for f in range(self.factors.shape[1]):
            sums[:, f] += np.bincount(key_doc, weights=self.factors[bucket, f] * weight, minlength=n)
        y += 0.5 * ((sums ** 2).sum(1) - squares)
        return 1 / (1 + np.exp(-np.clip(y, -60, 60)))


def _constant(p: float) -> FactorisationMachine:
    odds = np.log(p / (1 - p))
    return FactorisationMachine(float(odds), np.zeros(BUCKETS + DENSE), np.zeros((BUCKETS + DENSE, RANK)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> FactorisationMachine:
    """Adam on the logistic loss; rows are (buckets, weights, dense, label). Same rows, same model."""
    if not rows:
        return _constant(0.5)
    labels = np.array([r[3] for r in rows], dtype=np.float64)
    if labels.min() == labels.max():
        return _constant(float((labels.sum() + 0.5) / (len(labels) + 1)))
    rng = np.random.default_rng(11)
    dims = BUCKETS + DENSE
    w, v = np.zeros(dims), rng.normal(0, 0.02, (dims, RANK))
    b = float(np.log(labels.mean() / (1 - labels.mean())))
    state = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in (("w", w), ("v", v))}
    step, rate, decay = 0, 0.01, 1e-4
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            batch = order[at: at + BATCH]
            x = np.zeros((len(batch), dims))
            for i, r in enumerate(batch):
                np.add.at(x[i], rows[r][0], rows[r][1])
                x[i, BUCKETS:] = rows[r][2]
            sums, x2 = x @ v, x ** 2
            y = b + x @ w + 0.5 * ((sums ** 2).sum(1) - (x2 @ (v ** 2)).sum(1))
            g = (1 / (1 + np.exp(-np.clip(y, -60, 60))) - labels[batch]) / len(batch)
            grads = {"w": x.T @ g + decay * w,
                     "v": x.T @ (g[:, None] * sums) - (x2.T @ g)[:, None] * v + decay * v}
            step += 1
            b -= rate * g.sum()
            for name, p in (("w", w), ("v", v)):
                m1, m2 = state[name]
                m1 += 0.1 * (grads[name] - m1)
                m2 += 0.001 * (grads[name] ** 2 - m2)
                p -= rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return FactorisationMachine(b, w, v)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
          max_rows: int = TRAIN_ROWS) -> FactorisationMachine:
    """Fit on at most ``max_rows`` labelled documents (smallest hash of the key first)."""
    spark = docs.sparkSession
    usable = (labels.select(F.col(key).alias("k"), F.col(label).alias("y")).where("k is not null and y in (0, 1)")
              .groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2"))
    chosen = usable.select("k", "y").orderBy(F.xxhash64("k"), "k").limit(max_rows)
    sample = [(r.k, int(r.y)) for r in chosen.collect()]  # at most max_rows small rows
    if not sample:
        return _constant(0.5)
    picked = spark.createDataFrame(sample, T.StructType([
        T.StructField("k", labels.schema[key].dataType), T.StructField("y", T.IntegerType())]))
    texts = (docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
             .join(F.broadcast(picked), "k").groupBy("k").agg(F.first("y").alias("y"), F.min("t").alias("t")))

    def vectors(batches):
        for batch in batches:
            data, offs = text_bytes(batch.column("t"))
            for i, j in slices(offs):
                kd, bucket, weight, dense = features(data[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                cut = np.searchsorted(kd, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column("k").slice(i, j - i), batch.column("y").slice(i, j - i),
                    pa.array([bucket[a:b].astype("<u2").tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                    pa.array([weight[a:b].astype("<f4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                    pa.array([d.astype("<f4").tobytes() for d in dense], pa.binary()),
                ], names=["k", "y", "bucket", "weight", "dense"])

    schema = T.StructType([texts.schema["k"], texts.schema["y"], *(
        T.StructField(c, T.BinaryType()) for c in ("bucket", "weight", "dense"))])
    rows = sorted(texts.mapInArrow(vectors, schema).collect(), key=lambda r: r.k)
    return fit([(np.frombuffer(r.bucket, "<u2").astype(np.int64), np.frombuffer(r.weight, "<f4").astype(np.float64),
                 np.frombuffer(r.dense, "<f4").astype(np.float64), r.y) for r in rows])


def score(docs: DataFrame, model: FactorisationMachine, text: str = "text", out: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the column ``out``: probability that the label is 1."""
    docs = docs.drop(out)

    def run(batches):
        for batch in batches:
            data, offs = text_bytes(batch.column(text))
            parts = [model.scores(*features(data[offs[i]: offs[j]], offs[i: j + 1] - offs[i]))
                     for i, j in slices(offs)]
            values = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())],
                                             names=[*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def is_held_out(key: str = "doc_id"):
    """Fold of a document that is never learned from: crc32 of the id's text modulo 3 is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))
