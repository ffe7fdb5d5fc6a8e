"""Toxicity scores from averaged subword embeddings.

A text is the bag of the distinct byte n-grams of its lower-cased words (word borders count
as a blank), hashed into ``BUCKETS``; a word repeated a thousand times counts
once. Their embeddings, weighted by rarity, are averaged, and a linear softmax tells toxic from not; embeddings and softmax are
trained together in numpy. The embeddings take plain gradient steps: a bucket then moves as far as
its texts agree, and a few telling words stand out among many that occur in either kind (steps scaled
per bucket would let these learn the texts by heart); the small softmax takes Adam steps. A misspelt word
shares most of its n-grams with the word it comes from, so it need not have been seen.

The model is fitted on the bags of at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled documents, those
first in the order of a hash of their id, whatever the length of their texts: bags are made of whole texts inside the tasks, and
one takes 32 KB at most (144 MB in all). Of these, so many of both kinds are fitted on, in the same order, that their bags hold no more than
``MAX_ENTRIES`` n-grams together. Scoring covers every text as a whole.

As the softmax is linear, its logit is an average of one number per bucket: only
that table (1 MB) is broadcast.

Defined cases: null, empty and blank texts have no n-grams and get the score of
the bias alone; rows without a label or with a null label teach nothing; with no usable label
of both kinds every score is 0.5; repeated rows are scored alike, and of several texts under one doc_id one teaches; an empty
table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

NGRAMS = (3, 4, 5)
BITS = 18
BUCKETS = 1 << BITS
DIM = 8
MIN_TEXTS = 5                 # training texts that a bucket must occur in to be trained
STEPS = 300                   # batches trained on, whatever the sample's size
BATCH = 128
RATE = 0.05                   # Adam, softmax
EMB_RATE = 100.0              # gradient steps, embeddings; an average over a text has small gradients
MAX_TOXIC = 1500
MAX_CLEAN = 3000
MAX_ENTRIES = 8_000_000       # n-grams in the bags fitted on
FOLDS = 5
PIECE = 1 << 18               # bytes of a text hashed together


def grams(data: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at every position, and whether it lies in one word (borders included)."""
    m = len(data) - n + 1
    if m <= 0:
        return np.empty(0, np.uint32), np.empty(0, bool)
    blank = data <= 32
    b = np.where(blank, np.uint8(32), data).astype(np.uint32)
    h = np.full(m, n, np.uint32)
    for i in range(n):
        h = h * np.uint32(0x01000193) + b[i:i + m]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    inner = blank[1:1 + m].copy()
    for i in range(2, n - 1):
        inner |= blank[i:i + m]
    return h >> np.uint32(32 - BITS), ~inner


def bag(text: str | None) -> np.ndarray:
    """The distinct buckets of a text; a very long one is read piece by piece."""
    data = np.frombuffer(b" " + (text or "").lower().encode("utf-8", "surrogatepass") + b" ", np.uint8)
    if len(data) <= PIECE:
        return np.unique(np.concatenate([g[ok] for g, ok in (grams(data, n) for n in NGRAMS)]))
    met = np.zeros(BUCKETS, bool)
    for a in range(0, len(data), PIECE):
        for n in NGRAMS:
            g, ok = grams(data[a:a + PIECE + n - 1], n)
            met[g[ok]] = True
    return np.flatnonzero(met)


def pack(b: np.ndarray) -> bytes:
    """A bag as a list of buckets or, where that is shorter, as one bit per bucket."""
    if 4 * len(b) < BUCKETS // 8:
        return b.astype("<u4").tobytes()
    met = np.zeros(BUCKETS, bool)
    met[b] = True
    return np.packbits(met).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    if len(raw) < BUCKETS // 8:
        return np.frombuffer(raw, "<u4").astype(np.int32)
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8))).astype(np.int32)


class Model:
    """``slope``: per bucket its share of the logit; ``weight``: per bucket its rarity; ``bias``."""

    def __init__(self, slope: np.ndarray, weight: np.ndarray, bias: float):
        self.slope, self.weight, self.bias = slope, weight, bias

    def scores(self, texts: list) -> np.ndarray:
        z = np.full(len(texts), self.bias)
        for i, t in enumerate(texts):
            b = bag(t)
            if len(b):
                z[i] += self.slope[b].sum(dtype=np.float64) / self.weight[b].sum(dtype=np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(texts: list, labels: list[int], seed: int = 11) -> Model:
    return fit_bags([bag(t) for t in texts], labels, seed)


def fit_bags(seen: list[np.ndarray], labels: list[int], seed: int = 11) -> Model:
    """The model of these bags; the list is emptied as they are read into batches."""
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), np.ones(BUCKETS, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    df = np.zeros(BUCKETS)
    for b in seen:
        df[b] += 1
    # a bucket met in few texts tells little: it counts in the average but stays at 0
    weight = np.where(df >= MIN_TEXTS, np.log((1 + len(seen)) / (1 + df)), np.log((1 + len(seen)) / (1 + MIN_TEXTS))).astype(np.float32)
    weight = np.maximum(weight, 0.01)
    emb = rng.normal(0, 0.01, (BUCKETS, DIM)).astype(np.float32)
    emb[df < MIN_TEXTS] = 0
    out, bias = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    order = rng.permutation(len(seen))
    jobs = []
    for a in range(0, len(order), BATCH):
        rows = order[a:a + BATCH]
        doc, idx, val = [], [], []
        for r, i in enumerate(rows):
            b = seen[i]
            w = weight[b]
            keep = df[b] >= MIN_TEXTS
            doc.append(np.full(keep.sum(), r))
            idx.append(b[keep])
            val.append((w / w.sum())[keep] if len(w) else w)
            seen[i] = None                                     # its n-grams are in the batch now
        doc, idx, val = np.concatenate(doc).astype(np.int32), np.concatenate(idx).astype(np.int32), np.concatenate(val).astype(np.float32)
        by = np.argsort(idx, kind="stable").astype(np.int32)
        used, first = np.unique(idx[by], return_index=True)
        jobs.append((rows, doc, idx, val, by, used, first))
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in (("out", out), ("bias", bias))}
    t = 0

    def adam(name, value, grad):
        m, v = state[name]
        m[:] = 0.9 * m + 0.1 * grad
        v[:] = 0.99 * v + 0.01 * grad * grad
        value -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)

    while t < STEPS:
        for j in rng.permutation(len(jobs))[:STEPS - t]:
            rows, doc, idx, val, by, used, first = jobs[j]
            t += 1
            hid = np.zeros((len(rows), DIM), np.float32)
            part = emb[idx] * val[:, None]
            for d in range(DIM):
                hid[:, d] = np.bincount(doc, part[:, d], len(rows))
            z = hid @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            down = (p @ out.T).astype(np.float32)
            grad = np.add.reduceat((down[doc] * val[:, None])[by], first, axis=0) if len(used) else np.zeros((0, DIM), np.float32)
            adam("out", out, hid.T @ p)
            adam("bias", bias, p.sum(axis=0))
            emb[used] -= EMB_RATE * grad
    side = out[:, 1] - out[:, 0]
    return Model(((emb @ side) * weight).astype(np.float32), weight, float(bias[1] - bias[0]))


def remainder(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, bag): the bounded sample of labelled documents outside the held-out fold."""
    docs = docs.select("doc_id", "text")
    known = (labels.filter(F.col("toxic").isin(0, 1) & (remainder(F.col("doc_id")) != 0))
             .select(F.col("doc_id").alias("_id"), F.col("toxic").alias("y")))
    ids = docs.filter("text IS NOT NULL").select("doc_id").join(known, F.col("doc_id") == F.col("_id")).select("doc_id", "y").distinct()
    by_hash = lambda y, most: ids.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = C.materialize(by_hash(0, MAX_CLEAN).union(by_hash(1, MAX_TOXIC)), "tox-sample").withColumnRenamed("doc_id", "_id")

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["y"], "bag": [pack(bag(t)) for t in pdf["text"]]})

    taught = docs.filter("text IS NOT NULL").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", F.col("y").cast("int"), "text")
    return taught.mapInPandas(bags, "doc_id long, toxic int, bag binary").groupBy("doc_id", "toxic").agg(F.min("bag").alias("bag"))


def bounded(bags: list[np.ndarray], labels: list[int], most: int) -> np.ndarray:
    """The numbers of the first bags of each kind, as large a share of both, that hold ``most`` n-grams together."""
    y = np.array(labels, np.int64)
    rank = np.zeros(len(y))
    for v in (0, 1):
        rank[y == v] = (np.arange((y == v).sum()) + 0.5) / max((y == v).sum(), 1)
    order = np.argsort(rank, kind="stable")
    return order[np.cumsum([len(bags[i]) for i in order]) <= most] if len(order) else order


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = sample(docs, labels).withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id", "toxic").toLocalIterator()
    seen, y = [], []
    for r in rows:
        seen.append(unpack(r.bag))
        y.append(int(r.toxic))
    use = bounded(seen, y, MAX_ENTRIES).tolist()
    seen, y = [seen[i] for i in use], [y[i] for i in use]
    return fit_bags(seen, y)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s = shared.value.scores(pdf["text"].tolist())
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": s, "predicted": (s >= 0.5).astype("int32")})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    return (score(docs, train(docs, labels))
            .select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", "predicted"))
