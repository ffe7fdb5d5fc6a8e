"""Mixing sources to target weights.

The documents of a source form a stream of words, cut into blocks of a fixed
number of words. A mix is a list of slots, one block each:

1. Targets: the sources, by code point with null last, weigh ``WEIGHTS`` in
   turn and share all words; a target over ``MAX_EPOCHS`` times its source is cut to
   that, and what is cut goes to the others by weight, until none is over.
2. For every output shard the number of slots per source is a multinomial draw
   whose probabilities are what each source still has to give, and never more
   than that; so the whole mix meets each target to within a block.
3. The slots of a source are numbered through all shards. Slot ``j`` takes, in
   pass ``j // n_blocks``, block ``perm(j % n_blocks)`` under a keyed pseudorandom
   permutation of the block indexes (swap-or-not), another one for each pass; no
   list of blocks is ever shuffled or held.
4. Slots and blocks are joined by (source, block index).

A stream is numbered in chunks of about ``CHUNK_WORDS`` words (documents are dealt
to chunks by a hash of their id), so that no window holds a whole source.
The driver sees one row per source, and draws ``shards`` x sources numbers.

Defined cases: a null or blank text has size 0 and is never taken; null is a
source of its own; repeated rows count as documents of their own; an empty
table gives an empty mix; other columns are not read. Equal input and seed
give an equal mix.
"""
from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK_WORDS = 128
CHUNK_WORDS = 1 << 20
SHARDS = 256
ROUNDS = 40
SLOT_STEP = 1 << 16          # slots made from one row at a time
_U = np.uint64


def targets(sizes: dict, weights=WEIGHTS, max_epochs=MAX_EPOCHS) -> dict:
    """source -> words to take."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got, open_, left = {}, list(order), float(sum(sizes.values()))
    while open_:
        per = left / sum(weigh[s] for s in open_)
        over = [s for s in open_ if per * weigh[s] > max_epochs * sizes[s]]
        if not over:
            return got | {s: per * weigh[s] for s in open_}
        for s in over:
            got[s] = float(max_epochs * sizes[s])
            left -= got[s]
            open_.remove(s)
    return got


def draw(slots: list[int], shards: int, seed: str) -> np.ndarray:
    """Slots per shard and source; the columns add up to ``slots``."""
    rng = np.random.default_rng(list(hashlib.sha256(seed.encode()).digest()))
    left, out = np.array(slots, dtype=np.int64), []
    for i in range(shards):
        take, row = math.ceil(int(left.sum()) / (shards - i)), np.zeros_like(left)
        while take > 0:
            got = np.minimum(rng.multinomial(take, left / left.sum()), left)
            row, left, take = row + got, left - got, take - int(got.sum())
        out.append(row)
    return np.array(out).reshape(shards, len(slots))


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def permute(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Image of ``x`` under the permutation of 0..n-1 that ``key`` names, row by row."""
    x, n, key = (np.asarray(a).astype(np.uint64) for a in (x, n, key))
    for r in range(ROUNDS):
        k = _mix64(key + _U(2 * r + 1)) % n
        other = (k + n - x) % n
        swap = _mix64(_mix64(key ^ _U(r << 32)) + np.maximum(x, other)) & _U(1)
        x = np.where(swap == 1, other, x)
    return x.astype(np.int64)


@F.pandas_udf(T.LongType())
def _permuted(x: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permute(x.to_numpy(), n.to_numpy(), key.to_numpy()))


def words_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(C.HAS_WORD + "+")).cast("long")


class Mix:
    """``docs``: rid, doc_id, source, size, source_size, target. ``parts``: one row per block
    and document (source_no, block, rid, start, n_words). ``slots``: shard, source_no, slot, block."""

    def __init__(self, docs: DataFrame, parts: DataFrame, slots: DataFrame):
        self.docs, self.parts, self.slots = docs, parts, slots

    def fragments(self) -> DataFrame:
        """The mix: what each slot takes of which document."""
        return self.slots.join(self.parts, ["source_no", "block"])

    def taken(self) -> DataFrame:
        """One row per document with the words that the mix takes of it."""
        n = self.fragments().groupBy("rid").agg(F.sum("n_words").alias("taken"))
        return (self.docs.join(n, "rid", "left")
                .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, block: int = BLOCK_WORDS,
        shards: int = SHARDS, seed: str = "mix") -> Mix:
    spark = docs.sparkSession
    sized = C.materialize(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source",
                                      words_of(F.col("text")).alias("size")), "mix-sizes")
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = {r.source: r.size for r in rows}
    want = targets(sizes, weights, max_epochs)
    named = spark.createDataFrame(
        [(i, r.source, r.size, want[r.source], max(1, math.ceil((r.size + r.n) / CHUNK_WORDS))) for i, r in enumerate(rows)],
        "source_no int, s string, source_size long, target double, chunks long")
    d = sized.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    d = d.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks"))).drop("chunks")

    per_chunk = (d.groupBy("source_no", "chunk").agg(F.sum("size").alias("n"))
                 .withColumn("blocks", F.ceil(F.col("n") / block)))
    w = W.partitionBy("source_no").orderBy("chunk")
    bases = C.materialize(per_chunk.withColumn("base", F.sum("blocks").over(w) - F.col("blocks"))
                          .select("source_no", "chunk", "blocks", "base"), "mix-chunks")
    n_blocks = {r.source_no: r.n for r in bases.groupBy("source_no").agg(F.sum("blocks").alias("n")).collect()}

    at = W.partitionBy("source_no", "chunk").orderBy("doc_id", "size", "rid").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (d.withColumn("end", F.sum("size").over(at)).filter(F.col("size") > 0)
              .join(bases.drop("blocks"), ["source_no", "chunk"]).withColumn("start", F.col("end") - F.col("size")))
    parts = (placed.withColumn("b", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
             .withColumn("lo", F.greatest(F.col("start"), F.col("b") * block))
             .select("source_no", (F.col("base") + F.col("b")).alias("block"), "rid", "doc_id",
                     (F.col("lo") - F.col("start")).alias("start"),
                     (F.least(F.col("end"), (F.col("b") + 1) * block) - F.col("lo")).alias("n_words")))

    nb = [n_blocks.get(i, 0) for i in range(len(rows))]
    # a block holds on average a little less than ``block`` words, as each chunk's last one is short
    k = [min(max_epochs * n, round(want[r.source] * n / r.size)) if r.size else 0 for r, n in zip(rows, nb)]
    per_shard = draw(k, shards, seed) if sum(k) else np.zeros((0, len(k)), dtype=np.int64)
    first = np.cumsum(per_shard, axis=0) - per_shard
    plan = [(s, i, int(first[s, i]), int(per_shard[s, i]), nb[i]) for s in range(len(per_shard)) for i in range(len(nb)) if per_shard[s, i]]
    runs = spark.createDataFrame(plan, "shard int, source_no int, j0 long, n long, n_blocks long")
    key = F.xxhash64(F.lit(seed), F.col("source_no"), F.floor(F.col("slot") / F.col("n_blocks")))
    slots = (runs.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(SLOT_STEP).cast("long"))))
             .withColumn("i", F.explode(F.sequence(F.col("o"), F.least(F.col("o") + SLOT_STEP, F.col("n")) - 1)))
             .withColumn("slot", F.col("j0") + F.col("i"))
             .select("shard", "source_no", "slot", _permuted(F.col("slot") % F.col("n_blocks"), "n_blocks", key).alias("block")))
    return Mix(d.drop("chunk", "source_no"), parts, slots)


def texts(m: Mix, docs: DataFrame, block_texts: str = "text") -> DataFrame:
    """The mix with the words of each fragment, joined by single blanks."""
    ws = docs.select("doc_id", C.words(F.col("text")).alias("_w"))
    return (m.fragments().join(ws, "doc_id")
            .withColumn(block_texts, F.array_join(F.slice("_w", (F.col("start") + 1).cast("int"), F.col("n_words").cast("int")), " "))
            .drop("_w"))
