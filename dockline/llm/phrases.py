"""Phrase collocations from n-gram counts in prefix and suffix order.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and these into
words. f counts the occurrences of a phrase inside pieces, per language. The layout is
that of external n-gram estimation, with one stream of counts per order:

1. Order by order, tasks count the n-grams of their texts by sorting packed word numbers and pass on one
   row per distinct n-gram and slice of texts; the sums of all slices are the counts, of which those
   of at least ``min_count`` are written as the stream of that order.
   An n-gram can only reach ``min_count`` if both its (n-1)-grams do, so the next order passes on only
   n-grams whose parts are in a bit filter of fixed size made from the stream before. The filter
   errs on one side only (a false hit costs a row, the sum is exact), so it does not touch results.
2. Each stream is kept in prefix order (first n-1 words) and in suffix order (last n-1 words).
   Lockstep merge joins of sorted streams give every phrase the counts of its left and right parts,
   and, against the next order in both layouts, its most frequent extension on either side.
   No hash table of counts is built or looked up.
3. Score of a cut: floor(10^6 * a^2 / (l * r)) with decimals of 38 digits; the least cut counts. A phrase
   goes if an extension has at least ``cover`` of its count. (A longer phrase that covers it
   has an extension of it inside that is at least as frequent, so neighbours by one word suffice.)

Memory: a task holds ``SLICE`` bytes of text or one text, whichever is more, and the filter of
``FILTER_BITS`` bits, which is all that is broadcast. On a vocabulary that fills
the filter nothing is lost, more rows are shuffled.

Defined cases: a null language is ``und``; null, empty and blank texts have no words; equal rows
count as often as they stand there; ties are ordered by count, then by the bytes of the phrase; an empty table
gives no rows; other columns are not read.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common as C

MAX_WORDS = 3
MIN_COUNT = 10
COVER = (50, 100)          # an extension covers a phrase from 50 of 100 occurrences on
TOP = 2000
SLICE = 1 << 22            # bytes of text counted at a time
FILTER_BITS = 1 << 24
SPREAD = 32
NO_LANG = "und"

# byte classes: 0 word, 1 blank, 2 end of a piece
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def _word_hash(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(np.asarray(words.to_pylist(), dtype=object), categorize=False) if len(words) else np.zeros(0, _U)


def _chain(parts: list[np.ndarray]) -> np.ndarray:
    """One hash from the hashes of the words in order."""
    h = np.zeros(len(parts[0]), dtype=_U)
    for p in parts:
        h = _mix(h * _U(0x9E3779B97F4A7C15) + p)
    return h


class Tokens:
    """Words of some texts: ``ids`` into ``vocab`` for each run of word, blank or end bytes; ``word[t]``."""

    def __init__(self, texts: pa.Array):
        closed = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
        ends = np.frombuffer(closed.buffers()[1], dtype=np.int64)[closed.offset:closed.offset + len(closed) + 1]
        data = np.frombuffer(closed.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]]
        data = _LOWER[data]
        cls = _CLASS[data]
        cuts = np.flatnonzero(cls[1:] != cls[:-1]) + 1
        offsets = np.concatenate([[0], cuts, [len(data)]]).astype(np.int64) if len(data) else np.zeros(1, np.int64)
        runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        d = runs.dictionary_encode()
        self.vocab = d.dictionary.cast(pa.large_string())
        self.ids = d.indices.to_numpy()
        self.cls = cls[offsets[:-1]] if len(data) else cls
        self.word = self.cls == 0


def _grams(t: Tokens, n: int, passing) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct n-grams of ``t`` that ``passing`` lets through, as word numbers by place, with counts.
    Words of a piece stand two runs apart with one blank run between."""
    start = np.flatnonzero(t.word)
    for k in range(1, n):
        start = start[start + 2 * k < len(t.ids)]
        start = start[(t.cls[start + 2 * k - 1] == 1) & t.word[start + 2 * k]]
    if not len(start):
        return [np.zeros(0, np.int64)] * n, np.zeros(0, np.int64)
    if passing is not None:
        h = _word_hash(t.vocab)
        at = [h[t.ids[start + 2 * k]] for k in range(n)]
        ok = passing(_chain(at[:-1])) & passing(_chain(at[1:]))
        start = start[ok]
    # packed two by two: the number of the distinct first k words, then the next word
    key, levels = t.ids[start].astype(np.int64), []
    for k in range(1, n):
        if k > 1:
            distinct, key = np.unique(key, return_inverse=True)
            levels.append(distinct)
        key = (key << 32) | t.ids[start + 2 * k]
    distinct, counts = np.unique(key, return_counts=True)
    parts = []
    while n > 1 and len(parts) < n - 1:
        parts.append(distinct & 0xFFFFFFFF)
        distinct = distinct >> 32
        if levels:
            distinct = levels.pop()[distinct]
    return [distinct] + parts[::-1], counts


def _counter(n: int, bits):
    """Task function: (lang, text) batches to (gram, n) of slices of texts; a gram is its words, which hold
    no blank, and then the language."""
    def run(batches):
        filt = None if bits is None else bits.value

        def passing(h):
            at = h & _U(len(filt) * 8 - 1)
            return (filt[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1

        def flush(held):
            for lang in sorted(held):
                t = Tokens(pa.concat_arrays(held[lang]))
                parts, counts = _grams(t, n, passing if filt is not None else None)
                for lo in range(0, len(counts), 1 << 16):
                    words = [t.vocab.take(pa.array(p[lo:lo + (1 << 16)])) for p in parts]
                    grams = pc.binary_join_element_wise(*words, pa.scalar(lang, pa.large_string()), pa.scalar(" ", pa.large_string()))
                    yield pa.RecordBatch.from_arrays([grams.cast(pa.string()), pa.array(counts[lo:lo + (1 << 16)], pa.int64())], names=["gram", "n"])
        held, size = {}, 0
        for b in batches:
            langs, texts = b.column(0), b.column(1).cast(pa.large_string())
            lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            upto, lo = np.concatenate([[0], np.cumsum(lengths)]), 0
            while lo < len(lengths):
                # rows up to the slice's end, one at least
                hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + SLICE - size, side="right")) - 1)
                part, names = texts.slice(lo, hi - lo), langs.slice(lo, hi - lo)
                for lang in pc.unique(names).to_pylist():
                    held.setdefault(lang, []).append(part.filter(pc.equal(names, lang)))
                size += int(upto[hi] - upto[lo])
                lo = hi
                if size >= SLICE:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)
    return run


def _filter_of(stream: DataFrame, n: int, size: int) -> np.ndarray:
    """Bit filter of a stream's n-grams, ``size`` bits whatever the stream's length."""
    def places(batches):
        for b in batches:
            words = [b.column(i) for i in range(n)]
            at = np.unique(_chain([_word_hash(w) for w in words]) & _U(size - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(at & 63)], names=["block", "bit"])
    bits = (stream.select(*_w(n)).mapInArrow(places, "block long, bit long")
            .groupBy("block").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit AS int))")).alias("bits")))
    out = np.zeros(size // 64, dtype=np.int64)
    for r in bits.toLocalIterator():                    # at most size / 64 rows
        out[r.block] = r.bits
    return out.view(np.uint8)


def _w(n: int, first: int = 1) -> list[str]:
    return [f"w{i}" for i in range(first, first + n)]


def streams(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) with all word occurrences, and the count streams of orders 1 to ``max_words``: lang, w1.., n."""
    spark = docs.sparkSession
    src = docs.filter("text IS NOT NULL").select(F.coalesce("lang", F.lit(NO_LANG)).cast("string").alias("lang"), "text")
    total, out, filt = None, [], None
    for n in range(1, max_words + 1):
        part = F.split("gram", " ", n + 1)
        got = (src.mapInArrow(_counter(n, filt), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
               .select(part[n].alias("lang"), *[part[i].alias(w) for i, w in enumerate(_w(n))], "n"))
        if n == 1:
            got = C.materialize(got, "phrase-words")
            total = got.groupBy("lang").agg(F.sum("n").alias("n"))
        out.append(C.materialize(got.filter(F.col("n") >= min_count), f"phrase-{n}"))
        if filt is not None:
            filt.unpersist()
        if n < max_words:
            filt = spark.sparkContext.broadcast(_filter_of(out[-1], n, FILTER_BITS))
    return total, out


def _renamed(stream: DataFrame, n: int, first: int, count: str) -> DataFrame:
    """The stream of order ``n`` with its words under the names of places ``first`` on."""
    return stream.select("lang", *[F.col(f"w{i + 1}").alias(f"w{first + i}") for i in range(n)], F.col("n").alias(count))


def _score(a: Column, l: Column, r: Column) -> Column:
    d = "decimal(38,0)"
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (a.cast("decimal(15,0)") * a.cast("decimal(15,0)")),
                           (l.cast("decimal(19,0)") * r.cast("decimal(19,0)")).cast(d))


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP, cover=COVER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases."""
    total, st = streams(docs, max_words, min_count)
    found = None
    for n in range(2, max_words + 1):
        cand = st[n - 1].withColumnRenamed("n", "a")
        for k in range(1, n):
            # prefix order against the stream of the first k words, suffix order against that of the rest
            cand = cand.join(_renamed(st[k - 1], k, 1, f"l{k}").hint("merge"), ["lang"] + _w(k))
            cand = cand.join(_renamed(st[n - k - 1], n - k, k + 1, f"r{k}").hint("merge"), ["lang"] + _w(n - k, k + 1))
        if n < max_words:
            right = _renamed(st[n], n + 1, 1, "x").groupBy("lang", *_w(n)).agg(F.max("x").alias("xr"))
            left = _renamed(st[n], n + 1, 0, "x").groupBy("lang", *_w(n)).agg(F.max("x").alias("xl"))
            cand = cand.join(right.hint("merge"), ["lang"] + _w(n), "left").join(left.hint("merge"), ["lang"] + _w(n), "left")
            most = F.greatest(F.coalesce("xr", F.lit(0)), F.coalesce("xl", F.lit(0)))
            cand = cand.filter(F.lit(cover[1]) * most < F.lit(cover[0]) * F.col("a"))
        cuts = F.array(*[F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                                  F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, n)])
        cand = cand.withColumn("cut", F.array_min(cuts)).select(
            "lang", F.concat_ws(" ", *_w(n)).alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
        found = cand if found is None else found.unionByName(cand)
    # first within parts of a language, so that no task sorts more than SPREAD times ``top`` phrases of one
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    found = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
    found = found.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    best = W.partitionBy("lang").orderBy(*order)
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL)),
t AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p)),
f1 AS (SELECT lang, w1, count(*) AS f FROM t GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM t WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM t WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT g.lang, g.w1 || ' ' || g.w2 AS phrase, g.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 g JOIN f1 x USING (lang, w1) JOIN f1 y ON y.lang = g.lang AND y.w1 = g.w2
  WHERE g.f >= 10
    AND NOT EXISTS (SELECT 1 FROM f3 e WHERE e.lang = g.lang AND e.w1 = g.w1 AND e.w2 = g.w2 AND 100 * e.f >= 50 * g.f)
    AND NOT EXISTS (SELECT 1 FROM f3 e WHERE e.lang = g.lang AND e.w2 = g.w1 AND e.w3 = g.w2 AND 100 * e.f >= 50 * g.f)
  UNION ALL
  SELECT g.lang, g.w1 || ' ' || g.w2 || ' ' || g.w3, g.f, 1, x.f, y.f
  FROM f3 g JOIN f1 x USING (lang, w1) JOIN f2 y ON y.lang = g.lang AND y.w1 = g.w2 AND y.w2 = g.w3
  UNION ALL
  SELECT g.lang, g.w1 || ' ' || g.w2 || ' ' || g.w3, g.f, 2, x.f, y.f
  FROM f3 g JOIN f2 x USING (lang, w1, w2) JOIN f1 y ON y.lang = g.lang AND y.w1 = g.w3),
scored AS (SELECT *, (1000000::hugeint * a * a // (l::hugeint * r))::bigint AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored),
total AS (SELECT lang, sum(f)::bigint AS n FROM f1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
