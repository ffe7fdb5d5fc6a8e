"""Near-duplicate documents by DartMinHash.

A document is the multiset of its five-word shingles; an element's weight is
how often it occurs (any positive weights work). The plane over an element,
weight by rank, is strewn with darts by a Poisson process that depends only on the
element; each dart carries a coordinate from 0 to k-1. A document owns the region up to
its weight. Per coordinate the dart of lowest rank in the owned regions is kept:
two documents keep the same dart with probability equal to their weighted
Jaccard similarity. Only darts under a rank limit are thrown, about k (ln k + 3)
for a document whatever its length, so a signature costs O(k log k + shingles).

Signatures are cut into ``BANDS`` bands of ``ROWS`` coordinates (a pair at 0.8
meets in some band with probability 0.9999). Equal texts are one text from
here on. Texts that meet are compared exactly:

1. every text of a bucket with one representative of it, drawn by a hash that
   differs between buckets: as many comparisons as texts, not pairs of texts;
2. links found so far give classes; then the texts of buckets where several
   classes are left are compared across classes, by an exact prefix-filtered join.

A link inside a class changes nothing, so no link is lost. The classes are
the connected components.

Defined cases: texts under five words are one shingle; null and blank texts have
no shingles and each is a class of its own; equal rows are in one class; a class is
named by its smallest doc_id (null if it has none); an empty table gives an
empty result. A document is held as a whole by the task that hashes it.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
K = BANDS * ROWS
SALTS = 6                     # kinds of representative
CELLS = 100_000               # shingles hashed together
MASK = 16                     # words of 64 bits in the parity bitmap of a text
_U = np.uint64
_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the shingles in order, repeats included."""
    ws = (text or "").encode("utf-8", "surrogatepass").split()      # the six ASCII blanks
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    if len(h) < SHINGLE:
        return _mix64(np.array([np.sum(h * _MUL[:len(h)]) + _U(len(h))], np.uint64))
    n, s = len(h) - SHINGLE + 1, np.zeros(len(h) - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        s += h[i:i + n] * _MUL[i]
    return _mix64(s)


def units(s: np.ndarray) -> np.ndarray:
    """The multiset as a set: the c-th occurrence of a shingle has a hash of its own."""
    o = np.sort(s)
    new = np.ones(len(o), bool)
    new[1:] = o[1:] != o[:-1]
    if new.all():
        return o
    first = np.flatnonzero(new)
    c = np.arange(len(o)) - np.repeat(first, np.diff(np.append(first, len(o))))
    return np.where(c == 0, o, _mix64(o + c.astype(np.uint64) * _U(0x9E3779B97F4A7C15)))


def cells(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Regions of weighted elements as cells of unit weight, with the share of each that is owned."""
    n = np.ceil(weights).astype(np.int64)
    c = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    ids = np.where(c == 0, np.repeat(elements, n), _mix64(np.repeat(elements, n) + c.astype(np.uint64) * _U(0x9E3779B97F4A7C15)))
    return ids, np.minimum(1.0, np.repeat(weights, n) - c)


def signatures(ids: np.ndarray, owned: np.ndarray, sizes: np.ndarray, k: int = K) -> np.ndarray:
    """One row of k kept darts per document; ``sizes`` cells each, one or more, in ``ids`` one after another."""
    n = len(sizes)
    sig = np.full(n * k, np.iinfo(np.uint64).max, np.uint64)
    doc = np.repeat(np.arange(n), sizes)
    weight = np.bincount(doc, owned, n)
    limit, todo = k * (math.log(k) + 3) / weight, np.ones(n, bool)
    while todo.any():
        at = np.flatnonzero(todo[doc])
        rank, m = np.zeros(len(at)), 0
        while len(at):                                              # the m-th dart of each cell
            m += 1
            d = _mix64(ids[at] ^ _U(m * 0xD1B54A32D192ED03 % 2 ** 64))
            rank -= np.log(((d >> _U(11)).astype(np.float64) + 1) * 2.0 ** -53)
            low = rank < limit[doc[at]]
            at, rank, d = at[low], rank[low], d[low]
            e = _mix64(d + _U(0x632BE59BD9B4E019))
            hit = (_mix64(e) >> _U(11)).astype(np.float64) * 2.0 ** -53 < owned[at]
            kept = (rank[hit].astype(np.float32).view(np.uint32).astype(np.uint64) << _U(32)) | (d[hit] & _U(0xFFFFFFFF))
            np.minimum.at(sig, doc[at][hit] * k + (e[hit] % _U(k)).astype(np.int64), kept)
        todo = (sig.reshape(n, k) == np.iinfo(np.uint64).max).any(axis=1)
        limit = np.where(todo, 2 * limit, limit)
    return sig.reshape(n, k)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(documents, BANDS) of signed 64-bit bucket keys."""
    s = sig.reshape(len(sig), BANDS, ROWS)
    key = np.zeros((len(sig), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = _mix64(key * _U(0x9E3779B97F4A7C15) + s[:, :, r])
    return key.view(np.int64)


def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def done(keys, sets):
        ids = np.concatenate(sets)
        sig = signatures(ids, np.ones(len(ids)), np.array([len(x) for x in sets]))
        return pd.DataFrame({"key": keys, "bands": list(band_keys(sig))})

    for pdf in batches:
        keys, sets, n = [], [], 0
        for key, text in zip(pdf["key"], pdf["text"]):
            u = units(shingles(text))
            if not len(u):
                continue
            keys, sets, n = [*keys, key], [*sets, u], n + len(u)
            if n >= CELLS:
                yield done(keys, sets)
                keys, sets, n = [], [], 0
        if keys:
            yield done(keys, sets)


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for i in range(0, len(pdf), 200):
            part = pdf.iloc[i:i + 200]
            yield pd.DataFrame({"tid": part["tid"], "u": [units(shingles(t)).view(np.int64) for t in part["text"]]})


def _unit_sets(tids: DataFrame, keyed: DataFrame, texts: DataFrame) -> DataFrame:
    """(tid, u): the shingles of the texts named."""
    who = texts.join(tids, "tid").select("tid", F.col("key").alias("k"), F.col("min_doc"))
    # one row for each text: that of its smallest doc_id
    rows = (keyed.join(who, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("min_doc")))
            .select("tid", "text"))
    return rows.mapInPandas(_units, "tid long, u array<long>").dropDuplicates(["tid"])


def _similar(pairs: DataFrame, u: DataFrame) -> DataFrame:
    """The pairs (a, b) of text ids with similarity ``THRESHOLD`` or more."""
    both = (pairs.join(u.select(F.col("tid").alias("a"), F.col("u").alias("ua")), "a")
            .join(u.select(F.col("tid").alias("b"), F.col("u").alias("ub")), "b"))
    both = both.withColumn("i", F.size(F.array_intersect("ua", "ub")))
    return both.filter(F.col("i") >= THRESHOLD * (F.size("ua") + F.size("ub") - F.col("i")) - 1e-9).select("a", "b")


def _mask(u: str) -> Column:
    """Parity bitmap of a set of hashes: each flips a bit. Two bitmaps differ in at most as many bits as the sets in elements."""
    return F.expr(f"transform(sequence(0, {MASK - 1}), j -> aggregate({u}, 0L, (a, x) -> "
                  f"if((shiftright(x, 6) & {MASK - 1}) = j, a ^ shiftleft(1L, cast(x & 63 as int)), a)))")


def _across(u: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of texts of different labels that can reach ``THRESHOLD``, by prefix filter: with the
    shingles of each text in one order, rare ones first, two texts that similar share one among
    the first ``n - ceil(THRESHOLD n) + 1``. A text edited beyond the threshold has its own
    edits there and meets nobody, however large the group it comes from. Texts edited less, but apart from each
    other by more than the threshold, do meet; their bitmaps tell them apart inside the join."""
    one = u.select("tid", F.size("u").alias("n"), F.explode("u").alias("e"))
    often = one.groupBy("e").agg(F.count("*").alias("f"))
    first = (one.join(often, "e").groupBy("tid", "n").agg(F.sort_array(F.collect_list(F.struct("f", "e"))).alias("s"))
             .withColumn("s", F.slice("s", F.lit(1), F.col("n") - F.ceil(F.col("n") * THRESHOLD - 1e-9).cast("int") + 1))
             .select("tid", "n", F.posexplode("s").alias("p", "s")).filter("s.f > 1")
             .select("tid", "n", "p", F.col("s.e").alias("e")).join(labels, "tid"))
    first = C.materialize(first.join(u.select("tid", _mask("u").alias("m")), "tid"), "near-prefix")
    x, y = first.alias("x"), first.alias("y")
    c = lambda n: F.col(n)
    least = THRESHOLD / (1 + THRESHOLD) * (c("x.n") + c("y.n")) - 1e-9           # shared shingles needed
    # texts that similar differ in at most (n1 + n2) (1 - THRESHOLD) / (1 + THRESHOLD) shingles
    most = (1 - THRESHOLD) / (1 + THRESHOLD) * (c("x.n") + c("y.n")) + 1e-9
    apart = F.aggregate(F.zip_with(c("x.m"), c("y.m"), lambda a, b: F.bit_count(a.bitwiseXOR(b)).cast("int")), F.lit(0), lambda a, b: a + b)
    return (x.join(y, (c("x.e") == c("y.e")) & (c("x.label") < c("y.label")) & (c("x.n") >= THRESHOLD * c("y.n") - 1e-9)
                   & (c("y.n") >= THRESHOLD * c("x.n") - 1e-9) & (F.least(c("x.n") - c("x.p"), c("y.n") - c("y.p")) >= least) & (apart <= most))
            .select(F.least(c("x.tid"), c("y.tid")).alias("a"), F.greatest(c("x.tid"), c("y.tid")).alias("b")).distinct())


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, key (of the text; null without words), class_id."""
    key = F.when(F.col("text").rlike(C.HAS_WORD), F.md5("text"))
    keyed = docs.select("doc_id", key.alias("key"), "text").filter(F.col("key").isNotNull())
    bands = keyed.mapInPandas(_keyed_bands, "doc_id long, key string, bands array<long>")
    signed = C.materialize(bands, "near-bands")
    # text ids exist once written; a text's copies all carry the same bands
    texts = C.materialize(signed.groupBy("key").agg(F.min("doc_id").alias("min_doc"), F.any_value("bands").alias("bands"))
                          .withColumn("tid", F.monotonically_increasing_id()), "near-texts")
    put = texts.select("tid", F.explode("bands").alias("bucket"))
    salt = F.pmod("bucket", F.lit(SALTS))
    full = (put.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("tid", F.xxhash64("tid", salt)).alias("rep"))
            .filter(F.col("n") > 1))
    members = C.materialize(put.join(full, "bucket"), "near-members")
    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    tried = C.materialize(members.filter("tid != rep").select(*pair("tid", "rep")).distinct(), "near-pairs")
    met = tried.select(F.explode(F.array("a", "b")).alias("tid")).distinct()
    u = C.materialize(_unit_sets(met, keyed, texts), "near-units")
    links = C.materialize(_similar(tried, u), "near-links")
    found = components(links)

    big = (members.filter("n > 2").join(found, F.col("tid") == F.col("node"), "left")
           .select("bucket", "tid", F.coalesce("label", "tid").alias("label")))
    several = big.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("bucket")
    open_ = C.materialize(big.join(several, "bucket").select("tid", "label").distinct(), "near-open")
    if open_.limit(1).count():
        rest = C.materialize(_across(u.join(open_.select("tid"), "tid"), open_).join(tried, ["a", "b"], "left_anti"), "near-pairs")
        more = C.materialize(_similar(rest, u), "near-links")
        if more.limit(1).count():
            found = components(links.union(more))

    named = texts.join(found, F.col("tid") == F.col("node"), "left").select("key", "min_doc", F.coalesce("label", "tid").alias("label"))
    ids = named.groupBy("label").agg(F.min("min_doc").alias("class_id"))
    by_key = named.join(ids, "label").select(F.col("key").alias("k"), "class_id")
    all_ = docs.select("doc_id", key.alias("key"))
    return (all_.join(by_key, F.col("key") == F.col("k"), "left")
            .select("doc_id", "key", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")))


def _keyed_bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``_bands`` with doc_id; the texts of a batch that are equal are hashed once."""
    for pdf in batches:
        one = pdf.drop_duplicates("key")
        of = {k: b for part in _bands(iter([one])) for k, b in zip(part["key"], part["bands"])}
        yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "key": pdf["key"], "bands": pdf["key"].map(of)})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id and keep, true for the one that stays."""
    return classes(docs).select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("keep"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class, that with the smallest doc_id, all columns kept."""
    c = classes(docs)
    key, won = C.own(docs, [], "_key"), C.own(docs, [], "_won")
    best = (c.filter(F.col("key").isNotNull() & F.col("doc_id").eqNullSafe(F.col("class_id")))
            .groupBy(F.col("key").alias(won)).agg(F.min("doc_id").alias(won + "id")))
    d = docs.withColumn(key, F.when(F.col("text").rlike(C.HAS_WORD), F.md5("text")))
    kept = (d.filter(F.col(key).isNotNull()).join(best, (F.col(key) == F.col(won)) & F.col("doc_id").eqNullSafe(F.col(won + "id")))
            .drop(won, won + "id").dropDuplicates([key]).drop(key))
    return d.filter(F.col(key).isNull()).drop(key).unionByName(kept).select(*docs.columns)
