"""Removal of byte strings that occur earlier, with suffix arrays.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts earlier: in a
smaller document, or earlier in its own.

1. Shards. Every ``LENGTH``-byte string is filed under its minimizer, the ``GRAM``-byte gram of
   lowest hash in it. Equal strings have equal minimizers, so strings need to be compared
   only within a minimizer. Neighbouring strings mostly share theirs: a document
   becomes a list of segments, each the strings of one minimizer (about one per
   35 bytes); only (minimizer, two digests of the segment, document, place) is shuffled.
2. Equal segments (both 64-bit digests agree, over bytes and over mixed grams, and the minimizer) fall together: all but the earliest
   are repeats as a whole. What a batch repeats within itself is settled before the shuffle.
   A minimizer that is left with one segment has nothing to compare.
3. The rest, the ends of shared passages mostly, is cut from the texts and dealt by
   minimizer into shards of about ``SHARD`` bytes. A string that two segments share has its minimizer at
   the same place in both, so they agree in one of a few windows of ``CORE`` bytes around it; segments that agree
   with none in any have nothing to compare. The others are sorted: a shard's suffix array is built by
   induced sorting; common prefixes of ``LENGTH`` bytes in text order mark the classes of equal strings, and
   all but the earliest of a class are repeats.
4. A minimizer with over ``MOST`` different segments is not dealt to one task: its strings are
   shuffled one by one under a 128-bit hash and the earliest of each found by a grouped minimum.
5. Per document the repeats are joined to maximal runs and cut out.

Defined cases: a null text has no bytes; texts under ``LENGTH`` bytes keep all; null doc_ids come last
in order; rows equal in doc_id and text are one document, and each gets its result;
different texts under one doc_id are ordered by a hash of the text; an empty table
gives an empty result. A text is held as a whole by the task that cuts it.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .suffix import permuted_lcp, suffix_array

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1       # grams in a string
PIECE = 1 << 20                # bytes hashed together
SHARD = 1 << 19                # bytes in a suffix array
MOST = 8192                    # segments of a minimizer in a shard
STEP = 9                       # windows around a minimizer start every STEP bytes
CORE = LENGTH - STEP + 1       # bytes of them: any string with the minimizer holds one as a whole
_U = np.uint64
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 2 ** 64)
_BYTE = np.random.default_rng(100).integers(0, 2 ** 64, 256, dtype=np.uint64)
_LAST = 2 ** 63 - 1


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_ROOM = max(2 * PIECE + LENGTH, SHARD + MOST * (LENGTH + SPAN))   # the longest piece or shard
_UP, _DOWN = _powers(_P, _ROOM), _powers(_PINV, _ROOM)


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``digest`` reads the hash of any run of values."""
    s = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _UP[:len(values)], out=s[1:])
    return s


def digest(s: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return _mix64((s[hi] - s[lo]) * _DOWN[lo] + (hi - lo).astype(np.uint64))


def grams(data: np.ndarray) -> np.ndarray:
    """The hash of the ``GRAM`` bytes from each place on, by doubling."""
    h, width = _BYTE[data], 1
    while width < GRAM:
        left = h[:-width] * _U(pow(_P, width, 2 ** 64))
        left += h[width:]
        h = left
        width *= 2
    return _mix64(h)


def segments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(piece, minimizer, two digests, first string, strings) of the segments of the pieces
    ``data[starts[i]:ends[i]]``; places count from the piece's start."""
    n = len(data) - LENGTH + 1
    empty = np.empty(0, np.int64)
    if n <= 0:
        return empty, *[empty.view(np.uint64)] * 3, empty, empty
    h = grams(data)
    v = h & ~_U(2 ** 24 - 1)
    v |= np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    v = np.minimum(v[:n], v[SPAN - width:SPAN - width + n])
    at = (v & _U(2 ** 24 - 1)).astype(np.int64)               # place of each string's minimizer
    lengths = np.maximum(ends - starts - LENGTH + 1, 0)
    piece = np.repeat(np.arange(len(starts)), lengths)
    first = np.repeat(starts, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = at[first]
    if not len(at):
        return empty, *[empty.view(np.uint64)] * 3, empty, empty
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])
    lo = np.flatnonzero(new)
    count = np.diff(np.append(lo, len(at)))
    begin, piece = first[lo], piece[lo]
    end = begin + count + LENGTH - 1
    return (piece, h[at[lo]], digest(sums(_BYTE[data]), begin, end), digest(sums(h), begin, end - GRAM + 1),
            begin - starts[piece], count)


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list, list, list, list]]:
    """Batches of about PIECE bytes: data, and of each piece in it its text's number, its
    place in the text, its start and end in the data. Long texts are cut with an overlap, so that every string is in one piece."""
    parts, size, who, off, start, end = [], 0, [], [], [], []
    for i, t in enumerate(texts):
        for a in range(0, max(len(t) - LENGTH + 1, 0), PIECE):
            cut = t[a:a + PIECE + LENGTH - 1]
            if size and size + len(cut) > 2 * PIECE:
                yield np.frombuffer(b"".join(parts), np.uint8), who, off, start, end
                parts, size, who, off, start, end = [], 0, [], [], [], []
            who.append(i)
            off.append(a)
            start.append(size)
            parts.append(cut)
            size += len(cut)
            end.append(size)
            if size >= PIECE:
                yield np.frombuffer(b"".join(parts), np.uint8), who, off, start, end
                parts, size, who, off, start, end = [], 0, [], [], [], []
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), who, off, start, end


def _bytes(text) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


FILED = "p long, h long, g long, g2 long, d long, t long, s long, n int, dup boolean"
COLS = ["p", "h", "g", "g2", "d", "t", "s", "n", "dup"]


def _file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The segments; those that the same pieces hold earlier come marked ``dup``, dealt anywhere."""
    for pdf in batches:
        texts = [_bytes(t) for t in pdf["text"]]
        d, t = pdf["d"].to_numpy(), pdf["t"].to_numpy()
        for data, who, off, start, end in _pieces(texts):
            piece, h, g, g2, s, n = segments(data, np.array(start), np.array(end))
            who, off = np.array(who), np.array(off)
            out = pd.DataFrame({"h": h.view(np.int64), "g": g.view(np.int64), "g2": g2.view(np.int64),
                                "d": d[who[piece]], "t": t[who[piece]], "s": s + off[piece], "n": n.astype(np.int32)})
            out = out.sort_values(["d", "t", "s"], kind="stable")
            twin = out.duplicated(["h", "g", "g2"])
            same = out.duplicated(["h", "g", "g2", "d", "t", "s"])
            out["dup"] = twin
            any_ = _mix64(out["s"].to_numpy().astype(np.uint64) + _U(1) + out["d"].to_numpy().astype(np.uint64) * _U(_P)).view(np.int64)
            out["p"] = np.where(twin, any_, out["h"])
            yield out.loc[~same, COLS]


FOUND = "dup boolean, h long, d long, t long, s long, n int"


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reads segments sorted by (minimizer, digests, place): repeats of an equal segment are ``dup``; the first
    of each of several different segments of a minimizer goes on to be compared."""
    cols = ["dup", "h", "d", "t", "s", "n"]
    carry, several = None, False         # the last segment's first row; its minimizer has been met with another
    for pdf in batches:
        done = pdf[pdf["dup"]]
        rows = pdf[~pdf["dup"]]
        if carry is not None:
            rows = pd.concat([carry, rows])
        if not len(rows):
            yield done[cols]
            continue
        h, g, g2 = rows["h"].to_numpy(), rows["g"].to_numpy(), rows["g2"].to_numpy()
        newh = np.ones(len(rows), bool)
        newh[1:] = h[1:] != h[:-1]
        newg = newh.copy()
        newg[1:] |= (g[1:] != g[:-1]) | (g2[1:] != g2[:-1])
        place = rows[["d", "t", "s"]].to_numpy()
        first = place[np.maximum.accumulate(np.where(newg, np.arange(len(rows)), 0))]
        dup = ~newg & (place != first).any(axis=1)
        yield pd.concat([done, rows[dup].assign(dup=True)])[cols]
        run = np.cumsum(newh) - 1
        kinds = np.bincount(run[newg], minlength=run[-1] + 1)
        go = newg & (kinds[run] > 1)
        if carry is not None:
            go[run == 0] = newg[run == 0] & ((kinds[0] > 1) | several)
            if several:
                go[0] = False            # went on before
        yield rows[go].assign(dup=False)[cols]
        last = np.flatnonzero(newg)[-1]
        several = bool(go[last]) or (several and run[last] == 0)
        carry = rows.iloc[[last]]


def _by_document(found: DataFrame, columns: list[str]) -> DataFrame:
    return found.groupBy(F.col("d").alias("_d"), F.col("t").alias("_t")).agg(F.collect_list(F.struct(*columns)).alias("segs"))


CUT = "h long, d long, t long, s long, b binary"


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["h", "d", "t", "s", "b"]
    for pdf in batches:
        out = []
        for d, t, text, segs in zip(pdf["d"], pdf["t"], pdf["text"], pdf["segs"]):
            raw = _bytes(text)
            out += [(x["h"], d, t, x["s"], raw[x["s"]:x["s"] + x["n"] + LENGTH - 1]) for x in segs]
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)


REPEAT = "d long, t long, s long, n int"


def _runs(d, t, s) -> pd.DataFrame:
    """Places as runs of neighbouring ones."""
    order = np.lexsort((s, t, d))
    d, t, s = d[order], t[order], s[order]
    new = np.ones(len(s), bool)
    new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (s[1:] != s[:-1] + 1)
    lo = np.flatnonzero(new)
    return pd.DataFrame({"d": d[lo], "t": t[lo], "s": s[lo], "n": np.diff(np.append(lo, len(s))).astype(np.int32)})


def _text(rows: list[tuple]) -> tuple[np.ndarray, ...]:
    """The segments' bytes with a zero between them, where each begins, and its size."""
    text = b"\x00".join(r[4] for r in rows)
    sizes = np.array([len(r[4]) for r in rows])
    return text, np.cumsum(sizes + 1) - sizes - 1, sizes


def agreeing(rows: list[tuple]) -> list[tuple]:
    """The segments that agree with another of their minimizer in a window of ``CORE`` bytes around it, cut to the strings that
    hold such a window; where a segment holds its minimizer more than once, all of that minimizer as they are."""
    text, begin, sizes = _text(rows)
    data = np.frombuffer(text, np.uint8)
    h = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    seg = np.repeat(np.arange(len(rows)), sizes + 1)
    hit = np.flatnonzero(grams(data) == h[seg[:len(data) - GRAM + 1]])
    whole = np.bincount(seg[hit], minlength=len(rows)) != 1
    whole = np.isin(h, h[whole])
    at = np.zeros(len(rows), np.int64)
    at[seg[hit]] = hit
    total = sums(_BYTE[data])
    lo, hi = begin + sizes, begin.copy()                       # the bytes of the strings to keep
    for back in range(0, SPAN, STEP):                          # strings with the minimizer at back to back + STEP - 1
        w = at - back
        i = np.flatnonzero(~whole & (w >= begin) & (w + CORE <= begin + sizes))
        g = digest(total, w[i], w[i] + CORE)
        by = np.lexsort((g, h[i]))
        same = (g[by][1:] == g[by][:-1]) & (h[i][by][1:] == h[i][by][:-1])
        pair = np.zeros(len(by), bool)
        pair[1:] |= same
        pair[:-1] |= same
        i = i[by[pair]]
        lo[i] = np.minimum(lo[i], np.maximum(w[i] - STEP + 1, begin[i]))
        hi[i] = np.maximum(hi[i], np.minimum(w[i] + LENGTH, begin[i] + sizes[i]))
    lo, hi = np.where(whole, 0, lo - begin).tolist(), np.where(whole, sizes, hi - begin).tolist()
    return [(m, d, t, s + a, b[a:e]) for (m, d, t, s, b), a, e in zip(rows, lo, hi) if e - a >= LENGTH]


def repeats_in(rows: list[tuple]) -> pd.DataFrame:
    """Of segments (h, d, t, s, bytes): the strings that start earlier in another or the same segment."""
    rows = agreeing(rows)
    if not rows:
        return pd.DataFrame({"d": [], "t": [], "s": [], "n": []}, dtype=np.int64)
    text, begin, sizes = _text(rows)
    sa = suffix_array(np.frombuffer(text, np.uint8), 256)
    seg = np.repeat(np.arange(len(rows)), sizes + 1)[:len(text)]
    at = np.arange(len(text)) - begin[seg]
    whole = at + LENGTH <= sizes[seg]                 # a string that starts here lies in its segment
    # equal strings are neighbours in the array; suffixes between them that their segment cuts short share
    # the bytes, too, so a class ends where the shared prefix falls below LENGTH
    joined = permuted_lcp(text, sa, LENGTH)[sa] >= LENGTH
    keep = whole[sa]
    order, cls = sa[keep], np.cumsum(~joined)[keep]
    d = np.array([r[1] for r in rows])[seg[order]]
    t = np.array([r[2] for r in rows])[seg[order]]
    s = np.array([r[3] for r in rows])[seg[order]] + at[order]
    by = np.lexsort((s, t, d, cls))
    c = cls[by]
    later = np.zeros(len(c), bool)
    later[1:] = c[1:] == c[:-1]
    pick = by[later]
    return _runs(d[pick], t[pick], s[pick])


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reads cut segments sorted by minimizer; whole minimizers are gathered into shards."""
    rows, size, last = [], 0, None
    for pdf in batches:
        for h, d, t, s, b in zip(pdf["h"], pdf["d"], pdf["t"], pdf["s"], pdf["b"]):
            if size >= SHARD and h != last:
                yield repeats_in(rows)
                rows, size = [], 0
            rows.append((h, d, t, s, bytes(b)))
            size, last = size + len(b) + 1, h
    if rows:
        yield repeats_in(rows)


STRING = "w1 long, w2 long, d long, t long, s long"


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every string of the cut segments under a hash of 128 bits."""
    for pdf in batches:
        got = []
        for d, t, s, b in zip(pdf["d"], pdf["t"], pdf["s"], pdf["b"]):
            for i in range(len(b) - LENGTH + 1):
                w = hashlib.blake2b(b[i:i + LENGTH], digest_size=16).digest()
                got.append((int.from_bytes(w[:8], "big", signed=True), int.from_bytes(w[8:], "big", signed=True), d, t, s + i))
        yield pd.DataFrame(got, columns=["w1", "w2", "d", "t", "s"])


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the order of documents as (d, t)."""
    again = docs.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    t = F.xxhash64("text") if again else F.lit(0).cast("long")
    return docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(_LAST)).alias("d"), t.alias("t"))


def repeats(docs: DataFrame) -> DataFrame:
    """(d, t, s, n): runs of n places from byte s on where a string starts that starts earlier, too."""
    filed = docs.select("d", "t", "text").mapInPandas(_file, FILED)
    found = C.materialize(filed.repartition("p").sortWithinPartitions("p", "g", "g2", "d", "t", "s")
                          .mapInPandas(_compare, FOUND), "repeat-segments")
    equal = found.filter("dup").select("d", "t", "s", "n")
    open_ = found.filter("NOT dup")
    many = open_.groupBy(F.col("h").alias("_h")).agg((F.count("*") > MOST).alias("hot"))
    open_ = C.materialize(open_.join(many, F.col("h") == F.col("_h")).select("h", "d", "t", "s", "n", "hot"), "repeat-open")

    def cut(rows: DataFrame) -> DataFrame:
        of = _by_document(rows, ["h", "s", "n"])
        return docs.join(of, (F.col("d") == F.col("_d")) & (F.col("t") == F.col("_t"))).dropDuplicates(["d", "t"]).select("d", "t", "text", "segs").mapInPandas(_cut, CUT)

    out = equal.unionByName(cut(open_.filter("NOT hot")).repartition("h").sortWithinPartitions("h").mapInPandas(_search, REPEAT))
    if open_.filter("hot").limit(1).count():
        one = C.materialize(cut(open_.filter("hot")).mapInPandas(_strings, STRING), "repeat-strings")
        first = one.groupBy(F.col("w1").alias("_1"), F.col("w2").alias("_2")).agg(F.min(F.struct("d", "t", "s")).alias("first"))
        later = (one.join(first, (F.col("w1") == F.col("_1")) & (F.col("w2") == F.col("_2")))
                 .filter(F.struct("d", "t", "s") != F.col("first")))
        out = out.unionByName(later.select("d", "t", "s", F.lit(1).alias("n")))
    return C.materialize(out, "repeat-places")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        ids = pdf["doc_id"].astype("Int64").tolist()
        for a in range(0, len(pdf), 256):
            out = []
            for i in range(a, min(a + 256, len(pdf))):
                raw, segs = _bytes(pdf["text"].iloc[i]), pdf["segs"].iloc[i]
                spans, kept = [], raw
                if segs is not None and len(segs):
                    for s, n in sorted((x["s"], x["n"]) for x in segs):
                        e = s + n + LENGTH - 1
                        if spans and s <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], e)
                        else:
                            spans.append([s, e])
                    cuts = [0, *(x for s in spans for x in s), len(raw)]
                    kept = b"".join(raw[cuts[j]:cuts[j + 1]] for j in range(0, len(cuts), 2))
                out.append((ids[i], len(raw), len(raw) - len(kept), len(spans), kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]).astype({"doc_id": "Int64"})


def remove_repeats(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, and the bytes kept."""
    docs = keyed(documents)
    segs = _by_document(repeats(docs), ["s", "n"])
    return (docs.join(segs, (F.col("d") == F.col("_d")) & (F.col("t") == F.col("_t")), "left")
            .select("doc_id", "text", "segs").mapInPandas(_remove, RESULT))
