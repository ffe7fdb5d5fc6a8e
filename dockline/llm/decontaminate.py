"""Benchmark decontamination by edit distance.

Items and documents are read as words (lower case, outer punctuation
dropped). A document window leaks an item of ``n`` words when their edit distance, in words,
is at most ``floor(n * (1 - SIMILARITY))``.

1. Windows. An item-sized window can be that close only if it shares a run
   of ``q`` words with the item (each edit breaks at most ``q`` of the ``n - q + 1`` runs, and ``q``
   is chosen per item so that some remain). Every such shared run sets one window, aligned on
   it. This leaves out only windows that can't match.
2. CGK embedding. Item and window are walked with the same random bits: at
   step ``t`` the word under the pointer is written out, and a bit drawn from (t, word)
   says whether the pointer moves on. Strings at small edit distance
   then differ in few of the 3n written places.
3. Bit-sampling LSH. Of each of ``WALKS`` independent walks ``SAMPLES`` samples of ``BITS``
   places are compared; a window equal to its item in any sample is a candidate. The number of
   walks is measured, not guessed, and for each item length of its own: ``walks_for`` edits items of that length to
   the limit, and doubles the walks until ``RECALL`` of the edited copies collide. Long items
   need more walks than short ones. A length that would need over ``MOST_WALKS`` isn't hashed: all
   its windows go to the exact check.
4. Exact check. Candidates are verified by edit distance to the best
   substring around the window.

The items are sent to the tasks in blocks of at most ``BLOCK_BYTES`` of text, one pass
over the documents for each block, so the broadcast has a bound whatever the benchmark's size.

Defined cases: null and blank items or texts match nothing; items with equal
words are searched once and reported under each id; repeated rows are reported
once each; an empty table gives an empty result.
"""
from __future__ import annotations

import random
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

SIMILARITY = 0.8
RECALL = 0.99
BITS = 4
SAMPLES = 32                    # of each walk
WALKS = 4                       # to begin with
MOST_WALKS = 64                 # more than these cost more than the exact check
TRY_WORDS = 1 << 19             # words of edited copies that the walks of a length are measured on
BLOCK_BYTES = 32 << 20
MAX_Q = 3
BATCH_CHARS = 8 << 20           # text searched together
STEP_WINDOWS = 1 << 14          # windows embedded together
PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»“”„‘’…"
_U = np.uint64


def tokens(text: str | None) -> list[str]:
    """The words, lower-cased, without punctuation around them; words of nothing else are skipped."""
    return [w for x in (text or "").lower().split() if (w := x.strip(PUNCT))]


def limit(n: int) -> int:
    return int(n * (1 - SIMILARITY) + 1e-9)


def run_length(n: int) -> int:
    """The longest q up to MAX_Q for which every match of n words keeps a run of q words."""
    return next((q for q in range(MAX_Q, 0, -1) if n - q + 1 - limit(n) * q >= 1), 1)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def embed(rows: np.ndarray, walk: int, steps: int | None = None) -> np.ndarray:
    """CGK embedding of equally long rows of word numbers (>= 0): 3n places each; -1 after the end."""
    m, n = rows.shape
    out = np.full((m, steps or 3 * n), -1, np.int64)
    padded = np.concatenate([rows, np.full((m, 1), -1, rows.dtype)], axis=1)
    at, every = np.zeros(m, np.int64), np.arange(m)
    for t in range(out.shape[1]):
        word = padded[every, at]
        out[:, t] = word
        bit = _mix64(word.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _U((walk << 32) + t)) & _U(1)
        at = np.minimum(at + bit.astype(np.int64), n)
    return out


def places(n: int, walk: int) -> np.ndarray:
    """(SAMPLES, BITS) places of a walk over n words that are compared. The first 2n are drawn
    from: a walk of n words ends after 2n steps on average."""
    return np.random.default_rng([n, walk]).integers(0, max(1, 2 * n), (SAMPLES, BITS))


def sampled(rows: np.ndarray, walk: int) -> np.ndarray:
    """One hash per row and sample of a walk: of the words at the sample's places."""
    p = places(rows.shape[1], walk)
    e = embed(rows, walk, int(p.max()) + 1)
    h = np.zeros((len(rows), len(p)), np.uint64)
    for b in range(p.shape[1]):
        h = _mix64(h + e[:, p[:, b]].astype(np.uint64) + _U(b))
    return h


def collide(rows: np.ndarray, items: list[np.ndarray], which: np.ndarray, walks: int) -> np.ndarray:
    """Which of ``rows`` agree in some sample of some walk with the item ``which`` names;
    ``items`` holds the items' sampled hashes, one array per walk."""
    hit = np.zeros(len(rows), bool)
    for w in range(walks):
        left = np.flatnonzero(~hit)
        if not len(left):
            break
        hit[left] = (sampled(rows[left], w) == items[w][which[left]]).any(axis=1)
    return hit


def edits(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to a substring of ``text``, with that substring's start and end."""
    d, start = np.arange(len(item) + 1), np.zeros(len(item) + 1, np.int64)
    best = (int(d[-1]), 0, 0)
    prev, pstart = d.tolist(), start.tolist()
    it = item.tolist()
    for j, w in enumerate(text.tolist(), 1):
        cur, cstart = [0], [j]
        for i, x in enumerate(it, 1):
            c, s = prev[i - 1] + (x != w), pstart[i - 1]
            if prev[i] + 1 < c:
                c, s = prev[i] + 1, pstart[i]
            if cur[i - 1] + 1 < c:
                c, s = cur[i - 1] + 1, cstart[i - 1]
            cur.append(c)
            cstart.append(s)
        prev, pstart = cur, cstart
        if cur[-1] < best[0]:
            best = (cur[-1], cstart[-1], j)
    return best


def edited(item: np.ndarray, rng: random.Random) -> list[int]:
    """A copy of ``item`` edited up to the limit; new words have numbers from 10 ** 9."""
    y = item.tolist()
    for e in range(limit(len(item))):
        i = rng.randrange(len(y))
        kind = rng.randrange(3)
        if kind == 0:
            y[i] = 10 ** 9 + e
        elif kind == 1:
            del y[i]
        else:
            y.insert(i, 10 ** 9 + e)
    return y


def walks_for(items: list[np.ndarray], seed: int = 7) -> int | None:
    """Walks with which RECALL of copies edited up to the limit collide, measured on ``items``, which are
    of one length; None if MOST_WALKS don't do. Equal rows always collide."""
    n = len(items[0])
    if not limit(n):
        return 1
    rng = random.Random(seed * 1_000_003 + n)
    tries = max(100, min(2000, TRY_WORDS // n))
    a = np.array([rng.choice(items) for _ in range(tries)])
    after = [2 * 10 ** 9 + i for i in range(n)]                              # what follows a copy in its window
    b = np.array([(edited(x, rng) + after)[:n] for x in a])
    left, walks, done = np.arange(tries), WALKS, 0
    while walks <= MOST_WALKS:
        for w in range(done, walks):
            left = left[~(sampled(a[left], w) == sampled(b[left], w)).any(axis=1)]
            if not len(left):
                break
        if len(left) <= (1 - RECALL) * tries:
            return walks
        walks, done = 2 * walks, walks
    return None


class Index:
    """One block of items, ready to search."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids: dict[tuple, list] = defaultdict(list)
        for i, t in rows:
            if w := tuple(tokens(t)):
                self.ids[w].append(i)
        self.number = {w: i for i, w in enumerate(sorted({x for t in self.ids for x in t}))}
        self.items = [np.array([self.number[x] for x in t]) for t in self.ids]
        self.owners = list(self.ids.values())
        self.row, self.walks, self.hashes = {}, {}, {}                      # row of an item; per length: walks, hashes per walk
        by_n = defaultdict(list)
        for j, x in enumerate(self.items):
            self.row[j] = len(by_n[len(x)])
            by_n[len(x)].append(x)
        for n, mine in by_n.items():
            self.walks[n] = walks_for(mine)
            self.hashes[n] = [sampled(np.array(mine), w) for w in range(self.walks[n] or 0)]
        self.runs = {q: defaultdict(list) for q in range(1, MAX_Q + 1)}      # hash of q words -> (item, offset)
        for j, x in enumerate(self.items):
            q = run_length(len(x))
            for o, h in enumerate(self.grams(x, q).tolist()):
                self.runs[q][h].append((j, o))
        self.keys = {q: np.array(sorted(r), np.uint64) for q, r in self.runs.items() if r}

    @staticmethod
    def grams(x: np.ndarray, q: int) -> np.ndarray:
        n = len(x) - q + 1
        h = np.zeros(max(n, 0), np.uint64)
        for i in range(q):
            h = _mix64(h + x[i:i + n].astype(np.uint64) + _U(1)) if n > 0 else h
        return h

    def windows(self, x: np.ndarray) -> set[tuple[int, int]]:
        """(item, start) of the windows that share a run with an item."""
        found = set()
        for q, keys in self.keys.items():
            if len(x) < q:
                continue
            g = self.grams(x, q)
            at = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
            for p in np.flatnonzero(keys[at] == g).tolist():
                found.update((j, p - o) for j, o in self.runs[q][int(g[p])])
        return found

    def search(self, texts: list[str | None]) -> Iterator[tuple]:
        """(text number, item id, start, end, edit distance, item words) of each leak; positions in words."""
        at, n = 0, 0
        for i, t in enumerate(texts):
            n += len(t or "")
            if n >= BATCH_CHARS or i == len(texts) - 1:
                yield from self._search(texts, at, i + 1)
                at, n = i + 1, 0

    def _search(self, texts: list, lo: int, hi: int) -> Iterator[tuple]:
        # words that no item has get numbers above all others: a walk over them must differ, too
        num, other, docs, by_n = self.number.get, len(self.number), {}, defaultdict(list)
        for i in range(lo, hi):
            x = np.array([v if (v := num(w)) is not None else other + xxhash.xxh32_intdigest(w) for w in tokens(texts[i])], np.int64)
            for j, s in self.windows(x):
                docs[i] = x
                by_n[len(self.items[j])].append((i, j, s))
        hits = defaultdict(list)
        for n, found in by_n.items():
            if self.walks[n] is None:                            # exact check only
                for i, j, p in found:
                    hits[i, j].append(p)
                continue
            ends = np.full(n, -2, np.int64)                      # beyond a document
            for k in range(0, len(found), STEP_WINDOWS):
                part = found[k:k + STEP_WINDOWS]
                rows = np.array([np.concatenate([ends[:max(0, -s)], docs[i][max(0, s):s + n], ends])[:n] for i, _, s in part])
                which = np.array([self.row[j] for _, j, _ in part])
                for h in np.flatnonzero(collide(rows, self.hashes[n], which, self.walks[n])).tolist():
                    i, j, s = part[h]
                    hits[i, j].append(s)
        for (i, j), starts in sorted(hits.items()):
            for x in self.verify(j, docs[i], sorted(starts)):
                yield (i, *x)

    def verify(self, j: int, x: np.ndarray, starts: list[int]) -> list[tuple[int, int, int, int, int]]:
        item, k, got, upto = self.items[j], limit(len(self.items[j])), {}, -1
        for s in starts:
            if s <= upto:                                        # inside the leak found last
                continue
            lo, hi = max(0, s - k), min(len(x), s + len(item) + k)
            d, a, b = edits(item, x[lo:hi])
            if d <= k:
                got[(lo + a, lo + b)] = d
                upto = lo + b - len(item) // 2
        return [(i, a, b, d, len(item)) for (a, b), d in got.items() for i in self.owners[j]]


SCHEMA = "doc_id long, item_id long, start long, end long, edits int, item_words int"


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = BLOCK_BYTES) -> Iterator[list]:
    """The items in lists of at most ``size`` bytes of text, an item at least."""
    rows, n = [], 0
    for r in benchmark.select(item_id, text).orderBy(item_id, text).toLocalIterator():
        b = len((r[1] or "").encode("utf-8", "surrogatepass"))
        if rows and n + b > size:
            yield rows
            rows, n = [], 0
        rows.append((r[0], r[1]))
        n += b
    if rows:
        yield rows


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, edits, item_words): every leaked item with its place in words."""
    spark, found = docs.sparkSession, None
    for rows in blocks(benchmark):
        index = spark.sparkContext.broadcast(Index(rows))

        def search(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                ids = pdf["doc_id"].astype("Int64").tolist()
                got = [(ids[x[0]], *x[1:]) for x in index.value.search(pdf["text"].tolist())]
                out = pd.DataFrame(got, columns=["doc_id", "item_id", "start", "end", "edits", "item_words"])
                yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

        part = docs.select("doc_id", "text").mapInPandas(search, SCHEMA)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], SCHEMA) if found is None else found


def _flags(index):
    @F.pandas_udf(T.BooleanType())
    def leaking(text: pd.Series) -> pd.Series:
        flags = np.zeros(len(text), bool)
        flags[[x[0] for x in index.value.search(text.tolist())]] = True
        return pd.Series(flags)

    return leaking


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents in which an item leaks, all columns kept. The
    flag is set row by row, so nothing is joined and repeated rows are alike."""
    kept = docs
    for rows in blocks(benchmark):
        index = docs.sparkSession.sparkContext.broadcast(Index(rows))
        kept = kept.filter(~_flags(index)(F.col("text")))
    return kept
