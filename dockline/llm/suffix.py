"""Suffix arrays by induced sorting, and common prefixes in text order."""
from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, size: int | None = None) -> np.ndarray:
    """Suffix array of ``text`` (whole numbers from 0 to size - 1), by induced sorting:

    suffixes are classed as smaller (S) or larger (L) than the next one; the
    substrings between leftmost S suffixes (LMS) are sorted by inducing from their last
    letters and named; if names repeat, the string of names is sorted by
    recursion; then all suffixes are induced from the sorted LMS suffixes."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    text = np.asarray(text, dtype=np.int64)
    size = int(text.max()) + 1 if size is None else size
    # S or L: by the next differing letter; the last suffix is L (the end is smaller than any letter)
    differs = np.flatnonzero(text[1:] != text[:-1])
    rising = np.zeros(n, bool)
    if len(differs):
        nxt = np.searchsorted(differs, np.arange(n))
        has = nxt < len(differs)
        d = differs[np.minimum(nxt, len(differs) - 1)]
        rising = has & (text[np.minimum(d + 1, n - 1)] > text[d])
    lms = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    induce = (lambda first: _induce_wide(text, rising, size, first)) if size <= WIDE else _induce(text, rising, size)

    if not len(lms):
        return induce(lms)
    order = induce(lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = order[is_lms[order]]                 # LMS substrings in order
    stop = np.append(lms[1:], n - 1)
    width = np.zeros(n, np.int64)
    width[lms] = stop - lms + 1
    # neighbours are equal if they are as long and have the same letters (types then agree, too); a hash sorts out most
    odd = np.uint64(0x9E3779B97F4A7C15)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, odd, np.uint64)]), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)])
    a, b = order[:-1], order[1:]
    w = width[a]
    maybe = (w == width[b]) & (np.maximum(a, b) + w < n)
    lo, hi, w = np.minimum(a, b), np.maximum(a, b), np.where(maybe, w, 0)
    maybe &= (sums[lo + w] - sums[lo]) * power[hi - lo] == sums[hi + w] - sums[hi]
    same = np.zeros(len(order), bool)
    raw, z = (text.astype(np.uint8).tobytes(), 1) if size <= 256 else (text.tobytes(), 8)
    at = np.flatnonzero(maybe)
    for i, p, q, k in zip(at.tolist(), (a[at] * z).tolist(), (b[at] * z).tolist(), (w[at] * z).tolist()):
        same[i + 1] = raw[p:p + k] == raw[q:q + k]
    names = np.zeros(n, np.int64)
    names[order] = np.cumsum(~same) - 1
    reduced = names[lms]
    kinds = int(reduced.max()) + 1
    if kinds == len(lms):
        sorted_lms = order
    else:
        sorted_lms = lms[suffix_array(reduced, kinds)]
    return induce(sorted_lms)


WIDE = 256          # up to so many letters, buckets are induced as arrays


def _induce(text: np.ndarray, rising: np.ndarray, size: int):
    """Letter by letter: for large alphabets, where buckets are small."""
    n, counts = len(text), np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    heads, tails = (ends - counts).tolist(), ends.tolist()
    letters, up = text.tolist(), rising.tolist()

    def run(first: np.ndarray) -> np.ndarray:
        sa = [-1] * n
        tail = tails[:]
        for p in first[::-1].tolist():
            c = letters[p]
            tail[c] -= 1
            sa[tail[c]] = p
        head = heads[:]
        c = letters[n - 1]                       # the last suffix, induced by the end
        sa[head[c]] = n - 1
        head[c] += 1
        for p in sa:                             # sa grows ahead of the reading position
            if p > 0 and not up[p - 1]:
                c = letters[p - 1]
                sa[head[c]] = p - 1
                head[c] += 1
        tail = tails[:]
        for i in range(n - 1, -1, -1):
            p = sa[i]
            if p > 0 and up[p - 1]:
                c = letters[p - 1]
                tail[c] -= 1
                sa[tail[c]] = p - 1
        return np.array(sa)

    return run


def _induce_wide(text: np.ndarray, rising: np.ndarray, size: int, first: np.ndarray) -> np.ndarray:
    """The same, a bucket at a time: what a run of suffixes induces is found at once, and
    goes to the buckets in order; a bucket that induces into itself is read in waves."""
    n = len(text)

    def deal(preds: np.ndarray, to: list) -> None:
        if len(preds):
            c = text[preds]
            by = np.argsort(c, kind="stable")
            c, preds = c[by], preds[by]
            cut = np.flatnonzero(c[1:] != c[:-1]) + 1
            for k, part in zip(c[np.concatenate([[0], cut])].tolist(), np.split(preds, cut)):
                to[k].append(part)

    def waves(parts: list, c: int, kind: bool, to: list) -> list:
        done, cur = [], np.concatenate(parts) if parts else np.empty(0, np.int64)
        while len(cur):
            done.append(cur)
            pred = cur[cur > 0] - 1
            pred = pred[rising[pred] == kind]
            here = text[pred] == c
            cur = pred[here]
            deal(pred[~here], to)
        return done

    small, large = [[] for _ in range(size)], [[] for _ in range(size)]
    deal(first, small)
    large[int(text[n - 1])].append(np.array([n - 1]))          # the last suffix, induced by the end
    for c in range(size):
        large[c] = waves(large[c], c, False, large)
        for part in small[c]:
            pred = part[part > 0] - 1
            deal(pred[~rising[pred]], large)
    # S suffixes from the right: all arrays read backwards
    back, out = [[] for _ in range(size)], [None] * size
    for c in range(size - 1, -1, -1):
        back[c] = waves(back[c], c, True, back)
        whole = np.concatenate(large[c])[::-1] if large[c] else np.empty(0, np.int64)
        pred = whole[whole > 0] - 1
        deal(pred[rising[pred]], back)
        out[c] = np.concatenate([whole[::-1], *[x[::-1] for x in back[c][::-1]]])
    return np.concatenate(out)


def permuted_lcp(text: bytes, sa: np.ndarray, most: int) -> np.ndarray:
    """For each position in text order, the length (up to ``most``) that its suffix shares
    with the one before it in the suffix array. Eight bytes of all pairs that still agree are compared at a time."""
    n = len(sa)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([np.frombuffer(text, np.uint8), np.zeros(8, np.uint8)])
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word |= padded[k:n + k].astype(np.uint64) << np.uint64(8 * k)
    bits = np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)
    out = np.zeros(n, np.int64)
    at = np.flatnonzero(before >= 0)
    limit = np.minimum(n - np.maximum(at, before[at]), most)
    length = 0
    while len(at):
        x = word[at + length] ^ word[before[at] + length]
        low = x & (~x + np.uint64(1))                          # the lowest bit that differs
        agree = np.searchsorted(bits, low, side="right") - 1
        agree[x == 0] = 8
        out[at] = np.minimum(length + agree, limit)
        length += 8
        on = (agree == 8) & (limit > length)
        at, limit = at[on], limit[on]
    return out
