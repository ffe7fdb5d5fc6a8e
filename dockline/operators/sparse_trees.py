"""Regression trees over one-hot columns, grown as Spark ML grows them, without the zeros.

Spark ML keeps a bin per feature and row and statistics per feature and node, also for the one-hot slots of the
thousands of stations that a row or a node doesn't have. Here a slot is looked at only where it is set: the statistics
of its other side are the node's less its own. The candidates (thresholds of at most ``max_bins`` bins, a slot
against the rest), the gain by variance, the order among equal gains (first feature, first threshold), the leaves
and the pruning are those of ``org.apache.spark.ml.tree.impl.RandomForest`` with all features and one
instance a node at least, so a tree is the one Spark ML grows from the same rows and weights. Of two children only the
smaller is summed up; the other's sums are the parent's less these, exact for whole targets and weights.

Rows alike in features and target are one group with a count. A sum of n Poisson draws of mean 1 is a Poisson draw
of mean n, so the bootstrap needs the groups only. Their number is bounded by stations x hours x weekdays x
targets, not by the length of the history.
"""
from __future__ import annotations

import numpy as np

EPSILON = np.finfo(np.float64).eps                     # below it, Spark ML takes an impurity for none
ROUNDING = 1e-12                                       # of sums of residuals, relative; sums of whole targets are exact
HOUR, WEEKDAY, CAPACITY, COMMUNE, STATION = range(5)


class Groups:
    """Rows alike, with their number ``n``, in the order of station, commune, capacity, hour, weekday and target. An entity is a
    station with its commune and capacity: these are given once, with the number of its groups."""

    def __init__(self, station, commune, capacity, groups, hour, weekday, y, n, communes: int, stations: int, max_bins: int = 32):
        self.y, self.n = np.asarray(y, np.float64), np.asarray(n, np.int32)
        self.entity = np.repeat(np.arange(len(groups), dtype=np.int32), groups)
        rows = np.bincount(self.entity, weights=self.n)
        self.cuts = [thresholds(hour, self.n, max_bins), thresholds(weekday, self.n, max_bins), thresholds(capacity, rows, max_bins)]
        self.bins = [len(c) + 1 for c in self.cuts]
        self.hour = np.searchsorted(self.cuts[HOUR], hour).astype(np.uint8)
        self.weekday = np.searchsorted(self.cuts[WEEKDAY], weekday).astype(np.uint8)
        self.capacity = np.searchsorted(self.cuts[CAPACITY], capacity)
        self.station, self.commune = np.asarray(station, np.int64), np.asarray(commune, np.int64)
        first = np.searchsorted(self.station, np.arange(stations + 1))
        self.from_row = np.concatenate(([0], np.cumsum(groups)))[first]    # of a station; its rows are neighbours
        self.slots = {COMMUNE: communes, STATION: stations}
        self.offset = {COMMUNE: STATION - 1, STATION: STATION - 1 + communes}


def thresholds(values, counts, max_bins: int) -> np.ndarray:
    """Spark ML's candidate thresholds of a continuous feature, from the counts of all its values."""
    v = np.unique(values)
    c = np.bincount(np.searchsorted(v, values), weights=counts)
    v = v.astype(np.float64)
    total, most = c.sum(), min(max_bins, int(c.sum())) - 1
    middle = (v[:-1] + v[1:]) / 2.0
    if len(middle) <= most:
        return middle
    stride = total / (most + 1)
    cuts, seen, target = [], c[0], stride
    for i in range(1, len(v)):
        before, seen = seen, seen + c[i]
        if abs(before - target) < abs(seen - target):
            cuts.append(middle[i - 1])
            target += stride
    return np.array(cuts)


def _sums(key, size: int, s) -> np.ndarray:
    return np.stack([np.bincount(key, weights=x, minlength=size) for x in s])


def _runs(key, s):
    """Sums over runs of equal keys."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[starts], np.add.reduceat(s, starts, axis=1)


def _by_commune(g: Groups, node, entity, nodes: int, s):
    """Sums by node and commune, only for pairs that occur, in their order."""
    key = node * g.slots[COMMUNE] + g.commune[entity]
    if nodes * g.slots[COMMUNE] <= 4 * len(key):
        sums = _sums(key, nodes * g.slots[COMMUNE], s)
        key = np.flatnonzero(sums[0])
        sums = sums[:, key]
    else:
        order = np.argsort(key, kind="stable")
        key, sums = _runs(key[order], s[:, order])
    return key // g.slots[COMMUNE], key % g.slots[COMMUNE], sums


def _variance(s) -> np.ndarray:
    return (s[2] - s[1] * s[1] / s[0]) / s[0]


def _gain(impurity, left, right) -> np.ndarray:
    """-inf where the split is none."""
    with np.errstate(divide="ignore", invalid="ignore"):
        count = left[0] + right[0]
        gain = impurity - left[0] / count * _variance(left) - right[0] / count * _variance(right)
    return np.where((left[0] >= 1) & (right[0] >= 1) & (gain >= 0), gain, -np.inf)


class _Best:
    """The best split of every node of a level so far. ``code``: the bin up to which rows go left, or the slot;
    ``flip``: rows that have the slot go left."""

    def __init__(self, nodes: int, tie):
        self.gain, self.tie = np.full(nodes, -np.inf), tie                # gains closer than ``tie`` are equal
        self.kind, self.code = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        self.flip, self.left, self.right = np.zeros(nodes, bool), np.zeros((3, nodes)), np.zeros((3, nodes))

    def offer(self, kind: int, node, gain, code, flip, left, right) -> None:
        better = gain > self.gain[node] + self.tie[node]                  # of equal gains, the first feature's
        at = node[better]
        self.gain[at], self.kind[at], self.code[at], self.flip[at] = gain[better], kind, code[better], flip[better]
        self.left[:, at], self.right[:, at] = left[:, better], right[:, better]


class _Level:
    """Sums of weight, weight x target and weight x target squared of a level's open nodes: by node, hour and weekday, and for
    the pairs of node and entity that occur, in their order."""

    def __init__(self, by_time, node, entity, by_entity):
        self.by_time, self.node, self.entity, self.by_entity = by_time, node, entity, by_entity

    @classmethod
    def of(cls, g: Groups, rows: list, weight, y):
        """From the rows of each node."""
        hours, days, nodes = g.bins[HOUR], g.bins[WEEKDAY], len(rows)
        node, rows = np.repeat(np.arange(nodes), [len(r) for r in rows]), np.concatenate(rows)
        s, of = np.empty((3, len(rows))), y[rows]
        s[0] = weight[rows]
        np.multiply(s[0], of, out=s[1])
        np.multiply(s[1], of, out=s[2])
        by_time = _sums((node * hours + g.hour[rows]) * days + g.weekday[rows], nodes * hours * days, s)
        key, by_entity = _runs(node * len(g.station) + g.entity[rows], s)                   # rows are in the order of their entities
        return cls(by_time.reshape(3, nodes, hours, days), key // len(g.station), key % len(g.station), by_entity)

    def follow(self, g: Groups, small: "_Level", parent, small_goes_on, large_goes_on):
        """The next level: first the larger children that go on, then the smaller ones. ``small`` has the smaller child of
        every node in ``parent``."""
        entities, nodes = len(g.station), self.by_time.shape[1]
        rest = self.by_entity.copy()
        at = np.searchsorted(self.node * entities + self.entity, parent[small.node] * entities + small.entity)
        rest[:, at] -= small.by_entity
        large, little = np.full(nodes, -1), np.full(len(parent), -1)
        large[parent[large_goes_on]] = np.arange(large_goes_on.sum())
        little[small_goes_on] = large_goes_on.sum() + np.arange(small_goes_on.sum())
        old, new = (large[self.node] >= 0) & (rest[0] > 0), little[small.node] >= 0
        by_time = self.by_time[:, parent[large_goes_on]] - small.by_time[:, large_goes_on]
        by_time *= by_time[0] > 0                                         # where no row is left, nothing is: thresholds there tie
        return _Level(np.concatenate([by_time, small.by_time[:, small_goes_on]], 1),
                      np.concatenate([large[self.node[old]], little[small.node[new]]]),
                      np.concatenate([self.entity[old], small.entity[new]]),
                      np.concatenate([rest[:, old], small.by_entity[:, new]], 1))


def _best_splits(g: Groups, level: _Level, impurity, tie) -> _Best:
    nodes, every = len(impurity), np.arange(len(impurity))
    best, at = _Best(nodes, tie), level.node
    by_capacity = _sums(at * g.bins[CAPACITY] + g.capacity[level.entity], nodes * g.bins[CAPACITY], level.by_entity)
    for kind, h in ((HOUR, level.by_time.sum(3)), (WEEKDAY, level.by_time.sum(2)), (CAPACITY, by_capacity.reshape(3, nodes, -1))):
        if h.shape[2] < 2:
            continue
        up_to = h.cumsum(2)
        left, right = up_to[:, :, :-1], up_to[:, :, -1:] - up_to[:, :, :-1]
        gain = _gain(impurity[:, None], left, right)
        cut = (gain >= (gain.max(1) - tie)[:, None]).argmax(1)
        best.offer(kind, every, gain[every, cut], cut, np.zeros(nodes, bool), left[:, every, cut], right[:, every, cut])
    total = level.by_time.sum((2, 3))
    key, by_station = _runs(at * g.slots[STATION] + g.station[level.entity], level.by_entity)
    for kind, (at, slot, has) in ((COMMUNE, _by_commune(g, at, level.entity, nodes, level.by_entity)),
                                  (STATION, (key // g.slots[STATION], key % g.slots[STATION], by_station))):
        rest = total[:, at] - has
        with np.errstate(divide="ignore", invalid="ignore"):
            flip = ~(rest[1] / rest[0] <= has[1] / has[0])                # the side of the lower mean is the left one
        left, right = np.where(flip, has, rest), np.where(flip, rest, has)
        gain = _gain(impurity[at], left, right)
        new = np.concatenate(([True], at[1:] != at[:-1]))
        most = np.maximum.reduceat(gain, np.flatnonzero(new)) - tie[at[new]]
        first = np.flatnonzero(gain >= most[np.cumsum(new) - 1])
        first = first[np.unique(at[first], return_index=True)[1]]
        best.offer(kind, at[first], gain[first], slot[first], flip[first], left[:, first], right[:, first])
    return best


def _parted(g: Groups, rows, kind: int, code: int, flip: bool):
    """A node's rows, in their order: those that go left and those that go right."""
    if kind == STATION:
        a, b = np.searchsorted(rows, g.from_row[code:code + 2])
        has, rest = rows[a:b], np.concatenate((rows[:a], rows[b:]))
        return (has, rest) if flip else (rest, has)
    if kind in (HOUR, WEEKDAY):
        right = (g.hour if kind == HOUR else g.weekday)[rows] > code
    elif kind == CAPACITY:
        right = (g.capacity > code)[g.entity[rows]]
    else:
        right = ((g.commune == code) != flip)[g.entity[rows]]
    return rows[~right], rows[right]


def grow(g: Groups, weight, y, max_depth: int, rounding: float = 0.0):
    """One tree of the groups with these weights and targets, level by level: its nodes, as rows of Spark ML's node data,
    and the prediction for every group. Gains that differ by less than ``rounding`` x impurity are equal."""
    predicted = np.zeros(len(y))
    rows = [np.flatnonzero(weight).astype(np.int32)]                      # of every open node
    if not len(rows[0]):
        return [[0, 0.0, -1.0, [0.0] * 3, 0, -1.0, -1, -1, (-1, [], -1)]], predicted
    level = _Level.of(g, rows, weight, y)
    stats, made, open_ = [level.by_time.sum((2, 3))], 1, np.zeros(1, np.int64)
    split, leaves = {}, []                                                # () where there is no gain, None where no split is allowed
    for depth in range(max_depth):
        impurity = _variance(np.concatenate(stats, 1)[:, open_])
        best = _best_splits(g, level, impurity, rounding * np.abs(impurity))
        does = best.gain > 0
        for k in np.flatnonzero(~does):
            split[int(open_[k])] = None if np.isneginf(best.gain[k]) else ()
            leaves.append((int(open_[k]), rows[k]))
        parent = np.flatnonzero(does)
        if not len(parent):
            rows = []
            break
        child = made + np.arange(2 * len(parent)).reshape(-1, 2)          # left and right of every parent
        made += child.size
        pair = np.stack([best.left[:, parent], best.right[:, parent]], 2)
        stats.append(pair.reshape(3, -1))
        goes_on = (np.abs(_variance(pair)) >= EPSILON) & (depth + 1 < max_depth)
        sides = []
        for j, k in enumerate(parent):
            split[int(open_[k])] = (best.gain[k], int(best.kind[k]), int(best.code[k]), bool(best.flip[k]), *map(int, child[j]))
            sides.append(_parted(g, rows[k], best.kind[k], best.code[k], best.flip[k]))
            leaves += [(int(child[j, i]), sides[j][i]) for i in (0, 1) if not goes_on[j, i]]
        some = np.flatnonzero(goes_on.any(1))
        if not len(some):
            rows = []
            break
        less = np.array([int(len(sides[j][1]) < len(sides[j][0])) for j in some])          # which child has fewer rows
        small_on, large_on = goes_on[some, less], goes_on[some, 1 - less]
        small = _Level.of(g, [sides[j][i] for j, i in zip(some, less)], weight, y)
        level = level.follow(g, small, parent[some], small_on, large_on)
        open_ = np.concatenate([child[some, 1 - less][large_on], child[some, less][small_on]])
        rows = ([sides[j][1 - i] for j, i in zip(some[large_on], less[large_on])]
                + [sides[j][i] for j, i in zip(some[small_on], less[small_on])])
    stats = np.concatenate(stats, 1)
    values = stats[1] / stats[0]
    for i, of in leaves + list(zip(open_, rows)):
        predicted[of] = values[i]
    return _node_rows(g, stats, values, _variance(stats), split), predicted


def _node_rows(g: Groups, stats, predicted, impurity, split) -> list:
    """The nodes in preorder. Two leaves that predict the same are one, as in Spark ML; a node for which no split is allowed has
    impurity -1."""
    def inner(i: int) -> bool:
        return bool(split.get(i))

    kept, todo = {}, [(0, False)]                                         # children before parents
    while todo:
        i, seen = todo.pop()
        if not inner(i):
            kept[i] = False
        elif not seen:
            todo += [(i, True), (split[i][4], False), (split[i][5], False)]
        else:
            a, b = split[i][4:]
            kept[i] = kept[a] or kept[b] or predicted[a] != predicted[b]
    out, todo = [], [(0, None, 0)]
    while todo:
        i, parent, side = todo.pop()
        here = len(out)
        if parent is not None:
            out[parent][6 + side] = here
        row = [here, float(predicted[i]), float(impurity[i]), [float(x) for x in stats[:, i]], int(stats[0, i]), -1.0, -1, -1, (-1, [], -1)]
        if kept[i]:
            gain, kind, code, flip, a, b = split[i]
            if kind in g.slots:
                row[8] = (int(g.offset[kind] + code), [float(flip)], 2)
            else:
                row[8] = (int(kind), [float(g.cuts[kind][code])], -1)
            row[5] = float(gain)
            todo += [(b, here, 1), (a, here, 0)]
        elif i in split and split[i] is None:
            row[2] = -1.0
        out.append(row)
    return out


def boost(g: Groups, rounds: int, max_depth: int, step: float):
    """The trees of Spark ML's gradient boosting for squared errors; the first has weight 1, the others ``step``."""
    y, predicted = g.y, None
    for m in range(rounds):
        nodes, fit = grow(g, g.n, y if m == 0 else 2.0 * (y - predicted), max_depth, ROUNDING if m else 0.0)
        if m == 0:
            predicted = fit
        else:
            fit *= step
            predicted += fit
        yield nodes


def bagged(g: Groups, tree: int, seed: int, max_depth: int) -> list:
    """A tree of the forest. Its bootstrap depends on the seed, its number and the groups only."""
    return grow(g, np.random.default_rng([seed, tree]).poisson(g.n).astype(np.int32), g.y, max_depth)[0]
