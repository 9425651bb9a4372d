"""Regression forests grown on all rows, as many as there are.

Spark's own forest gathers features x bins figures of every node in every task that holds rows, and takes its cuts from
about 10,000 rows. Here instead:

1. cuts come from the counts of all values of a feature: between all neighbouring values where there are at most
   ``max_bins``, else after the values that hold the quantiles. A row becomes a code a feature, features of 0 and 1 a bit.
2. every tree draws each row 0, 1, 2, ... times (Poisson with mean 1) by a hash of row and tree.
3. nodes of more than ``LOCAL_ROWS`` rows are split from figures gathered over all blocks, a level at a time.
4. each other node has a task, which reads all blocks, keeps the node's rows and grows the tree from there on, a level at
   a time for all its nodes.
5. trees stay in Spark, as rows of their parts, and rows are scored by pairs of a part and a block of codes.

Labels are whole numbers of 30 bits while a forest grows, so that all sums are exact: neither partitions nor the order of
rows have a say in the trees. Leaf values are multiples of one power of two, so that their sums are exact, too.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay.operators.ordering import quantile_values, value_sums
from lodestay.session import durable, written

LABEL_BITS = 30
VALUE_BITS = 40  # of a leaf's value below the greatest label; 4,096 trees sum up exactly
LOCAL_ROWS = 1 << 23  # drawn rows from which one task grows parts of a tree; sums of labels stay below 2^53
LOCAL_BYTES = 1 << 28  # of their codes
BATCH_BYTES = 1 << 24  # of blocks that a task is handed at a time
BLOCK_ROWS = 1 << 16  # training rows in a block
BLOCK_BYTES = 1 << 24  # of codes in a block that is scored
WALKED_BYTES = 1 << 22  # of codes that walk down a part together
UNIT_ROWS = 1 << 15  # rows of the nodes that are grown together, to stay in a processor's cache
GOLDEN = 0x9E3779B97F4A7C15
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


# ---- codes -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Layout:
    """How a row of features becomes codes: ``cuts`` a feature, columns for features with cuts, then bits for those of
    0 and 1. A feature without cuts has neither."""

    cuts: Sequence[np.ndarray]
    numbers: Sequence[int]
    flags: Sequence[int]

    @property
    def bins(self) -> list[int]:
        return [len(self.cuts[f]) + 1 for f in self.numbers]

    @property
    def item(self) -> np.dtype:
        return np.dtype(np.uint8 if max(self.bins, default=0) <= 256 else np.uint16)

    @property
    def slot(self) -> np.dtype:
        n = len(self.flags) + 1  # the number of bits stands for none, the next one matches nothing
        return np.dtype(np.uint8 if n < 256 else np.uint16 if n < 65536 else np.uint32)

    @property
    def features(self) -> np.ndarray:
        return np.array([*self.numbers, *self.flags], np.int64)

    @property
    def width(self) -> int:
        return len(self.numbers) * self.item.itemsize + (len(self.flags) + 7) // 8

    def rows(self, values: np.ndarray) -> np.ndarray:
        """The codes of feature rows, ``width`` bytes each."""
        codes = np.empty((len(values), len(self.numbers)), self.item)
        for c, f in enumerate(self.numbers):
            codes[:, c] = np.searchsorted(self.cuts[f], values[:, f], side="left")
        return np.hstack([codes.view(np.uint8).reshape(len(values), -1), np.packbits(values[:, list(self.flags)] > 0.5, axis=1)])

    def numeric(self, raw: np.ndarray) -> np.ndarray:
        size = len(self.numbers) * self.item.itemsize
        return np.ascontiguousarray(raw[:, :size]).view(self.item).reshape(len(raw), len(self.numbers))

    def bits(self, raw: np.ndarray) -> np.ndarray:
        if not self.flags:
            return np.zeros((len(raw), 0), np.uint8)
        return np.unpackbits(np.ascontiguousarray(raw[:, len(self.numbers) * self.item.itemsize:]), axis=1, count=len(self.flags))

    def slots(self, raw: np.ndarray) -> np.ndarray:
        """The bits that are set, one line for the first of each row, one for the second, ..."""
        found = [np.nonzero(self.bits(raw[i:i + 4096])) for i in range(0, len(raw), 4096)]
        rows = np.concatenate([r + 4096 * i for i, (r, _) in enumerate(found)])
        which = np.concatenate([b for _, b in found])
        held = np.bincount(rows, minlength=len(raw))
        out = np.full((held.max(initial=0), len(raw)), len(self.flags), self.slot)
        out[np.arange(len(rows)) - (np.cumsum(held) - held)[rows], rows] = which
        return out

    def wide(self, raw: np.ndarray) -> np.ndarray:
        """A code for every column, bits too."""
        return np.hstack([self.numeric(raw), self.bits(raw).astype(self.item)])


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    n, width = rows.shape
    ends = np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of equal lengths, or a list column, as rows."""
    if pa.types.is_binary(column.type):
        flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    else:
        flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width)


def fit_layout(train: DataFrame, size: int, max_bins: int) -> Layout:
    """Cuts from the counts of all values of ``values``, an array column of ``size`` features."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(0), size)
            if len(values):
                found = [np.unique(values[:, f], return_counts=True) for f in range(size)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.arange(size, dtype=np.int32), [len(v) for v, _ in found])),
                    pa.array(np.concatenate([v for v, _ in found])),
                    pa.array(np.concatenate([n for _, n in found]).astype(np.int64))], ["feature", "value", "n"])

    found = train.select("values").mapInArrow(counted, "feature int, value double, n bigint")
    counts = durable(value_sums(found, ["feature"], "value", "n"))
    different = {r.feature: r.n for r in counts.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not different:
        raise ValueError("a forest needs training rows")
    few = sorted(f for f, n in different.items() if n <= max_bins)
    many = sorted(set(different) - set(few))
    last: dict[int, list] = {f: [] for f in range(size)}  # the values after which a feature may be cut
    for r in counts.where(F.col("feature").isin(few)).select("feature", "__value").collect():
        last[r.feature].append(r[1])
    if many:
        wanted = [k / max_bins for k in range(1, max_bins)]
        for r in quantile_values(counts.where(F.col("feature").isin(many)), ["feature"], wanted).distinct().collect():
            last[r.feature].append(r.value)
    edges = {f: np.array(sorted(v)) for f, v in last.items()}

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            feature, value = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for f in np.unique(feature):
                mine = value[feature == f]
                bins = np.searchsorted(edges[f], mine, side="left")
                at, where = np.unique(bins, return_inverse=True)
                least = np.full(len(at), np.inf)
                np.minimum.at(least, where, mine)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), f, np.int32)), pa.array(at.astype(np.int32)), pa.array(least)],
                    ["feature", "bin", "value"])

    nearby = counts.select("feature", "__value").mapInArrow(nearest, "feature int, bin int, value double")
    first = {(r.feature, r.bin): r.value for r in nearby.groupBy("feature", "bin").agg(F.min("value").alias("value")).collect()}
    counts.unpersist()
    cuts = []
    for f in range(size):
        pairs = [(a, first[f, i + 1]) for i, a in enumerate(edges[f]) if (f, i + 1) in first]
        middle = [(a / 2 + b / 2, a, b) for a, b in pairs]
        cuts.append(np.array([m if a <= m < b else a for m, a, b in middle]))
    flags = [f for f in range(size) if len(cuts[f]) and edges[f].tolist() == [0.0, 1.0]]
    return Layout(cuts, [f for f in range(size) if len(cuts[f]) and f not in set(flags)], flags)


# ---- draws -----------------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(hashes: np.ndarray, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree."""
    part = (_mixed(hashes + np.uint64((tree + 1) * GOLDEN & (1 << 64) - 1)) >> np.uint64(11)) * 2.0 ** -53
    return np.searchsorted(POISSON, part, side="right").astype(np.uint8)


# ---- splits ----------------------------------------------------------------------------------

class _Best:
    """The best split of each node so far, the first of equal ones."""

    def __init__(self, weight: np.ndarray, total: np.ndarray, minimum: int):
        k = len(weight)
        self.weight, self.total, self.minimum = weight, total, minimum
        self.score, self.column, self.cut = np.zeros(k), np.zeros(k, np.int64), np.zeros(k, np.int64)
        self.left, self.left_total = np.zeros(k), np.zeros(k)

    def scores(self, left, left_total, weight, total) -> np.ndarray:
        """Reduction of the sum of squares, times the node's weight."""
        right, gap = weight - left, left_total * weight - total * left
        ok = (left >= self.minimum) & (right >= self.minimum)
        return np.divide(gap * gap, left * right, out=np.zeros(gap.shape), where=ok)

    def offer(self, nodes, score, column, cut, left, left_total) -> None:
        better = np.flatnonzero(score > self.score[nodes])
        at = nodes[better]
        self.score[at], self.left[at], self.left_total[at] = score[better], left[better], left_total[better]
        self.column[at] = column[better] if isinstance(column, np.ndarray) else column
        self.cut[at] = cut[better] if isinstance(cut, np.ndarray) else cut

    def offer_number(self, column: int, counts: np.ndarray, sums: np.ndarray) -> None:
        left, left_total = counts.cumsum(1)[:, :-1], sums.cumsum(1)[:, :-1]
        score = self.scores(left, left_total, self.weight[:, None], self.total[:, None])
        at, nodes = score.argmax(1), np.arange(len(score))
        self.offer(nodes, score[nodes, at], column, at, left[nodes, at], left_total[nodes, at])

    def offer_flags(self, column: int, counts: np.ndarray, sums: np.ndarray) -> None:
        left, left_total = self.weight[:, None] - counts, self.total[:, None] - sums
        score = self.scores(left, left_total, self.weight[:, None], self.total[:, None])
        at, nodes = score.argmax(1), np.arange(len(score))
        self.offer(nodes, score[nodes, at], column + at, 0, left[nodes, at], left_total[nodes, at])

    def offer_runs(self, nodes: np.ndarray, column, cut, left, left_total) -> None:
        """Splits in the order of their nodes."""
        if not len(nodes):
            return
        score = self.scores(left, left_total, self.weight[nodes], self.total[nodes])
        new = np.concatenate([[True], nodes[1:] != nodes[:-1]])
        most = np.maximum.reduceat(score, np.flatnonzero(new))
        group = np.cumsum(new) - 1
        at = np.flatnonzero(score == most[group])
        at = at[np.concatenate([[True], group[at][1:] != group[at][:-1]])]
        some = lambda x: x[at] if isinstance(x, np.ndarray) else x
        self.offer(nodes[at], score[at], some(column), some(cut), left[at], left_total[at])


def _sums(node, lines, size, k, weight, product) -> tuple[np.ndarray, np.ndarray]:
    """Weights and weighted labels by node and code."""
    counts, sums = np.zeros(k * size), np.zeros(k * size)
    step = UNIT_ROWS if k * size <= UNIT_ROWS else max(1, len(node))  # a few rows at a time stay in the cache
    for i in range(0, len(node), step):
        base = node[i:i + step] * size
        for line in lines:
            key = base + line[i:i + step]
            counts += np.bincount(key, weight[i:i + step], k * size)
            sums += np.bincount(key, product[i:i + step], k * size)
    return counts.reshape(k, size), sums.reshape(k, size)


def _sorted(node, lines, size) -> tuple[np.ndarray, np.ndarray]:
    """Keys of node and code in order, with their rows."""
    n, keys = len(node), []
    shift, base = max(1, n.bit_length()), node * size
    for line in lines:
        keys.append((base + line << shift) | np.arange(n))
    keys = keys[0] if len(keys) == 1 else np.concatenate(keys)
    keys.sort()
    return keys >> shift, keys & ((1 << shift) - 1)


class _Smaller:
    """Figures of the children of split nodes: those of the smaller ones from their rows, the others are what is left of
    the parent's."""

    def __init__(self, figures, rows, parents, parent, small):
        self.figures, self.rows = figures, rows  # by column, of all nodes of the level above; of the smaller children
        self.parents, self.parent, self.small = parents, parent, small[:, None]  # split nodes; number and side of the children

    def of(self, c: int, size: int) -> tuple[np.ndarray, np.ndarray] | None:
        if self.figures[c] is None:
            return None
        codes, slots, node, weight, product = self.rows
        own = _sums(node, [codes[c]] if c < len(codes) else slots, size, len(self.parents), weight, product)
        return tuple(
            np.where(self.small, mine[self.parent], whole[self.parents[self.parent]] - mine[self.parent])
            for mine, whole in zip(own, self.figures[c]))


def _best_splits(codes, slots, node, weight, product, node_weight, node_total, layout: Layout, minimum: int,
                 known: _Smaller | None) -> tuple[_Best, list]:
    """The best splits, and the figures by node and code where they were made."""
    best, k, n = _Best(node_weight, node_total, minimum), len(node_weight), len(node)
    before, before_total = np.cumsum(node_weight) - node_weight, np.cumsum(node_total) - node_total
    figures: list = [None] * (len(codes) + 1)

    def made(c, lines, size):
        figures[c] = known and known.of(c, size) or _sums(node, lines, size, k, weight, product)
        return figures[c]

    for c, size in enumerate(layout.bins):
        if k * size <= n:
            best.offer_number(c, *made(c, [codes[c]], size))
            continue
        keys, rows = _sorted(node, [codes[c]], size)  # few rows a node: their codes in order instead of all codes
        ends = np.flatnonzero(keys[1:] != keys[:-1])
        at = keys[ends]
        nodes = at // size
        left, left_total = np.cumsum(weight[rows])[ends] - before[nodes], np.cumsum(product[rows])[ends] - before_total[nodes]
        best.offer_runs(nodes, c, at - nodes * size, left, left_total)
    if len(slots):
        size, m = len(layout.flags) + 1, len(layout.numbers)
        if k * size <= slots.size:
            counts, sums = made(m, slots, size)
            best.offer_flags(m, counts[:, :-1], sums[:, :-1])
        else:
            keys, rows = _sorted(node, slots, size)
            ends = np.flatnonzero(np.concatenate([keys[1:] != keys[:-1], [True]]))
            at = keys[ends]
            nodes, flag = at // size, at % size
            right, right_total = (np.diff(np.cumsum(x[rows])[ends], prepend=0.0) for x in (weight, product))
            some = flag < size - 1
            nodes = nodes[some]
            best.offer_runs(nodes, m + flag[some], 0, node_weight[nodes] - right[some], node_total[nodes] - right_total[some])
    return best, figures


def _taken(lines: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``lines[:, rows]``, a line at a time, which is faster."""
    out = np.empty((len(lines), len(rows)), lines.dtype)
    for line, to in zip(lines, out):
        np.take(line, rows, out=to, mode="clip")
    return out


class _Grower:
    """A part of a tree from its rows. Nodes are listed by level; the children of the i-th split node are those at 1 + 2 i
    and 2 + 2 i."""

    def __init__(self, layout: Layout, depth: int, minimum: int):
        self.layout, self.depth, self.minimum = layout, depth, minimum
        self.levels: list[list] = [[] for _ in range(depth + 1)]
        self.gains = np.zeros(len(layout.numbers) + len(layout.flags))

    def grown(self, rows: list, level: int) -> tuple[np.ndarray, ...]:
        """(column or -1, cut, values of the leaves) from codes, slots, weights and labels, a list that is emptied so that
        they are let go as soon as they can be."""
        codes, slots, weight, label = rows
        rows.clear()
        product = weight * label.astype(np.float64)
        whole, total = np.array([weight.sum(dtype=np.float64)]), np.array([product.sum()])
        if not self._open(whole, level)[0]:
            codes, slots, weight, product = codes[:, :0], slots[:, :0], weight[:0], product[:0]
        rows += [codes, slots, np.zeros(len(weight), np.int64), weight, product]
        del codes, slots, weight, label, product
        self._levels(rows, whole, total, level)
        found = [x for level in self.levels for x in level]
        return tuple(np.concatenate([x[i] for x in found]) for i in range(3))

    def _open(self, weight, level) -> np.ndarray:
        return (weight >= 2 * self.minimum) if level < self.depth else np.zeros(len(weight), bool)

    def _levels(self, rows: list, node_weight, node_total, level) -> None:
        """``node`` numbers the nodes that can be split; rows of others are left out or have no weight."""
        codes, slots, node, weight, product = rows
        rows.clear()
        m, known = len(self.layout.numbers), None
        while len(node_weight):
            open_ = np.flatnonzero(self._open(node_weight, level))
            if len(node) > 2 * UNIT_ROWS and len(open_) > 8:
                units = self._units(node, open_, len(node_weight))
                if len(units) > 1:
                    known, order = None, _sorted(np.zeros(len(node), np.int64), [node], 0)[1]
                    for part, first, (a, b) in units:
                        mine = order[part]
                        self._levels([_taken(codes, mine), _taken(slots, mine), node[mine] - first, weight[mine], product[mine]],
                                     node_weight[a:b], node_total[a:b], level)
                    return
            column, cut = np.full(len(node_weight), -1, np.int32), np.zeros(len(node_weight), np.uint16)
            if not len(open_):
                self.levels[level].append((column, cut, node_total / node_weight))
                return
            best, figures = _best_splits(
                codes, slots, node, weight, product, node_weight[open_], node_total[open_], self.layout, self.minimum, known)
            split = best.score > 0
            at = open_[split]
            column[at], cut[at] = best.column[split], best.cut[split]
            leaf = column < 0
            self.levels[level].append((column, cut, node_total[leaf] / node_weight[leaf]))
            np.add.at(self.gains, best.column[split], best.score[split] / best.weight[split])

            goes = np.zeros(len(node), bool)
            if m:
                goes = codes[np.minimum(best.column, m - 1)[node], np.arange(len(node))] > best.cut[node]
            by_flag = best.column >= m
            if len(slots) and by_flag.any():
                wanted = np.where(by_flag, best.column - m, len(self.layout.flags) + 1).astype(slots.dtype)[node]
                hit = np.zeros(len(node), bool)
                for line in slots:
                    hit |= line == wanted
                goes = np.where(by_flag[node], hit, goes)
            rank = (np.cumsum(split) - 1)[node]
            child = 2 * rank + goes
            left, left_total = best.left[split], best.left_total[split]
            node_weight = np.stack([left, node_weight[at] - left], 1).ravel()
            node_total = np.stack([left_total, node_total[at] - left_total], 1).ravel()
            level += 1
            if not len(node_weight):
                return
            next_open = self._open(node_weight, level)
            goes_on = split[node]
            keep = goes_on & next_open[child]
            known = None
            if any(f is not None for f in figures):
                small_left, both = left <= best.weight[split] - left, next_open.reshape(-1, 2).any(1)
                mine = np.flatnonzero(goes_on & both[rank] & (goes != small_left[rank]))
                children = np.flatnonzero(next_open)
                known = _Smaller(
                    figures, (_taken(codes, mine), _taken(slots, mine), rank[mine], weight[mine], product[mine]), np.flatnonzero(split),
                    children // 2, (children % 2 == 0) == small_left[children // 2])
            child = (np.cumsum(next_open) - 1)[child]
            if keep.mean() > 0.8:  # a few rows of nodes that are done stay, without weight
                node, weight, product = np.where(keep, child, 0), weight * keep, product * keep
            else:
                mine = np.flatnonzero(keep)
                node, weight, product = child[mine], weight[mine], product[mine]
                codes = _taken(codes, mine)
                slots = _taken(slots, mine)
            del child, rank, goes, goes_on, keep

    @staticmethod
    def _units(node, open_, k) -> list:
        """Neighbouring nodes of about ``UNIT_ROWS`` rows: their rows in the order of nodes, first open node, range of nodes."""
        ends = np.cumsum(np.bincount(node, minlength=len(open_)))
        starts = ends - np.diff(ends, prepend=0)
        unit = starts // UNIT_ROWS
        first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        bounds = [0, *open_[first[1:]].tolist(), k]
        after = [*first[1:].tolist(), len(open_)]
        return [(slice(starts[f], ends[e - 1]), f, (bounds[i], bounds[i + 1])) for i, (f, e) in enumerate(zip(first.tolist(), after))]


# ---- growing in Spark ------------------------------------------------------------------------

@dataclass(frozen=True)
class _Plan:
    """What the tasks know: split upper nodes a tree, position -> (column, cut); the root is 1, its children 2 and 3."""

    layout: Layout
    trees: int
    depth: int
    minimum: int
    upper: dict
    ended: dict  # upper nodes that cannot be split, (tree, position) -> mean

    def places(self, tree: int, codes: np.ndarray, slots: np.ndarray, n: int) -> np.ndarray:
        at, m = np.ones(n, np.int64), len(self.layout.numbers)
        for position, (column, cut) in sorted(self.upper.get(tree, {}).items()):
            mine = np.flatnonzero(at == position)
            goes = codes[column][mine] > cut if column < m else (slots[:, mine] == column - m).any(0)
            at[mine] = 2 * position + goes
        return at


def _blocks(rows: DataFrame, layout: Layout) -> DataFrame:
    """Distinct rows with their counts as blocks of rows; a row that comes n times has n hashes."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def blocks():
            hashes, labels, times = (np.concatenate([h[i] for h in held]) for i in (0, 1, 3))
            raw, ends = np.concatenate([h[2] for h in held]), np.cumsum(times)
            for a in range(0, int(ends[-1]), BLOCK_ROWS):
                at = np.arange(a, min(a + BLOCK_ROWS, int(ends[-1])))
                row = np.searchsorted(ends, at, side="right")
                nth = (at - (ends - times)[row]).astype(np.uint64)
                part = raw[row]
                cells = [_mixed(hashes[row] + nth * np.uint64(GOLDEN)), labels[row], layout.numeric(part).T, layout.slots(part)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(at)], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in cells]],
                    ["n", "hashes", "labels", "codes", "slots"])

        for batch in batches:
            if batch.num_rows:
                times = batch.column(3).to_numpy()
                held.append((batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy(), _matrix(batch.column(2), layout.width), times))
                n += int(times.sum())
            if n >= BLOCK_ROWS:
                yield from blocks()
                held, n = [], 0
        if held:
            yield from blocks()

    return rows.mapInArrow(packed, "n int, hashes binary, labels binary, codes binary, slots binary")


def _read_blocks(batches, layout: Layout) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            n, *cells = (batch.column(c)[i].as_py() for c in range(5))
            hashes, labels = np.frombuffer(cells[0], np.uint64), np.frombuffer(cells[1], np.int32)
            codes = np.frombuffer(cells[2], layout.item).reshape(len(layout.numbers), n)
            yield n, hashes, labels, codes, np.frombuffer(cells[3], layout.slot).reshape(-1, n)


PART = "tree int, position bigint, nodes bigint, columns binary, cuts binary, values binary, gains array<double>"


def _narrow(layout: Layout) -> type:
    return np.int16 if len(layout.features) < 1 << 15 else np.int32


def _parts(blocks: DataFrame, plan: _Plan, groups: Sequence[tuple[int, list[int]]], value) -> DataFrame:
    """The lower parts of the trees, (tree, positions) a group. Each group has a task, which reads all blocks and keeps
    what the tree drew of its positions; nothing is shuffled or written for it."""
    layout = plan.layout

    def grown(batches):
        held: dict = {}
        for batch in batches:
            which = batch.column(5).to_pylist()
            for group, (n, hashes, labels, codes, slots) in zip(which, _read_blocks([batch], layout)):
                tree, positions = groups[group]
                times = drawn(hashes, tree)
                at = plan.places(tree, codes, slots, n) if tree in plan.upper else np.ones(n, np.int64)
                for position in positions:
                    rows = np.flatnonzero((times > 0) & (at == position))
                    if len(rows):
                        cells = times[rows], labels[rows], _taken(codes, rows), _taken(slots, rows)
                        held.setdefault((tree, position), []).append(cells)
        for tree, position in sorted(held):
            yield part(tree, position, held.pop((tree, position)))

    def part(tree, position, cells):
        times, labels = (np.concatenate([c[i] for c in cells]) for i in (0, 1))
        codes, most = np.hstack([c[2] for c in cells]), max(len(c[3]) for c in cells)
        slots = np.full((most, len(times)), len(layout.flags), layout.slot)
        start = 0
        for c in cells:
            slots[:len(c[3]), start:start + len(c[0])] = c[3]
            start += len(c[0])
        del c
        cells.clear()
        cells += [codes, slots, times, labels]
        del codes, slots, times, labels
        grower = _Grower(layout, plan.depth, plan.minimum)
        columns, cuts, means = grower.grown(cells, position.bit_length() - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array([tree], pa.int32()), pa.array([position], pa.int64()), pa.array([len(columns)], pa.int64()),
             *[pa.array([x.tobytes()], pa.binary()) for x in (columns.astype(_narrow(layout)), cuts, value(means))],
             pa.array([grower.gains.tolist()], pa.list_(pa.float64()))],
            ["tree", "position", "nodes", "columns", "cuts", "values", "gains"])

    numbers = blocks.sparkSession.range(0, len(groups), 1, len(groups)).select(F.col("id").cast("int").alias("group"))
    return blocks.coalesce(1).hint("shuffle_replicate_nl").crossJoin(numbers).mapInArrow(grown, PART)


def _groups(parts: dict, local_rows: int) -> list[tuple[int, list[int]]]:
    """Neighbouring parts, (tree, position) -> weight, of a tree that one task can hold."""
    out, size = [], 0
    for (tree, position), weight in sorted(parts.items()):
        if not out or out[-1][0] != tree or size + weight > local_rows:
            out.append((tree, []))
            size = 0
        out[-1][1].append(position)
        size += weight
    return out


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Blocks are large rows; by default a task would hold a quarter of a GB of them at once, twice."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _upper_splits(blocks: DataFrame, plan: _Plan, wanted: dict) -> DataFrame:
    """The best split of each wanted node, tree -> positions, from figures of all blocks."""
    layout, m = plan.layout, len(plan.layout.numbers)
    sizes = [*layout.bins, len(layout.flags) + 1, 1]  # the last one holds the node's own figures
    cells = sum(sizes)

    def gathered(batches):
        figures = {t: np.zeros((2, len(p), cells), np.int64) for t, p in wanted.items()}
        for n, hashes, labels, codes, slots in _read_blocks(batches, layout):
            for tree, positions in wanted.items():
                times, at = drawn(hashes, tree), plan.places(tree, codes, slots, n)
                node = np.searchsorted(positions, at)
                rows = np.flatnonzero((times > 0) & (np.append(positions, 0)[node] == at))
                node, weight, start = node[rows], times[rows].astype(np.float64), 0
                product = weight * labels[rows]
                for c, size in enumerate(sizes):
                    lines = [codes[c][rows]] if c < m else slots[:, rows] if c == m else [np.zeros(len(rows), np.int64)]
                    for i, x in enumerate(_sums(node, lines, size, len(positions), weight, product)):
                        figures[tree][i, :, start:start + size] += x.astype(np.int64)
                    start += size
        for tree, positions in wanted.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(positions), tree, np.int32)), pa.array(np.array(positions, np.int64)),
                 pa.array([figures[tree][:, i].tobytes() for i in range(len(positions))], pa.binary())],
                ["tree", "position", "figures"])

    def chosen(key, table):
        total = sum(np.frombuffer(x, np.int64) for x in table.column("figures").to_pylist()).reshape(2, 1, cells)
        weight, label = total[:, :, -1].astype(np.float64)
        best, start, total = _Best(weight, label, plan.minimum), 0, total.astype(np.float64)
        for c, size in enumerate(sizes[:-1]):
            part = total[:, :, start:start + size]
            if c < m:
                best.offer_number(c, *part)
            elif size > 1:
                best.offer_flags(m, part[0, :, :-1], part[1, :, :-1])
            start += size
        found = {"weight": weight, "total": label, "score": best.score, "left": best.left, "left_total": best.left_total}
        return pa.table({
            "tree": pa.array([key[0].as_py()], pa.int32()), "position": pa.array([key[1].as_py()], pa.int64()),
            "split_column": pa.array(best.column, pa.int32()), "cut": pa.array(best.cut, pa.int32()),
            **{name: pa.array(x, pa.float64()) for name, x in found.items()}})

    names = ", ".join(f"{c} double" for c in ("weight", "total", "score", "left", "left_total"))
    return blocks.mapInArrow(gathered, "tree int, position bigint, figures binary").groupBy("tree", "position").applyInArrow(
        chosen, f"tree int, position bigint, split_column int, cut int, {names}")


def grow_forest(train: DataFrame, key: Column, trees: int, depth: int, minimum: int, max_bins: int, megabytes: int,
                local_rows: int = LOCAL_ROWS) -> Forest:
    """A forest on all rows of ``features`` and ``label``; ``key`` tells rows apart. ``megabytes`` bounds the figures of the
    upper nodes that a task gathers in one pass."""
    spark = train.sparkSession
    train = train.select(key.alias("key"), "label", vector_to_array(F.col("features")).alias("values"))
    ends = train.agg(F.min("label"), F.max("label"), F.count(F.lit(1)), F.max(F.size("values"))).first()
    low, high, n, size = ends
    if not n:
        raise ValueError("a forest needs training rows")
    layout = fit_layout(train, size, max_bins)
    middle, half = low / 2 + high / 2, high / 2 - low / 2
    scale = 2.0 ** (LABEL_BITS - math.frexp(half)[1]) if half else 1.0
    grid = 2.0 ** (math.frexp(max(abs(low), abs(high)) or 1.0)[1] - VALUE_BITS)

    def value(means):
        return np.round((middle + np.asarray(means, np.float64) / scale) / grid) * grid

    def coded(batches):
        for batch in batches:
            if batch.num_rows:
                labels = np.round((batch.column(1).to_numpy() - middle) * scale).astype(np.int32)
                codes = layout.rows(_matrix(batch.column(2), size))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels), _binary(codes)], ["key", "label", "codes"])

    rows = train.mapInArrow(coded, "key bigint, label int, codes binary")
    rows = rows.select(F.xxhash64("key", "label", "codes").alias("hash"), "label", "codes").groupBy("hash", "label", "codes").count()
    blocks = durable(_blocks(rows, layout))
    plan = _Plan(layout, trees, depth, minimum, {}, {})
    gains = np.zeros((trees, len(layout.features)))
    local_rows = max(1, min(local_rows, LOCAL_BYTES // max(1, layout.width)))
    most = max(1, (megabytes << 20) // (16 * (sum(layout.bins) + len(layout.flags) + 2)))  # nodes in a pass
    lower = {(t, 1): n for t in range(trees)}  # what tasks grow alone, with its weight
    level, large = 0, list(lower) if n > local_rows else []
    while large and level < depth:
        found = []
        for i in range(0, len(large), most):
            wanted: dict = {}
            for tree, position in large[i:i + most]:
                wanted.setdefault(tree, []).append(position)
            with _small_batches(spark):
                found += _upper_splits(blocks, plan, wanted).collect()
        large, level = [], level + 1
        for r in sorted(found, key=lambda r: (r.tree, r.position)):
            if r.weight <= local_rows:  # a root whose draws were few
                continue
            lower.pop((r.tree, r.position))
            if not r.score > 0:
                plan.ended[r.tree, r.position] = r.total / r.weight
                continue
            plan.upper.setdefault(r.tree, {})[r.position] = (r.split_column, r.cut)
            gains[r.tree, r.split_column] += r.score / r.weight
            for side, weight, total in ((0, r.left, r.left_total), (1, r.weight - r.left, r.total - r.left_total)):
                child = r.tree, 2 * r.position + side
                if weight > local_rows and level == depth:
                    plan.ended[child] = total / weight
                    continue
                lower[child] = weight
                if weight > local_rows:
                    large.append(child)
    parts = _parts(blocks, plan, _groups(lower, local_rows), value)
    if plan.ended:
        leaf = np.array([-1], _narrow(layout)).tobytes()
        parts = parts.union(spark.createDataFrame(
            [(t, p, 1, leaf, bytes(2), value([x]).tobytes(), [0.0] * len(layout.features)) for (t, p), x in plan.ended.items()], PART))
    with _small_batches(spark):
        parts = written(parts)
        found = {(r.tree, r.position): r for r in parts.select("tree", "position", "nodes", "gains").collect()}
    for (tree, _), r in sorted(found.items()):
        gains[tree] += np.array(r.gains, np.float64)
    nodes = sum(r.nodes for r in found.values()) + sum(len(x) for x in plan.upper.values())
    blocks.unpersist()
    return Forest(parts, plan, size, gains, nodes)


# ---- the forest ------------------------------------------------------------------------------

@dataclass(frozen=True)
class ListedTree:
    """A tree as text, in the words of Spark's trees."""

    toDebugString: str


@dataclass(frozen=True)
class Forest:
    parts: DataFrame
    plan: _Plan
    numFeatures: int
    gains: np.ndarray  # a tree's reductions of the sum of squares by column
    nodes: int
    predictionCol: str = "prediction"

    @property
    def featureImportances(self) -> DenseVector:
        """Each tree's gains as shares, averaged; shares of what all features have."""
        whole = self.gains.sum(1, keepdims=True)
        shares = np.divide(self.gains, whole, out=np.zeros_like(self.gains), where=whole > 0).sum(0)
        out = np.zeros(self.numFeatures)
        out[self.plan.layout.features] = shares / shares.sum() if shares.sum() > 0 else shares
        return Vectors.dense(out)

    def setPredictionCol(self, name: str) -> Forest:
        return replace(self, predictionCol=name)

    @property
    def trees(self) -> list[ListedTree]:
        """For small forests: the trees come to the driver."""
        parts = {(r.tree, r.position): _nodes(r.columns, r.cuts, r.values, self.plan.layout) for r in self.parts.collect()}
        return [ListedTree("\n".join(["tree", *self._lines(t, 1, parts)])) for t in range(self.plan.trees)]

    @property
    def toDebugString(self) -> str:
        trees = [f"  Tree {t}:\n" + x.toDebugString.split("\n", 1)[1] for t, x in enumerate(self.trees)]
        return "\n".join([f"forest of {len(trees)} trees, {self.numFeatures} features", *trees])

    def _lines(self, tree: int, position: int, parts: dict) -> Iterator[str]:
        layout = self.plan.layout

        def split(column, cut, left, right, indent):
            feature, pad = layout.features[column], " " * indent
            if column < len(layout.numbers):
                at = float(layout.cuts[feature][cut])
                yes, no = f"<= {at!r}", f"> {at!r}"
            else:
                yes, no = "in {0.0}", "not in {0.0}"
            yield f"{pad}If (feature {feature} {yes})"
            yield from left(indent + 1)
            yield f"{pad}Else (feature {feature} {no})"
            yield from right(indent + 1)

        def lower(nodes, i, indent):
            column, cut, child, value = nodes
            if child[i] == i:
                yield " " * indent + f"Predict: {float(value[i])!r}"
            else:
                yield from split(column[i], cut[i], lambda d: lower(nodes, child[i], d), lambda d: lower(nodes, child[i] + 1, d), indent)

        def upper(p, indent):
            if p in self.plan.upper.get(tree, {}):
                yield from split(*self.plan.upper[tree][p], lambda d: upper(2 * p, d), lambda d: upper(2 * p + 1, d), indent)
            else:
                yield from lower(parts[tree, p], 0, indent)

        return upper(position, 4)

    def codes(self, features: Column) -> Column:
        """The codes of feature vectors, all that a prediction depends on."""
        layout, size = self.plan.layout, self.numFeatures

        @F.pandas_udf("binary")
        def coded(values: pd.Series) -> pd.Series:
            if not len(values):
                return pd.Series([], dtype=object)
            raw = layout.rows(np.concatenate(values.tolist()).reshape(len(values), size))
            return pd.Series([x.tobytes() for x in raw])

        return coded(vector_to_array(features))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the mean of the trees' leaf values. Each different row of codes is scored once."""
        coded = df.withColumn("__codes", self.codes(F.col("features")))
        predicted = self._predicted(durable(coded.select("__codes").distinct()))
        return coded.join(predicted, "__codes").drop("__codes").select(*df.columns, self.predictionCol)

    def _predicted(self, distinct: DataFrame) -> DataFrame:
        plan, layout, width, name = self.plan, self.plan.layout, self.plan.layout.width, self.predictionCol
        step = max(1, BLOCK_BYTES // max(1, width))

        def packed(batches):
            held, n = [], 0
            for batch in batches:
                held.append(_matrix(batch.column(0), width))
                n += len(held[-1])
                while n >= step:
                    rows = np.concatenate(held)
                    yield block(rows[:step])
                    held, n = [rows[step:]], n - step
            if n:
                yield block(np.concatenate(held))

        def block(rows):
            raw = rows.tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([hashlib.md5(raw).hexdigest()]), pa.array([len(rows)], pa.int32()), pa.array([raw], pa.binary())],
                ["block", "n", "codes"])

        def walked(batches):
            sums: dict = {}
            for batch in batches:
                for i in range(batch.num_rows):
                    tree, position, columns, cuts, values, key, n, raw = (batch.column(c)[i].as_py() for c in range(8))
                    if key not in sums:
                        sums[key] = [0, np.zeros(n)]
                    sums[key][0] += _walk(plan, tree, position, _nodes(columns, cuts, values, layout), raw, n, sums[key][1])
            for key, (rows, total) in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key]), pa.array([rows], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["block", "walks", "total"])

        def summed(key, table):
            total = sum(np.frombuffer(x, np.float64) for x in table.column("total").to_pylist())
            walks = sum(table.column("walks").to_pylist())
            if walks != len(total) * plan.trees:
                raise RuntimeError("parts of the forest are missing; a cluster should set spark.checkpoint.dir")
            return pa.table({"block": [key[0].as_py()], "mean": [(total / plan.trees).tobytes()]})

        def unpacked(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    n, raw, mean = (batch.column(c)[i].as_py() for c in range(3))
                    rows = np.frombuffer(raw, np.uint8).reshape(n, width)
                    for a in range(0, n, BLOCK_ROWS):
                        part = slice(a, a + BLOCK_ROWS)
                        yield pa.RecordBatch.from_arrays([_binary(rows[part]), pa.array(np.frombuffer(mean)[part])], ["__codes", name])

        tasks = max(1, math.ceil(distinct.count() / step))
        blocks = durable(distinct.repartition(tasks).mapInArrow(packed, "block string, n int, codes binary"))
        parallel = max(1, min(self.plan.trees, 4 * self.parts.sparkSession.sparkContext.defaultParallelism))
        parts = self.parts.select("tree", "position", "columns", "cuts", "values").repartition(parallel, "tree", "position")
        pairs = parts.hint("shuffle_replicate_nl").crossJoin(blocks)  # parts stay apart from blocks: neither is small for sure
        sums = pairs.mapInArrow(walked, "block string, walks bigint, total binary")
        means = sums.groupBy("block").applyInArrow(summed, "block string, mean binary")
        with _small_batches(self.parts.sparkSession):
            return durable(blocks.join(means, "block").select("n", "codes", "mean").mapInArrow(unpacked, f"__codes binary, `{name}` double"))


def _nodes(columns: bytes, cuts: bytes, values: bytes, layout: Layout) -> tuple[np.ndarray, ...]:
    """Column, cut, first child and value of each node; a leaf is its own child and no code is beyond its cut."""
    column = np.frombuffer(columns, np.int16 if len(layout.features) < 1 << 15 else np.int32)
    inner = column >= 0
    child = np.where(inner, 2 * np.cumsum(inner) - 1, np.arange(len(column))).astype(np.int32)
    value = np.zeros(len(column))
    value[~inner] = np.frombuffer(values)
    cut = np.where(inner, np.frombuffer(cuts, np.uint16), np.iinfo(np.uint16).max).astype(np.uint16)
    return np.where(inner, column, 0), cut, child, value


def _walk(plan: _Plan, tree: int, position: int, nodes: tuple, raw: bytes, n: int, total: np.ndarray) -> int:
    """Adds the values of the rows of a block that come to a part; how many these are."""
    layout, walks = plan.layout, 0
    columns = len(layout.features)
    rows = np.frombuffer(raw, np.uint8).reshape(n, layout.width)
    column, cut, child, value = nodes
    way = [position >> k for k in range(position.bit_length() - 1, -1, -1)]  # from the root
    step = max(1, WALKED_BYTES // max(1, columns * layout.item.itemsize))
    for a in range(0, n, step):
        wide = layout.wide(rows[a:a + step])
        mine = np.arange(len(wide))
        for p, then in zip(way, way[1:]):
            at, bound = plan.upper[tree][p]
            mine = mine[(wide[mine, at] > bound) == (then == 2 * p + 1)]
        walks += len(mine)
        if not columns:
            total[a + mine] += value[0]
            continue
        flat, starts = wide.ravel(), mine * columns
        at, then = None, np.zeros(len(mine), np.int32)
        while at is None or not np.array_equal(at, then):
            at = then
            then = child[at] + (flat[starts + column[at]] > cut[at])
        total[a + mine] += value[at]
    return walks
