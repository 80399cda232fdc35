"""Gradient boosted trees grown leaf by leaf, with an L2 term on the leaf values.

Rows are packed into blocks, column by column: a row is its label, its margin so far and one small number per
column (the level's index of a categorical column, the bin of a numeric one) in as few bytes as hold it.  Gradients,
hessians and rows are added up per (fit, node, column, bin); the sums of a node give its best split.  A categorical column
splits one level from the rest (a split of its one-hot column), a numeric one at a threshold.

* Growth is best-first: of all leaves the one with the largest gain is split, up to ``leaves``.
* Gradients are rounded to multiples of 2 ** -30 and summed as whole numbers, so that the trees do
  not depend on how rows are dealt or tasks are repeated, nor on which of the two ways below grows them.
* Several fits (the folds of a cross-validation, a refit) grow side by side.

A fit whose rows and sums stay below ``WHOLE_BYTES`` grows as a whole in one task: no job per step, a node's sums
are those of its parent less those of its sibling, and the driver gets the trees.

A larger fit stays distributed and takes one Spark job per step, in lockstep with the other large ones:

* A step asks for the best splits of all nodes that may be needed, so a tree takes about as many jobs as it is deep.
* Every task adds up its blocks, tasks combine the sums of a (fit, node), and the best split of each is all that reaches the
  driver, whatever the number of rows and levels.
* The rows of a column of more than ``WIDE_LEVELS`` levels are dealt by level, so that a level's sums are complete in one task,
  which returns its best level only.  Levels with more rows than a partition's share are dealt over all partitions, and
  their sums combined.  Each further wide column has a copy of the rows, dealt by its levels.
* Margins are written to the checkpoint folder every ``CHECKPOINT_TREES`` trees; tasks apply the few trees since.

The steps run over RDDs of blocks, as Spark ML's own trees do: some 700 jobs a fit, of which each would
spend most of a second on planning as a query.

Memory: a task holds the cells of the nodes asked for: (narrow levels + bins + its share of a wide column's levels) x nodes x
fits x 24 bytes.  A numeric column has at most ``bins`` bins; the levels are those that the feature preparation found.
"""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package

CHECKPOINT_TREES = 10
WHOLE_BYTES = 256 << 20         # a fit that needs no more than this grows in one task
WHOLE_ROWS = 1 << 22            # nor one of more rows: doubles hold the sums of so many exactly
WIDE_LEVELS = 4096              # columns of more levels are dealt by level
BLOCK_ROWS = 1 << 18
_CHUNK = 1 << 16                # rows summed at a time: they fit a core's cache
_PART_BYTES = 32 << 20
_PART_LEVELS = 1 << 16
_UNIT = float(1 << 30)          # gradients are whole numbers of 1 / _UNIT
_SPECULATE = 16                 # nodes asked for beyond those that growth waits for
_ROOT = 1                       # children of node i: 2 i (left) and 2 i + 1
_BLOCK = "fit int, layout int, part int, y binary, margin binary, x binary"


@dataclass(frozen=True)
class Growth:
    """Parameters of the growth."""

    trees: int = 100
    leaves: int = 8
    rate: float = 0.03
    l2: float = 5.0
    min_rows: int = 20
    min_hessian: float = 1e-3
    bins: int = 255


@dataclass
class Split:
    """Best split of a node: column, bin, and sums of the whole node and of its left side."""

    gain: float
    feature: int
    bin: int
    g: int
    h: int
    n: int
    left_g: int
    left_h: int
    left_n: int


@dataclass
class Tree:
    splits: dict[int, tuple[int, int]] = field(default_factory=dict)       # node -> (column, bin)
    values: dict[int, float] = field(default_factory=dict)                 # leaf -> value
    covers: dict[int, int] = field(default_factory=dict)                   # node -> training rows


def goes_left(values: np.ndarray, bin_: int, categorical: bool) -> np.ndarray:
    return values == bin_ if categorical else values <= bin_


def spread(splits: dict[int, tuple[int, int]], x: Sequence[np.ndarray], n_categorical: int, values: dict, kind: type) -> np.ndarray:
    """The value of the node that each row of the columns ``x`` reaches under ``splits``."""
    def at(node: int):
        if node not in splits:
            return kind(values[node])
        feature, bin_ = splits[node]
        return np.where(goes_left(x[feature], bin_, feature < n_categorical), at(2 * node), at(2 * node + 1))

    return np.broadcast_to(at(_ROOT), len(x[0]))


def margins(trees: Sequence[Tree], x: Sequence[np.ndarray], n_categorical: int) -> np.ndarray:
    out = np.zeros(len(x[0]))
    for tree in trees:
        out += spread(tree.splits, x, n_categorical, tree.values, np.float64)
    return out


def gradients(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the log-loss, as whole numbers of 1 / _UNIT."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint((p - y) * _UNIT), np.rint(p * (1.0 - p) * _UNIT)


def _kinds(sizes: Sequence[int]) -> list[np.dtype]:
    """The narrowest type for each column of so many bins."""
    return [np.dtype(np.uint8 if n <= 1 << 8 else np.uint16 if n <= 1 << 16 else np.uint32) for n in sizes]


def _columns(x: bytes, n: int, sizes: Sequence[int]) -> list[np.ndarray]:
    out, at = [], 0
    for kind in _kinds(sizes):
        out.append(np.frombuffer(x, kind, n, at))
        at += n * kind.itemsize
    return out


def _added(x: Sequence[np.ndarray], starts: Sequence[int], g: np.ndarray, h: np.ndarray, rows: np.ndarray | None = None,
           counted: np.ndarray | None = None) -> np.ndarray:
    """Gradient, hessian and row sums (three rows) of all columns' bins, one after the other; ``counted``: the row sums,
    if they are known."""
    sums = np.zeros((3, starts[-1]), np.int64)
    n = len(g) if rows is None else len(rows)
    chunk = max([_CHUNK, *np.diff(starts)])
    for lo in range(0, n, chunk):
        some = slice(lo, lo + chunk) if rows is None else rows[lo:lo + chunk]
        gs, hs = g[some], h[some]
        for k, column in enumerate(x):
            cell, part = column[some].astype(np.intp), slice(starts[k], starts[k + 1])
            width = starts[k + 1] - starts[k]
            # Doubles hold the sums of so many rows exactly.
            sums[0, part] += np.bincount(cell, gs, width).astype(np.int64)
            sums[1, part] += np.bincount(cell, hs, width).astype(np.int64)
            if counted is None:
                sums[2, part] += np.bincount(cell, minlength=width)
    if counted is not None:
        sums[2] = counted
    return sums


def _gains(left: np.ndarray, total: np.ndarray, o: Growth) -> np.ndarray:
    """Gain of each split by its left side's sums; 0 where it is not allowed."""
    right = total[:, None] - left
    (lg, lh), (rg, rh), (ag, ah) = left[:2] / _UNIT, right[:2] / _UNIT, total[:2] / _UNIT
    allowed = (left[2] >= o.min_rows) & (right[2] >= o.min_rows) & (lh >= o.min_hessian) & (rh >= o.min_hessian)
    with np.errstate(invalid="ignore", divide="ignore"):     # empty sides, never allowed
        return np.where(allowed, lg * lg / (lh + o.l2) + rg * rg / (rh + o.l2) - ag * ag / (ah + o.l2), 0.0)


def _best(cells: np.ndarray, columns: Sequence[int], starts: Sequence[int], n_categorical: int, growth: Growth, total: np.ndarray) -> Split:
    """Best split of a node by the sums of the bins of ``columns`` (gain 0 where none is allowed)."""
    left = cells.copy()
    for k, column in enumerate(columns):
        if column >= n_categorical:
            part = slice(starts[k], starts[k + 1])
            left[:, part] = np.cumsum(cells[:, part], axis=1)
    gain = _gains(left, total, growth)
    top = int(np.argmax(gain))                          # the first column and bin of equal gains
    k = int(np.searchsorted(starts, top, side="right")) - 1
    return Split(float(gain[top]), columns[k], top - int(starts[k]), *total.tolist(), *left[:, top].tolist())


def _starts(sizes: Sequence[int]) -> list[int]:
    return np.cumsum([0, *sizes]).tolist()


# ---------------------------------------------------------------- a fit in one task

def whole_bytes(n: int, sizes: Sequence[int], growth: Growth) -> int:
    """Memory that :func:`grow_whole` takes."""
    return n * (sum(k.itemsize for k in _kinds(sizes)) + 60) + sum(sizes) * 48 * growth.leaves


def grow_whole(y: np.ndarray, x: Sequence[np.ndarray], base: float, sizes: Sequence[int], n_categorical: int, growth: Growth,
               checkpoint_trees: int) -> list[Tree]:
    """The trees that :func:`grow` finds, from rows in memory.  Margins are added up in the same order as there."""
    n, starts, columns = len(y), _starts(sizes), range(len(sizes))
    margin, recent, g, h = np.full(n, base), np.zeros(n), np.empty(n), np.empty(n)
    trees, counted = [], None
    for number in range(growth.trees):
        if number and number % checkpoint_trees == 0:
            margin += recent
            recent[:] = 0.0
        for lo in range(0, n, _CHUNK):
            some = slice(lo, lo + _CHUNK)
            g[some], h[some] = gradients(margin[some] + recent[some], y[some])
        cells = {_ROOT: _added(x, starts, g, h, None, counted)}
        counted = cells[_ROOT][2].copy()
        rows: dict[int, np.ndarray | None] = {_ROOT: None}
        known = {_ROOT: _best(cells[_ROOT], columns, starts, n_categorical, growth, cells[_ROOT][:, :starts[1]].sum(axis=1))}

        def divide(at: int) -> None:
            here, (feature, bin_) = rows.pop(at), (known[at].feature, known[at].bin)
            left = goes_left(x[feature] if here is None else x[feature][here], bin_, feature < n_categorical)
            for child, side in ((2 * at, left), (2 * at + 1, ~left)):
                rows[child] = np.flatnonzero(side).astype(np.int32) if here is None else here[side]

        while True:
            tree, waiting = _grown(known, growth)
            if not waiting:
                break
            for at in sorted({k // 2 for k in waiting}):
                divide(at)
                small, large = sorted((2 * at, 2 * at + 1), key=lambda k: len(rows[k]))
                whole, totals = cells.pop(at), {k: np.array(_sums(known, k)) for k in (small, large)}
                if len(rows[large]) >= 2 * growth.min_rows:
                    cells[small] = _added(x, starts, g, h, rows[small])
                    cells[large] = whole - cells[small]
                for k in (small, large):                # too few rows for two sides: no split is allowed
                    known[k] = (_best(cells[k], columns, starts, n_categorical, growth, totals[k]) if len(rows[k]) >= 2 * growth.min_rows
                                else Split(0.0, 0, 0, *totals[k].tolist(), 0, 0, 0))
        for at in sorted(tree.splits):
            if at in rows:
                divide(at)
        for leaf, value in tree.values.items():
            recent[slice(None) if rows[leaf] is None else rows[leaf]] += value
        trees.append(tree)
    return trees


def grow_in_tasks(blocks: DataFrame, bases: dict[int, float], sizes: dict[int, list[int]], n_categorical: int, growth: Growth) -> dict[int, list[Tree]]:
    """fit -> trees, each fit in a task of its own."""
    fits, checkpoint_trees = sorted(bases), CHECKPOINT_TREES

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple]] = {}
        for batch in batches:
            for fit, _, _, y, _, x in zip(*(c.to_pylist() for c in batch.columns)):
                y = np.frombuffer(y, np.float64)
                found.setdefault(fit, []).append((y, _columns(x, len(y), sizes[fit])))
        for fit in sorted(found):
            parts = found.pop(fit)
            y = np.concatenate([y for y, _ in parts])
            x = [np.concatenate([x[k] for _, x in parts]) for k in range(len(sizes[fit]))]
            del parts
            trees = grow_whole(y, x, bases[fit], sizes[fit], n_categorical, growth, checkpoint_trees)
            yield pa.RecordBatch.from_arrays([pa.array([fit], pa.int32()), pa.array([pickle.dumps(trees)], pa.binary())], ["fit", "trees"])

    position = F.array_position(F.array(*[F.lit(k) for k in fits]), F.col("fit")) - 1
    dealt = blocks.repartitionById(len(fits), position.cast("int")).mapInArrow(grown, "fit int, trees binary")
    return {r["fit"]: pickle.loads(bytes(r["trees"])) for r in dealt.collect()}


# ---------------------------------------------------------------- one step of the distributed fits

@dataclass
class Deal:
    """How the rows of a fit are dealt by the levels of a wide column."""

    column: int
    parts: np.ndarray           # level -> partition; -1: over all of them
    cells: np.ndarray           # level -> its cell in that partition; ``width`` + k: the k-th level dealt over all
    first: np.ndarray           # partition -> its first level
    width: int
    hot: np.ndarray             # the levels dealt over all partitions

    @classmethod
    def by(cls, column: int, counts: np.ndarray, partitions: int) -> Deal:
        """Consecutive levels in a partition, balanced by rows and levels."""
        n = counts.sum()
        hot = np.flatnonzero((counts * partitions >= n) & (partitions > 1))
        weight = counts / max(n, 1) + 1.0 / len(counts)
        weight[hot] = 0.0
        before = np.cumsum(weight) - weight
        parts = np.minimum(before * partitions / max(weight.sum(), 1e-300), partitions - 1).astype(np.int32)
        first = np.searchsorted(parts, np.arange(partitions))
        width = int(np.bincount(parts, minlength=partitions).max())
        cells = (np.arange(len(counts)) - first[parts]).astype(np.int32)
        cells[hot] = width + np.arange(len(hot))
        parts[hot] = -1
        return cls(column, parts, cells, first, width, hot)

    def part_of(self, x: Sequence[np.ndarray]) -> np.ndarray:
        part = self.parts[x[self.column]]
        spare = part < 0
        if spare.any():                                 # by all values of a row, so that a repeated task deals alike
            mixed = np.zeros(int(spare.sum()), np.uint64)
            for column in x:
                mixed = (mixed ^ column[spare].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            part[spare] = (mixed % np.uint64(len(self.first))).astype(np.int32)
        return part


def _better(a: Split | None, b: Split | None) -> Split | None:
    """The split of larger gain, of equal ones that of the first column and bin."""
    if a is None or b is None:
        return a or b
    return max(a, b, key=lambda s: (s.gain, -s.feature, -s.bin))


def _joined(a: tuple, b: tuple) -> tuple:
    """Sums and best splits of two tasks."""
    sums = dict(a[0])
    for key, value in b[0].items():
        sums[key] = sums[key] + value if key in sums else value
    return sums, _better(a[1], b[1])


class _Lockstep:
    """The blocks of all fits and the trees that their stored margins do not hold yet."""

    def __init__(self, blocks: DataFrame, sizes: dict[int, list[int]], n_categorical: int, growth: Growth, deals: dict[int, list[Deal]]):
        self.sizes, self.n_categorical, self.growth = sizes, n_categorical, growth     # sizes: bins of each column, per fit
        self.pending: dict[int, list[Tree]] = {}
        self.wide = {fit for fit, dealt in deals.items() if dealt}
        self.deals = blocks.sparkSession.sparkContext.broadcast(deals)
        self._kept = None
        self._keep(blocks)

    def _keep(self, blocks: DataFrame) -> None:
        old, self.blocks = self._kept, materialize(blocks)
        rows = self.blocks.rdd
        # Tiny partitions would cost more to start than to sum: two per core at most.
        rows = rows.coalesce(min(rows.getNumPartitions(), 2 * rows.context.defaultParallelism))
        self._kept = rows.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
        if old is not None:
            old.unpersist()

    def release(self) -> None:
        self._kept.unpersist()
        self.deals.unpersist()

    def totals(self) -> dict[int, tuple[int, int, int]]:
        """Gradient, hessian and row sums of the fits with wide columns."""
        pending, n_categorical, sizes, wide = self.pending, self.n_categorical, self.sizes, self.wide
        if not wide:
            return {}

        def summed(blocks: Iterator[tuple]) -> Iterator[tuple]:
            for block in blocks:
                fit, layout, _, y, margin, x = _unpacked(block, sizes)
                if fit in wide and layout == 0:
                    g, h = gradients(margin + margins(pending.get(fit, ()), x, n_categorical), y)
                    yield fit, (int(g.sum()), int(h.sum()), len(y))

        found: dict[int, tuple[int, int, int]] = {}
        for fit, sums in self._kept.mapPartitions(summed).collect():
            found[fit] = tuple(a + b for a, b in zip(found.get(fit, (0, 0, 0)), sums))
        return found

    def best(self, partial: dict[int, dict[int, tuple[int, int]]], wanted: dict[int, set[int]],
             totals: dict[tuple[int, int], tuple[int, int, int]]) -> dict[tuple[int, int], Split]:
        """Best split of every wanted node that has rows (gain 0 where none is allowed).  ``totals``: the sums of the wanted nodes of
        fits with wide columns."""
        pending, n_categorical, growth, sizes, shared = self.pending, self.n_categorical, self.growth, self.sizes, self.deals
        nodes = {fit: sorted(ks) for fit, ks in wanted.items()}

        def narrow(fit: int) -> list[int]:
            return [k for k in range(len(sizes[fit])) if k not in {d.column for d in shared.value.get(fit, ())}]

        def summed(blocks: Iterator[tuple]) -> Iterator[tuple]:
            # (fit, layout, partition or -1 for the narrow columns) -> per wanted node the sums of the cells
            sums: dict[tuple, list[np.ndarray]] = {}
            for block in blocks:
                fit, layout, part, y, margin, x = _unpacked(block, sizes)
                if fit not in nodes:
                    continue
                leaves = {node: -1 for k in partial[fit] for node in (2 * k, 2 * k + 1)} | {_ROOT: -1} | {k: i for i, k in enumerate(nodes[fit])}
                slot = spread(partial[fit], x, n_categorical, leaves, np.int16)
                margin = margin + margins(pending.get(fit, ()), x, n_categorical)
                g, h = gradients(margin, y)
                dealt = shared.value.get(fit, ())
                asked: list[tuple] = []
                if layout == 0 and (own := narrow(fit)):
                    asked.append((-1, -1, [x[k] for k in own], _starts([sizes[fit][k] for k in own])))
                if dealt:
                    d = dealt[layout]
                    asked.append((layout, part, [d.cells[x[d.column]]], [0, d.width + len(d.hot)]))
                for i in range(len(nodes[fit])):
                    here = np.flatnonzero(slot == i)
                    if len(here):
                        for lay, at, columns, starts in asked:
                            new = _added(columns, starts, g, h, None if len(here) == len(y) else here)
                            of = sums.setdefault((fit, lay, at), {})
                            of[i] = of[i] + new if i in of else new
            for (fit, layout, part), of in sums.items():
                for i, cells in of.items():
                    key = fit, nodes[fit][i]
                    if layout < 0:
                        yield key, ({-1: cells}, None)
                        continue
                    d, total = shared.value[fit][layout], np.array(totals[key])
                    gain = _gains(cells[:, :d.width], total, growth)
                    top = int(np.argmax(gain))
                    found = Split(float(gain[top]), d.column, int(d.first[part]) + top, *total.tolist(), *cells[:, top].tolist())
                    yield key, ({d.column: cells[:, d.width:]} if len(d.hot) else {}, found if gain[top] > 0 else None)

        def chosen(item: tuple) -> tuple:
            key, (sums, found) = item
            fit, own = key[0], narrow(key[0])
            starts = _starts([sizes[fit][k] for k in own])
            total = np.array(totals[key]) if key in totals else sums[-1][:, :starts[1]].sum(axis=1)
            if -1 in sums:
                found = _better(found, _best(sums[-1], own, starts, n_categorical, growth, total))
            for d in shared.value.get(fit, ()):
                if d.column in sums:
                    gain = _gains(sums[d.column], total, growth)
                    top = int(np.argmax(gain))
                    found = _better(found, Split(float(gain[top]), d.column, int(d.hot[top]), *total.tolist(), *sums[d.column][:, top].tolist()))
            return key, found or Split(0.0, 0, 0, *total.tolist(), 0, 0, 0)

        parts = min(sum(map(len, nodes.values())), 2 * self._kept.context.defaultParallelism)
        return self._kept.mapPartitions(summed).reduceByKey(_joined, parts).map(chosen).collectAsMap()

    def store(self) -> None:
        """Write the margins with all trees so far."""
        pending, n_categorical, sizes = self.pending, self.n_categorical, self.sizes

        def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                new = []
                for block in zip(*(c.to_pylist() for c in batch.columns)):
                    fit, _, _, _, margin, x = _unpacked(block, sizes)
                    new.append((margin + margins(pending.get(fit, ()), x, n_categorical)).tobytes())
                yield batch.set_column(4, "margin", pa.array(new, pa.binary()))

        self._keep(self.blocks.mapInArrow(applied, _BLOCK))
        self.pending = {}


def _unpacked(block: tuple, sizes: dict[int, list[int]]) -> tuple[int, int, int, np.ndarray, np.ndarray, list[np.ndarray]]:
    fit, layout, part, y, margin, x = block
    y = np.frombuffer(y, np.float64)
    return fit, layout, part, y, np.frombuffer(margin, np.float64), _columns(x, len(y), sizes[fit])


def _grown(known: dict[int, Split], growth: Growth) -> tuple[Tree, set[int]]:
    """Best-first growth as far as the known nodes allow, and the nodes it waits for."""
    tree, leaves = Tree(), {_ROOT: None}
    if _ROOT not in known:
        return tree, {_ROOT}
    while True:
        unknown = {k for k in leaves if k not in known}
        if len(leaves) >= growth.leaves or unknown:
            break
        top = max(leaves, key=lambda k: (known[k].gain, -k))
        if known[top].gain <= 0:
            break
        del leaves[top]
        tree.splits[top] = (known[top].feature, known[top].bin)
        leaves |= {2 * top: None, 2 * top + 1: None}
    if len(leaves) >= growth.leaves:
        unknown = set()                                  # their values follow from the parents' sums
    if not unknown:
        for k in [*tree.splits, *leaves]:
            g, h, n = _sums(known, k)
            tree.covers[k] = n
            if k in leaves:
                tree.values[k] = -(g / _UNIT) / (h / _UNIT + growth.l2) * growth.rate
    return tree, unknown


def _sums(known: dict[int, Split], node: int) -> tuple[int, int, int]:
    if node in known:
        return known[node].g, known[node].h, known[node].n
    s = known[node // 2]
    left = s.left_g, s.left_h, s.left_n
    return left if node % 2 == 0 else tuple(a - b for a, b in zip((s.g, s.h, s.n), left))


def _frontier(known: dict[int, Split], waiting: set[int], depth: int) -> set[int]:
    """What to ask for: the nodes that growth waits for and the most promising others below known splits."""
    others = [k for p, s in known.items() if s.gain > 0 for k in (2 * p, 2 * p + 1)
              if k not in known and k not in waiting and k.bit_length() <= depth]
    others.sort(key=lambda k: (-known[k // 2].gain, k))
    return waiting | set(others[:max(0, _SPECULATE - len(waiting))])


def grow(blocks: DataFrame, bases: dict[int, float], sizes: dict[int, list[int]], n_categorical: int, growth: Growth,
         deals: dict[int, list[Deal]] | None = None) -> dict[int, list[Tree]]:
    """fit -> trees from blocks (see ``_BLOCK``): all fits in lockstep."""
    step = _Lockstep(blocks, sizes, n_categorical, growth, deals or {})
    trees: dict[int, list[Tree]] = {fit: [] for fit in bases}
    for number in range(growth.trees):
        if number and number % CHECKPOINT_TREES == 0:
            step.store()
        known: dict[int, dict[int, Split]] = {fit: {} for fit in bases}
        roots = step.totals()
        while True:
            grown = {fit: _grown(known[fit], growth) for fit in bases}
            asked = {fit: _frontier(known[fit], waiting, growth.leaves) for fit, (_, waiting) in grown.items() if waiting}
            if not asked:
                break
            # The partial tree splits every known node, so that its leaves are all that can be asked for.
            partial = {fit: {k: (s.feature, s.bin) for k, s in known[fit].items() if s.gain > 0} for fit in asked}
            totals = {(fit, k): roots[fit] if k == _ROOT else _sums(known[fit], k) for fit, nodes in asked.items() if fit in roots for k in nodes}
            found = step.best(partial, asked, totals)
            for fit, nodes in asked.items():
                for k in nodes:
                    known[fit][k] = found.get((fit, k)) or Split(0.0, 0, 0, *_sums(known[fit], k), 0, 0, 0)
        for fit, (tree, _) in grown.items():
            trees[fit].append(tree)
            step.pending.setdefault(fit, []).append(tree)
    step.release()
    return trees


# ---------------------------------------------------------------- from prepared columns and back

def bin_edges(prepared: DataFrame, columns: Sequence[str], bins: int) -> list[list[float]]:
    """Thresholds of each numeric column: midpoints between its values if there are at most
    ``bins`` of them, else its approximate quantiles (a sketch of fixed size)."""
    if not columns:
        return []
    real = {c: F.when(~F.isnan(c), F.col(c)) for c in columns}
    # 5 %, far from the factor of two: at 1 % Spark keeps the sketches in some 1,600 buffer columns each, seconds of planning.
    counts = prepared.agg(*[F.approx_count_distinct(real[c], 0.05).alias(c) for c in columns]).first()
    few = [c for c in columns if counts[c] <= 2 * bins]
    wide = [c for c in columns if c not in few]
    sets = prepared.agg(*[F.collect_set(real[c]).alias(c) for c in few]).first() if few else {}
    edges = {}
    for c in few:
        values = sorted(sets[c])
        if len(values) > bins:
            wide.append(c)
        else:
            edges[c] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    if wide:
        shares = [k / bins for k in range(1, bins)]
        found = prepared.agg(*[F.percentile_approx(real[c], shares, 100 * bins).alias(c) for c in wide]).first()
        edges |= {c: sorted(set(found[c])) for c in wide}
    return [edges[c] for c in columns]


def _blocks(prepared: DataFrame, fit: int, base: float, label: str, categorical: Sequence[str], numeric: Sequence[str],
            edges: list[list[float]], sizes: Sequence[int], deals: Sequence[Deal] = (), partitions: int = 1, margin: bool = True) -> DataFrame:
    """Blocks (see ``_BLOCK``) of up to ``BLOCK_ROWS`` rows, one copy of the rows for each of ``deals``; a missing number counts as larger
    than every threshold."""
    n_cat, kinds = len(categorical), _kinds(sizes)

    def packed(layout: int, deal: Deal | None):
        def blocks_of(y: np.ndarray, x: list[np.ndarray]) -> pa.RecordBatch:
            part = deal.part_of(x) if deal is not None else np.zeros(len(y), np.int32)
            order = np.argsort(part, kind="stable")
            found, begins = np.unique(part[order], return_index=True)
            made = []
            for p, here in zip(found.tolist(), np.split(order, begins[1:])):
                made.append((fit, layout, p, y[here].tobytes(), np.full(len(here) * margin, base).tobytes(), b"".join(v[here].tobytes() for v in x)))
            kinds_out = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*made), kinds_out)], ["fit", "layout", "part", "y", "margin", "x"])

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0

            def flushed() -> pa.RecordBatch:
                return blocks_of(np.concatenate([y for y, _ in held]), [np.concatenate([x[k] for _, x in held]) for k in range(len(kinds))])

            for batch in batches:
                if not batch.num_rows:
                    continue
                x = []
                for k, kind in enumerate(kinds):
                    values = batch.column(k + 1).to_numpy(zero_copy_only=False).astype(np.float64)
                    x.append((values if k < n_cat else np.searchsorted(edges[k - n_cat], values)).astype(kind))
                held.append((batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64), x))
                n += batch.num_rows
                if n >= BLOCK_ROWS:
                    yield flushed()
                    held, n = [], 0
            if held:
                yield flushed()

        return pack

    columns = [F.col(label).cast("double"), *[F.col(f"idx__{c}") for c in categorical], *[F.col(f"num__{c}") for c in numeric]]
    rows = prepared.select(*columns)
    if not deals:
        return rows.mapInArrow(packed(0, None), _BLOCK)
    return reduce(DataFrame.unionByName, [rows.mapInArrow(packed(i, d), _BLOCK).repartitionById(partitions, F.col("part")) for i, d in enumerate(deals)])


def _deals(prepared: DataFrame, columns: Sequence[str], sizes: Sequence[int], n: int) -> tuple[list[Deal], int]:
    """How a large fit's rows are dealt by its wide columns, and over how many partitions."""
    wide = [k for k, c in enumerate(columns) if sizes[k] > WIDE_LEVELS]
    row_bytes = 16 + sum(k.itemsize for k in _kinds(sizes))
    partitions = max(2 * prepared.sparkSession.sparkContext.defaultParallelism, n * row_bytes // _PART_BYTES, max(sizes) // _PART_LEVELS)
    deals = []
    for k in wide:
        found = prepared.groupBy(F.col(columns[k]).cast("long").alias("level")).agg(F.count(F.lit(1)).alias("n")).toArrow()
        counts = np.zeros(sizes[k], np.int64)
        counts[found["level"].to_numpy()] = found["n"].to_numpy()
        deals.append(Deal.by(k, counts, partitions))
    return deals, partitions


def fit_many(jobs: Sequence[tuple], label: str = "target", growth: Growth = Growth()) -> list[LeafwiseTreesModel]:
    """One model per (FittedFeatures, prepared rows).  Without rows a model says 0.5."""
    if not jobs:
        return []
    ship_package(jobs[0][1].sparkSession)
    categorical, numeric = jobs[0][0].categorical, jobs[0][0].numeric

    def looked_at(job: tuple) -> tuple:
        feats, prepared = job
        n, wins = prepared.agg(F.count(F.lit(1)), F.sum(F.col(label).cast("double"))).first()
        return n, wins, bin_edges(prepared, [f"num__{c}" for c in numeric], growth.bins), [feats.levels(c) for c in range(len(categorical))]

    with ThreadPoolExecutor(max_workers=2) as pool:
        found = list(pool.map(looked_at, jobs))
    bases, sizes, deals, small, large = {}, {}, {}, [], []
    for k, (n, wins, edges, levels) in enumerate(found):
        if not n:
            continue
        share = min(max(wins / n, 1e-15), 1 - 1e-15)
        bases[k] = math.log(share / (1 - share))
        sizes[k] = [len(v) + 1 for v in levels] + [len(e) + 1 for e in edges]
        whole = n <= WHOLE_ROWS and whole_bytes(n, sizes[k], growth) <= WHOLE_BYTES
        deals[k], partitions = ([], 1) if whole else _deals(jobs[k][1], [f"idx__{c}" for c in categorical], sizes[k], n)
        part = _blocks(jobs[k][1], k, bases[k], label, categorical, numeric, edges, sizes[k], deals[k], partitions, not whole)
        (small if whole else large).append((k, part))
    trees: dict[int, list[Tree]] = {}
    for blocks, way in ((small, grow_in_tasks), (large, grow)):
        if blocks:
            own = [{k: of[k] for k, _ in blocks} for of in (bases, sizes, deals)]
            rows = reduce(DataFrame.unionByName, [part for _, part in blocks])
            trees |= way(rows, own[0], own[1], len(categorical), growth, *([own[2]] if way is grow else []))
    return [LeafwiseTreesModel(spec=json.dumps({
        "base": bases.get(k, 0.0), "trees": [_described(t, feats, levels, edges) for t in trees.get(k, [])]}))
        for k, ((feats, _), (_, _, edges, levels)) in enumerate(zip(jobs, found))]


def _described(tree: Tree, feats, levels: list[list[str]], edges: list[list[float]]) -> dict:
    """A tree in terms of columns and feature names, ready for JSON."""
    n_cat, nodes = len(feats.categorical), {}
    for at, (feature, bin_) in tree.splits.items():
        if feature < n_cat:
            column, level = feats.categorical[feature], levels[feature][bin_]
            nodes[at] = {"column": f"imp__{column}", "level": level, "name": f"cat__{column}_{level}"}
        else:
            column = feats.numeric[feature - n_cat]
            nodes[at] = {"column": f"num__{column}", "threshold": edges[feature - n_cat][bin_], "name": f"num__{column}"}
        nodes[at]["cover"] = tree.covers[at]
    for at, value in tree.values.items():
        nodes[at] = {"value": value, "cover": tree.covers[at]}
    return {str(k): v for k, v in sorted(nodes.items())}


def goes_left_by(values, node: dict) -> np.ndarray:
    """Which of a batch's values of the node's column go left; missing ones go right."""
    if "level" in node:
        return (values == node["level"]).to_numpy(dtype=bool, na_value=False)
    return values.to_numpy(dtype=np.float64, na_value=np.nan) <= node["threshold"]


def _margin(trees: list[dict], columns: dict) -> np.ndarray:
    """Sum of the trees' values over a batch of columns; each different test is made once."""
    tests: dict[tuple, np.ndarray] = {}
    total = np.zeros(len(next(iter(columns.values()))))

    def walk(nodes: dict, at: int, rows: np.ndarray) -> None:
        node = nodes[str(at)]
        if "value" in node:
            total[rows] += node["value"]
        elif len(rows):
            key = node["column"], node.get("level"), node.get("threshold")
            if key not in tests:
                tests[key] = goes_left_by(columns[node["column"]], node)
            left = tests[key][rows]
            walk(nodes, 2 * at, rows[left])
            walk(nodes, 2 * at + 1, rows[~left])

    for nodes in trees:
        walk(nodes, _ROOT, np.arange(len(total)))
    return total


class LeafwiseTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (vector of P(0), P(1)); saved and loaded as a stage of a ``PipelineModel``."""

    spec = Param(Params._dummy(), "spec", "base margin and trees as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, spec: str = '{"base": 0.0, "trees": []}'):
        super().__init__()
        self._set(spec=spec)

    @property
    def base(self) -> float:
        return json.loads(self.getOrDefault(self.spec))["base"]

    @property
    def trees(self) -> list[dict]:
        return json.loads(self.getOrDefault(self.spec))["trees"]

    def margin(self):
        """Log-odds of each row: one Arrow pass over the columns that the trees test."""
        trees, base = self.trees, self.base
        names = sorted({n["column"] for t in trees for n in t.values() if "column" in n})
        constant = sum(t[str(_ROOT)].get("value", 0.0) for t in trees)
        if not names:
            return F.lit(base + constant)

        def margin(*columns: pd.Series) -> pd.Series:
            return pd.Series(base + _margin(trees, dict(zip(names, columns))))

        return F.pandas_udf(margin, "double")(*names)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        p = 1.0 / (1.0 + F.exp(-F.col("_margin")))
        return (dataset.withColumn("_margin", self.margin())
                .withColumn("probability", array_to_vector(F.array(1.0 - p, p))).drop("_margin"))
