"""Gradient-boosted classifiers for searches over many settings and folds, and
for serving the winner (E16-E21, S9, V1).

A search needs dozens of boosted models over one table; fitted one by one with
distributed trees, each costs rounds x depth small jobs.  Every model trains on all
of its training rows.  Rows of equal bin numbers are one distinct row with a count
and a label sum per stretch of the time order, which changes no sum.  Up to ``HELD``
distinct rows go to every task and each model is one task of one job; more stay in
blocks, and all models grow in step, one job per level whose sums of gradients per
node and bin do not depend on the rows.

* Trees grow by second-order gain on the log loss over at most ``BINS`` quantile
  bins per number; a category is tested against all others (one-hot columns
  without their width).  Boosting adds trees one by one, so models that differ in
  their number of rounds only are prefixes of one fit.
* Scores come from bin numbers: a row is coded once for all models, and a tree is
  a table per feature from the bin number to the leaves that it leaves open, a bit
  per leaf; the one bit that all features leave is the row's leaf (``Leaves``).
  AUCs come from scores packed per block of rows and range of scores, so what is
  shuffled is a few bytes per score (``aucs``).
* ``BoostedTrees`` is a Spark ML model: it reads the raw columns, scores Arrow
  batches with numpy, and is saved and loaded like any other stage, so the
  learner that a search ranks is the one that is served.
"""

from __future__ import annotations

import base64
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosewise.session import ensure_checkpoint_dir, ship_package, stored

HELD = 1 << 19          # distinct training rows that a task holds, at most
KEEP = 40               # trees between two checkpoints of the margins
FEW, MANY = 1 << 15, 1 << 19   # distinct rows of a task: at least, and at most once all cores are busy
PART = 1 << 15          # distinct rows of a block
DIRECT = 16             # tasks whose sums meet in the driver
BINS = 64
RIDGE, LEAST_HESSIAN, LEAST_GAIN = 1.0, 1.0, 1e-6
CHUNK = 1 << 13         # rows scored at once, so that they stay in the processor's cache
BLOCK = 1 << 17         # rows whose scores are packed together
RANGE = 1 << 18         # scores of one range, about


@dataclass(frozen=True)
class Fit:
    """One model: trained on rows with row_idx < ``until``, read after each of
    ``stages`` rounds."""
    name: str
    depth: int
    step: float
    stages: tuple[int, ...]
    until: int


@dataclass
class Trees:
    """A fitted model.  A tree is a heap of nodes: ``feature`` (-1: leaf) and
    ``threshold`` (greater goes right; the last feature is the category's number,
    equal goes right), ``value`` the margin that a row at the node gets."""
    numeric: list[str]
    categorical: str | None
    categories: list
    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def matrix(self, pdf: pd.DataFrame) -> np.ndarray:
        """The features of rows; missing numbers count as the greatest."""
        out = np.empty((len(pdf), len(self.numeric) + 1))
        for j, c in enumerate(self.numeric):
            out[:, j] = pdf[c].astype(float)
        out[np.isnan(out)] = np.inf
        number = {v: k for k, v in enumerate(self.categories)}
        out[:, -1] = pdf[self.categorical].map(number).fillna(-1) if self.categorical else -1
        return out

    def margins(self, x: np.ndarray, stages: list[int]):
        """The log-odds after each of ``stages`` (ascending) rounds."""
        bins = Binned([self])
        yield from Leaves(self, bins).margins(bins.codes(x), stages)

    def first(self, rounds: int) -> Trees:
        return Trees(self.numeric, self.categorical, self.categories, self.start, self.feature[:rounds],
                     self.threshold[:rounds], self.value[:rounds])

    def to_json(self) -> str:
        def text(a):
            return [base64.b64encode(np.ascontiguousarray(a).tobytes()).decode(), str(a.dtype), list(a.shape)]
        return json.dumps({**{k: getattr(self, k) for k in ("numeric", "categorical", "categories", "start")},
                           **{k: text(getattr(self, k)) for k in ("feature", "threshold", "value")}})

    @staticmethod
    def from_json(s: str) -> Trees:
        d = json.loads(s)
        for k in ("feature", "threshold", "value"):
            data, kind, shape = d[k]
            d[k] = np.frombuffer(base64.b64decode(data), kind).reshape(shape)
        return Trees(**d)


class Binned:
    """Bin numbers for the trees of several models on the same columns: a number's
    bin is how many of their thresholds lie below it, a category's its number + 1."""

    def __init__(self, models: list[Trees]):
        last = len(models[0].numeric)
        self.edges = [np.unique(np.concatenate([m.threshold[m.feature == j] for m in models])) for j in range(last)]
        self.width = [len(e) + 1 for e in self.edges] + [max(len(m.categories) for m in models) + 2]
        self.groups = _groups(self.width)
        self.shapes = [tuple(self.width[j] for j in g) for g in self.groups]

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)] + [x[:, -1].astype(np.int64) + 1]

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(group of features, row): the bin numbers of a group as one."""
        bins = self.bins(x)
        out = np.empty((len(self.groups), len(x)), np.int64)
        for k, (group, shape) in enumerate(zip(self.groups, self.shapes)):
            out[k] = np.ravel_multi_index([bins[j] for j in group], shape)
        return out


class Leaves:
    """The trees of a model as tables: per tree, group of features and bin number
    the leaves that remain, a bit each.  Trees of up to 6 levels fit a word; several
    small ones share one."""

    def __init__(self, m: Trees, bins: Binned):
        self.start, rounds = m.start, len(m.feature)
        self.depth = depth = int(np.log2(m.feature.shape[1] + 1)) - 1
        if depth > 6:
            raise ValueError("trees of more than 6 levels have more leaves than a word has bits")
        self.bits = max(8, 1 << depth)
        kind = np.dtype(f"u{self.bits // 8}")
        feature, value, last = m.feature, m.value.astype(float), len(m.numeric)
        tables = [np.full((rounds, w), (1 << (1 << depth)) - 1, kind) for w in bins.width]
        for level in range(depth):
            size = 1 << (depth - level)                              # leaves below a node
            for i in range(1 << level):
                node = (1 << level) - 1 + i
                right = ((1 << (size // 2)) - 1) << (i * size + size // 2)
                left = ((1 << (size // 2)) - 1) << (i * size)
                every = (1 << self.bits) - 1
                stop = np.flatnonzero(feature[:, node] < 0)          # a leaf: its leftmost place below stands for it
                value[stop, 2 * node + 1] = value[stop, node]
                tables[last][stop] &= kind.type(every & ~right)
                for j in np.unique(feature[:, node]):
                    if j < 0:
                        continue
                    t = np.flatnonzero(feature[:, node] == j)
                    at, n = m.threshold[t, node][:, None], np.arange(bins.width[j])
                    goes = n == at + 1 if j == last else n > np.searchsorted(bins.edges[j], at)
                    tables[j][t] &= np.where(goes, kind.type(every & ~left), kind.type(every & ~right))
        self.value = value[:, (1 << depth) - 1:]
        self.pack = 64 // self.bits
        self.tables = []
        for group, shape in zip(bins.groups, bins.shapes):
            cells = np.unravel_index(np.arange(int(np.prod(shape))), shape)
            table = np.full((-(-rounds // self.pack) * self.pack, len(cells[0])), 1, kind)
            table[:rounds] = np.bitwise_and.reduce([tables[j][:, c] for j, c in zip(group, cells)])
            # (word, cell): the trees of a word beside each other
            whole = np.ascontiguousarray(table.reshape(-1, self.pack, table.shape[1]).transpose(0, 2, 1))
            self.tables.append(whole.view(np.uint64)[:, :, 0])

    def margins(self, codes: np.ndarray, stages: list[int]):
        out = np.empty((len(stages), codes.shape[1]))
        for at in range(0, codes.shape[1], CHUNK):
            self._chunk(np.ascontiguousarray(codes[:, at:at + CHUNK]), stages, out[:, at:at + CHUNK])
        yield from out

    def _chunk(self, codes: np.ndarray, stages: list[int], out: np.ndarray) -> None:
        n, leaves = codes.shape[1], 1 << self.depth
        margin, word, more = np.full(n, self.start), np.empty(n, np.uint64), np.empty(n, np.uint64)
        wide = self.bits > 16
        # a leaf's value is found by its bit, or by the exponent of its bit as a float
        place = np.arange(leaves) + 1023 if wide else 1 << np.arange(leaves)
        held, add = np.zeros(2048 if wide else 1 << self.bits), np.empty(n)
        done = 0
        for s, stage in enumerate(stages):
            for t in range(done, min(stage, len(self.value))):
                if t % self.pack == 0 or t == done:
                    np.take(self.tables[0][t // self.pack], codes[0], out=word, mode="clip")
                    for table, code in zip(self.tables[1:], codes[1:]):
                        np.take(table[t // self.pack], code, out=more, mode="clip")
                        np.bitwise_and(word, more, out=word)
                    each = word.view(f"u{self.bits // 8}").reshape(n, self.pack)
                held[place] = self.value[t]
                leaf = each[:, t % self.pack]
                if wide:
                    leaf = leaf.astype(float).view(np.int64) >> 52
                np.take(held, leaf, out=add, mode="clip")
                margin += add
            done = max(done, min(stage, len(self.value)))
            out[s] = margin


def best_splits(grad: np.ndarray, hess: np.ndarray, one_against_rest: bool):
    """Per node the best split of a feature's bins (node, bin): (gain, bin,
    gradient and Hessian sums of the left side).  Numbers are cut after a bin;
    of a category one value goes right."""
    g, h = grad.sum(1, keepdims=True), hess.sum(1, keepdims=True)
    if one_against_rest:
        left_g, left_h = g - grad, h - hess
    else:
        left_g, left_h = grad.cumsum(1), hess.cumsum(1)
    right_g, right_h = g - left_g, h - left_h
    gain = left_g ** 2 / (left_h + RIDGE) + right_g ** 2 / (right_h + RIDGE) - g ** 2 / (h + RIDGE)
    gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = -1.0
    at = gain.argmax(1)
    rows = np.arange(len(gain))
    return gain[rows, at], at, left_g[rows, at], left_h[rows, at]


def _groups(width: list[int], most: int = 512) -> list[list[int]]:
    """Features counted together: small ones share one table of all their
    combinations, whose margins are their own counts."""
    out: list[list[int]] = []
    for j in sorted(range(len(width)), key=lambda j: width[j]):
        if out and np.prod([width[i] for i in out[-1]]) * width[j] <= most:
            out[-1].append(j)
        else:
            out.append([j])
    return out


class Cells:
    """The groups of features that are counted together, and the bin number of each
    of their features in every cell of a group's table."""

    def __init__(self, width: list[int]):
        self.width, self.groups = width, _groups(width)
        self.shapes = [tuple(width[j] for j in group) for group in self.groups]
        self.sizes = [math.prod(shape) for shape in self.shapes]
        self.bins = [np.unravel_index(np.arange(size), shape) for size, shape in zip(self.sizes, self.shapes)]

    def codes(self, x: np.ndarray) -> list[np.ndarray]:
        """Per group the cell of every row of bins (row, feature)."""
        return [np.ravel_multi_index([x[:, j].astype(np.int64) for j in group], shape)
                for group, shape in zip(self.groups, self.shapes)]

    def places(self, feature: np.ndarray, cut: np.ndarray, level: int, leaves: bool) -> list[np.ndarray]:
        """Per group and cell the places of a tree's ``level`` that are left open, a
        bit each.  A row in a leaf above has none, with ``leaves`` the leftmost below."""
        last = len(self.width) - 1
        word = np.uint64
        left_open = [np.full(w, (1 << (1 << level)) - 1, word) for w in self.width]
        for up in range(level):
            half = 1 << (level - up - 1)
            for i in range(1 << up):
                j, b = int(feature[(1 << up) - 1 + i]), int(cut[(1 << up) - 1 + i])
                left = ((1 << half) - 1) << (2 * half * i)
                right, every = left << half, (1 << 64) - 1
                if j < 0:
                    left_open[last] &= word(every & ~(right if leaves else left | right))
                else:
                    n = np.arange(self.width[j])
                    left_open[j] &= np.where(n == b if j == last else n > b, word(every & ~left), word(every & ~right))
        return [np.bitwise_and.reduce([left_open[j][c] for j, c in zip(group, bins)]) for group, bins in zip(self.groups, self.bins)]


def _open_places(tables: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """The bit of every row's place: the one that all groups leave open."""
    word = tables[0][codes[0]]
    for table, code in zip(tables[1:], codes[1:]):
        word &= table[code]
    return word


def _place(word: np.ndarray) -> np.ndarray:
    """The number of the one bit that is set: the exponent of the word as a float."""
    return (word.astype(float).view(np.int64) >> 52) - 1023


class Growth:
    """The trees of one model, grown level by level from sums of gradients and
    Hessians: ``feature``, ``cut`` (a bin) and ``value`` per tree and node."""

    def __init__(self, fit: Fit, cells: Cells, share: float):
        self.fit, self.cells = fit, cells
        share = np.clip(share, 1e-6, 1 - 1e-6)
        self.start = float(np.log(share / (1 - share)))
        size, rounds = (1 << (fit.depth + 1)) - 1, max(fit.stages)
        self.feature = np.full((rounds, size), -1, np.int16)
        self.cut = np.zeros((rounds, size), np.int32)
        self.value = np.zeros((rounds, size), np.float32)

    def begin(self, t: int) -> None:
        self.t, self.level, self.open = t, 0, True
        self.alive, self.above = np.ones(1, bool), [None] * len(self.cells.groups)

    def counted(self) -> int:
        """Nodes that are counted: the root, then the left children."""
        return max(1, (1 << self.level) // 2)

    def split(self, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Take the level's sums, per group (gradient and Hessian; counted node;
        cell); (feature or -1, bin) of every node.  A right child is its parent less
        the left one."""
        fit, t, nodes, base = self.fit, self.t, 1 << self.level, (1 << self.level) - 1
        width, last = self.cells.width, len(self.cells.width) - 1
        best = np.full(nodes, LEAST_GAIN)
        at_f, at_b = np.full(nodes, -1), np.zeros(nodes, np.int64)
        sums = np.zeros((4, nodes))
        if self.level == 0:
            g, h = tables[0].sum(axis=(1, 2))
            self.value[t, 0] = fit.step * g / (h + RIDGE)
        for k, (group, shape) in enumerate(zip(self.cells.groups, self.cells.shapes)):
            table = tables[k]
            if self.level:
                table = np.stack([table, self.above[k] - table], axis=2).reshape(2, nodes, -1)
            self.above[k] = table
            whole = table.reshape(2, nodes, *shape)
            for i, j in enumerate(group):
                if width[j] < 2:
                    continue
                gj, hj = whole.sum(axis=tuple(2 + o for o in range(len(group)) if o != i))
                gain, b, lg, lh = best_splits(gj, hj, j == last)
                better = self.alive & (gain > best)
                best[better], at_f[better], at_b[better] = gain[better], j, b[better]
                sums[:, better] = np.stack([lg, lh, gj.sum(1) - lg, hj.sum(1) - lh])[:, better]
        split = np.flatnonzero(at_f >= 0)
        node = base + split
        self.feature[t, node], self.cut[t, node] = at_f[split], at_b[split]
        self.value[t, 2 * node + 1] = fit.step * sums[0, split] / (sums[1, split] + RIDGE)
        self.value[t, 2 * node + 2] = fit.step * sums[2, split] / (sums[3, split] + RIDGE)
        self.alive = np.repeat(at_f >= 0, 2)
        self.level += 1
        self.open = len(split) > 0 and self.level < fit.depth
        return at_f, at_b


def _sums(at, codes, weights, counted: int, sizes: list[int]) -> list[np.ndarray]:
    """Per group the weights' sums (weight; counted node; cell)."""
    out = []
    for size, code in zip(sizes, codes):
        cell = at * size + code
        out.append(np.stack([np.bincount(cell, w, counted * size).reshape(counted, size) for w in weights]))
    return out


def grow(x: np.ndarray, width: list[int], y: np.ndarray, fit: Fit,
         count: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(start, feature, bin, value) of the trees of one model.  ``x``: bins
    (row, feature), the last feature a category's number; ``width``: bins of
    each feature; ``y``: labels, with ``count`` the label sums of so many equal rows
    each.  Below the root only left children are counted."""
    n, last = len(y), x.shape[1] - 1
    count = np.ones(n) if count is None else count
    cells = Cells(width)
    codes, rows = cells.codes(x), np.arange(n)
    growth = Growth(fit, cells, y.sum() / count.sum() if n else 0.5)
    margin = np.full(n, growth.start)
    for t in range(max(fit.stages)):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - count * p, count * (p * (1 - p))
        heap = np.zeros(n, np.int64)              # node of each row
        place = np.zeros(n, np.int64)             # its place in the level; -1 once it is in a leaf
        growth.begin(t)
        while growth.open:
            left = np.flatnonzero((place >= 0) & (place & 1 == 0)) if growth.level else slice(None)
            at = place[left] >> (growth.level > 0)
            at_f, at_b = growth.split(_sums(at, [c[left] for c in codes], (g[left], h[left]), growth.counted(), cells.sizes))
            f, b = np.append(at_f, -1)[place], np.append(at_b, 0)[place]
            v = x[rows, f]
            right = np.where(f == last, v == b, v > b)
            goes = f >= 0
            heap = np.where(goes, 2 * heap + 1 + right, heap)
            place = np.where(goes, 2 * place + right, -1)
        margin = margin + growth.value[t][heap]
    return growth.start, growth.feature, growth.cut, growth.value


# --- distinct rows ------------------------------------------------------------------

def _words(sizes: list[int]) -> list[list[int]]:
    """Positions of the numbers below ``sizes`` that share a 64-bit word."""
    out, room = [], 0
    for k, size in enumerate(sizes):
        if not out or room * size >= 1 << 62:
            out.append([])
            room = 1
        out[-1].append(k)
        room *= size
    return out


def to_words(codes, sizes: list[int]) -> list[np.ndarray]:
    """Numbers (position, row) as few words per row."""
    return [reduce(lambda w, k: w * sizes[k] + codes[k], group, np.zeros(len(codes[0]), np.int64)) for group in _words(sizes)]


def from_words(words: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    out = np.empty((len(sizes), len(words[0])), np.int16 if max(sizes) <= 1 << 15 else np.int32)
    for group, w in zip(_words(sizes), words):
        for k in reversed(group):
            w, out[k] = np.divmod(w, sizes[k])
    return out


def distinct_rows(rows: DataFrame, code, columns: list[str], sizes: list[int], parts: int) -> DataFrame:
    """Equal rows as one: (w0, w1, .. their numbers as words; n0, y0, n1, y1, .. how
    many of them lie in each of ``parts`` parts, and their labels' sum).  ``code``
    turns a batch of ``columns`` into (numbers (position, row), part, label)."""
    names = [f"w{i}" for i in range(len(_words(sizes)))]

    def run(batches):
        for b in batches:
            if len(b):
                codes, part, y = code(b)
                yield pa.record_batch([*map(pa.array, to_words(codes, sizes)), pa.array(part, pa.int32()), pa.array(y, pa.float64())],
                                      names=[*names, "part", "y"])

    ship_package(rows.sparkSession)
    coded = rows.select(*columns).mapInArrow(run, ", ".join(f"{w} long" for w in names) + ", part int, y double")
    sums = []
    for i in range(parts):
        here = F.col("part") == i
        sums += [F.count(F.when(here, 1)).alias(f"n{i}"), F.sum(F.when(here, F.col("y")).otherwise(0.0)).alias(f"y{i}")]
    return stored(coded.groupBy(*names).agg(*sums), "distinct-rows")


def until_each(columns, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts, label sums), each (part, row): those of the part and all before it."""
    return tuple(np.cumsum([np.asarray(columns[f"{c}{i}"], float) for i in range(parts)], axis=0) for c in "ny")


def added(sums, branches: int) -> list[np.ndarray]:
    """The tasks' sums added up: by the driver those of few tasks, else in a tree."""
    def plus(a, b):
        return list(map(add, a, b))

    return reduce(plus, sums.collect()) if sums.getNumPartitions() <= DIRECT else sums.treeReduce(plus, branches)


def _blocks(batches, width: list[int], parts: int):
    """Distinct rows in blocks of about ``PART``: (cells per group; per part how many
    rows occur in it or before; counts; label sums), rows that occur early first."""
    cells = Cells(width)
    kind = np.int16 if max(cells.sizes) <= 1 << 15 else np.int32

    def block(held):
        t = {c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in held[0].schema.names}
        n, y = until_each(t, parts)
        order = np.argsort((n == 0).sum(axis=0), kind="stable")
        n, y = n[:, order], y[:, order]
        x = from_words([t[f"w{i}"][order] for i in range(len(_words(width)))], width).T
        codes = np.stack(cells.codes(x)).astype(kind)
        small = [a.astype(np.int32) if (a == a.astype(np.int32)).all() else a for a in (n, y)]
        return codes, (n > 0).sum(axis=1), *small

    held, size = [], 0
    for b in batches:
        if len(b):
            held.append(b)
            size += len(b)
        if size >= PART:
            yield block(held)
            held, size = [], 0
    if size:
        yield block(held)


def grow_in_step(distinct: DataFrame, n: int, fits: list[Fit], width: list[int], untils: list[int]) -> dict[str, Growth]:
    """All fits over ``n`` distinct rows that stay in blocks: per level of a round one
    job adds up the sums of every model."""
    spark = distinct.sparkSession
    ensure_checkpoint_dir(spark)
    parts, cells, sc = len(untils), Cells(width), spark.sparkContext
    tasks = max(min(sc.defaultParallelism, math.ceil(n / FEW)), math.ceil(n / MANY))
    branches = max(2, math.ceil(math.log(max(2, tasks), 8)))

    def pack(batches):
        for codes, ends, count, label in _blocks(batches, width, parts):
            yield pa.record_batch([pa.array([a.tobytes()], pa.binary()) for a in (codes, ends, count, label)] + [
                pa.array([" ".join(a.dtype.str for a in (codes, ends, count, label))])],
                names=["codes", "ends", "n", "y", "kinds"])

    first = distinct.agg(*[F.sum(f"{c}{i}").alias(f"{c}{i}") for i in range(parts) for c in "ny"]).toPandas()
    total, label = (a[:, 0] for a in until_each(first.fillna(0), parts))
    growths = {f.name: Growth(f, cells, label[i] / total[i] if total[i] else 0.5) for f in fits for i in [untils.index(f.until)]}
    part = {f.name: untils.index(f.until) for f in fits}
    starts = {k: g.start for k, g in growths.items()}

    def parse(r):
        codes, ends, count, label = (np.frombuffer(b, k) for b, k in zip((r.codes, r.ends, r.n, r.y), r.kinds.split()))
        codes, count, label = (a.reshape(-1, ends[-1]) for a in (codes, count, label))
        return codes, ends, count, label, {k: np.full(ends[part[k]], s, np.float32) for k, s in starts.items()}

    packed = distinct.repartition(tasks).mapInArrow(pack, "codes binary, ends binary, n binary, y binary, kinds string")
    state = stored(packed, "boost-blocks").rdd.coalesce(tasks).map(parse).persist(StorageLevel.MEMORY_AND_DISK)
    before = None
    for t in range(max(max(f.stages) for f in fits)):
        now = [g for g in growths.values() if t < max(g.fit.stages)]
        for g in now:
            g.begin(t)
        while some := [g for g in now if g.open]:
            work = [(g.fit.name, g.counted(), cells.places(g.feature[t], g.cut[t], g.level, False) if g.level else None) for g in some]
            flat, = added(state.mapPartitions(lambda blocks, work=work: _level_sums(blocks, work, part, cells.sizes)), branches)
            at = 0
            for g in some:
                tables = []
                for size in cells.sizes:
                    tables.append(flat[at:at + 2 * g.counted() * size].reshape(2, g.counted(), size))
                    at += tables[-1].size
                g.split(tables)
        if before is not None:
            before.unpersist()     # the first sums of this round have written the new margins
        more = {g.fit.name: _leaves(g, t) for g in now if t + 1 < max(g.fit.stages)}
        if more:
            before, state = state, state.map(lambda b, more=more: _after(b, more))
            state.persist(StorageLevel.MEMORY_AND_DISK)
            if (t + 1) % KEEP == 0:
                state.checkpoint()
    state.unpersist()
    if before is not None:
        before.unpersist()
    return growths


def _level_sums(blocks, work, part: dict[str, int], sizes: list[int]):
    """One array: the sums of the blocks for every model in ``work``, (name, counted
    nodes, places), on end."""
    out = None
    for codes, ends, count, label, margins in blocks:
        found = []
        for name, counted, places in work:
            i = part[name]
            rows = ends[i]
            p = 1 / (1 + np.exp(-margins[name]))
            mine, n, y = codes[:, :rows], count[i, :rows], label[i, :rows]
            at = 0
            if places is not None:
                word = _open_places(places, mine)
                left = np.flatnonzero(word & np.uint64(0x5555555555555555))
                at = _place(word[left]) >> 1
                mine, n, y, p = mine[:, left], n[left], y[left], p[left]
            np_ = n * p.astype(float)
            found += [a.ravel() for a in _sums(at, mine, (y - np_, np_ * (1 - p)), counted, sizes)]
        found = np.concatenate(found)
        out = found if out is None else out + found
    return [] if out is None else [[out]]


def _leaves(g: Growth, t: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(places of the last level, the value at each) of a grown tree."""
    depth, value = g.fit.depth, g.value[t].copy()
    for node in range((1 << depth) - 1):
        if g.feature[t, node] < 0:       # a leaf: the leftmost place below stands for it
            value[2 * node + 1] = value[node]
    return g.cells.places(g.feature[t], g.cut[t], depth, True), value[(1 << depth) - 1:]


def _after(block, more: dict):
    """The block with a round's trees added to its margins."""
    codes, ends, count, label, margins = block
    new = {}
    for name, margin in margins.items():
        if name in more:
            places, value = more[name]
            new[name] = margin + value[_place(_open_places(places, codes[:, :len(margin)]))]
    return codes, ends, count, label, new


def first_by_hash(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows with the least hashes of ``row_idx``.  Of a larger table
    only rows below a hash that somewhat more than ``most`` rows stay under are
    sorted, so no task gets ``most`` rows from every partition."""
    n, h = rows.count(), F.xxhash64("row_idx")
    share = (1.1 * most + 1000) / max(n, 1)
    if share < 1:
        below = rows.where(h < F.lit(int(share * (1 << 64)) - (1 << 63)))
        if below.count() >= most:
            rows = below
    return rows.orderBy(h, "row_idx").limit(most)


def train(indexed: DataFrame, fits: list[Fit], numeric: list[str], categorical: str | None, label: str,
          held: int = HELD) -> dict[str, Trees]:
    """All fits over a table with the time index ``row_idx``, each on all of its rows.

    Rows without a label are not trained on.  What reaches the driver and every
    task is bounded: up to ``held`` distinct rows, or else a level's sums, and the bin
    edges, the categories and the trees.
    """
    spark = indexed.sparkSession
    untils = sorted({f.until for f in fits})
    rows = indexed.where(F.col(label).isNotNull() & (F.col("row_idx") < untils[-1]))
    edges = [np.unique(c) for c in rows.approxQuantile(numeric, [k / BINS for k in range(1, BINS)], 0.001)]
    cats = sorted(r[0] for r in rows.where(F.col(categorical).isNotNull()).select(categorical).distinct().collect()) if categorical else []
    number = {v: k for k, v in enumerate(cats)}
    width = [len(e) + 1 for e in edges] + [len(cats) + 1 if categorical else 1]
    last = np.array(untils[:-1], np.int64)

    def code(b):
        codes = [np.searchsorted(e, b.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False), side="left")
                 for c, e in zip(numeric, edges)]
        if categorical:
            d = b.column(categorical).dictionary_encode()
            known = np.array([number.get(v, len(cats)) for v in d.dictionary.to_pylist()] + [len(cats)], np.int64)
            codes.append(known[d.indices.fill_null(len(known) - 1).to_numpy(zero_copy_only=False)])
        else:
            codes.append(np.zeros(len(b), np.int64))
        part = np.searchsorted(last, b.column("row_idx").to_numpy(zero_copy_only=False), side="right")
        return codes, part, b.column(label).cast(pa.float64()).to_numpy(zero_copy_only=False)

    distinct = distinct_rows(rows, code, ["row_idx", label, *numeric, *([categorical] if categorical else [])], width, len(untils))
    thresholds = [np.append(e, np.inf) for e in edges] + [np.arange(len(cats) + 1, dtype=float)]

    def trees(start, feature, cut, value) -> Trees:
        real = np.zeros(cut.shape)
        for j, t in enumerate(thresholds):
            real[feature == j] = t[cut[feature == j]]
        return Trees(numeric, categorical, cats, start, feature, real, value)

    n = distinct.count()
    if n > held:
        return {k: trees(g.start, g.feature, g.cut, g.value) for k, g in grow_in_step(distinct, n, fits, width, untils).items()}
    pdf = distinct.toPandas()
    pdf = pdf.sort_values([c for c in pdf if c[0] == "w"], ignore_index=True)     # the same sums in every run
    x = from_words([pdf[f"w{i}"].to_numpy() for i in range(len(_words(width)))], width).T
    shared = spark.sparkContext.broadcast((x, *until_each(pdf, len(untils))))
    by_name = {f.name: f for f in fits}

    def run(batches):
        x, count, y = shared.value
        for b in batches:
            for name in b["name"]:
                i = untils.index(by_name[name].until)
                mine = count[i] > 0
                model = trees(*grow(x[mine], width, y[i, mine], by_name[name], count[i, mine]))
                yield pd.DataFrame({"name": [name], "trees": [model.to_json()]})

    heavy = sorted(fits, key=lambda f: -f.until * f.depth * max(f.stages))     # the longest first
    names = spark.createDataFrame([(k, f.name) for k, f in enumerate(heavy)], "k int, name string")
    out = names.repartitionByRange(len(fits), "k").select("name").mapInPandas(run, "name string, trees string").collect()
    return {r.name: Trees.from_json(r.trees) for r in out}


def score_ranges(rows: DataFrame, models: dict[str, Trees], blocks: dict[str, tuple[int, int]],
                 stages: dict[str, tuple[int, ...]], total: int) -> dict[tuple[str, int], np.ndarray]:
    """Per (model, rounds) the bounds of score ranges of about ``RANGE`` rows, from
    a sample of bounded size.  They deal the work and change no result."""
    folds = len(set(blocks.values()))
    if total <= RANGE:
        return {(k, s): np.zeros(0) for k in models for s in stages[k]}
    pdf = rows.sample(False, min(1.0, folds * (1 << 13) / total), 42).toPandas()
    first = next(iter(models.values()))
    bins = Binned(list(models.values()))
    codes, idx, out = bins.codes(first.matrix(pdf)), pdf["row_idx"].to_numpy(np.int64), {}
    for name, m in models.items():
        lo, hi = blocks[name]
        mine = np.flatnonzero((idx >= lo) & (idx < hi))
        parts = -(-total * len(mine) // (max(len(pdf), 1) * RANGE))
        for stage, margin in zip(stages[name], Leaves(m, bins).margins(codes[:, mine], list(stages[name]))):
            cut = np.quantile(1 / (1 + np.exp(-margin)), np.arange(1, parts) / parts) if parts > 1 else np.zeros(0)
            out[name, stage] = np.unique(cut)
    return out


def packed_scores(rows: DataFrame, models: dict[str, Trees], blocks: dict[str, tuple[int, int]], stages: dict[str, tuple[int, ...]],
                  bounds: dict[tuple[str, int], np.ndarray], label: str) -> DataFrame:
    """(model, rounds, part, body): every row of ``rows`` under every model whose
    block lo..hi holds it, after each of its stages.  ``body`` has the distinct
    scores of a block of rows in one range and their counts of labels 1 and not 1."""
    shared = rows.sparkSession.sparkContext.broadcast(({k: m.to_json() for k, m in models.items()}, bounds))

    def run(batches):
        texts, cuts = shared.value
        trees = {k: Trees.from_json(s) for k, s in texts.items()}
        bins, first = Binned(list(trees.values())), next(iter(trees.values()))
        leaves = {k: Leaves(m, bins) for k, m in trees.items()}

        def packed(pdf):
            codes, idx, one = bins.codes(first.matrix(pdf)), pdf["row_idx"].to_numpy(np.int64), pdf[label].to_numpy() == 1
            held, out = {}, []
            for name, m in leaves.items():
                if blocks[name] not in held:
                    lo, hi = blocks[name]
                    mine = np.flatnonzero((idx >= lo) & (idx < hi))
                    held[blocks[name]] = codes[:, mine], one[mine]
                mine, y = held[blocks[name]]
                if not len(y):
                    continue
                for stage, margin in zip(stages[name], m.margins(mine, list(stages[name]))):
                    score, where = np.unique(1 / (1 + np.exp(-margin)), return_inverse=True)
                    n = np.bincount(where, minlength=len(score))
                    pos = np.bincount(where, y, minlength=len(score))
                    table = np.stack([score, pos, n - pos], 1)
                    at = np.r_[0, np.searchsorted(score, cuts[name, stage], side="right"), len(score)]
                    out += [(name, stage, part, table[a:b].tobytes()) for part, (a, b) in enumerate(zip(at[:-1], at[1:])) if b > a]
            return pd.DataFrame(out, columns=["model", "rounds", "part", "body"])

        held, n = [], 0
        for pdf in batches:
            held.append(pdf)
            n += len(pdf)
            if n >= BLOCK:
                yield packed(pd.concat(held, ignore_index=True))
                held, n = [], 0
        if n:
            yield packed(pd.concat(held, ignore_index=True))

    ship_package(rows.sparkSession)
    # scoring costs much more than moving a row: few rows are spread over all cores
    tasks = max(rows.rdd.getNumPartitions(), 2 * rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks).mapInPandas(run, "model string, rounds int, part int, body binary")


def range_sums(packed: DataFrame) -> DataFrame:
    """(model, rounds, part, n_pos, n_neg, twice): rows of a range, and twice its
    pairs of a label 1 with a lower other label, ties counted half."""

    def run(pdf):
        score, pos, neg = np.concatenate([np.frombuffer(b).reshape(-1, 3) for b in pdf["body"]]).T
        order = np.argsort(score, kind="stable")
        heads = np.flatnonzero(np.r_[True, np.diff(score[order]) > 0])
        pos, neg = (np.add.reduceat(c[order].astype(np.int64), heads) for c in (pos, neg))
        twice = int((pos * (2 * (np.cumsum(neg) - neg) + neg)).sum())
        return pd.DataFrame({**{c: pdf[c].iloc[:1].to_numpy() for c in ("model", "rounds", "part")},
                             "n_pos": [pos.sum()], "n_neg": [neg.sum()], "twice": [twice]})

    return packed.groupBy("model", "rounds", "part").applyInPandas(
        run, "model string, rounds int, part int, n_pos long, n_neg long, twice long")


def aucs(rows: DataFrame, models: dict[str, Trees], blocks: dict[str, tuple[int, int]], stages: dict[str, tuple[int, ...]],
         label: str) -> DataFrame:
    """(model, rounds, auc): the exact ROC-AUC, ties counted half, of every model
    over all rows of ``rows`` (with ``row_idx``) in its block lo..hi, after each of
    its stages; null for rows of one class."""
    first = next(iter(models.values()))
    cols = ["row_idx", label, *first.numeric, *([first.categorical] if first.categorical else [])]
    i = F.col("row_idx")
    held = F.lit(False)
    for lo, hi in sorted(set(blocks.values())):
        held = held | ((i >= lo) & (i < hi))
    rows = rows.where(F.col(label).isNotNull() & held).select(*cols)
    bounds = score_ranges(rows, models, blocks, stages, rows.count())
    per = stored(range_sums(packed_scores(rows, models, blocks, stages, bounds, label)), "range-sums")
    before = Window.partitionBy("model", "rounds").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pairs = F.col("twice") / F.lit(2.0) + F.col("n_pos") * F.coalesce(F.sum("n_neg").over(before), F.lit(0))
    return per.select("model", "rounds", "n_pos", "n_neg", pairs.alias("_u")).groupBy("model", "rounds").agg(
        F.try_divide(F.sum("_u"), F.sum("n_pos") * F.sum("n_neg")).alias("auc"))


class BoostedTrees(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees as a pipeline stage: adds ``probability`` (a vector of the
    two classes' probabilities) to rows that have the raw feature columns."""

    trees = Param(Params._dummy(), "trees", "the fitted trees as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, trees: str = ""):
        super().__init__()
        self._set(**self._input_kwargs)

    def fitted(self) -> Trees:
        return Trees.from_json(self.getOrDefault(self.trees))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        m = self.fitted()
        shared = dataset.sparkSession.sparkContext.broadcast(self.getOrDefault(self.trees))
        cols = [*m.numeric, *([m.categorical] if m.categorical else [])]

        @F.pandas_udf("double")
        def probability(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            t = Trees.from_json(shared.value)
            bins = Binned([t])
            leaves = Leaves(t, bins)
            for row in batches:
                margin, = leaves.margins(bins.codes(t.matrix(row)), [len(t.feature)])
                yield pd.Series(1 / (1 + np.exp(-margin)))

        ship_package(dataset.sparkSession)
        p = probability(F.struct(*[F.col(f"`{c}`") for c in cols]))
        return (dataset.withColumn("_p", p)
                .withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("_p"), F.col("_p")))).drop("_p"))
