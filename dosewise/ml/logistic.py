"""L2 logistic regressions on numeric columns and one category, fitted on all rows of a
large table (M1, M2).

Spark's fit makes a vector of every row several times and keeps those.  Here a row is
packed once into a few small numbers, for any number of fits; each value of the loss and
its gradient is one job over the packed rows, whose sums do not depend on the rows.

The fit takes the steps that Spark's takes (L-BFGS on standardised columns, the same
start, memory, line search and end) and so ends at its weights, also where the loss is
so flat that its tolerance leaves their last digits open.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.ml.gradient import added
from dosewise.session import ship_package


@dataclass
class Moments:
    """Rows, labels of 1, and per column (numeric, then category slots) mean and
    population deviation."""
    n: int
    ones: float
    mean: np.ndarray
    sd: np.ndarray

    @property
    def usable(self) -> bool:
        """Numbers in all columns and labels of both kinds."""
        return 0 < self.ones < self.n and bool(np.isfinite(self.mean).all() and np.isfinite(self.sd).all())


def moments(rows: DataFrame, numeric: list[str], code: str, label: str, slots: int) -> Moments:
    """Of the rows whose category has number ``code`` (``slots``: none of them).  A
    missing number or a label other than 0 and 1 leaves no usable moments."""
    y = F.col(label).cast("double")
    per = rows.groupBy(F.col(code).cast("int").alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(y.isin(0.0, 1.0), y).otherwise(math.nan)).alias("y"),
        *[F.avg(F.coalesce(F.col(c), F.lit(math.nan))).alias(f"m{j}") for j, c in enumerate(numeric)],
        *[F.var_pop(F.coalesce(F.col(c), F.lit(math.nan))).alias(f"v{j}") for j, c in enumerate(numeric)],
        *[f(c).alias(f"{a}{j}") for a, f in (("l", F.min), ("h", F.max)) for j, c in enumerate(numeric)]).collect()
    if not per:
        return Moments(0, 0.0, np.zeros(0), np.zeros(0))
    k, size = len(numeric), np.array([r.n for r in per], float)
    n, share = int(size.sum()), np.zeros(slots + 1)
    share[[r.c for r in per]] = size / n
    m, v, low, high = (np.array([[r[f"{a}{j}"] for j in range(k)] for r in per], float).reshape(-1, k) for a in "mvlh")
    mean = size @ m / n
    sd = np.sqrt(size @ (v + (m - mean) ** 2) / n)
    sd[low.min(axis=0) == high.max(axis=0)] = 0      # equal values, also if their means are rounded
    share = share[:slots]
    return Moments(n, sum(r.y for r in per), np.concatenate([mean, share]), np.concatenate([sd, np.sqrt(share * (1 - share))]))


def small(x: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds them exactly."""
    with np.errstate(invalid="ignore"):
        for t in (np.int8, np.int16, np.int32):
            if ((y := x.astype(t)) == x).all():
                return y
    return x


def blocks_of(rows: DataFrame, numeric: list[str], code: str, label: str):
    """The rows as an RDD of pickled blocks, ordered by category inside a block:
    (categories, first row of each, numeric columns, labels)."""
    def pack(batches):
        for b in batches:
            if len(b):
                x = [c.to_numpy(zero_copy_only=False) for c in b.columns]
                c = small(x[-2])
                order = np.argsort(c, kind="stable")
                slots, starts = np.unique(c[order], return_index=True)
                slots = slots.astype(int)
                block = slots, starts, [small(a[order].astype(float)) for a in x[:-2]], x[-1][order].astype(np.int8)
                yield pa.record_batch([pa.array([pickle.dumps(block, 5)], pa.binary())], names=["block"])

    return rows.select(*numeric, code, label).mapInArrow(pack, "block binary").rdd.map(lambda r: bytes(r.block))


def add_block(block, w: np.ndarray, u: np.ndarray, out: list[np.ndarray]) -> None:
    """Add a block's loss and its gradient in intercept, numeric columns and slots at the
    weights ``w`` (intercept, numeric columns) and ``u`` (slots; the last: no category)."""
    slots, starts, cols, y = block
    loss, g, gu = out
    x = np.ones((len(cols) + 1, len(y)))
    for j, col in enumerate(cols):
        x[j + 1] = col
    m = w @ x + np.repeat(u[slots], np.diff(starts, append=len(y)))
    e = np.exp(-np.abs(m))
    r = np.where(m >= 0, 1.0, e) / (1 + e) - y
    loss += (np.maximum(m, 0) + np.log1p(e)).sum() - m @ y
    g += x @ r
    gu[slots] += np.add.reduceat(r, starts)


@dataclass
class Packed:
    """The rows of a table, packed once for any number of fits."""
    at: Moments
    k: int
    blocks: RDD | None

    def release(self) -> None:
        if self.blocks is not None:
            self.blocks.unpersist()


def packed(rows: DataFrame, numeric: list[str], code: str, label: str, slots: int) -> Packed:
    """Moments of the rows and, if they are usable, the rows in the executors."""
    ship_package(rows.sparkSession)
    at = moments(rows, numeric, code, label, slots)
    return Packed(at, len(numeric), blocks_of(rows, numeric, code, label).persist(StorageLevel.MEMORY_AND_DISK) if at.usable else None)


def fit(rows: Packed, penalty: np.ndarray, most: int = 1000, tol: float = 1e-6) -> tuple[float, np.ndarray]:
    """The intercept and the weights (of the columns as they are) of the least mean loss
    plus half the squared weights times ``penalty`` (a factor per column) per row."""
    at, k, blocks = rows.at, rows.k, rows.blocks
    slots, free = len(at.mean) - k, at.sd > 0
    scale = np.divide(1.0, at.sd * math.sqrt(at.n / (at.n - 1)), out=np.zeros(k + slots), where=free)
    penalty = penalty * scale ** 2 / at.n
    branches = max(2, round(blocks.getNumPartitions() ** (1 / 3)))

    def loss(z):
        """Mean loss and gradient at the weights ``z`` of standardised columns, intercept last."""
        v = z[:-1] * scale
        w, u = np.concatenate([[z[-1] - v @ at.mean], v[:k]]), np.append(v[k:], 0.0)

        def sums(part):
            out = [np.zeros(1), np.zeros(k + 1), np.zeros(slots + 1)]
            for b in part:
                add_block(pickle.loads(b), w, u, out)
            return [out]

        value, g, gu = added(blocks.mapPartitions(sums), branches)
        g = np.append((np.concatenate([g[1:], gu[:-1]]) - at.mean * g[0]) * scale, g[0]) / at.n
        g[:-1] += penalty * z[:-1]
        return float(value[0]) / at.n + (penalty * z[:-1] ** 2).sum() / 2, g

    z = least(loss, np.append(np.zeros(k + slots), math.log(at.ones / (at.n - at.ones))), most, tol)
    v = z[:-1] * scale
    return float(z[-1] - v @ at.mean), v


def least(f, x: np.ndarray, most: int, tol: float, memory: int = 10) -> np.ndarray:
    """L-BFGS with strong Wolfe steps (Nocedal and Wright) from ``x``, ended as Spark's:
    by the gradient, the values of the last 20 steps, or two failed searches in turn."""
    value, g = f(x)
    first, values, past, failed = value, [math.inf], [], False
    for turn in range(most):
        if np.linalg.norm(g) <= max(tol * value, 1e-8) or abs(value - max(values)) <= tol * first:
            break
        d, kept = -g, []
        for s, y in reversed(past):
            kept.append((s @ d) / (s @ y))
            d = d - kept[-1] * y
        if past:
            d = d * ((past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]))
        for s, y in past:
            d = d + (kept.pop() - (y @ d) / (s @ y)) * s
        found = wolfe(f, x, d, value, g, 1.0 if turn else 1 / np.linalg.norm(d))
        if found is None or found[0] * np.linalg.norm(g) < 1e-10:
            if failed:
                break
            failed, past = True, []
            continue
        t, new, h = found
        past = [*past, (t * d, h - g)][-memory:]
        x, value, g, failed = x + t * d, new, h, False
        values = [*values, value][-20:]
    return x


def wolfe(f, x: np.ndarray, d: np.ndarray, value: float, g: np.ndarray, t: float, tries: int = 10):
    """(step, value, gradient) along ``d`` that meets the strong Wolfe conditions, or None."""
    def at(t):
        v, h = f(x + t * d)
        return t, v, h @ d, h

    slope = g @ d
    low = (0.0, value, slope, g)
    if slope > 0:
        return None
    for i in range(tries):
        c = at(t)
        if not math.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (i and c[1] >= low[1]):
            ends = low, c
        elif abs(c[2]) <= 0.9 * abs(slope):
            return c[0], c[1], c[3]
        elif c[2] >= 0:
            ends = c, low
        else:
            low, t = c, t * 1.5
            continue
        low, high = ends
        for _ in range(tries):
            c = at(between(high, low) if low[1] > high[1] else between(low, high))
            if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= 0.9 * abs(slope):
                return c[0], c[1], c[3]
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        return None
    return None


def between(a, b) -> float:
    """Where the cubic through both ends is least, not nearer to an end than a tenth."""
    p = a[2] + b[2] - 3 * (a[1] - b[1]) / (a[0] - b[0])
    q = math.sqrt(max(p * p - a[2] * b[2], 0.0))
    width = b[0] - a[0]
    t = b[0] - width * (b[2] + q - p) / (b[2] - a[2] + 2 * q)
    lo, hi = a[0] + 0.1 * width, a[0] + 0.9 * width
    return lo if t < lo else hi if t > hi else t
