"""Toxic spans by a linear-chain conditional random field.

Two states (toxic or not) over the words of a text.  A word's features are
itself, its prefixes and suffixes, and its neighbours.  Only documents carry
labels, so token labels are derived first: a feature is a sign of toxicity if
it is surely more frequent in toxic than in clean sample documents (by the lower
bound of its share).  Copies count once: sample documents that share about half
of their 3-word shingles or more (by ``MINIMA`` minimum hashes), directly or by
others between them, are one class, and a class has one vote.  Which words
documents share beside that plays no part.  A word of a toxic
document with such a feature is labelled toxic, every other word is not.  The
field is fitted on windows of those labelled tokens by gradient steps on the
exact likelihood (forward-backward).

Scoring runs forward-backward over every whole text.  A document's score is a
logistic function of its strongest marginal and of its expected number of toxic
words, fitted on the same sample; words at or above one half are reported as
spans (code-point offsets).

The sample is bounded (``SAMPLE`` labelled rows of each class, a few windows of
``SPAN`` words of each); the model keeps non-zero weights only.  Scoring is one
narrow pass without a shuffle; the emission scores of a word are computed once
per worker (at most ``CACHE`` words remembered).
"""

from __future__ import annotations


import re
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewise.llm.blocks import Block, grouped, mix
from dosewise.llm.common import arrow_type, as_bytes, id_type, pieces
from dosewise.llm.decontaminate import _grams
from dosewise.llm.sampling import class_sizes, labelled
from dosewise.session import ship_package

SAMPLE = 2000       # labelled rows of each class that the model is fitted on
SPAN, WINDOWS = 24, 4
LEAST, LIFT = 5, 4.5   # toxic classes of sample documents with a sign; least ratio of its share to the clean one
MINIMA, ALIKE = 64, 0.5   # minimum hashes of a document; share of equal ones from which two are copies
CACHE = 400_000
BYTES = 4 << 20     # text tagged at a time
EPOCHS, RATE, DECAY = 60, 0.15, 2e-5

_SEEDS = np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_EDGE = re.compile(r"^\W+|\W+$")


def norm(word: bytes) -> str:
    return _EDGE.sub("", word.decode("utf-8", "replace"))


def own(word: str) -> list[str]:
    """Features of a word by itself."""
    if not word:
        return []
    n = len(word)
    return (["w=" + word] + [f"p{k}=" + word[:k] for k in (3, 4, 5, 6) if n > k]
            + [f"s{k}=" + word[-k:] for k in (3, 4) if n > k])


def texts_words(text: bytes) -> list[bytes]:
    return [w for p in pieces(text) for w in p.lower().split()]


class Emissions(dict):
    """Word (lower-cased bytes) -> row of its scores: as itself, as the word
    before, as the word after."""

    def __init__(self, weights: dict):
        self.weights = weights
        self.scores = [array("f"), array("f"), array("f")]

    def __missing__(self, word: bytes) -> int:
        w, get = norm(word), self.weights.get
        row = self[word] = len(self)
        self.scores[0].append(get("bias", 0.0) + sum(get(f, 0.0) for f in own(w)))
        self.scores[1].append(get("before=" + w, 0.0))
        self.scores[2].append(get("after=" + w, 0.0))
        return row

    def trim(self) -> None:
        if len(self) > CACHE:
            self.clear()
            self.scores = [array("f"), array("f"), array("f")]

    def emit(self, rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Emission log-odds of the words ``rows`` of several texts on end;
        ``first``/``last`` mark the ends of each text."""
        e, before, after = (np.array(s, np.float32) for s in self.scores)
        out = e[rows]
        out[1:] += np.where(first[1:], 0, before[rows[:-1]])
        out[:-1] += np.where(last[:-1], 0, after[rows[1:]])
        return out


def layout(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts on end -> time order: (place of every word, words at each step,
    offset of each step); longer texts come first within a step."""
    order = np.argsort(-sizes, kind="stable")
    rank = np.empty(len(sizes), np.int64)
    rank[order] = np.arange(len(sizes))
    top = int(sizes.max()) if len(sizes) else 0
    alive = np.searchsorted(-sizes[order], -np.arange(top), side="left")
    offset = np.cumsum(alive) - alive
    begin = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    step = np.arange(int(sizes.sum())) - begin[doc]
    return offset[step] + rank[doc], alive, offset


def chain(em: np.ndarray, alive: np.ndarray, offset: np.ndarray, trans: np.ndarray):
    """Forward and backward log-odds in time order.  ``trans``: log weights
    [[stay clean, clean to toxic], [toxic to clean, stay toxic]]."""
    (d, b), (c, a) = np.exp(trans)
    fwd, bwd = em.astype(np.float64), np.zeros(len(em))
    steps = len(alive)
    for t in range(1, steps):
        m, o, q = alive[t], offset[t], offset[t - 1]
        x = np.exp(np.clip(fwd[q:q + m], -30, 30))
        fwd[o:o + m] += np.log((x * a + b) / (x * c + d))
    for t in range(steps - 2, -1, -1):
        m, o, q = alive[t + 1], offset[t + 1], offset[t]
        x = np.exp(np.clip(em[o:o + m] + bwd[o:o + m], -30, 30))
        bwd[q:q + m] = np.log((x * a + c) / (x * b + d))
    return fwd, bwd


def marginals(em: np.ndarray, sizes: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Log-odds of the toxic state of every word, texts on end."""
    place, alive, offset = layout(sizes)
    timed = np.empty(len(em), np.float64)
    timed[place] = em
    fwd, bwd = chain(timed, alive, offset, trans)
    return (fwd + bwd)[place]


def fit(seqs: list[tuple[list[str], list[int]]]) -> tuple[dict, np.ndarray]:
    """Feature weights and transitions from labelled token sequences."""
    sizes = np.array([len(w) for w, _ in seqs])
    y = np.concatenate([np.array(t, float) for _, t in seqs])
    feats = []
    for ws, _ in seqs:
        for k, w in enumerate(ws):
            f = ["bias", *own(w)]
            if k:
                f.append("before=" + ws[k - 1])
            if k + 1 < len(ws):
                f.append("after=" + ws[k + 1])
            feats.append(f)
    counts = Counter(f for fs in feats for f in fs)
    index = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= 2))}
    wide = max(len(f) for f in feats)
    ids = np.full((len(feats), wide), len(index), np.int64)   # the last weight stays 0
    for r, fs in enumerate(feats):
        got = [index[f] for f in fs if f in index]
        ids[r, :len(got)] = got
    place, alive, offset = layout(sizes)
    doc_end = np.zeros(len(feats), bool)
    doc_end[np.cumsum(sizes) - 1] = True
    w, trans = np.zeros(len(index) + 1), np.zeros((2, 2))
    w[index["bias"]] = -3.0
    square, tsquare = np.full(len(w), 1e-8), np.full((2, 2), 1e-8)
    pair_y = np.zeros((2, 2))
    a_y, b_y = y[:-1][~doc_end[:-1]].astype(int), y[1:][~doc_end[:-1]].astype(int)
    np.add.at(pair_y, (a_y, b_y), 1)
    n = len(y)
    for _ in range(EPOCHS):
        em = w[ids].sum(axis=1)
        timed = np.empty(n)
        timed[place] = em
        fwd, bwd = chain(timed, alive, offset, trans)
        fwd, bwd = fwd[place], bwd[place]
        p = 1 / (1 + np.exp(-np.clip(fwd + bwd, -30, 30)))
        a, r = np.clip(fwd[:-1], -30, 30), np.clip(em[1:] + bwd[1:], -30, 30)
        e = np.exp(trans)
        xi = np.stack([np.full(n - 1, e[0, 0]), np.exp(r) * e[0, 1], np.exp(a) * e[1, 0], np.exp(a + r) * e[1, 1]])
        xi = (xi / xi.sum(axis=0))[:, ~doc_end[:-1]].sum(axis=1).reshape(2, 2)
        g = np.bincount(ids.ravel(), np.repeat(p - y, wide), len(w)) / n + DECAY * w
        g[-1] = 0
        gt = (xi - pair_y) / n + DECAY * trans
        square += g * g
        tsquare += gt * gt
        w -= RATE * g / np.sqrt(square)
        trans -= RATE * gt / np.sqrt(tsquare)
    return {f: float(w[i]) for f, i in index.items() if abs(w[i]) > 0.02}, trans


class Model:
    """``weights``/``trans`` of the field and the document's logistic function;
    without both classes in the sample the prior alone scores."""

    def __init__(self, prior: float):
        self.prior, self.weights, self.trans, self.top = prior, None, None, None

    def aggregate(self, found: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summary(found) @ self.top, -30, 30)))


def summary(found: np.ndarray) -> np.ndarray:
    """(strongest log-odds, expected toxic words, words) -> what a document's
    logistic function sees: the strongest word, how many, and how dense."""
    top, expected, words = found.T
    return np.stack([top / 5, np.log(expected + 1e-3), np.minimum(expected, 8),
                     np.log((expected + 1e-3) / np.maximum(words, 1)), np.ones(len(found))], axis=1)


def document_features(texts: list[bytes], em: Emissions, trans: np.ndarray):
    """(strongest log-odds, expected toxic words, rows of toxic words) per text."""
    top, expected = np.full(len(texts), -20.0), np.zeros(len(texts))
    hits: list = [None] * len(texts)
    em.trim()
    sizes, rows = [], []
    for t in texts:
        ws = texts_words(t)
        rows.append(np.fromiter(map(em.__getitem__, ws), np.int32, len(ws)))
        sizes.append(len(ws))
    sizes = np.array(sizes, np.int64)
    if sizes.sum() == 0:
        return np.stack([top, expected, sizes], axis=1), hits
    some = np.flatnonzero(sizes)
    ends = np.cumsum(sizes[some])
    first, last = np.zeros(ends[-1], bool), np.zeros(ends[-1], bool)
    first[ends - sizes[some]] = True
    last[ends - 1] = True
    odds = marginals(em.emit(np.concatenate(rows), first, last), sizes[some], trans)
    begin = ends - sizes[some]
    top[some] = np.maximum(np.maximum.reduceat(odds, begin), -20)
    expected[some] = np.add.reduceat(1 / (1 + np.exp(-np.clip(odds, -30, 30))), begin)
    for i, b, e in zip(some, begin, ends):
        if top[i] >= 0:
            hits[i] = np.flatnonzero(odds[b:e] >= 0)
    return np.stack([top, expected, sizes], axis=1), hits


_WORD = re.compile(r"[^\x20\x09-\x0d]+")


def offsets(text: bytes, hit: np.ndarray | None) -> list[tuple[int, int]]:
    """Code-point spans of the words numbered ``hit``; neighbours are joined."""
    if hit is None or not len(hit):
        return []
    wanted, out = set(hit.tolist()), []
    for k, m in enumerate(_WORD.finditer(text.decode("utf-8", "replace"))):
        if k in wanted:
            if out and out[-1][2] == k - 1:
                out[-1] = (out[-1][0], m.end(), k)
            else:
                out.append((m.start(), m.end(), k))
    return [(a, b) for a, b, _ in out]


def minima(text: bytes) -> np.ndarray:
    """Minimum hashes of a text's 3-word shingles."""
    out = np.full(MINIMA, ~np.uint64(0))
    for p in pieces(text):
        h = Block([p.lower()]).hashes()
        if len(h):
            g = np.unique(_grams(h, min(3, len(h))))
            out = np.minimum(out, [mix(g + k).min() for k in _SEEDS])
    return out


def copy_classes(signs: np.ndarray) -> np.ndarray:
    """A class number for every row of minimum hashes: rows that are alike, or
    that a chain of alike rows joins, have the same one."""
    out = np.full(len(signs), -1)
    left = np.arange(len(signs))
    for c in range(len(signs)):
        if not len(left):
            break
        todo, left = [left[0]], left[1:]
        while todo:
            i = todo.pop()
            out[i] = c
            near = (signs[left] == signs[i]).sum(axis=1) >= ALIKE * MINIMA
            todo += left[near].tolist()
            left = left[~near]
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on a bounded sample of labelled rows."""
    n0, n1 = class_sizes(labels, label)
    model = Model((n1 + 1) / (n0 + n1 + 2))
    if not n0 or not n1:
        return model
    ship_package(docs.sparkSession)
    # equal texts count once
    rows = (labelled(docs, labels, label, sample).groupBy("text", "y").agg(F.min("doc_id").alias("doc_id"))
            .select(F.col("doc_id").cast("string").alias("id"), "text", "y").persist())

    def signed(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(2).cast(pa.int64()),
                                   pa.array([minima(t).tobytes() for t in as_bytes(b.column(1))], pa.binary())],
                                  names=["id", "y", "sign"])

    # bounded by the sample, as is all that is collected here
    signs = sorted((r.id, r.y, bytes(r.sign)) for r in rows.mapInArrow(signed, "id string, y long, sign binary").collect())
    found = copy_classes(np.frombuffer(b"".join(s for _, _, s in signs), np.uint64).reshape(-1, MINIMA))
    k0, k1 = (len({c for c, (_, y, _) in zip(found.tolist(), signs) if y == v}) for v in (0, 1))
    many = np.bincount(found)[found] > 1
    copies = {i: c for (i, _, _), c, m in zip(signs, found.tolist(), many) if m}

    def features(batches):
        counts: Counter = Counter()     # of documents without copies
        votes = set()
        for b in batches:
            for i, text, y in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), b.column(2).to_pylist()):
                fs = {f for w in set(texts_words(text)) for f in own(norm(w))}
                if i in copies:
                    votes.update((f, y, copies[i]) for f in fs)
                else:
                    counts.update((f, y) for f in fs)
        out = [(f, y, -1, n) for (f, y), n in counts.items()] + [(f, y, c, 1) for f, y, c in votes]
        yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(
            (pa.string(), pa.int64(), pa.int64(), pa.int64()))], names=["f", "y", "copy", "n"])

    counted = (rows.mapInArrow(features, "f string, y long, copy long, n long").groupBy("f", "y", "copy")
               .agg(F.when(F.col("copy") < 0, F.sum("n")).otherwise(1).alias("n")).groupBy("f")
               .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n1"),
                    F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("n0"))
               .where(F.col("n1") >= LEAST)
               .where((F.col("n1") - 2 * F.sqrt("n1")) / k1 >= LIFT * (F.col("n0") + 2 * F.sqrt("n0") + 2) / k0))
    picked = {r.f for r in counted.collect()}
    if not picked:
        rows.unpersist()
        return model

    def windows(batches):
        for b in batches:
            ws_out, ts_out = [], []
            for text, y in zip(as_bytes(b.column(1)), b.column(2).to_pylist()):
                ws = [norm(w) for w in texts_words(text)]
                marks = [int(y == 1 and not picked.isdisjoint(own(w))) for w in ws]
                at = [k for k, v in enumerate(marks) if v]
                spots = ([max(0, at[j] - SPAN // 2) for j in np.unique(np.linspace(0, len(at) - 1, WINDOWS).round().astype(int))]
                         if at else [int(s) for s in np.unique(np.linspace(0, max(0, len(ws) - SPAN), WINDOWS // 2).round())])
                for s in spots:
                    if ws[s:s + SPAN]:
                        ws_out.append(ws[s:s + SPAN])
                        ts_out.append(marks[s:s + SPAN])
            yield pa.record_batch([pa.array(ws_out, pa.list_(pa.string())), pa.array(ts_out, pa.list_(pa.int64()))],
                                  names=["ws", "ts"])

    seqs = sorted((list(r.ws), list(r.ts)) for r in rows.mapInArrow(windows, "ws array<string>, ts array<long>").collect())
    weights, trans = fit(seqs)
    model.weights, model.trans = weights, trans

    def seen(batches):
        em = Emissions(weights)
        for b in batches:
            pairs = list(zip(as_bytes(b.column(1)), b.column(2).to_pylist()))
            for part in grouped(pairs, lambda p: len(p[0]) + 1, BYTES):
                found, _ = document_features([t for t, _ in part], em, trans)
                yield pa.record_batch([*map(pa.array, found.T), pa.array([float(y) for _, y in part])],
                                      names=["top", "expected", "words", "y"])

    got = np.array(sorted(tuple(r) for r in rows.mapInArrow(
        seen, "top double, expected double, words double, y double").collect()))
    rows.unpersist()
    x, y = summary(got[:, :3]), got[:, 3]
    weight = np.where(y == 1, n1 / max(1, (y == 1).sum()), n0 / max(1, (y == 0).sum()))
    weight /= weight.sum()
    theta = np.zeros(x.shape[1])
    for _ in range(50):   # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        g = x.T @ (weight * (p - y)) + 1e-4 * theta
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(theta))
        theta -= np.clip(np.linalg.solve(h, g), -2, 2)
    model.top = theta
    return model


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, spans): the document's score and its toxic spans (start,
    end; code points), one row per row of ``docs``.

    A null text is an empty one: no span, the score of no evidence.  Repeated
    rows are kept; other columns are not carried.
    """
    kind = id_type(docs)
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = pa.schema([("doc_id", arrow_type(kind)), ("score", pa.float64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
    weights, trans, prior = model.weights, model.trans, model.prior

    def run(batches):
        em = Emissions(weights or {})
        for b in batches:
            pairs = list(zip(b.column(0).to_pylist(), as_bytes(b.column(1))))
            for part in grouped(pairs, lambda p: len(p[1]) + 1, BYTES):
                if model.top is None:
                    s, found = np.full(len(part), prior), [[]] * len(part)
                else:
                    seen, hits = document_features([t for _, t in part], em, trans)
                    s = model.aggregate(seen)
                    found = [[{"start": a, "end": e} for a, e in offsets(t, h)] for (_, t), h in zip(part, hits)]
                yield pa.record_batch([pa.array([i for i, _ in part], schema.field(0).type), pa.array(s),
                                       pa.array(found, schema.field(2).type)], schema=schema)

    ship_package(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, T.StructType([T.StructField("doc_id", kind), T.StructField("score", T.DoubleType()), T.StructField("spans", span)]))
