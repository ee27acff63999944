"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is encoded
as a feature vector (shares of byte classes, repetition, word lengths, a hashed
histogram of byte pairs), embedded by a tanh layer, and weighted by a gated
attention: softmax over the passages of w . (tanh(V e) * sigmoid(U e)).  The
weighted sum of embeddings is scored by a logistic unit.  Only the document's
label trains it; which passages matter is learned.

The model is fitted on a bounded sample of labelled rows (``SAMPLE`` per class,
``BAG`` passages per document, evenly spaced) and has a fixed size; scoring
reads every passage of every text, in one narrow pass without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewise.llm.blocks import SPACE, Block, grouped
from dosewise.llm.common import arrow_type, each_bytes
from dosewise.llm.sampling import class_sizes, labelled
from dosewise.session import ship_package

PASSAGE = 48          # words in a passage
SAMPLE = 3000         # labelled rows of each class that the model is fitted on
BAG = 64              # passages of one document used in fitting
BYTES = 1 << 18       # text encoded at a time
PAIRS = 32            # buckets of the byte-pair histogram
WIDTH, GATE = 16, 8   # embedding and attention sizes
EPOCHS, RATE, DECAY = 60, 0.02, 1e-4

# Byte classes: lower, upper, digit, white space, sentence marks, other marks
# (four groups), continuation and lead bytes of other scripts, control bytes.
_CLASS = np.full(256, 9, np.int64)
_CLASS[0x80:0xC0], _CLASS[0xC0:] = 7, 8
for _k, _chars in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", None,
                             b".,;:'\"?-()", b"!", b"*%&$#@^~+=_`"]):
    if _chars:
        _CLASS[list(_chars)] = _k
_CLASS[SPACE] = 3
_CLASS[list(b"|<>[]{}\\/")] = 10
CLASSES = 11
FEATURES = CLASSES + 6 + PAIRS


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, passages per text).  A text without words is
    one passage of zeros but for its last feature."""
    b = Block(texts)
    per = np.maximum(1, -(-b.n_words // PASSAGE))
    base = np.cumsum(per) - per
    n = int(per.sum())
    word_passage = base[b.doc] + b.nth // PASSAGE
    x = np.zeros((n, FEATURES), np.float32)
    words = np.bincount(word_passage, minlength=n).astype(np.float32)
    some = np.maximum(words, 1)
    if len(b.start):
        # every byte belongs to the passage of the last word begun before it
        owner = np.zeros(len(b.data), np.int64)
        owner[b.start] = 1
        owner = np.maximum(np.cumsum(owner) - 1, 0)
        passage = word_passage[owner]
        keep = np.ones(len(b.data), bool)
        keep[b.ends - 1] = False
        first = np.searchsorted(b.begins, np.arange(len(b.data)), side="right") - 1
        keep &= first == b.doc[owner]          # leading white space of a text has no word yet
        p, d, text = passage[keep], b.data[keep], first[keep]
        size = np.maximum(np.bincount(p, minlength=n), 1)[:, None]
        x[:, :CLASSES] = np.bincount(p * CLASSES + _CLASS[d], minlength=n * CLASSES).reshape(n, CLASSES) / size
        pair = (d[:-1].astype(np.int64) * 37 + d[1:] * 101 >> 2) % PAIRS
        inner = text[1:] == text[:-1]          # no pair spans two texts
        x[:, CLASSES + 6:] = np.bincount((p[:-1] * PAIRS + pair)[inner], minlength=n * PAIRS).reshape(n, PAIRS) / size
        h = b.hashes()
        same = (h[1:] == h[:-1]) & (word_passage[1:] == word_passage[:-1])
        x[:, CLASSES] = np.bincount(word_passage[1:][same], minlength=n) / some
        slots = np.bincount(word_passage * 64 + (h >> np.uint64(58)).astype(np.int64), minlength=n * 64).reshape(n, 64)
        x[:, CLASSES + 1] = (slots > 0).sum(axis=1) / np.minimum(some, 48)
        x[:, CLASSES + 2] = slots.max(axis=1) / some
        length = (b.end - b.start).astype(np.float64)
        mean = np.bincount(word_passage, length, n) / some
        x[:, CLASSES + 3] = np.minimum(mean, 40) / 10
        x[:, CLASSES + 4] = np.bincount(word_passage[length == 1], minlength=n) / some
    x[:, CLASSES + 5] = words == 0
    return x, per


class Model:
    """Weights of the network; ``prior`` alone scores when a class is missing."""

    def __init__(self, prior: float, seed: int = 7):
        r = np.random.default_rng(seed)
        self.prior, self.fitted = prior, False
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        self.w = {"W": r.normal(0, FEATURES ** -0.5, (FEATURES, WIDTH)), "b": np.zeros(WIDTH),
                  "V": r.normal(0, WIDTH ** -0.5, (WIDTH, GATE)), "U": r.normal(0, WIDTH ** -0.5, (WIDTH, GATE)),
                  "a": r.normal(0, GATE ** -0.5, GATE), "c": r.normal(0, WIDTH ** -0.5, WIDTH), "d": np.zeros(1)}

    def forward(self, x: np.ndarray, per: np.ndarray) -> dict:
        w, start = self.w, np.cumsum(per) - per
        e = np.tanh(x @ w["W"] + w["b"])
        tv, su = np.tanh(e @ w["V"]), 1 / (1 + np.exp(-(e @ w["U"])))
        s = (tv * su) @ w["a"]
        s = np.exp(s - np.repeat(np.maximum.reduceat(s, start), per))
        att = s / np.repeat(np.add.reduceat(s, start), per)
        z = np.add.reduceat(att[:, None] * e, start, axis=0)
        return {"e": e, "tv": tv, "su": su, "att": att, "z": z, "logit": z @ w["c"] + w["d"][0], "start": start}

    def score(self, x: np.ndarray, per: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(per), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.forward((x - self.mean) / self.scale, per)["logit"], -30, 30)))

    def gradient(self, x, per, y, weight) -> dict:
        f, w = self.forward(x, per), self.w
        g = (1 / (1 + np.exp(-np.clip(f["logit"], -30, 30))) - y) * weight
        out = {"c": f["z"].T @ g, "d": np.array([g.sum()])}
        dz = np.repeat(g[:, None] * w["c"], per, axis=0)
        datt = (dz * f["e"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(f["att"] * datt, f["start"]), per)
        ds = f["att"] * (datt - mean)
        dh = ds[:, None] * w["a"]
        out["a"] = (f["tv"] * f["su"]).T @ ds
        dv, du = dh * f["su"] * (1 - f["tv"] ** 2), dh * f["tv"] * f["su"] * (1 - f["su"])
        out["V"], out["U"] = f["e"].T @ dv, f["e"].T @ du
        de = (f["att"][:, None] * dz + dv @ w["V"].T + du @ w["U"].T) * (1 - f["e"] ** 2)
        out["W"], out["b"] = x.T @ de, de.sum(axis=0)
        return out

    def fit(self, bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray, seed: int = 7) -> None:
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(axis=0), every.std(axis=0) + 1e-3
        bags = [(b - self.mean) / self.scale for b in bags]
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for epoch in range(EPOCHS):
            order = r.permutation(len(bags))
            rate = RATE * (1 - epoch / EPOCHS)
            for at in range(0, len(order), 256):
                part = order[at:at + 256]
                per = np.array([len(bags[i]) for i in part])
                g = self.gradient(np.concatenate([bags[i] for i in part]), per, y[part], weight[part] / weight[part].sum())
                step += 1
                for k, p in self.w.items():
                    d = g[k] + DECAY * p
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v2[k] = 0.999 * v2[k] + 0.001 * d * d
                    p -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
        self.fitted = True


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on a bounded sample of labelled rows.  Without both classes the
    model is the smoothed share of label 1 (0.5 without labels)."""
    n0, n1 = class_sizes(labels, label)
    model = Model((n1 + 1) / (n0 + n1 + 2))
    rows = labelled(docs, labels, label, sample)
    ship_package(docs.sparkSession)

    def run(batches):
        for b in batches:
            ids, y = b.column(0), b.column(2).to_pylist()
            for part in grouped(list(zip(ids.to_pylist(), each_bytes(b.column(1)), y)), lambda t: len(t[1]), BYTES):
                x, per = encode([t[1] for t in part])
                at = np.cumsum(per) - per
                out = []
                for (doc_id, _, cls), a, n in zip(part, at, per):
                    take = np.unique(np.linspace(0, n - 1, min(n, BAG)).round().astype(int))
                    out.append((str(doc_id), cls, x[a:a + n][take].astype("<f4").tobytes()))
                yield pa.record_batch([pa.array(c) for c in zip(*out)], names=["id", "y", "bag"])

    got = sorted(rows.mapInArrow(run, "id string, y long, bag binary").toLocalIterator(), key=lambda r: r.id)
    y = np.array([r.y for r in got], float)
    if len(got) == 0 or y.min() == y.max():
        return model
    bags = [np.frombuffer(r.bag, "<f4").reshape(-1, FEATURES) for r in got]
    share = np.where(y == 1, n1 / max(1, (y == 1).sum()), n0 / max(1, (y == 0).sum()))
    model.fit(bags, y, share)
    return model


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with a double column ``out`` from 0 to 1 (all other columns as
    they are; ``out`` must be a new name).  A null text is an empty one."""
    if out in docs.columns:
        raise ValueError(f"{out} is already a column")
    shape = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in shape.fields])
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            s = []
            for part in grouped(each_bytes(b.column(at)), len, BYTES):
                s.append(model.score(*encode(part)))
            done = np.concatenate(s) if s else np.zeros(0)
            yield pa.record_batch([c.cast(f.type) for c, f in zip(b.columns, schema)] + [pa.array(done, pa.float64())],
                                  schema=schema)

    ship_package(docs.sparkSession)
    return docs.mapInArrow(run, shape)
