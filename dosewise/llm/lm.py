"""Hashed maximum-entropy language model with class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history).

* Counts of all training words come from one aggregation over 64-bit word
  hashes.  The ``DICT`` most frequent words form the dictionary; all others,
  unknown ones too, share one rare class, in which a word has its smoothed
  share.
* Classes: the ``HEAD`` most frequent words in classes of ``SEAT`` words with a
  softmax of their own; the next words by cluster (of what stands before them)
  and frequency; the rest by frequency.
* Features of the history, hashed into ``ROWS`` rows of weights each: the word
  before (bigram), the word before that (skip), and both together (trigram).
  Words without a row of their own stand for their class.
* Training: the training documents are dealt into ``ROUNDS`` shards.  In each
  round every partition sums the exact gradient (expected minus observed) over
  its part of one shard, the sums meet in a tree of tasks, and the driver takes
  a damped step scaled by each row's expected count.  All arrays have fixed
  sizes, whatever the corpus; every training token is used once.
* Scoring runs the softmaxes over sparse numpy batches.  Words outside the
  dictionary are looked up by a join with the counts (at most 1/DICT of all
  tokens has any one of these that was seen in training; unseen ones are
  counted per document first).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewise.llm.blocks import Block, grouped
from dosewise.llm.common import arrow_type, each_bytes, fold, id_type
from dosewise.session import ship_package, stored

DICT = 1 << 18           # words in the dictionary at most
TOP, CONTEXT, CLUSTERS = 16384, 64, 8   # words that are clustered, by how many words before them, into what
HEAD, SEAT = 512, 32     # words with a softmax in their class, words per class
ROWS = 4096              # weight rows of a feature
ROUNDS, STEP, PRIOR, CLIP = 4, 0.5, 5.0, 2.0
BYTES = 1 << 18          # text read at a time
PART = 1 << 12           # tokens in one numpy batch
KEEP = 1 << 20           # distinct words that a task counts before it reports them
END_HASH = np.uint64(0x5DEECE66D1234567)
ALPHA = 0.1

_FOLD_CASE = np.arange(256, dtype=np.uint8)
_FOLD_CASE[65:91] += 32


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, tokens per text); an end token closes each text."""
    b = Block(texts)
    b.data = _FOLD_CASE[b.data]
    n = b.n_words + 1
    out = np.empty(int(n.sum()), np.uint64)
    ends = np.cumsum(n) - 1
    out[ends] = END_HASH
    if len(b.start):
        out[np.arange(len(b.start)) + b.doc] = b.hashes()
    return out, n


class Dictionary:
    """Words by decreasing count; ``ids`` gives len(self) for any other word."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.lexsort((hashes, -counts))
        self.hashes, self.counts = hashes[order], counts[order]
        self._index()

    def __getstate__(self):
        return self.hashes, self.counts

    def __setstate__(self, state):
        self.hashes, self.counts = state
        self._index()

    def __len__(self):
        return len(self.hashes)

    def _index(self):
        self.by_hash = np.argsort(self.hashes).astype(np.int32)
        self.sorted = self.hashes[self.by_hash]
        self.begin = np.searchsorted(self.sorted >> np.uint64(46), np.arange((1 << 18) + 1, dtype=np.uint64))
        self.most = int(np.diff(self.begin).max()) if len(self) else 0

    def ids(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), len(self), np.int32)
        slot = (h >> np.uint64(46)).astype(np.int64)
        at, stop = self.begin[slot], self.begin[slot + 1]
        left = np.flatnonzero(at < stop)
        for _ in range(self.most):
            a = at[left]
            hit = self.sorted[a] == h[left]
            out[left[hit]] = self.by_hash[a[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < stop[left]]
            if not len(left):
                break
        return out


def _tree(df: DataFrame, add) -> bytes:
    """Add up the partitions' single rows of bytes in a tree with few branches,
    so that only a few meet in the driver."""
    rdd = df.rdd.map(lambda r: bytes(r[0]))
    return rdd.treeReduce(add, max(2, math.ceil(math.log(max(2, rdd.getNumPartitions()), 8))))


def _history(x: np.ndarray, n: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The word before and the one before that; before a text stands the end."""
    first = np.cumsum(n) - n
    p1 = np.empty_like(x)
    p1[1:] = x[:-1]
    p1[first] = end
    p2 = np.empty_like(x)
    p2[1:] = p1[:-1]
    p2[first] = end
    return p1, p2


class Model:
    """Dictionary, classes and weights."""

    def __init__(self, words: Dictionary, total: int, types: int, clusters: np.ndarray):
        d, cnt = len(words), words.counts.astype(float)
        self.words, self.total, self.types = words, total, types
        self.rare_total, self.rare_types = total - int(cnt.sum()), types - d
        head, top = min(HEAD, d), min(TOP, d)
        self.n_head = HEAD // SEAT
        cls, seat = np.zeros(d + 1, np.int64), np.zeros(d + 1, np.int64)
        order = np.lexsort((np.arange(head), clusters[:head]))
        cls[order], seat[order] = np.arange(head) // SEAT, np.arange(head) % SEAT
        cls[head:top] = self.n_head + 2 * clusters[head:top] + (np.arange(head, top) >= 2048)
        cls[top:d] = self.n_head + 2 * CLUSTERS + np.minimum(3, np.log2(np.arange(top, d) / TOP).astype(int))
        self.n_class = self.n_head + 2 * CLUSTERS + 6      # an even number; the last is the rare class
        cls[d] = self.n_class - 1
        size = np.bincount(cls[:d], cnt, self.n_class).astype(float)
        size[-1] = self.rare_total + ALPHA
        self.cls, self.seat = cls, seat
        self.class_share = size / size.sum()
        self.class_log = np.log(np.maximum(self.class_share, 1e-30)).astype(np.float32)
        self.word_log = np.append(np.log(cnt / size[cls[:d]]) if d else [], 0.0)
        self.word_log[:head] = 0.0
        seats = np.full((self.n_head, SEAT), 1e-9)
        seats[cls[:head], seat[:head]] = cnt[:head]
        self.seat_log = np.log(seats / seats.sum(axis=1, keepdims=True)).astype(np.float32)
        # words from here on stand for their class in a history
        ids = np.arange(d + 1)
        self.row = np.where(ids < ROWS - 64, ids, ROWS - 64 + cls).astype(np.int64)
        self.end = int(words.ids(np.array([END_HASH], np.uint64))[0])
        self.w = np.zeros((3, ROWS, self.n_class), np.float32)
        self.u = np.zeros((ROWS, SEAT), np.float32)

    def forward(self, x, p1, p2) -> dict:
        """Softmaxes of a batch.  Logits are bounded (a share's logarithm plus a
        few clipped steps), so they need no shift before ``exp``."""
        a, b = self.row.take(p1), self.row.take(p2)
        f = (a, b, (a * 40503 + b * 2654435761 >> 7) & (ROWS - 1))
        c = self.cls.take(x)
        z = self.w[0].take(f[0], axis=0)
        z += self.w[1].take(f[1], axis=0)
        z += self.w[2].take(f[2], axis=0)
        z += self.class_log
        e = np.exp(z)
        s = e @ np.ones(self.n_class, np.float32)
        at = np.arange(len(x)) * self.n_class + c
        logp = z.ravel().take(at).astype(np.float64) - np.log(s)
        h = np.flatnonzero(c < self.n_head)
        ch = c.take(h)
        g = (a.take(h) * 17 + ch * 257) & (ROWS - 1)
        y = self.u.take(g, axis=0)
        y += self.seat_log.take(ch, axis=0)
        ey = np.exp(y)
        sy = ey @ np.ones(SEAT, np.float32)
        seat = np.arange(len(h)) * SEAT + self.seat.take(x.take(h))
        logp[h] += y.ravel().take(seat) - np.log(sy)
        logp += self.word_log.take(x)      # 0 for the words of head classes
        return {"f": f, "e": e, "s": s, "at": at, "h": h, "g": g, "ey": ey, "sy": sy, "seat": seat, "logp": logp}

    def sizes(self) -> list[int]:
        return [3 * ROWS * self.n_class, ROWS * SEAT]

    def gradient(self, x, p1, p2, gw, gu, n) -> None:
        """Add the batch's expected minus observed classes and seats to ``gw``
        and ``gu``, and how often each row was used to ``n``."""
        for at in range(0, len(x), PART):
            s = slice(at, at + PART)
            r = self.forward(x[s], p1[s], p2[s])
            p, q = r["e"], r["ey"]
            p *= (1 / r["s"])[:, None]
            p.ravel()[r["at"]] -= 1
            for k in range(3):
                _scatter(r["f"][k], p, gw[k], n[k])
            if len(q):
                q *= (1 / r["sy"])[:, None]
                q.ravel()[r["seat"]] -= 1
                _scatter(r["g"], q, gu, n[3])

    def step(self, gw, gu, n, round_: int) -> None:
        eta = STEP / (1 + round_)
        for k in range(3):
            self.w[k] -= np.clip(eta * gw[k] / (n[k][:, None] * self.class_share + PRIOR), -CLIP, CLIP).astype(np.float32)
        self.u -= np.clip(eta * gu / (n[3][:, None] / SEAT + PRIOR), -CLIP, CLIP).astype(np.float32)

    def log10(self, x, p1, p2) -> np.ndarray:
        out = np.empty(len(x))
        for at in range(0, len(x), PART):
            s = slice(at, at + PART)
            out[s] = self.forward(x[s], p1[s], p2[s])["logp"]
        return out / math.log(10)


def _scatter(rows: np.ndarray, values: np.ndarray, out: np.ndarray, seen: np.ndarray) -> None:
    """Add ``values`` to the given rows of ``out`` and count the rows in
    ``seen``.  Two floats are added at a time, as one complex number."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    r = rows.take(order)
    start = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
    sums = np.add.reduceat(values.view(np.complex64).take(order, axis=0), start, axis=0)
    out.view(np.complex64)[r[start]] += sums
    seen[r[start]] += np.diff(np.append(start, len(r)))


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, c): how often every token occurs; ``texts`` has one column."""
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def merged(parts):
        h, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        u, at = np.unique(h, return_inverse=True)
        return u, np.bincount(at, n, len(u)).astype(np.int64)

    def batch(h, n):
        return pa.record_batch([pa.array(h.view(np.int64)), pa.array(n)], schema=schema)

    def run(batches):
        parts, size = [], 0
        for b in batches:
            for part in grouped(each_bytes(b.column(0)), lambda t: len(t) + 1, BYTES):
                u, n = np.unique(tokens(part)[0], return_counts=True)
                parts.append((u, n))
                size += len(u)
                if size > KEEP:
                    parts = [merged(parts)]
                    size = len(parts[0][0])
                    if size > KEEP // 2:
                        yield batch(*parts[0])
                        parts, size = [], 0
        if parts:
            yield batch(*merged(parts))

    return texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("c"))


def dictionary(counts: DataFrame, most: int = DICT) -> tuple[Dictionary, int]:
    """The most frequent words (at most ``most``, all of equal rank or none) and
    the count that the least of them has.  The counts' histogram has a few
    hundred rows."""
    level = F.floor(F.log2(F.col("c")) * 32)
    hist = sorted(((r.level, r.n, r.least) for r in counts.groupBy(level.alias("level")).agg(
        F.count("*").alias("n"), F.min("c").alias("least")).collect()), reverse=True)
    total, least = 0, (1 << 62)
    for _, n, low in hist:
        if total + n > most:
            break
        total, least = total + n, low
    rows = counts.where(F.col("c") >= least).toArrow()
    h = rows.column("h").to_numpy().astype(np.int64).view(np.uint64)
    return Dictionary(h, rows.column("c").to_numpy().astype(np.int64)), least


def _clusters(m: np.ndarray) -> np.ndarray:
    """Cluster words by what stands before them: ``m`` (words x contexts)
    counts.  Centres come from the frequent words, far from each other first."""
    top = m[:2048]
    if not len(top):
        return np.zeros(len(m), np.int64)
    prior = (m.sum(axis=0) + 1) / (m.sum() + m.shape[1])
    p = top + prior * 4
    p /= p.sum(axis=1, keepdims=True)
    root, weight, centres = np.sqrt(p), top.sum(axis=1), [0]
    for _ in range(CLUSTERS - 1):
        near = (root @ root[centres].T).max(axis=1)
        centres.append(int(np.argmin(np.where(weight > 50, near, 2))))
    q = p[centres]
    for _ in range(20):
        best = (top @ np.log(q).T).argmax(axis=1)
        q = np.stack([top[best == g].sum(axis=0) + prior * 20 for g in range(CLUSTERS)])
        q /= q.sum(axis=1, keepdims=True)
    return (m @ np.log(q).T).argmax(axis=1)


def train(docs: DataFrame, held_out: int = 10) -> tuple[Model, DataFrame]:
    """(model, counts): learn from all rows outside fold 0 of ``held_out``."""
    ship_package(docs.sparkSession)
    rows = docs.where(fold(F.col("doc_id"), held_out) != 0).select(F.col("text").cast("string").alias("text"), "doc_id")
    counts = stored(word_counts(rows.select("text")), "counts")
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    words, least = dictionary(counts)
    shard = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(ROUNDS))
    share = docs.sparkSession.sparkContext.broadcast
    top = min(TOP, len(words))
    known = share(words)

    def neighbours(batches):
        words = known.value
        end = int(words.ids(np.array([END_HASH], np.uint64))[0])
        m = np.zeros(top * CONTEXT, np.int64)
        for b in batches:
            for part in grouped(each_bytes(b.column(0)), lambda t: len(t) + 1, BYTES):
                h, n = tokens(part)
                x = words.ids(h)
                p1, _ = _history(x, n, end)
                some = (p1 < CONTEXT) & (x < top)
                m += np.bincount(x[some].astype(np.int64) * CONTEXT + p1[some], minlength=len(m))
        yield pa.record_batch([pa.array([m.tobytes()], pa.binary())], names=["m"])

    def add_ints(a, b):
        return (np.frombuffer(a, np.int64) + np.frombuffer(b, np.int64)).tobytes()

    uses = 4 * ROWS * 8     # bytes of the row counts, before the gradient

    def add_gradients(a, b):
        return add_ints(a[:uses], b[:uses]) + (np.frombuffer(a, np.float32, offset=uses)
                                               + np.frombuffer(b, np.float32, offset=uses)).tobytes()

    m = _tree(rows.select("text").mapInArrow(neighbours, "m binary"), add_ints)
    m = np.frombuffer(m, np.int64).reshape(top, CONTEXT).astype(float)
    model = Model(words, int(sums.n or 0), int(sums.v), _clusters(m))
    for r in range(ROUNDS):
        now = share(model)   # of fixed size

        def gradients(batches):
            model = now.value
            g = np.zeros(sum(model.sizes()), np.float32)
            gw, gu = np.split(g, model.sizes()[:1])
            gw, gu, n = gw.reshape(3, ROWS, -1), gu.reshape(ROWS, -1), np.zeros((4, ROWS), np.int64)
            for b in batches:
                for part in grouped(each_bytes(b.column(0)), lambda t: len(t) + 1, BYTES):
                    h, size = tokens(part)
                    x = model.words.ids(h)
                    model.gradient(x, *_history(x, size, model.end), gw, gu, n)
            yield pa.record_batch([pa.array([n.tobytes() + g.tobytes()], pa.binary())], names=["g"])

        total = _tree(rows.where(shard == r).select("text").mapInArrow(gradients, "g binary"), add_gradients)
        n = np.frombuffer(total, np.int64, 4 * ROWS).astype(float)
        gw, gu = np.split(np.frombuffer(total, np.float32, offset=uses).astype(float), model.sizes()[:1])
        model.step(gw.reshape(3, ROWS, -1), gu.reshape(ROWS, -1), n.reshape(4, ROWS), r)
        now.unpersist()
    return model, counts.where(F.col("c") < least)


def score(docs: DataFrame, model: Model, rare_counts: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), one row per
    row of ``docs``: log10 probabilities of the whole text with its end under
    the smoothed word frequencies (``base_score``) and under the model.

    ``rare_counts``: counts of the training words outside the dictionary.  A
    null text is an empty one: the end alone.  Without training rows both
    scores are 0.  Repeated rows are kept; other columns are not carried.
    """
    kind = id_type(docs)
    shape = T.StructType([T.StructField("uid", T.LongType()), T.StructField("doc_id", kind),
                          T.StructField("n_tokens", T.LongType()), T.StructField("n_dict", T.LongType()),
                          T.StructField("base", T.DoubleType()), T.StructField("logp", T.DoubleType()),
                          T.StructField("h", T.ArrayType(T.LongType())), T.StructField("n", T.ArrayType(T.IntegerType()))])
    schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in shape.fields])
    now = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = now.value
        d = len(model.words)
        base = np.append(np.log10(model.words.counts + ALPHA), 0.0)
        uid = TaskContext.get().partitionId() << 40
        for b in batches:
            at = 0
            for part in grouped(each_bytes(b.column(1)), lambda t: len(t) + 1, BYTES):
                h, n = tokens(part)
                x = model.words.ids(h)
                logp = model.log10(x, *_history(x, n, model.end))
                first = np.cumsum(n) - n
                doc = np.repeat(np.arange(len(n)), n)
                far = np.flatnonzero(x == d)
                order = far[np.lexsort((h[far], doc[far]))]
                rd, rh = doc[order], h[order]
                new = np.flatnonzero(np.r_[True, (rd[1:] != rd[:-1]) | (rh[1:] != rh[:-1])]) if len(order) else order
                times = np.diff(np.append(new, len(order))).astype(np.int32)
                offsets = np.searchsorted(rd[new], np.arange(len(n) + 1)).astype(np.int32)
                yield pa.record_batch([
                    pa.array(uid + np.arange(len(n))), b.column(0).slice(at, len(n)).cast(schema.field(1).type),
                    pa.array(n), pa.array(n - np.bincount(rd, minlength=len(n))),
                    pa.array(np.add.reduceat(base[x], first)), pa.array(np.add.reduceat(logp, first)),
                    pa.ListArray.from_arrays(offsets, pa.array(rh[new].view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(times))], schema=schema)
                uid += len(n)
                at += len(n)

    ship_package(docs.sparkSession)
    table = stored(docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, shape), "scored")
    rare = (table.select("uid", F.explode(F.arrays_zip("h", "n")).alias("r")).select("uid", "r.h", "r.n")
            .join(rare_counts, "h", "left")
            .groupBy("uid").agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + ALPHA)).alias("rare_log"),
                                F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known")))
    base_all = math.log10(model.total + ALPHA * (model.types + 1))
    rare_all = math.log10(model.rare_total + ALPHA * (model.rare_types + 1))
    extra = F.coalesce("rare_log", F.lit(0.0))
    return (table.drop("h", "n").join(rare, "uid", "left").select(
        "doc_id", "n_tokens", (F.col("n_dict") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * base_all).alias("base_score"),
        (F.col("logp") + extra - (F.col("n_tokens") - F.col("n_dict")) * rare_all).alias("score")))
