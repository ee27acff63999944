"""Benchmark passages in training documents, found by rare seeds and scored by
local alignment.

Which seeds an edited copy must share.  A local alignment with m matched words and
e errors (replaced, missing or additional words, each -1; a match is 2) of an item
of n words reaches the score t (of 2 n) only if 2 m - e >= 2 t n.  Between its m - 1
neighbouring matches lie e errors, so at least m - 1 - e / 2 >= t n - 1 neighbours
have one error or none between them.  The words of such a pair are one or two words
apart in both texts.  So a seed is a pair of words at distance 1 or 2, and
T = ceil(t n) - 1 different words of the item must start a pair that the passage
has too, within (3 - 2 t) n words of it.  Nothing above the threshold is missed.

1. A Bloom filter of all items' seeds, and one pass that counts them in all
   documents, give each word of an item a price: documents times items that hold
   the seeds it starts.  The dearest words (stock phrases) are left out as far as T
   allows: without the T - r dearest of its n - 1 starts an item still has r seeds
   in common with every copy, without the T - 1 dearest one.
2. Items are taken in classes of similar length, each with a filter of its seeds.  A
   second pass keeps passages where the least r of the class begin within the
   greatest reach of the class (r is about T / 2, so chance pairs leave nothing).
3. Passages join items on the seeds of the rarest n - T words, so a phrase that all
   documents and items share joins nothing.  Every pair is a candidate once.
4. Smith-Waterman alignment of the passage's words with the item's, over the
   score of a perfect copy, gives a score from 0 to 1.  A pair goes unaligned only
   if the item's words that the passage holds at all, every one matched, would
   stay below the threshold.

Words are runs of ASCII letters, digits and non-ASCII characters, lower-cased.
Filters have a fixed size and are all that is broadcast; a larger benchmark makes
them let more pairs through.  Texts of any length are hashed in pieces, and long
passages are cut with overlaps that hold any alignment.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.window import Window

from dosewise.llm.blocks import Block, grouped, located_words, mix
from dosewise.llm.common import arrow_type, id_type
from dosewise.session import ship_package, stored

FILTER_BITS = 24         # the Bloom filter has 2**24 bits (2 MB)
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
BYTES = 1 << 18          # text hashed at a time
SPAN = 1 << 20           # words of a long text whose seeds are looked up at a time

_BREAKS = np.ones(256, bool)
_BREAKS[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = False
_BREAKS[0x80:] = False
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_PAIRS = np.uint64(2 * int(_STEPS[0]) % (1 << 64))


def _block(texts: list) -> Block:
    return Block([(t or "").lower().encode("utf-8", "replace") for t in texts], _BREAKS)


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of a word-hash sequence (those that start at every
    word with n - 1 words after it)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    g = np.full(m, n, np.uint64)
    for k in range(n):
        g = mix(g * _STEPS[k % 4] + h[k:k + m])
    return g


def _slots(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return (g & mask).astype(np.int64), ((g >> np.uint64(32)) & mask).astype(np.int64)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The seed of two words; the same at distance 1 and 2."""
    return mix(mix(_PAIRS + a) * _STEPS[1] + b)


def needed(n, threshold: float):
    """(T, r) of items of n words: starts in common with every copy above the
    threshold, and those that are asked for.  T is 0 for one or two words, which
    are sought as they stand."""
    t = np.maximum(np.ceil(threshold * np.asarray(n) - 1e-9).astype(np.int64) - 1, 0)
    return t, np.maximum((t + 1) // 2, 1)


def items_table(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(iid, item_id, item_words: hashes as bytes, n, seeds, starts, kind) of every
    item with words; ``starts`` says at which word each seed begins, ``kind`` is
    the class of lengths."""
    kind = id_type(items, "item_id")
    shape = T.StructType([
        T.StructField("iid", T.LongType()), T.StructField("item_id", kind), T.StructField("item_words", T.BinaryType()),
        T.StructField("n", T.LongType()), T.StructField("seeds", T.ArrayType(T.LongType())),
        T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("kind", T.IntegerType())])
    schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in shape.fields])

    def run(batches):
        iid = TaskContext.get().partitionId() << 40
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = _block([t]).hashes()
                n = len(h)
                if not n:
                    continue
                if n == 1:
                    seeds, starts = _grams(h, 1), np.zeros(1, np.int64)
                elif n == 2:
                    seeds, starts = _pair(h[:1], h[1:]), np.zeros(1, np.int64)
                else:
                    seeds = np.concatenate([_pair(h[:-1], h[1:]), _pair(h[:-2], h[2:])])
                    starts = np.concatenate([np.arange(n - 1), np.arange(n - 2)])
                rows.append((iid, i, h.tobytes(), n, seeds.view(np.int64).tolist(), starts.tolist(), n.bit_length()))
                iid += 1
            yield pa.record_batch([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    ship_package(items.sparkSession)
    return items.select("item_id", F.col("text").cast("string")).where("item_id is not null").distinct().mapInArrow(run, shape)


def bloom(table: DataFrame) -> bytes:
    """The seeds' Bloom filter, merged in a tree of tasks; its size is fixed."""
    def fill(batches):
        bits = np.zeros(1 << FILTER_BITS, bool)
        for b in batches:
            g = np.array([s for row in b.column(0).to_pylist() for s in row], np.int64).view(np.uint64)
            for s in _slots(g):
                bits[s] = True
        yield pa.record_batch([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])

    def either(x, y):
        return (np.frombuffer(x, np.uint8) | np.frombuffer(y, np.uint8)).tobytes()

    return table.select("seeds").mapInArrow(fill, "bits binary").rdd.map(lambda r: bytes(r.bits)).treeReduce(either)


def _in(bits: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Which seeds the (packed) filter lets through."""
    x, y = _slots(g)
    return ((bits[x >> 3] >> (7 - (x & 7)).astype(np.uint8)) & (bits[y >> 3] >> (7 - (y & 7)).astype(np.uint8)) & 1).astype(bool)


def _met(h: np.ndarray, doc: np.ndarray, filters: dict):
    """{kind: (starts, seeds)} of the seeds of a word sequence that its filter
    lets through, by start."""
    found: dict = {kind: [] for kind in filters}
    for at in range(0, len(h), SPAN):
        a, own = h[at:at + SPAN], doc[at:at + SPAN]
        for step in (1, 2):
            b, other = h[at + step:at + step + len(a)], doc[at + step:at + step + len(a)]
            g = _pair(a[:len(b)], b)
            same = own[:len(b)] == other
            for kind, bits in filters.items():
                if kind > 1:
                    k = np.flatnonzero(same & _in(bits, g))
                    found[kind].append((k + at, g[k]))
        if 1 in filters:
            g = _grams(a, 1)
            k = np.flatnonzero(_in(filters[1], g))
            found[1].append((k + at, g[k]))
    out = {}
    for kind, parts in found.items():
        s, g = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        order = np.argsort(s, kind="stable")
        out[kind] = (s[order], g[order])
    return out


def _read(batch):
    """Groups of a batch's texts: (first row, word hashes, text of each word,
    words per text)."""
    at = 0
    texts = ((t.as_py() or "").lower().encode("utf-8", "replace") for t in batch.column(1))
    for part in grouped(texts, lambda t: len(t) + 1, BYTES):
        _, _, h, n = located_words(part, separators=_BREAKS)
        yield at, h, np.repeat(np.arange(len(part), dtype=np.int32), n), n
        at += len(part)


def seed_counts(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(seed, met): how often the documents hold each seed of the items, summed
    within a task before the shuffle (a few seeds that no item has come too)."""
    bits = bloom(table)
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    schema = pa.schema([("seed", pa.int64()), ("met", pa.int64())])

    def summed(parts):
        g, n = (np.concatenate(c) for c in zip(*parts))
        seeds, where = np.unique(g, return_inverse=True)
        return seeds, np.bincount(where, n).astype(np.int64)

    def out(parts):
        seeds, n = summed(parts)
        return pa.record_batch([pa.array(seeds.view(np.int64)), pa.array(n)], schema=schema)

    def run(batches):
        every = np.frombuffer(shared.value, np.uint8)
        parts, size = [], 0
        for batch in batches:
            for _, h, doc, _ in _read(batch):
                met = [g for _, g in _met(h, doc, {1: every, 2: every}).values()]
                seeds, n = np.unique(np.concatenate(met), return_counts=True)
                parts.append((seeds, n))
                size += len(seeds)
                if size > 1 << 19:
                    parts = [summed(parts)]
                    size = len(parts[0][0])
                    if size > 1 << 18:
                        yield out(parts)
                        parts, size = [], 0
        if parts:
            yield out(parts)

    ship_package(docs.sparkSession)
    return (docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, "seed long, met long")
            .groupBy("seed").agg(F.sum("met").alias("met")))


def rare_seeds(table: DataFrame, met: DataFrame, threshold: float) -> DataFrame:
    """(iid, kind, seed, first): the seeds of each item's starts without the
    dearest ones, and whether they are among the rarest n - T."""
    seeds = table.select("iid", "n", "kind", F.explode(F.arrays_zip("seeds", "starts")).alias("s")).select(
        "iid", "n", "kind", F.col("s.seeds").alias("seed"), F.col("s.starts").alias("start"))
    held = seeds.groupBy("seed").agg(F.countDistinct("iid").alias("items"))
    price = held.join(met, "seed", "left").select("seed", (F.col("items") * F.coalesce("met", F.lit(0))).alias("price"))
    starts = seeds.join(price, "seed").groupBy("iid", "n", "start").agg(F.sum("price").alias("price"))
    rank = F.row_number().over(Window.partitionBy("iid").orderBy("price", "start"))   # an item's words
    ranked = starts.select("iid", "start", "n", rank.alias("rank"))
    t = F.greatest(F.ceil(F.col("n") * threshold - 1e-9) - 1, F.lit(0))
    spare = F.greatest(t - F.greatest(F.floor((t + 1) / 2), F.lit(1)), F.lit(0))
    n_starts = F.greatest(F.col("n") - 1, F.lit(1))
    kept = ranked.where(F.col("rank") <= n_starts - spare).select(
        "iid", "start", (F.col("rank") <= n_starts - F.greatest(t - 1, F.lit(0))).alias("first"))
    return (seeds.join(kept, ["iid", "start"]).groupBy("iid", "kind", "seed").agg(F.max("first").alias("first")))


def passages(docs: DataFrame, filters: dict, threshold: float, longest: dict) -> DataFrame:
    """(pid, doc_id, first, words, seeds) around places where enough seeds of a
    class of items begin.  ``filters`` and ``longest`` words by class."""
    kind = id_type(docs)
    schema = pa.schema([("pid", pa.int64()), ("doc_id", arrow_type(kind)), ("first", pa.int64()), ("words", pa.binary()),
                        ("seeds", pa.list_(pa.int64()))])
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    reach = {k: int(np.ceil((3 - 2 * threshold) * n)) + 2 for k, n in longest.items()}
    least = {k: int(needed(1 << (k - 1), threshold)[1]) for k in filters}    # the class's shortest items have 2**(k-1) words
    most = 8 * max(reach.values())

    def enough(s, own, r, span):
        """Which of the ascending starts lie in r of one text within a span."""
        hit = np.zeros(len(s) + 1, np.int64)
        k = np.arange(len(s) - r + 1)
        k = k[(s[k + r - 1] - s[k] < span) & (own[k] == own[k + r - 1])] if len(k) else k
        np.add.at(hit, k, 1)
        np.add.at(hit, k + r, -1)
        return np.cumsum(hit[:-1]) > 0

    def run(batches):
        bits = {k: np.frombuffer(v, np.uint8) for k, v in shared.value.items()}
        pid = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for row, h, doc, n in _read(batch):
                begin = np.cumsum(n) - n
                parts = []
                for k, (s, g) in _met(h, doc, bits).items():
                    new = np.ones(len(s), bool)
                    new[1:] = s[1:] != s[:-1]        # a start counts once, whatever its seeds
                    at = s[new]
                    ok = np.repeat(enough(at, doc[at], least[k], reach[k]), np.diff(np.append(np.flatnonzero(new), len(s))))
                    s, g = s[ok], g[ok]
                    d = doc[s]
                    parts.append((s, g, np.maximum(s - reach[k], begin[d]), np.minimum(s + 2 + reach[k], begin[d] + n[d])))
                s, g, low, high = (np.concatenate(c) for c in zip(*parts))
                if not len(s):
                    continue
                order = np.lexsort((g, s, low))
                s, g, low, high = s[order], g[order], low[order], high[order]
                new = np.ones(len(s), bool)
                new[1:] = (low[1:] > np.maximum.accumulate(high)[:-1]) | (doc[s[1:]] != doc[s[:-1]])
                first = np.flatnonzero(new)
                tops = np.maximum.reduceat(high, first)
                for a, z, top in zip(first, np.append(first[1:], len(s)), tops):
                    d, bottom = doc[s[a]], int(low[a])
                    for cut in range(bottom, max(bottom + 1, int(top) - most // 4), most * 3 // 4):
                        end = min(cut + most, int(top))
                        mine = g[a:z][(s[a:z] >= cut) & (s[a:z] < end)]
                        if len(mine):
                            rows.append((pid, batch.column(0)[row + d].as_py(), int(cut - begin[d]), h[cut:end].tobytes(),
                                         np.unique(mine).view(np.int64).tolist()))
                            pid += 1
            yield pa.record_batch([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    ship_package(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, T.StructType([T.StructField("pid", T.LongType()), T.StructField("doc_id", kind),
                           T.StructField("first", T.LongType()), T.StructField("words", T.BinaryType()),
                           T.StructField("seeds", T.ArrayType(T.LongType()))]))


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """(best local alignment score, word after its end in the passage)."""
    n = len(passage)
    steps = -GAP * np.arange(n + 1)
    above = np.zeros(n + 1, np.int64)
    best, end = 0, 0
    for w in item:
        here = np.zeros(n + 1, np.int64)
        here[1:] = above[:-1] + np.where(passage == w, MATCH, MISMATCH)
        np.maximum(here, above + GAP, out=here)
        here[0] = 0
        np.maximum(here, 0, out=here)
        # a gap along the passage: the best earlier cell less the steps since
        here = np.maximum.accumulate(here + steps) - steps
        k = int(here.argmax())
        if here[k] > best:
            best, end = int(here[k]), k
        above = here
    return best, end


def find(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, end_word): documents that contain a copy or an
    edited copy of an item, with the best score per pair.

    ``end_word`` is the place in the document, in words, after the best
    alignment.  Every pair whose best alignment reaches the threshold is found if
    threshold times the item's words is over 1; a shorter item (one or two words)
    is sought as its whole word sequence.  Null or empty texts and items without
    words match nothing.  Rows without a doc_id or item_id are left out; repeated
    rows count once; other columns are not carried.
    """
    table = stored(items_table(items, threshold), "items")
    kinds = table.groupBy("kind").agg(F.max("n").alias("n")).collect()      # at most one row per bit of a length
    if not kinds:
        t, u = docs.schema["doc_id"].dataType.simpleString(), table.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {t}, item_id {u}, score double, end_word long")
    named = docs.where("doc_id is not null")
    rare = stored(rare_seeds(table, seed_counts(named, table), threshold), "rare-seeds")
    filters = {r["kind"]: bloom(rare.where(F.col("kind") == r["kind"]).select(F.array("seed").alias("seeds"))) for r in kinds}
    found = stored(passages(named, filters, threshold, {r["kind"]: r["n"] for r in kinds}), "passages")
    met = found.select("pid", F.explode("seeds").alias("seed"))
    pairs = met.join(rare.where("first").select("iid", "seed"), "seed").select("pid", "iid").distinct()
    work = (pairs.join(found.select("pid", "doc_id", "first", "words"), "pid")
            .join(table.select("iid", "item_id", "item_words"), "iid")
            .select("doc_id", "item_id", "first", "words", "item_words"))
    shape = T.StructType([work.schema["doc_id"], work.schema["item_id"], T.StructField("score", T.DoubleType()),
                          T.StructField("end_word", T.LongType())])
    schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in shape.fields])

    def run(batches):
        for b in batches:
            score, end = [], []
            for first, p, i in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()):
                passage, item = np.frombuffer(p, np.uint64), np.frombuffer(i, np.uint64)
                s, e = MATCH * int(np.isin(item, passage).sum()), 0     # no alignment scores more
                if s / (MATCH * len(item)) >= threshold:
                    s, e = align(passage, item)
                score.append(s / (MATCH * len(item)))
                end.append(first + e)
            yield pa.record_batch([b.column(0).cast(schema.field(0).type), b.column(1).cast(schema.field(1).type),
                                   pa.array(score, pa.float64()), pa.array(end, pa.int64())], schema=schema)

    return (work.mapInArrow(run, shape).where(F.col("score") >= threshold)
            .groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "end_word")).alias("best"))
            .select("doc_id", "item_id", "best.score", "best.end_word"))
