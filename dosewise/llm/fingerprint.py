"""Quartile bucket digests of documents, and their likeness to an edited copy
and to the next document.

A digest counts hashed byte triplets (three patterns within four bytes) in
``BUCKETS`` buckets and writes, per bucket, which quartile of all bucket counts
its count lies in, after a header with the logarithm of the length and the
ratios of the quartiles.  The difference of two digests sums a penalty per
bucket (0, 1, 2 or 6) and a bounded one for the header; likeness is 1 less the
difference over that of unrelated digests, not below 0.

The next document in id order is found without a global sort in one task:
documents are dealt into buckets of the id range (bounds from a quantile sketch
of numbers, from a sample of other ids; rows without an id by a hash of their
text), buckets go to tasks in order, each is sorted, and the first document of
each bucket is sent to the bucket before it as well.  Texts cross the network
once, compressed.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewise.llm.common import arrow_type, id_type
from dosewise.operators.relational import sample_n
from dosewise.session import ship_package

BUCKETS = 256
PATTERNS = [(1, 2), (1, 3), (2, 3)]   # offsets of the second and third byte
PENALTY = np.array([0, 1, 2, 6])
UNRELATED = 1.625 * BUCKETS            # mean penalty of independent digests
HEADER_MOST = 24                       # most that the header can add
PER_TASK, MOST_BUCKETS = 8, 32768      # id buckets per input partition, and in all (a bucket streams)
SAMPLED = 20                           # ids sampled per bucket where they are no numbers
CHUNK = 1 << 20


def _permutation() -> np.ndarray:
    """A fixed permutation of the bytes."""
    x, out = 1, []
    while len(out) < 256:
        x = (x * 1103515245 + 12345) % (1 << 31)
        if (v := x >> 16 & 255) not in out:
            out.append(v)
    return np.array(out, np.uint8)


_MIX = _permutation()
_PAIR = []
for _salt in range(len(PATTERNS)):
    _a = _MIX[np.arange(256) ^ (17 * _salt + 3)]
    _PAIR.append(_MIX[_a[:, None] ^ np.arange(256, dtype=np.uint8)[None, :]].ravel())


def counts(data: bytes) -> np.ndarray:
    """Triplets per bucket."""
    out = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(1, len(data) - 1), CHUNK):
        d = np.frombuffer(data[at:at + CHUNK + 3], np.uint8)
        for (i, j), pair in zip(PATTERNS, _PAIR):
            m = min(len(d) - j, CHUNK)
            if m > 0:
                h = _MIX[pair[d[:m].astype(np.uint16) << 8 | d[i:i + m]] ^ d[j:j + m]]
                out += np.bincount(h, minlength=BUCKETS)
    return out


def digest(data: bytes) -> str:
    """Hexadecimal digest: length code (2), quartile ratios (2), bucket codes."""
    c = counts(data)
    q1, q2, q3 = np.sort(c)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (c > q1).astype(np.uint8) + (c > q2) + (c > q3)
    length = min(255, int(round(12 * np.log1p(len(data)) / np.log(2)))) if data else 0
    ratio = [int(15 * q // max(q3, 1)) for q in (q1, q2)]
    packed = codes[0::4] << 6 | codes[1::4] << 4 | codes[2::4] << 2 | codes[3::4]
    return bytes([length, ratio[0] << 4 | ratio[1]]).hex() + packed.astype(np.uint8).tobytes().hex()


def likeness(a: str, b: str) -> float:
    """1 for equal digests, about 0 for unrelated ones."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint8).astype(np.int64) for s in (a, b))
    header = min(HEADER_MOST, abs(x[0] - y[0]) // 2 + abs((x[1] >> 4) - (y[1] >> 4)) + abs((x[1] & 15) - (y[1] & 15)))
    shifts = np.array([6, 4, 2, 0])
    codes = [(v[2:, None] >> shifts & 3).ravel() for v in (x, y)]
    d = PENALTY[np.abs(codes[0] - codes[1])].sum() + header
    return float(max(0.0, 1 - d / (UNRELATED + HEADER_MOST)))


def edited(text: str, following: str) -> str:
    """The last quarter of a text's code points replaced by the first as many of
    the following text."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def compare(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next), one row per row of ``docs``.

    The next document is the next row by doc_id (a number, text, day or time, in
    the order of its type; equal ids in a fixed order of their texts), after the
    last row the first.  Rows without an id come first, by a hash of their text.
    A null text is an empty one, with the digest of no triplets.  Other columns
    are not carried.
    """
    import zstandard

    kind = id_type(docs)
    numeric = isinstance(kind, T.NumericType)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select("doc_id", text.alias("text"), F.when(F.col("doc_id").isNull(), F.xxhash64(text)).alias("h"))
    tasks = max(1, base.rdd.getNumPartitions())
    n = min(tasks * PER_TASK, MOST_BUCKETS)
    bits = max(1, (n - 1).bit_length())
    half = 1 << bits - 1
    if n == 1:
        edges = []
    elif numeric:
        ids = docs.select(F.col("doc_id").cast("double").alias("x"))
        edges = sorted(set(ids.approxQuantile("x", [k / n for k in range(1, n)], 0.25 / n)))
    else:
        ids = docs.select(F.col("doc_id").cast("string").alias("x")).where("x IS NOT NULL")
        some = sorted(r.x for r in sample_n(ids, ["x"], SAMPLED * n).collect())
        edges = sorted({some[k * len(some) // n] for k in range(1, n)}) if some else []

    def place(doc_id, h) -> int:
        if doc_id is None:
            return (h >> 64 - bits) - half      # -2 * half .. -1
        return bisect_right(edges, float(doc_id) if numeric else str(doc_id))

    least_schema = pa.schema([("bucket", pa.int64()), ("least", arrow_type(kind))])

    def least(batches):
        found: dict = {}
        for b in batches:
            col = b.column(0)
            values = col.to_pylist()
            if numeric:
                where = np.searchsorted(edges, np.array([float(v) for v in values]), side="right")
            else:
                where = np.array([place(v, None) for v in values], int)
            for k in np.unique(where):
                v = min(values[j] for j in np.flatnonzero(where == k))
                if k not in found or v < found[k]:
                    found[int(k)] = v
        yield pa.record_batch([pa.array(list(found), pa.int64()), pa.array(list(found.values()), arrow_type(kind))],
                              schema=least_schema)

    ship_package(docs.sparkSession)
    # one row per bucket: its least id, or its least hash
    firsts = dict(tuple(r) for r in base.select("doc_id").where("doc_id IS NOT NULL").mapInArrow(
        least, T.StructType([T.StructField("bucket", T.LongType()), T.StructField("least", kind)]))
        .groupBy("bucket").agg(F.min("least")).collect())
    firsts |= dict(tuple(r) for r in base.where("doc_id IS NULL").groupBy(
        (F.shiftright("h", 64 - bits) - half).alias("bucket")).agg(F.min("h")).collect())
    known = sorted(firsts)
    before = {b: known[k - 1] for k, b in enumerate(known)}   # the first bucket follows the last
    task = {b: k * tasks // len(known) for k, b in enumerate(known)}

    sent = T.StructType([T.StructField("task", T.IntegerType()), T.StructField("bucket", T.LongType()),
                         T.StructField("next_only", T.BooleanType()), T.StructField("doc_id", kind),
                         T.StructField("h", T.LongType()), T.StructField("packed", T.BinaryType()),
                         T.StructField("print", T.StringType())])
    sent_schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in sent.fields])

    def deal(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            rows = []
            for i, t, h in zip(*(c.to_pylist() for c in b.columns)):
                data = t.encode("utf-8", "replace")
                k = place(i, h)
                row = (i, h, pack.compress(data), digest(data))
                rows.append((task[k], k, False, *row))
                if firsts[k] == (h if i is None else i):
                    rows.append((task[before[k]], before[k], True, *row))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), sent_schema)] if rows else
                                  [pa.array([], f.type) for f in sent_schema], schema=sent_schema)

    shape = T.StructType([T.StructField("doc_id", kind), T.StructField("n_chars", T.LongType())]
                         + [T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
                         + [T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")])
    schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in shape.fields])

    def pair(batches):
        unpack = zstandard.ZstdDecompressor()
        last = None    # (bucket, doc_id, text, print) waiting for its next document
        for b in batches:
            out = []
            for _, bucket, next_only, i, _, z, mark in zip(*(c.to_pylist() for c in b.columns)):
                if next_only and (last is None or last[0] != bucket):
                    continue
                text = unpack.decompress(z).decode() if z else ""
                if last is not None and last[0] == bucket:
                    new = edited(last[2], text).encode()
                    stamp = digest(new)
                    out.append((last[1], len(last[2]), hashlib.sha256(new).hexdigest(), last[3], stamp,
                                likeness(last[3], stamp), likeness(last[3], mark)))
                last = None if next_only else (bucket, i, text, mark)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else
                                  [pa.array([], f.type) for f in schema], schema=schema)

    # a bucket's rows in order, then the first row of the bucket after it
    return (base.mapInArrow(deal, sent).repartitionById(tasks, F.col("task"))
            .sortWithinPartitions("bucket", "next_only", F.col("doc_id").asc_nulls_first(), "h", "packed")
            .mapInArrow(pair, shape))
