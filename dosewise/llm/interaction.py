"""Filter interaction audit: what each filter of a chain removes, in every order
of the chain, from one small table of counts.

Every document passes or fails each of F filters, so it falls into one of 2**F
cells.  The documents of a part (say, a source) are counted per cell once; the
counts of a part, reshaped to a 2 x 2 x ... x 2 tensor, answer every question
about any order: a step of an order sums the tensor over "pass" along the axes
of the filters before it, "fail" along its own and "all" along the later ones.
``contracted`` does so for all F! orders and their steps in one einsum.

Scale: one narrow pass over the texts gives each document its four text filters
and a 16-byte digest of the text; only these small rows are shuffled.  The
smallest id of every digest comes from a ``min`` combined before the shuffle, and
joins back on (digest, id), so a group of copies with a third of all rows is
dealt by the ids of its rows.  The counts are at most parts x 2**F x 2 rows, and
tensors are contracted part by part on the executors.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewise.llm.blocks import grouped, located_words
from dosewise.llm.common import arrow_type, each_bytes, id_type
from dosewise.session import ship_package, stored

FILTERS = "ABCDE"
WORDS, DISTINCT, CAPITALS, SIGNS = 50, 65, 5, b"#$%&*|"   # the text filters' limits
BYTES = 1 << 19
MEASURES = ("n", "good", "toxic")

_SIGN = np.zeros(256, bool)
_SIGN[list(SIGNS)] = True


def text_failures(texts: list[bytes]) -> np.ndarray:
    """Per text, the bits of the text filters that it fails (A is the lowest)."""
    start, _, h, n = located_words(texts)
    doc = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = np.bincount(doc[order][new], minlength=len(texts))
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])

    def per_text(hit):
        at = np.flatnonzero(hit)
        return np.diff(np.searchsorted(at, edges))

    points = per_text((data & 0xC0) != 0x80) - 1            # less the line feed after each
    capitals = per_text((data >= 0x41) & (data <= 0x5A))
    signs = per_text(_SIGN[data])
    return ((n < WORDS) * 1 + (100 * distinct < DISTINCT * n) * 2 + (100 * capitals > CAPITALS * points) * 4
            + (signs > 0) * 8).astype(np.int32)


def tested(docs: DataFrame, part: str) -> DataFrame:
    """(doc_id, part, fails: bits of the text filters, digest) of every row."""
    kind = id_type(docs)
    shape = T.StructType([T.StructField("doc_id", kind), T.StructField("part", T.StringType()),
                          T.StructField("fails", T.IntegerType()), T.StructField("digest", T.BinaryType())])
    schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in shape.fields])

    def run(batches):
        for b in batches:
            at = 0
            for texts in grouped(each_bytes(b.column(2)), lambda t: len(t) + 1, BYTES):
                ids, parts = (b.column(k).slice(at, len(texts)).cast(schema.field(k).type) for k in (0, 1))
                at += len(texts)
                yield pa.record_batch([ids, parts, pa.array(text_failures(texts)), pa.array(
                    [hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary())], schema=schema)

    ship_package(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                       F.col("text").cast("string")).mapInArrow(run, shape)


def cells(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, cell, n, good, toxic): documents per part and combination of failed
    filters (bit k set: filter k of ``FILTERS`` failed), cells without any left out."""
    rows = stored(tested(docs, part), "tested")
    known = rows.where("doc_id is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    mark = (labels.where("doc_id is not null and (quality = 1 or toxic = 1)")
            .groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                                   F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    # one row for equal (id, text, part): the same id twice is no smaller id
    counted = known.groupBy("doc_id", "digest", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    copy = counted.join(first.withColumn("first", F.lit(True)), ["doc_id", "digest"], "left")
    marked = copy.join(mark, "doc_id", "left").select(
        "part", (F.col("fails") + F.when(F.col("first").isNull(), 16).otherwise(0)).alias("cell"), "n",
        (F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    nameless = rows.where("doc_id is null").select("part", F.col("fails").alias("cell"), F.lit(1).cast("long").alias("n"),
                                                   F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    return marked.unionByName(nameless).groupBy("part", "cell").agg(*[F.sum(c).alias(c) for c in MEASURES])


def contracted(tensor: np.ndarray) -> dict[str, np.ndarray]:
    """All steps of all orders of one part.

    ``tensor``: counts of shape (2,) * F + (measures), index 1 failing.  Every
    result has a row per order (as ``permutations`` gives them) and step.
    """
    size = tensor.ndim - 1
    orders = np.array(list(permutations(range(size))))
    place = np.argsort(orders, axis=1)                      # step of each filter
    step = np.arange(size)
    before = place[:, None, :] < step[None, :, None]        # (order, step, axis)
    own = place[:, None, :] == step[None, :, None]
    passing, failing, all_ = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])

    def pick(*rules):
        out = np.broadcast_to(all_, before.shape + (2,)).copy()
        for where, what in rules:
            out[where] = what
        return out

    axes = list(range(size))

    def sums(select, counts):
        """Contract every axis of the counts with its selector, row by row."""
        args = [counts, [*axes, size]]
        for k in axes:
            args += [select[:, :, k, :], [size + 1, size + 2, k]]
        return np.einsum(*args, [size + 1, size + 2, size], optimize=True)

    removed = sums(pick((before, passing), (own, failing)), tensor)
    kept = sums(pick((before, passing), (own, passing)), tensor)[..., 0]
    failed = sums(pick((own, failing)), tensor)[..., 0]
    alone = sums(pick((~own, passing), (own, failing)), tensor)[..., 0]
    by_filter = np.zeros(size, np.int64)
    np.add.at(by_filter, orders.ravel(), removed[..., 0].ravel())
    return {"kept": kept, "removed": removed[..., 0], "redundant": failed - removed[..., 0], "unique_fails": alone,
            "good_lost": removed[..., 1], "toxic_lost": removed[..., 2], "shapley": by_filter[orders]}


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley): a row per part, order and step.

    A filter fails a document with A fewer than 50 words, B distinct words below
    65 % of all, C A-Z over 5 % of the code points, D a sign of ``#$%&*|``, E a
    text that a smaller doc_id has too, anywhere in the table.  Null texts are
    empty; null parts count as the empty string; a row without an id is no copy
    and has no label; rows with the same id and text are no copies of each other,
    and each counts; an id with several labels has a label's 1 if any row has it.
    Other columns of either table play no part.  No row of ``docs``, no result.
    """
    table = cells(docs, labels, part)
    per_part = table.groupBy("part").agg(F.collect_list(F.struct("cell", *MEASURES)).alias("cells"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    shape = T.StructType([T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
                          T.StructField("step", T.IntegerType())] + [T.StructField(c, T.LongType()) for c in names])
    schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in shape.fields])
    size = len(FILTERS)
    order_names = ["".join(p) for p in permutations(FILTERS)]

    def run(batches):
        for b in batches:
            for name, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                flat = np.zeros((2 ** size, len(MEASURES)), np.int64)
                for c in found:
                    flat[c["cell"]] = [c[m] for m in MEASURES]
                # the lowest bit is filter A, which is to be the first axis
                tensor = flat.reshape((2,) * size + (-1,)).transpose(*reversed(range(size)), size)
                out = contracted(tensor)
                rows = len(order_names) * size
                yield pa.record_batch(
                    [pa.array([name] * rows), pa.array(np.repeat(order_names, size).tolist()),
                     pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(order_names)))]
                    + [pa.array(out[c].ravel().astype(np.int64)) for c in names], schema=schema)

    return per_part.mapInArrow(run, shape)
