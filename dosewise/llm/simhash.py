"""SimHash near-duplicates with a pigeonring candidate filter.

A fingerprint bit is the majority of that bit over the XXH64 hashes of all
word shingles.  Two fingerprints link at ``max_bits`` or fewer differing bits.

Candidates: the 64 bits are cut into m = max_bits + 2 segments on a ring.
Spread over a ring, at most ``max_bits`` differences leave a start from which
every chain of l consecutive segments holds at most floor(l * max_bits / m) of
them (the pigeonring principle; the plain pigeonhole principle is its l = 1).
For the first segments that budget leaves two segments of the chain without a
difference, so pairs of equal segments are the join key; a pair that shares a
key must then satisfy the whole chain of budgets from some start before its
full Hamming distance is taken.

Scale: equal fingerprints are merged first (a partial ``min``), keys that only
one fingerprint has are dropped by a counted join, and a key with many
fingerprints is cut into blocks so that no task holds more than two blocks.
A block pair reports only the links that first connect two of its groups (a
spanning forest), never all pairs.  Nothing is capped.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewise.llm.common import arrow_type, each_bytes, free_name, id_type, popcount, words
from dosewise.llm.components import components
from dosewise.session import ship_package, stored

SEED = 42
BLOCK = 2048   # fingerprints of one key in one block
HASHES = 8192  # hashes whose bits are counted at a time


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text (0 without words)."""
    import xxhash

    digest, counts, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    tail: list = []
    for w in words(text):
        w = tail + w
        tail = w[max(0, len(w) - shingle + 1):] if shingle > 1 else []
        if len(w) < shingle:
            continue
        grams = zip(*(w[k:] for k in range(shingle)))
        hashes = [digest(b" ".join(g), SEED) for g in grams]
        for at in range(0, len(hashes), HASHES):
            h = np.array(hashes[at:at + HASHES], np.uint64)
            counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    if not total:
        if not tail:
            return 0
        h, total = np.array([digest(b" ".join(tail), SEED)], np.uint64), 1
        counts += np.unpackbits(h.view(np.uint8), bitorder="little")
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """(doc_id, fp long) for every row; a null text counts as empty."""
    kind = id_type(docs)
    schema = pa.schema([("doc_id", arrow_type(kind)), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in each_bytes(b.column(1))], np.uint64).view(np.int64)
            yield pa.record_batch([b.column(0).cast(schema.field(0).type), pa.array(fps)], schema=schema)

    ship_package(docs.sparkSession)
    return docs.select("doc_id", F.col(text).cast("string")).mapInArrow(
        run, T.StructType([T.StructField("doc_id", kind), T.StructField("fp", T.LongType())]))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ring's segments."""
    m = max_bits + 2
    cuts = [round(64 * k / m) for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def chain_ok(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether differences ``x`` (xor of two fingerprints) meet the budgets of a
    chain of consecutive segments from some start."""
    seg = segments(max_bits)
    m = len(seg)
    d = [popcount((x >> np.uint64(a)) & np.uint64((1 << w) - 1)) for a, w in seg]
    found = np.zeros(x.shape, bool)
    for start in range(m):
        total, ok = d[start].astype(np.int16), d[start] == 0
        for length in range(2, m + 1):
            total = total + d[(start + length - 1) % m]
            ok &= total <= length * max_bits // m
        found |= ok
    return found


def forest(a: np.ndarray, b: np.ndarray | None, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect the distinct fingerprints of ``a`` (and of ``b``, if
    given, across the two): a spanning forest of all links between them."""
    every = a if b is None else np.concatenate([a, b])
    other = a if b is None else b
    shift = 0 if b is None else len(a)
    label, out = np.arange(len(every)), []
    rows = max(1, (1 << 19) // max(1, len(other)))
    for at in range(0, len(a), rows):
        x = a[at:at + rows, None] ^ other[None, :]
        near = chain_ok(x, max_bits)
        near &= popcount(x) <= max_bits
        for r in np.nonzero(near.any(axis=1))[0]:
            i = at + r
            js = np.nonzero(near[r])[0] + shift
            got, first = np.unique(label[js], return_index=True)
            for l, f in zip(got, first):
                if l != label[i]:
                    out.append((int(every[i]), int(every[js[f]])))
            if len(out) and len(got):
                low = min(int(got[0]), int(label[i]))
                label[np.isin(label, np.append(got, label[i]))] = low
    return out


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """``fps`` (fp, distinct) -> (a, b): links between fingerprints, enough of
    them to connect everything that is linked."""
    seg = segments(max_bits)
    part = [F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << w) - 1)) for a, w in seg]
    keys = F.array(*[F.struct(F.lit(k).cast("byte").alias("pair"),
                              F.shiftleft(part[i], seg[j][1]).bitwiseOR(part[j]).alias("value"))
                     for k, (i, j) in enumerate(combinations(range(len(seg)), 2))])
    keyed = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.pair", "k.value")
    crowd = keyed.groupBy("pair", "value").agg(F.count("*").alias("n")).where("n > 1")
    n = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp", "pair"), F.col("blocks")).cast("int")
    both = (keyed.join(crowd, ["pair", "value"]).withColumn("blocks", n).withColumn("mine", mine)
            .select("fp", "pair", "value", "mine",
                    F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            .select("pair", "value", "fp", F.least("mine", "other").alias("i"),
                    F.greatest("mine", "other").alias("j"), "mine"))
    sets = (both.groupBy("pair", "value", "i", "j")
            .agg(F.collect_list(F.when(F.col("mine") == F.col("i"), F.col("fp"))).alias("left"),
                 F.collect_list(F.when(F.col("mine") != F.col("i"), F.col("fp"))).alias("right"))
            .where("size(left) > 0 and (size(right) > 0 or (i = j and size(left) > 1))")
            .select("left", "right"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            out = []
            for x, y in zip(batch.column(0), batch.column(1)):
                a = np.sort(np.array(x.as_py(), np.int64)).view(np.uint64)
                y = y.as_py()
                b = np.sort(np.array(y, np.int64)).view(np.uint64) if y else None
                out += forest(a, b, max_bits)
            if out:
                ends = np.array(out, np.uint64).view(np.int64)
                yield pa.record_batch([pa.array(ends[:, 0]), pa.array(ends[:, 1])], schema=schema)

    ship_package(fps.sparkSession)
    return sets.mapInArrow(run, "a long, b long")


def grouped_fingerprints(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fps`` (doc_id, fp) -> (fp, root): the smallest fingerprint reachable,
    and (component_id) the smallest doc_id of the whole component."""
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes.select("fp"), max_bits))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored(named.join(least, "root").select("fp", "root", "component_id"), "component")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, text: str = "text") -> DataFrame:
    """(doc_id, fp, fingerprint, component_id), one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links, the row's own
    included.  A null text is an empty one; empty texts share fingerprint 0 and
    so are linked.  Rows without an id take part; a component of such rows only
    has a null component_id.  Repeated rows are kept.  Other columns of
    ``docs`` are not carried.
    """
    fps = stored(fingerprints(docs, shingle, text), "fingerprints")
    return (fps.join(grouped_fingerprints(fps, max_bits), "fp")
            .select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def deduplicate(docs: DataFrame, shingle: int = 3, max_bits: int = 3, text: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each component: the one with the smallest
    doc_id (rows without an id last; any one of repeated rows).  All columns are
    carried as they are.

    The rows are written once with their fingerprint and a row number, so that
    the decision holds for exactly one row whatever the ids are.
    """
    fp, uid = free_name(docs, "fp"), free_name(docs, "uid")
    shape = T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType()), T.StructField(uid, T.LongType())])
    schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in shape.fields])
    at = docs.columns.index(text)

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in each_bytes(b.column(at))], np.uint64).view(np.int64)
            cols = [c.cast(f.type) for c, f in zip(b.columns, schema)]
            yield pa.record_batch([*cols, pa.array(fps), pa.array(row + np.arange(len(fps)))], schema=schema)
            row += len(fps)

    ship_package(docs.sparkSession)
    rows = stored(docs.mapInArrow(run, shape), "rows")
    marks = rows.select("doc_id", F.col(fp).alias("fp"), F.col(uid).alias("uid"))
    found = grouped_fingerprints(marks.select("doc_id", "fp"), max_bits)
    keep = stored(marks.join(found.select("fp", "root"), "fp").groupBy("root")
                  .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("first"))
                  .select(F.col("first.uid").alias(uid)), "keep")
    # always a sort-merge join: the rows move once at every size
    return rows.hint("merge").join(keep, uid, "left_semi").select(*docs.columns)
