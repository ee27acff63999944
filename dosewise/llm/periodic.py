"""Periodic runs of words: maximal stretches that repeat a short word sequence.

A run has smallest period q, at least ``factor`` periods and ``least`` words, and
no neighbouring word extends it.  They are found by seed and extend along the
diagonals (lags) of a text against itself:

1. A run of period q matches itself at lag q over at least
   g(q) = max(least, factor q) - q words in a row.  Periods are taken in classes
   [lo, hi] whose k = min g is at least hi, so every run of the class holds a
   k-gram that occurs again q words later, and since k >= q (and q is the smallest
   period) not earlier.  So the pairs of a k-gram's consecutive occurrences in
   one document are all that is needed: one pair for each word and class, not a
   square of occurrences.  k grows by the factor ``factor`` - 1 with each class,
   so a text of n words has about log n classes.
2. Pairs at a lag of the class are extended both ways, word by word.  A table
   holds, for each lag, how far its matches are known; seeds before that point
   are passed over, so a run is extended once however many seeds it has.
3. An extension of at least max(least, factor q) words is a run, and its smallest
   period is its lag: a smaller one would divide it and give nearer seeds.

Scale: documents are independent, so one narrow pass without a shuffle does it.
Short texts share numpy arrays; a long text is hashed in pieces and its k-grams
are sorted in blocks of positions, so memory is a few arrays of eight bytes a
word.  Words are compared by 64-bit hashes within one document.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewise.llm.blocks import grouped, located_words, mix
from dosewise.llm.common import arrow_type, each_bytes, id_type
from dosewise.session import ship_package

LEAST, FACTOR = 6, 4
BYTES = 1 << 19      # text in one array, unless a single text is longer
BLOCK = 1 << 20      # positions whose k-grams are sorted at a time
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def classes(longest: int, least: int = LEAST, factor: int = FACTOR):
    """(lo, hi, k): classes of periods that texts of ``longest`` words can have,
    with the length of their seeds."""
    if factor < 3:
        raise ValueError("a run has three periods or more")
    lo = 1
    while factor * lo <= longest and least <= longest:
        k = max(least, factor * lo) - lo
        hi = lo
        while hi < k and factor * hi < least:    # below it longer periods have shorter seeds
            k = min(k, max(least, factor * (hi + 1)) - hi - 1)
            hi += hi < k
        hi = max(hi, min(k, longest // factor))
        yield lo, hi, k
        lo = hi + 1


def _extended(w: np.ndarray, i: int, lag: int, begin: int, end: int) -> tuple[int, int]:
    """The matches w[j] == w[j + lag] around j = i, in the text begin..end."""
    lo, hi, step = i, i, 64
    top = end - lag
    while hi < top:
        to = min(hi + step, top)
        bad = np.flatnonzero(w[hi:to] != w[hi + lag:to + lag])
        if len(bad):
            hi += int(bad[0])
            break
        hi, step = to, min(2 * step, 1 << 16)
    step = 64
    while lo > begin:
        to = max(lo - step, begin)
        bad = np.flatnonzero(w[to:lo] != w[to + lag:lo + lag])
        if len(bad):
            lo = to + int(bad[-1]) + 1
            break
        lo, step = to, min(2 * step, 1 << 16)
    return lo, hi


def _pairs(gram: np.ndarray, at: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of consecutive occurrences of equal grams at places ``at``
    (ascending) whose lag lies in lo..hi, by lag, then place."""
    order = np.argsort(gram)
    g = gram[order]
    if len(g) == 0 or not (g[1:] == g[:-1]).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    group = np.zeros(len(g), np.int64)
    np.cumsum(g[1:] != g[:-1], out=group[1:])
    packed = np.sort(group << 32 | order)        # groups in order of place
    same = (packed[1:] >> 32) == (packed[:-1] >> 32)
    place = at[packed & 0xFFFFFFFF]
    lag = place[1:] - place[:-1]
    found = np.flatnonzero(same & (lag >= lo) & (lag <= hi))
    lag, place = lag[found], place[found]
    order = np.lexsort((place, lag))
    return lag[order], place[order]


def runs(w: np.ndarray, n_words: np.ndarray, least: int = LEAST, factor: int = FACTOR):
    """(text, start, length, period) arrays of all runs of texts whose word
    hashes stand one after another in ``w``, by text, start, period."""
    ends = np.cumsum(n_words)
    begins = ends - n_words
    text = np.repeat(np.arange(len(n_words), dtype=np.int32), n_words)
    found: list = []
    ladder, power = w, 1                         # hashes of grams of ``power`` words
    for lo, hi, k in classes(int(n_words.max(initial=0)), least, factor):
        while 2 * power <= k:
            up = ladder[:-power] if len(ladder) > power else ladder[:0]
            ladder = mix(up * _LEFT + ladder[power:] * _RIGHT)
            power *= 2
        able = n_words >= max(least, factor * lo)
        covered: dict = {}
        spots = np.flatnonzero(able)
        # blocks of places: all texts at once, or parts of a long one; each sees
        # as many places after it as the longest lag
        first, last = (int(begins[spots[0]]), int(ends[spots[-1]])) if len(spots) else (0, 0)
        for b in range(first, last, BLOCK):
            at = np.arange(b, min(b + BLOCK + hi, last - k + 1))
            if not len(at):
                break
            owner = text[at]
            at = at[able[owner] & (at + k <= ends[owner])]
            if not len(at):
                continue
            gram = mix(ladder[at] * _LEFT + ladder[at + (k - power)] * _RIGHT + text[at].astype(np.uint64) * _LEFT)
            lags, places = _pairs(gram, at, lo, hi)
            cuts = np.flatnonzero(np.diff(lags, prepend=-1))
            for s, e in zip(cuts, np.append(cuts[1:], len(lags))):
                lag, seeds, p = int(lags[s]), places[s:e], 0
                while p < len(seeds):
                    i = int(seeds[p])
                    known = covered.get(lag, -1)
                    if i < known:
                        p = int(np.searchsorted(seeds, known))
                        continue
                    d = int(text[i])
                    x, y = _extended(w, i, lag, int(begins[d]), int(ends[d]))
                    covered[lag] = max(y, i + 1)
                    if y - x + lag >= max(least, factor * lag):
                        found.append((d, x - int(begins[d]), y - x + lag, lag))
    out = np.array(sorted(set(found)), np.int64).reshape(-1, 4)
    return tuple(out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))].T)


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, step: int = 1 << 16) -> bytes:
    """The words at the given places, joined by one space."""
    parts = []
    for a in range(0, len(start), step):
        s, size = start[a:a + step], end[a:a + step] - start[a:a + step] + 1
        to = np.cumsum(size)
        index = np.arange(to[-1]) + np.repeat(s - (to - size), size)
        index[to - 1] = 0
        out = data[index]
        out[to - 1] = 0x20
        parts.append(out.tobytes())
    return b"".join(parts)[:-1]


def find(docs: DataFrame, least: int = LEAST, factor: int = FACTOR,
         order: Callable[[str, int], np.ndarray | None] | None = None) -> DataFrame:
    """(doc_id, n_words, runs: array of (start, length, period) by start and
    period, collapsed): one row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, case-sensitive.  ``collapsed`` is the text
    without the words that a run holds after its first period, joined by one
    space.  ``order`` (doc_id as text, number of words) may give the order in
    which a document's words are read, repeats included (None: as they stand).
    A null or empty text, and one of white space, has no word, no run and an
    empty ``collapsed``; rows without an id are never reordered; repeated rows
    each have their own row; other columns are not carried.
    """
    kind = id_type(docs)
    shape = T.StructType([
        T.StructField("doc_id", kind), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType())])
    schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in shape.fields])

    def group(ids, texts):
        start, end, h, n = located_words(texts)
        data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        begins = np.cumsum(n) - n
        moved = {}
        if order is not None:
            for d in range(len(texts)):
                if n[d] and ids[d].is_valid and (x := order(str(ids[d].as_py()), int(n[d]))) is not None:
                    moved[d] = x + begins[d]
        if moved:
            index = np.concatenate([moved.get(d, np.arange(begins[d], begins[d] + n[d])) for d in range(len(texts))])
            start, end, h = start[index], end[index], h[index]
            n = np.array([len(moved[d]) if d in moved else n[d] for d in range(len(texts))])
            begins = np.cumsum(n) - n
        text, at, length, period = runs(h, n, least, factor)
        per = np.bincount(text, minlength=len(texts))
        edge = np.zeros(len(h) + 1, np.int64)
        np.add.at(edge, begins[text] + at + period, 1)
        np.add.at(edge, begins[text] + at + length, -1)
        keep = np.cumsum(edge[:-1]) == 0
        collapsed = []
        for d, t in enumerate(texts):
            if per[d] or d in moved:
                mine = np.flatnonzero(keep[begins[d]:begins[d] + n[d]]) + begins[d]
                collapsed.append(_joined(data, start[mine], end[mine]))
            elif len(t) <= BYTES:
                collapsed.append(b" ".join(t.split()))
            else:
                collapsed.append(_joined(data, start[begins[d]:begins[d] + n[d]], end[begins[d]:begins[d] + n[d]]))
        offsets = pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32())
        spans = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (at, length, period)], fields=list(schema.field("runs").type.value_type))
        return pa.record_batch([ids, pa.array(n, pa.int64()),
                                pa.ListArray.from_arrays(offsets, spans).cast(schema.field("runs").type),
                                pa.array(collapsed, pa.binary()).cast(schema.field("collapsed").type)], schema=schema)

    def run(batches):
        for b in batches:
            at = 0
            for part in grouped(each_bytes(b.column(1)), lambda t: len(t) + 1, BYTES):
                yield group(b.column(0).slice(at, len(part)).cast(schema.field(0).type), part)
                at += len(part)

    ship_package(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, shape)
