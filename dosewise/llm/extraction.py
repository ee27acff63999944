"""Main text of web pages: declared articles, and what a host suffix array leaves
of the other blocks.

Markup gives evidence: text inside ``article`` or ``main`` is content, whole;
navigation, page headers and footers, asides, forms, scripts, styles, embedded
objects, adverts, notices and reader comments (by tag, or by a whole word of
class, id or role) are not, unless they hold an article.  Every other block is
open: outside an article, or in a container whose class only resembles noise
(``related-posts``).

The open words of a page are concatenated, and suffixes are grouped by host and
their first ``RUN`` words: a group with two distinct pages is a stretch of the
host's suffix array with common prefixes of at least ``RUN`` words, that is, a
long substring repeated across pages.  Open words covered by one are boilerplate
and go.  What stays is, on a page without an article, every other word; on a page
with one, the unique runs of at least ``RUN`` words (fewer words are too few to
outweigh the tag).  A page without article text that is covered almost wholly is
a copy of another page, not boilerplate, and stays whole.

(Repeated runs are not removed inside declared articles: articles of one host
quote and copy each other, and their text is wanted whole.)

Scale: the array holds every suffix of open blocks, and of the articles those
that a Bloom filter of the open ones lets through (any other could not make an
open run a repeated one).  "On two pages" is the least and the greatest page of a
group, which is combined before the shuffle, so a run on a third of all pages is
no hot group; a page's covered places are gathered per page.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewise.llm.blocks import Block, mix
from dosewise.llm.common import arrow_type
from dosewise.llm.decontaminate import _grams, _slots, bloom
from dosewise.session import ship_package, stored

RUN = 8          # words of a repeated substring
COPY = 0.9       # share of a page's open words beyond which it is a copy

# The roles of tags and of words in classes, ids and roles.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "canvas", "object",
       "select", "button", "audio", "video"}
CHROME = {"nav", "footer", "aside", "form", "dialog", "menu", "head"}
CONTENT = {"article", "main"}
BREAKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset",
          "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend",
          "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
          "thead", "tr", "ul"}
HOLDERS = {"div", "section", "ul", "ol", "p", "span", "header", "table", "li", "dl", "figure", "article", "ins"}
VOID = {"br", "hr", "img", "input", "link", "meta", "wbr", "area", "base", "col", "embed", "source", "track"}
NOISE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
         "comments", "consent", "cookie", "cookies", "disqus", "gdpr", "menu", "menubar", "modal", "nav", "navbar",
         "navigation", "newsletter", "notice", "notices", "popup", "promo", "promotion", "related", "respond", "share",
         "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "widget", "complementary", "contentinfo",
         "search", "dialog", "alert", "replies"}
OUTER_NOISE = {"header", "footer", "masthead"}   # noise outside an article only

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*+)>|<[/!?a-zA-Z][^>]*(?:>|\Z)",
                  re.S)
_ROLE = re.compile(r"""(?<![\w:-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_QUOTED = re.compile(r"""\"[^\"]*\"|'[^']*'""")
_HIDDEN = re.compile(r"(?<![\w:-])hidden(?=[\s=/]|$)", re.I)
_ARIA_HIDDEN = re.compile(r"""(?<![\w:-])aria-hidden\s*=\s*["']?true""", re.I)
_PARTS = re.compile(r"[^a-zA-Z]+")


def _noise(tag: str, attributes: str, inside: bool) -> int:
    """2: an element's class, id or role has a noise word, or it is hidden; 1: a
    part of a word is one, which leaves it in doubt; 0: neither."""
    if not attributes or tag not in HOLDERS:
        return 0
    words = [w.lower() for m in _ROLE.finditer(attributes) for w in (m[1] or m[2] or m[3] or "").split()]
    noise = NOISE if inside else NOISE | OUTER_NOISE
    if not noise.isdisjoint(words) or _ARIA_HIDDEN.search(attributes) or _HIDDEN.search(_QUOTED.sub('""', attributes)):
        return 2
    return int(any(not noise.isdisjoint(_PARTS.split(w)) for w in words))


def _raw_end(page: str, tag: str, at: int) -> int:
    """Where the content of a raw element ends: its end tag, or the page's end."""
    m = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
    return m.start() if m else len(page)


def _holding(page: str) -> set[int]:
    """Where the elements start that hold an article or main."""
    out: set[int] = set()
    open_: dict[str, list[int]] = {}
    at = 0
    while m := _TAG.search(page, at):
        at = m.end()
        tag = (m[2] or "").lower()
        if not m[1] and tag in CONTENT:
            for starts in open_.values():
                for start in reversed(starts):
                    if start in out:     # and so are those around it
                        break
                    out.add(start)
        if not m[1] and tag in RAW:
            if not m[3].endswith("/"):
                at = _raw_end(page, tag, at)
        elif m[1] and tag in ("body", "html"):
            open_.clear()
        elif tag in HOLDERS or tag in CHROME:
            if not m[1]:
                open_.setdefault(tag, []).append(m.start())
            elif open_.get(tag):
                open_[tag].pop()
    return out


def blocks(page: str) -> tuple[list[str], list[bool], bool]:
    """(blocks, which of them are article text, whether an article is declared):
    the text blocks of a page in page order, decoded, white space turned into
    one space, empty ones left out.  Those that are not article text are open.

    An element that holds an article is never skipped, except within another
    article (nested articles of a comment section are comments).  Articles in
    noise count as such if the page has no others, else they are open.
    """
    found, levels, buffer = [], [], []
    depth = dict.fromkeys(CONTENT, 0)    # open articles and mains
    seen = False
    skip, deep, nested, within, origin = "", 0, 0, 0, 0   # element being skipped, its depth, articles in it and around it
    held: set[int] | None = None         # elements that hold an article, once it matters
    marks: list[list] = []               # open elements in doubt or of noise: tag, depth, kind, mains around it
    by_tag: dict[str, list[int]] = {}
    kinds = {"noise": 0, "doubt": 0, "doubt in article": 0}
    at = 0

    def level() -> int:
        """2: article text, 1: an article's in noise, 0: open."""
        if not any(depth.values()) or kinds["doubt in article"] or (kinds["doubt"] and not depth["article"]):
            return 0
        if kinds["noise"]:
            last = next(x for x in reversed(marks) if x[2] == "noise")
            return int(depth["article"] > 0 or depth["main"] > last[3])
        return 2

    def flush():
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                found.append(text)
                levels.append(level())
            buffer.clear()

    def mark(tag, kind):
        by_tag.setdefault(tag, []).append(len(marks))
        marks.append([tag, 1, kind, depth["main"]])
        kinds[kind] += 1

    def close(tag):
        if by_tag.get(tag):
            k = by_tag[tag][-1]
            marks[k][1] -= 1
            if not marks[k][1]:
                flush()
                while len(marks) > k:
                    t, _, kind, _ = marks.pop()
                    by_tag[t].pop()
                    kinds[kind] -= 1

    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            if not skip:
                buffer.append(page[at:])
            break
        if not skip and m.start() > at:
            buffer.append(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if skip:
            if tag in RAW and not m[1]:
                if not m[3].endswith("/"):
                    at = _raw_end(page, tag, at)
            elif tag in CONTENT and not m[1] and not depth["article"] and held is None:
                held, at, skip = _holding(page) | {origin}, origin, ""
            elif tag == skip and not m[1]:
                deep += 1
            elif tag in CONTENT and not m[1]:
                nested += 1
            elif tag in CONTENT and tag != skip and nested:
                nested -= 1
            elif m[1] and (tag == skip or tag in ("body", "html") or (within and tag in CONTENT)):
                deep = deep - 1 if tag == skip else 0
                if deep <= 0:
                    if tag in CONTENT and tag != skip:
                        close(tag)
                        depth[tag] = max(0, depth[tag] - 1)
                    skip = ""
            continue
        if m[1]:
            if tag in BREAKS:
                flush()
            close(tag)
            if tag in CONTENT:
                depth[tag] = max(0, depth[tag] - 1)
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                at = _raw_end(page, tag, at)
            continue
        if tag in BREAKS:
            flush()
        elif tag == "br":
            buffer.append(" ")
        if tag in VOID:
            continue
        inside = any(depth.values())
        noise = 2 if tag in CHROME or (tag == "header" and not inside) else _noise(tag, m[3], inside)
        if noise == 2 and (depth["article"] or (tag not in CONTENT and (held is None or m.start() not in held))):
            flush()
            skip, deep, nested, within, origin = tag, 1, 0, inside, m.start()
            continue
        if noise == 2:
            flush()
            mark(tag, "noise")
        elif noise and inside and tag not in CONTENT:
            flush()
            mark(tag, "doubt in article" if depth["article"] else "doubt")
        elif by_tag.get(tag):
            marks[by_tag[tag][-1]][1] += 1
        if tag in CONTENT:
            depth[tag] += 1
            seen = True
    flush()
    least = 2 if 2 in levels else 1
    return found, [v >= least for v in levels], seen


def host_of(url: str | None) -> str:
    m = re.match(r".*?://([^/?#]*)", url or "", re.S)
    return m[1].lower() if m else ""


def _words(found: list[str]) -> tuple[np.ndarray, list[list[str]]]:
    per = [b.split() for b in found]
    b = Block([" ".join(w).lower().encode("utf-8", "replace") for w in per])
    return b.hashes(), per


def kept(found: list[str], sure: list[bool], seen: bool, places: list[int]) -> list[str]:
    """The blocks of a page: article text, and of the open ones the words not
    covered by repeated runs at ``places``."""
    per = [[] if s else b.split() for b, s in zip(found, sure)]
    total = sum(map(len, per))
    covered = np.zeros(total + RUN, bool)
    for k in range(RUN):
        covered[np.asarray(places, np.int64) + k] = True
    covered = covered[:total]
    if not any(sure) and total and covered.sum() >= COPY * total:
        return found
    keep = ~covered
    if seen:
        edges = np.flatnonzero(np.diff(np.concatenate([[False], keep, [False]]).astype(np.int8)))
        for b, e in zip(edges[::2], edges[1::2]):
            keep[b:e] = e - b >= RUN
    out, at = [], 0
    for text, s, w in zip(found, sure, per):
        left = [x for x, k in zip(w, keep[at:at + len(w)]) if k]
        at += len(w)
        if s or left:
            out.append(text if s else " ".join(left))
    return out


def _runs(host: str, found: list[str]) -> np.ndarray:
    """A hash of host and words for every run of ``RUN`` words."""
    g = _grams(_words(found)[0], RUN)
    return mix(g ^ Block([b"\0" + host.encode("utf-8", "replace")]).hashes()[0]) if len(g) else g


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``.

    Null or empty html gives an empty text.  Pages without a url (or without
    ``://``) share the empty host.  Repeated rows are kept; other columns are
    not carried.
    """
    ship_package(pages.sparkSession)
    rows = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    kind = rows.schema["page_id"].dataType
    head = [T.StructField("page_id", kind), T.StructField("url", T.StringType())]
    done = T.StructType([*head, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    open_ = T.StructType([*head, T.StructField("uid", T.LongType()), T.StructField("host", T.StringType()),
                          T.StructField("blocks", T.ArrayType(T.StringType())),
                          T.StructField("sure", T.ArrayType(T.BooleanType())), T.StructField("seen", T.BooleanType())])

    def arrow(shape):
        return pa.schema([(f.name, arrow_type(f.dataType)) for f in shape.fields])

    done_schema, open_schema = arrow(done), arrow(open_)

    def batch(found, schema):
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*found), schema)] if found else
                               [pa.array([], f.type) for f in schema], schema=schema)

    def parsed(b):
        for i, u, h in zip(*(c.to_pylist() for c in b.columns)):
            yield i, u, *blocks(h or "")

    def decided(sure, seen, found):
        """No run of open words can be kept or removed."""
        return all(sure) or (seen and sum(len(b.split()) for b, s in zip(found, sure) if not s) < RUN)

    def finished(batches):
        for b in batches:
            out = []
            for i, u, found, sure, seen in parsed(b):
                if decided(sure, seen, found):
                    text = "\n".join(b for b, s in zip(found, sure) if s)
                    out.append((i, u, text, len(text)))
            yield batch(out, done_schema)

    def undecided(batches):
        uid = TaskContext.get().partitionId() << 40
        for b in batches:
            out = []
            for i, u, found, sure, seen in parsed(b):
                if not decided(sure, seen, found):
                    out.append((i, u, uid, host_of(u), found, sure, seen))
                    uid += 1
            yield batch(out, open_schema)

    left = stored(rows.mapInArrow(undecided, open_), "open")
    suffix = pa.schema([("run", pa.int64()), ("uid", pa.int64()), ("at", pa.int32())])

    def listed(g, u, at):
        return pa.record_batch([pa.array(g.view(np.int64)), pa.array(np.full(len(g), u)), pa.array(at.astype(np.int32))],
                               schema=suffix)

    def suffixes(batches):
        for b in batches:
            for u, h, found, sure in zip(*(c.to_pylist() for c in b.columns)):
                g = _runs(h, [x for x, s in zip(found, sure) if not s])
                if len(g):
                    yield listed(g, u, np.arange(len(g)))

    array = left.select("uid", "host", "blocks", "sure").mapInArrow(suffixes, "run long, uid long, at int")
    bits = bloom(array.select(F.array("run").alias("seeds")))
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def passing(member, h, u, found, sure):
        g = _runs(h, [x for x, s in zip(found, sure) if s])
        i, j = _slots(g)
        g = np.unique(g[member[i] & member[j]])
        if len(g):
            yield listed(g, u, np.full(len(g), -1))

    def in_left(batches):
        member = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for b in batches:
            for u, h, found, sure in zip(*(c.to_pylist() for c in b.columns)):
                yield from passing(member, h, u, found, sure)

    def in_finished(batches):
        member = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        uid = -1 - (TaskContext.get().partitionId() << 40)    # below 0: no page in ``left``
        for b in batches:
            for _, u, found, sure, seen in parsed(b):
                if decided(sure, seen, found):
                    yield from passing(member, host_of(u), uid, found, sure)
                    uid -= 1

    every = array
    if any(bits):
        every = (array.unionByName(left.select("uid", "host", "blocks", "sure").mapInArrow(in_left, array.schema))
                 .unionByName(rows.mapInArrow(in_finished, array.schema)))
    repeated = (every.groupBy("run").agg(F.min("uid").alias("low"), F.max("uid").alias("high"))
                .where("low < high").select("run"))
    places = array.join(repeated, "run").groupBy("uid").agg(F.collect_list("at").alias("places"))
    work = left.join(places, "uid", "left").select("page_id", "url", "blocks", "sure", "seen", "places")

    def stripped(batches):
        for b in batches:
            out = []
            for i, u, found, sure, seen, covered in zip(*(c.to_pylist() for c in b.columns)):
                text = "\n".join(kept(found, sure, seen, covered or []))
                out.append((i, u, text, len(text)))
            yield batch(out, done_schema)

    return rows.mapInArrow(finished, done).unionByName(work.mapInArrow(stripped, done))
