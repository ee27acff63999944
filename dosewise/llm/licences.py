"""Licence and rights notices in texts, by ordered signature rules.

Several hundred regular expressions over the words of a text, each with a
keyword without which it cannot match, a place in the order (earlier rules have
priority), a label and a weight.  SQL functions only:

1. A text is reduced to its words, lower-cased.
2. The few dozen distinct keywords are looked for once; only rules whose keyword
   occurs are run at all.
3. Every match of a rule is a detection, a range of word numbers.
4. A detection that another one contains goes; of two with the same range the
   earlier rule's stays.  Then, of two neighbours that still overlap, the one of
   the later rule goes.
5. The base phrases are located the same way and always stay.

Everything is a narrow projection: no shuffle and no Python.  Places are running
sums over the pieces between matches (``native.located``) and containment is a
running maximum (``native.scan``), so a text with very many notices stays cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.llm import native

# The base phrases and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
BASE_WEIGHT = 0.5

# Signatures as (label, keyword, pattern, weight) families.  Words
# are lower-case with one space between them; {v} stands for a version.
GNU = [("gpl", "", ["1", "2", "3"]), ("lgpl", "(?:lesser|library) ", ["2", "2 1", "3"]), ("agpl", "affero ", ["1", "3"])]
CC_PARTS = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?"}
CC_KINDS = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
# label, long name, short name or none, keyword of the long name, versions
NAMED = [
    ("apache", "apache (?:software )?licen[sc]e", "apache", "apache", ["1 0", "1 1", "2 0"]),
    ("mpl", "mozilla public licen[sc]e", "mpl", "mozilla", ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse public licen[sc]e", "epl", "eclipse", ["1 0", "2 0"]),
    ("cddl", "common development and distribution licen[sc]e", "cddl", "common  development", ["1 0", "1 1"]),
    ("cpl", "common public licen[sc]e", "cpl", "common  public", ["0 5", "1 0"]),
    ("eupl", "european union public licen[sc]e", "eupl", "european  union", ["1 0", "1 1", "1 2"]),
    ("osl", "open software licen[sc]e", "osl", "open  software", ["1 0", "2 0", "2 1", "3 0"]),
    ("afl", "academic free licen[sc]e", "afl", "academic  free", ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("ofl", "(?:sil )?open font licen[sc]e", "ofl", "open  font", ["1 0", "1 1"]),
    ("artistic", "artistic licen[sc]e", None, "artistic", ["1 0", "2 0"]),
    ("python", "python (?:software foundation )?licen[sc]e", "psf", "python", ["2 0", "2"]),
    ("gfdl", "free documentation licen[sc]e", "gfdl", "free  documentation", ["1 1", "1 2", "1 3"]),
    ("cecill", "cecill(?: [abc])?", None, "cecill", ["1 0", "2 0", "2 1"]),
    ("zpl", "zope public licen[sc]e", "zpl", "zope", ["1 1", "2 0", "2 1"]),
    ("boost", "boost software licen[sc]e", "bsl", "boost", ["1 0"]),
    ("sspl", "server side public licen[sc]e", "sspl", "server  side", ["1", "1 0"]),
    ("elastic", "elastic licen[sc]e", None, "elastic", ["1 0", "2 0"]),
    ("busl", "business source licen[sc]e", "busl", "business  source", ["1 0", "1 1"]),
    ("odbl", "open (?:data commons open )?database licen[sc]e", "odbl", "database", ["1 0"]),
    ("odc-by", "open data commons attribution licen[sc]e", "odc by", "open  data", ["1 0"]),
    ("lppl", "latex project public licen[sc]e", "lppl", "latex", ["1 0", "1 1", "1 2", "1 3", "1 3 c"]),
    ("apsl", "apple public source licen[sc]e", "apsl", "apple", ["1 0", "1 1", "1 2", "2 0"]),
    ("ms-pl", "microsoft public licen[sc]e", "ms pl", "microsoft", []),
    ("ms-rl", "microsoft reciprocal licen[sc]e", "ms rl", "microsoft", []),
    ("qpl", "q public licen[sc]e", "qpl", "q  public", ["1 0"]),
    ("php", "php licen[sc]e", None, "php", ["3 0", "3 01"]),
    ("upl", "universal permissive licen[sc]e", "upl", "universal  permissive", ["1 0"]),
    ("zlib", "zlib(?: libpng)? licen[sc]e", None, "zlib", []),
    ("isc", "isc licen[sc]e", None, "isc", []),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[sc]e", None, "ncsa", []),
    ("w3c", "w3c (?:software )?(?:notice|licen[sc]e)", None, "w3c", []),
    ("openssl", "openssl licen[sc]e", None, "openssl", []),
    ("postgresql", "postgresql licen[sc]e", None, "postgresql", []),
    ("vim", "vim licen[sc]e", None, "vim  licen", []),
    ("beerware", "beer ?ware licen[sc]e", "beerware", "beer", ["42"]),
    ("wtfpl", "do what the f[a-z]+ you want to public licen[sc]e", "wtfpl", "do  what  the", ["2"]),
    ("unlicense", "(?:the )?unlicen[sc]e", None, "unlicen", []),
]
BSD = [("0", "(?:0|zero)"), ("1", "(?:1|one)"), ("2", "(?:2|two)"), ("3", "(?:3|three)"), ("4", "(?:4|four)")]
SINGLE = [
    ("mit", "mit  licen", "(?:released |available |licen[sc]ed |distributed )under (?:the )?(?:terms of the )?mit licen[sc]e", 1.0),
    ("mit", "mit  licen", "mit licen[sc]e", 0.9),
    ("mit", "hereby  granted", "permission is hereby granted free of charge to any person obtaining a copy", 1.0),
    ("mit", "x11", "x11 licen[sc]e", 0.8),
    ("isc", "fee  is  hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 1.0),
    ("bsd-3-clause", "modified  bsd", "modified bsd licen[sc]e", 0.9),
    ("bsd-3-clause", "new  bsd", "new bsd licen[sc]e", 0.9),
    ("bsd-2-clause", "simplified  bsd", "simplified bsd licen[sc]e", 0.9),
    ("bsd-2-clause", "freebsd", "freebsd licen[sc]e", 0.8),
    ("bsd-4-clause", "original  bsd", "original bsd licen[sc]e", 0.9),
    ("bsd", "source  and  binary", "redistribution and use in source and binary forms with or without modification are permitted", 1.0),
    ("bsd", "bsd", "bsd(?: style)? licen[sc]e", 0.8),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?", 0.9),
    ("cc0-1.0", "publicdomain", "creativecommons org publicdomain zero 1 0", 1.0),
    ("cc-pdm", "publicdomain", "creativecommons org publicdomain mark 1 0", 1.0),
    ("cc", "creative", "creative commons licen[sc]e", 0.7),
    ("cc", "creative", "licen[sc]ed under (?:a |the )?creative commons", 0.8),
    ("public-domain", "public  domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", 0.9),
    ("public-domain", "public  domain", "public domain", 0.5),
    ("reserved", "rights  reserved", "(?:all|no) rights reserved", 0.6),
    ("reserved", "rights  reserved", "some rights reserved", 0.5),
    ("reserved", "may  be  reproduced", "no part of this (?:publication|book|work|site) may be reproduced", 0.9),
    ("reserved", "written  permission", "without (?:the )?(?:prior |express )*written permission of the (?:publisher|author|owner|copyright holder)", 0.7),
    ("proprietary", "proprietary", "(?:confidential and proprietary|proprietary and confidential)", 0.9),
    ("proprietary", "unauthorized", "unauthorized (?:copying|use|reproduction|distribution)(?: or (?:copying|use|reproduction|distribution))? (?:of this [a-z]+ )?is (?:strictly )?prohibited", 0.9),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?", 0.6),
    ("copyright", "copyright", "(?:c )?copyright (?:by|of|holder|owner|notice)", 0.4),
    ("educational", "use  only", "(?:free )?for (?:personal|private|educational|non ?commercial)(?: and (?:educational|personal|non ?commercial))? use only", 0.6),
    ("spdx", "spdx", "spdx licen[sc]e identifier", 0.6),
    ("see-licence", "licen", "see (?:the )?(?:file )?licen[sc]e(?: txt| md| file)?(?: for (?:details|more information))?", 0.4),
]


def _doubled(words: str) -> str:
    """Between two words stand two spaces, so that each word owns both of its own
    and neighbouring matches share none."""
    return words.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?")


def _label(name: str, version: str = "", suffix: str = "") -> str:
    v = version.replace(" ", ".")
    if name in ("gpl", "lgpl", "agpl") and v and "." not in v:
        v += ".0"
    return name.replace(" ", "-") + ("-" + v if v else "") + suffix


def signatures() -> list[tuple[str, str, str, float]]:
    """All rules in order: (label, keyword, pattern, weight), the more specific
    ones of a family first."""
    out = []
    for name, prefix, versions in GNU:
        for v in reversed(versions):
            number = f"(?:version |v |v)?{v}" + ("" if " " in v else "(?: 0)?")
            long = f"(?:gnu )?{prefix}general public licen[sc]e {number}"
            named = f"(?:gnu )?{prefix}general public licen[sc]e {name} {number}"
            short = f"(?:gnu )?{name} ?{number}"
            for tail, suffix, gain in ((" or (?:at your option )?(?:any )?later(?: version)?", "-or-later", 1.0), (" only", "-only", 1.0), ("", "", 0.95)):
                out += [(_label(name, v, suffix), "general  public", long + tail, gain),
                        (_label(name, v, suffix), "general  public", named + tail, gain),
                        (_label(name, v, suffix), name, short + tail, gain - 0.05)]
        out += [(name, "general  public", f"(?:gnu )?{prefix}general public licen[sc]e", 0.8), (name, name, f"(?:gnu )?{name}", 0.5)]
    for kind in reversed(CC_KINDS):
        full = " ".join(CC_PARTS[p] for p in kind.split())
        for v in [*reversed(CC_VERSIONS), ""]:
            at = f" {v}" if v else ""
            gain = 1.0 if v else 0.8
            label = _label("cc " + kind, v)
            out += [(label, "creativecommons", f"creativecommons org licen[sc]es {kind}{at}", gain),
                    (label, "creative", f"creative commons {full}{at}(?: international| unported| generic)?(?: licen[sc]e)?", gain),
                    (label, "cc  by", f"cc {kind}{at}", gain - 0.05)]
    for name, long, short, keyword, versions in NAMED:
        for v in reversed(versions):
            out.append((_label(name, v), keyword, f"{long} (?:version |v |v)?{v}", 1.0))
            if short:
                out.append((_label(name, v), short.replace(" ", "  "), f"{short} ?(?:version |v |v)?{v}", 0.9))
        out.append((name, keyword, long, 0.8))
    for n, word in BSD:
        out += [(f"bsd-{n}-clause", "bsd", f"bsd {word} clause(?: licen[sc]e)?", 1.0),
                (f"bsd-{n}-clause", "bsd", f"{word} clause bsd(?: licen[sc]e)?", 1.0)]
    out += SINGLE
    return [(label, keyword.replace("  ", " ").replace(" ", "  "), f" {_doubled(pattern)} ", round(weight, 2))
            for label, keyword, pattern, weight in out]


RULES = signatures()
_DETECTION = "struct<start:int,end:int,rank:int,label:string,weight:double>"


def words_of(text: str) -> str:
    """SQL: the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text, A-Z
    lower-cased, with one space between them."""
    lower = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"trim(regexp_replace({lower}, r'[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' '))"


def _halves(s: str) -> str:
    """Words before a place: every word has two spaces."""
    return f"cast((length({s}) - length(replace({s}, ' ', ''))) / 2 as int)"


def _detections(text: str, rules: str) -> str:
    """SQL: all matches of an array of rules, by start, longer and earlier first."""
    found = native.located(text, "r.pattern", _halves)
    return (f"array_sort(flatten(transform({rules}, r -> transform({found}, m -> named_struct('start', m.s, 'end', m.e, "
            "'rank', r.rank, 'label', r.label, 'weight', r.weight)))), (a, b) -> case when a.start <> b.start then "
            "a.start - b.start when a.end <> b.end then b.end - a.end else a.rank - b.rank end)")


def _uncontained(found: str) -> str:
    """SQL: those that no other contains; sorted, an earlier one contains a later
    one exactly when the greatest end so far reaches its end."""
    flagged = native.scan(found, "-1", lambda s, x: f"greatest({s}, {x}.end)",
                          lambda s, x: f"named_struct('out', {x}.end <= {s}, 'd', {x})", f"struct<out:boolean,d:{_DETECTION}>")
    return f"transform(filter({flagged}, f -> not f.out), f -> f.d)"


def _apart(found: str) -> str:
    """SQL: of overlapping neighbours the one of the later rule goes."""
    return native.bind(found, lambda v: (
        f"filter({v}, (x, i) -> not (i > 0 and {v}[greatest(i - 1, 0)].end > x.start and {v}[greatest(i - 1, 0)].rank < x.rank) "
        f"and not (i + 1 < size({v}) and {v}[least(i + 1, size({v}) - 1)].start < x.end "
        f"and {v}[least(i + 1, size({v}) - 1)].rank < x.rank))"))


def _rules_sql(rules) -> str:
    return "array(" + ", ".join(
        f"named_struct('rank', {k}, 'label', '{label}', 'keyword', '{keyword}', 'pattern', r'{pattern}', 'weight', {weight}D)"
        for k, (label, keyword, pattern, weight) in enumerate(rules)) + ")"


def find(docs: DataFrame, rules=None) -> DataFrame:
    """(doc_id, n_words, base, detections, score): one row per row of ``docs``.

    ``base`` and ``detections`` are arrays of (start, end, rank, label, weight)
    by start, in word numbers, end exclusive.  ``score`` is the greatest weight
    of a detection that stays (a base phrase counts ``BASE_WEIGHT``), 0 without
    any.  A null or empty text has no word and no detection; repeated rows each
    have a row; other columns are not carried.
    """
    rules = RULES if rules is None else rules
    base = [(label, phrase.replace(" ", "  "), f" {_doubled(phrase)} ", BASE_WEIGHT) for phrase, label in BASE]
    keywords = sorted({k for _, k, _, _ in rules})
    words = docs.select("doc_id", F.expr(words_of("coalesce(cast(text as string), '')")).alias("words"))
    spaced = words.select("doc_id", F.expr("if(words = '', 0, length(words) - length(replace(words, ' ', '')) + 1)").cast("long").alias("n_words"),
                          F.expr("concat(' ', replace(words, ' ', '  '), ' ')").alias("spaced"))
    quoted = ", ".join(f"'{k}'" for k in keywords)
    gated = spaced.withColumn("hits", F.expr(f"filter(array({quoted}), k -> contains(spaced, k))"))
    none = f"cast(array() as array<{_DETECTION}>)"
    met = f"filter({_rules_sql(rules)}, r -> array_contains(hits, r.keyword))"
    found = gated.select(
        "doc_id", "n_words",
        F.expr(_detections("spaced", f"filter({_rules_sql(base)}, r -> contains(spaced, r.keyword))")).alias("base"),
        F.expr(f"if(size(hits) = 0, {none}, {_apart(_uncontained(_detections('spaced', met)))})").alias("detections"))
    return found.withColumn("score", F.expr(
        "aggregate(concat(base, detections), 0D, (s, d) -> greatest(s, d.weight))"))
