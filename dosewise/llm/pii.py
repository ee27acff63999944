"""Personal data in texts, in SQL functions only.

Regular expressions propose spans, validators confirm them (Luhn for cards,
mod 97 for bank accounts, ranges for addresses and digit counts for phones),
and words near a span raise its score.  The kinds of the base contract are kept
whenever their validator passes; the kinds that the method adds (``iban``,
``ssn``) are kept from a score of ``KEEP`` on, so a bare ``ssn`` needs a context
word and an ``iban`` does not.

Positions come from splitting the text at the same pattern: a match starts
after the pieces and matches before it (``native.located``).  Offsets are code
points.  Everything is a narrow projection: no shuffle, no Python.  Validators,
context and redaction read the text in chunks of matches, so a text with very many
spans costs little more than its length.

The patterns below are the contract's, with two additions that change no match:
possessive repeats, and for emails and addresses a look-behind that lets a match
start only at the start of a run (or where the last match ended), so a long run
of letters or digits is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewise.llm import native

# Patterns, context words, scores.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
# A text without a match of the gate has no span of the kind.
GATES = {
    "email": "instr({t}, '@') > 0",
    "ip": r"{t} rlike r'[0-9]\.[0-9]'",
    "card": r"{t} rlike r'[0-9](?:[\x20-]?[0-9]){{11}}'",
    "phone": "instr({t}, '+') > 0",
    "iban": r"{t} rlike r'[A-Z]{{2}}[0-9]{{2}}\x20?[A-Z0-9]{{4}}'",
    "ssn": r"{t} rlike r'[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}'",
}
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "ssn"]
SCORES = {"email": 80, "ip": 60, "card": 80, "phone": 70, "iban": 90, "ssn": 35}
CONTEXT = {
    "email": "email|e-mail|mail|contact",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|mobile",
    "iban": "iban|account|bank",
    "ssn": "ssn|social|security",
}
NEAR, RAISE, KEEP = 40, 20, 50

# Validators over a match x (and the text t, start s, end e for the edges).
_EDGES = ("not (substring({t}, s, least(s, 1)) rlike '[A-Za-z0-9]') and "
          "not (substring({t}, e + 1, 1) rlike '[A-Za-z0-9]')")
VALID = {
    "email": "true",
    "ip": r"forall(split(x, '[.]'), q -> coalesce(try_cast(concat('0', trim(leading '0' from q)) as int) <= 255, false))",
    "card": "exists(array(regexp_replace(x, '[^0-9]', '')), d -> length(d) between 12 and 19 and "
            "aggregate(sequence(1, length(d)), 0, (a, i) -> a + "
            "if(i % 2 = 1, int(substring(d, length(d) - i + 1, 1)), "
            "int(substring(d, length(d) - i + 1, 1)) * 2 - if(substring(d, length(d) - i + 1, 1) > '4', 9, 0))) % 10 = 0)",
    "phone": "length(regexp_replace(x, '[^0-9]', '')) between 9 and 15",
    "iban": "exists(array(replace(x, ' ', '')), d -> length(d) between 15 and 34 and "
            "aggregate(split(concat(substring(d, 5), substring(d, 1, 4)), ''), 0, (a, c) -> "
            "if(c = '', a, if(c between '0' and '9', (a * 10 + ascii(c) - 48) % 97, (a * 100 + ascii(c) - 55) % 97))) = 1)"
            " and " + _EDGES,
    "ssn": _EDGES,
}


def _spans(kind: str, t: str) -> str:
    """SQL: array of (start, rank, end, kind, score) of one kind.  Validators and
    context read the part of the text around a chunk of matches."""
    none = "cast(array() as array<struct<start:int,rank:int,end:int,kind:string,score:int>>)"
    near = (f"concat(substring(u, greatest(r.s - {NEAR}, 0) + 1, least(r.s, {NEAR})), ' ', "
            f"substring(u, r.e + 1, {NEAR}))")
    score = (f"{SCORES[kind]} + if(lower({near}) rlike '(^|[^a-z])({CONTEXT[kind]})([^a-z]|$)', {RAISE}, 0)")
    valid = _over(VALID[kind].replace("{t}", "u"))
    scored = (f"transform(filter(transform(k.c, r -> struct(r.s - k.b as s, r.e - k.b as e, r.x as x)), r -> "
              f"exists(array(r), y -> {valid})), r -> "
              f"named_struct('start', r.s + k.b, 'rank', {KINDS.index(kind)}, 'end', r.e + k.b, 'kind', '{kind}', 'score', {score}))")
    if kind not in BASE:
        scored = f"filter({scored}, r -> r.score >= {KEEP})"
    around = f"substring({t}, k.b + 1, element_at(k.c, -1).e + {NEAR} - k.b)"
    found = (f"flatten(transform({native.chunks(native.located(t, f"r'{PATTERNS[kind]}'"))}, c -> "
             f"transform(array(named_struct('b', greatest(c[0].s - {NEAR}, 0), 'c', c)), k -> "
             f"transform(array({around}), u -> {scored})[0])[0]))")
    gate = GATES[kind].format(t=t)
    return f"case when {gate} then {found} else {none} end"


def _over(valid: str) -> str:
    """The validator with x, s, e read from the lambda variable y."""
    import re
    return re.sub(r"\b(x|s|e)\b(?!')", lambda m: f"y.{m[1]}", valid)


def spans(text: Column | str = "text") -> Column:
    """All spans of a text column by start, then kind: an array of (start,
    rank, end, kind, score), offsets in code points, end exclusive."""
    name = text if isinstance(text, str) else "text"
    t = f"coalesce(`{name}`, '')"
    return F.expr("array_sort(concat(" + ", ".join(_spans(k, t) for k in KINDS) + "))")


def find(docs: DataFrame, text: str = "text", out: str = "pii_spans") -> DataFrame:
    """Add ``out`` to every row.  A null or empty text has no span."""
    return docs.withColumn(out, spans(text))


def joined(column: str) -> Column:
    """kind:start:end, comma-joined, of an array of spans."""
    return F.array_join(F.transform(column, lambda r: F.concat_ws(":", r["kind"], r["start"], r["end"])), ",")


def redacted(text: str = "text", found: str = "pii_spans") -> Column:
    """The text with every span replaced by its kind in brackets; overlapping
    spans become one.  A text without spans (null too) stays as it is."""
    t = f"`{text}`"
    edits = native.scan(found, "0", lambda at, r: f"greatest({at}, {r}.end)",
                        lambda at, r: f"named_struct('a', {at}, 'b', {r}.start, 'kind', {r}.kind)", "struct<a:int,b:int,kind:string>")
    part = f"substring({t}, c[0].a + 1, element_at(c, -1).b - c[0].a)"
    parts = (f"flatten(transform({native.chunks(f'filter({edits}, q -> q.b >= q.a)')}, c -> transform(array({part}), u -> "
             f"transform(c, q -> concat(substring(u, q.a - c[0].a + 1, q.b - q.a), '[', upper(q.kind), ']')))[0]))")
    return F.expr(f"case when size({found}) = 0 then {t} else concat(array_join({parts}, ''), "
                  f"substring({t}, array_max(transform({found}, r -> r.end)) + 1)) end")
