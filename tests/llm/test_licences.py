import random
import re

import duckdb
from tests.llm.data import AWKWARD, clashing, docs

from dosewise.llm import licences, q_audit
from dosewise.llm.common import QUERIES

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER)) if w]


def phrases(text):
    w, out = words(text), []
    for phrase, label in licences.BASE:
        p = phrase.split()
        out += [(k, label) for k in range(len(w)) if w[k:k + len(p)] == p]
    return sorted(out)


def detections(text, rules):
    """Every rule over the whole text, then pairwise suppression."""
    s = " " + "  ".join(words(text)) + " "
    found = [(s[:m.start()].count(" ") // 2, s[:m.end()].count(" ") // 2, k, label, weight)
             for k, (label, _, pattern, weight) in enumerate(rules) for m in re.finditer(pattern, s)]
    left = [x for x in found if not any(
        y is not x and y[0] <= x[0] and x[1] <= y[1] and ((y[0], y[1]) != (x[0], x[1]) or y[2] < x[2]) for y in found)]
    left.sort()
    return [x for i, x in enumerate(left)
            if not (i and left[i - 1][1] > x[0] and left[i - 1][2] < x[2])
            and not (i + 1 < len(left) and left[i + 1][0] < x[1] and left[i + 1][2] < x[2])]


def brute(i, text):
    base, found = phrases(text), detections(text, licences.RULES)
    labels = {x[1] for x in base}
    return (i, len(words(text)), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted(labels)),
            ",".join(sorted(labels | {x[3] for x in found})), max([x[4] for x in found] + [0.5] * bool(base) + [0.0]))


NOTICES = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "All rights reserved.",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "CC BY CC-BY cc_by",
    "GPLv3 or later; LGPL-2.1-only, GNU AGPL v3", "https://creativecommons.org/licenses/by-nc-sa/3.0/ all\x00rights\treserved",
    "Copyright (c) 2019-2021 The Authors. All Rights Reserved. Redistribution and use in source and binary forms, with or without "
    "modification, are permitted", "Permission is hereby granted, free of charge, to any person obtaining a copy", "ALL RIGHTS RESERVEDé",
    "é all rights reserved, 日本 general public license version 2 or any later version", "Mozilla Public License 2.0 mpl-2.0",
    "3-clause BSD license; two clause bsd", "(c) all rights reserved general public licence cc0 1.0 universal public domain dedication",
    "Kccc by", "cc by nc nd 2 5 creative commons attribution noncommercial noderivs 2.5 generic license"]


def texts(seed=1):
    r = random.Random(seed)
    pool = [w for n in NOTICES for w in n.split()] + ["plain", "words", "4.0", "v2"]
    return ([t for t in AWKWARD if t is None or len(t) < 40_000] + NOTICES + NOTICES[:2]
            + [" ".join(r.choice(NOTICES) if r.random() < 0.2 else r.choice(pool) for _ in range(r.randint(1, 60))) for _ in range(120)])


def test_query_equals_brute_force_and_sql(spark, tmp_path):
    t = texts()
    ids = [None, 5, 5, *range(6, len(t) + 3)]
    df = clashing(docs(spark, t, ids))
    df.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(str(brute(i, x)) for i, x in zip(ids, t))
    assert sorted(str(tuple(r)) for r in QUERIES["op13_licence_signatures"](spark, str(tmp_path)).collect()) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = [tuple(r) for r in con.sql(q_audit.OP13_SQL).fetchall()]
    assert sorted(str(r) for r in got) == want


def test_every_rule_keyword_is_needed():
    """No text without the keyword can match: each way through a pattern's
    options that a text of the pattern's own words takes holds the keyword."""
    for label, keyword, pattern, _ in licences.RULES:
        plain = pattern
        while re.search(r"\(\?:([^()]*)\)[?*]", plain):
            plain = re.sub(r"\(\?:([^()]*)\)[?*]", "", plain)
        assert any(keyword in way for way in ways(plain)) and all(keyword in way for way in ways(plain)), (label, keyword, pattern)
    assert len(licences.RULES) > 300


def ways(pattern):
    """The literal texts of a pattern without options (classes stand for each of
    their characters; repeated classes for one)."""
    m = re.search(r"\(\?:([^()]*)\)", pattern)
    if m:
        return [w for x in m[1].split("|") for w in ways(pattern[:m.start()] + x + pattern[m.end():])]
    m = re.search(r"\[([^\]]*)\][+]?", pattern)
    if m:
        return [w for c in m[1][0:1] + m[1][-1:] for w in ways(pattern[:m.start()] + c + pattern[m.end():])]
    return [pattern]


def test_specific_notices_suppress_general_ones(spark):
    rows = licences.find(docs(spark, NOTICES[:8])).collect()
    assert [[d.label for d in r.detections] for r in rows[:5]] == [
        ["apache-2.0"], ["mit"], ["reserved"], ["gpl-3.0"], ["cc-by-nc-4.0"]]
    assert [d.label for d in rows[6].detections] == ["gpl-3.0-or-later", "lgpl-2.1-only", "agpl-3.0"]


def test_many_notices_and_empty_table(spark):
    r = licences.find(docs(spark, ["All rights reserved. " * 30_000])).selectExpr("size(base) b", "size(detections) d", "base[29999].start s").first()
    assert tuple(r) == (30_000, 30_000, 89_997)
    assert licences.find(docs(spark, [])).count() == 0


def test_no_python_and_no_shuffle(spark):
    plan = licences.find(docs(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow"))
