import itertools
import random

import duckdb
import numpy as np
from tests.llm.data import AWKWARD, clashing, docs

from dosewise.llm import interaction, q_audit

SPACES = {c: 0x20 for c in range(9, 14)}
LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    """Per row (id, text, part): the set of filters that it fails."""
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = [x for x in t.translate(SPACES).split(" ") if x]
        bad = set()
        if len(w) < 50:
            bad.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            bad.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t):
            bad.add("C")
        if any(c in "#$%&*|" for c in t):
            bad.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows):
            bad.add("E")
        out.append(bad)
    return out


def brute(rows, labels):
    bad = failures(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = []
    for part in {p or "" for _, _, p in rows}:
        mine = [(b, i in good, i in toxic) for (i, _, p), b in zip(rows, bad) if (p or "") == part]
        removed = {}
        for order in itertools.permutations("ABCDE"):
            left = mine
            for s, f in enumerate(order, 1):
                gone = [m for m in left if f in m[0]]
                left = [m for m in left if f not in m[0]]
                removed["".join(order), s] = (f, len(left), len(gone), sum(m[1] for m in gone), sum(m[2] for m in gone))
        shapley = {f: sum(r[2] for r in removed.values() if r[0] == f) for f in "ABCDE"}
        for (o, s), (f, kept, gone, g, t) in removed.items():
            fails = sum(f in m[0] for m in mine)
            out.append((part, o, s, kept, gone, fails - gone, sum(m[0] == {f} for m in mine), g, t, shapley[f]))
    return sorted(out)


def some_rows(seed=1):
    r = random.Random(seed)
    texts = [t for t in AWKWARD if t is None or len(t) < 40_000]
    texts += ["Many WORDS In Capitals " * 20, "a b c d " * 20, "x $ y", "plain " * 60]
    texts += [" ".join(r.choice("abcdefghijklmnopqrstuvwxyz") * r.randint(1, 4) for _ in range(r.choice([30, 60, 80]))) for _ in range(20)]
    texts += [r.choice(texts) for _ in range(30)]
    rows = [(k, t, r.choice(["s1", "s2", None, ""])) for k, t in enumerate(texts, 1)]
    rows += [(None, "one", "s1"), (None, "one", "s2"), (7, "same id", "s1"), (7, "same id", "s1"), (7, "same id", "s2"), (8, "same id", None)]
    r.shuffle(rows)
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(1, 40)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    return rows, labels


def tables(spark, rows, labels):
    d = spark.createDataFrame([(i, t, p, "x", "x") for i, t, p in rows],
                              "doc_id long, text string, source string, part string, cell string")
    return d.repartition(5), clashing(spark.createDataFrame(labels, LABELS))


def test_audit_equals_brute_force_and_sql(spark):
    rows, labels = some_rows()
    d, lab = tables(spark, rows, labels)
    got = interaction.audit(d, lab)
    want = brute(rows, labels)
    assert sorted(tuple(r) for r in got.collect()) == want
    con = duckdb.connect()
    con.register("documents", d.toPandas())
    con.register("labels", lab.select("doc_id", "quality", "toxic").toPandas().astype({"doc_id": "Int64", "quality": "Int32"}))
    assert sorted(con.sql(q_audit.OP12_SQL).fetchall()) == want


def test_einsum_equals_counting_over_cells():
    r = np.random.default_rng(2)
    tensor = r.integers(0, 50, (2,) * 5 + (3,))
    out = interaction.contracted(tensor)
    for o, order in enumerate(itertools.permutations(range(5))):
        for s, f in enumerate(order):
            def total(test, m=0):
                return sum(tensor[c][m] for c in itertools.product((0, 1), repeat=5) if test(c))
            assert out["removed"][o, s] == total(lambda c: c[f] and not any(c[g] for g in order[:s]))
            assert out["kept"][o, s] == total(lambda c: not any(c[g] for g in order[:s + 1]))
            assert out["redundant"][o, s] == total(lambda c: c[f] and any(c[g] for g in order[:s]))
            assert out["unique_fails"][o, s] == total(lambda c: c[f] and sum(c) == 1)
            assert out["toxic_lost"][o, s] == total(lambda c: c[f] and not any(c[g] for g in order[:s]), 2)


def test_empty_tables(spark):
    empty = docs(spark, [])
    none = spark.createDataFrame([], LABELS)
    assert interaction.audit(empty, none).count() == 0
    assert interaction.audit(docs(spark, [None, "a"]), none).count() == 600
