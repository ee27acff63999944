import itertools
import random

import numpy as np
import xxhash
from tests.llm.data import AWKWARD, clashing, docs, vocabulary_words

from dosewise.llm import simhash
from dosewise.llm.components import components


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits=3):
    label = list(range(len(fps)))
    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= bits and label[i] != label[j]:
            a, b = label[i], label[j]
            label = [a if x == b else x for x in label]
    return label


def test_fingerprints_and_components_equal_brute_force(spark):
    r = random.Random(5)
    base = vocabulary_words(1, 300)
    texts = list(AWKWARD) + [" ".join(vocabulary_words(k, 60)) for k in range(10)]
    for k in range(25):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = f"edit{r.randint(0, 99)}"
        texts.append(" ".join(w))
    got = simhash.near_duplicates(clashing(docs(spark, texts))).collect()
    fps = [brute_fp(t) for t in texts]
    assert {g.doc_id: g.fingerprint for g in got} == {i + 1: f"{f:016x}" for i, f in enumerate(fps)}
    label = brute_components(fps)
    least = {lab: min(i + 1 for i, x in enumerate(label) if x == lab) for lab in label}
    assert {g.doc_id: g.component_id for g in got} == {i + 1: least[x] for i, x in enumerate(label)}


def test_links_of_a_crowded_key_in_blocks_connect_everything(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    r = np.random.default_rng(3)
    centre = int(r.integers(1 << 62))
    fps = {centre}
    while len(fps) < 150:
        x = centre
        for b in r.choice(64, r.integers(1, 6), replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    edges = simhash.links(df, 3).collect()
    assert all(bin((e.a ^ e.b) & (2**64 - 1)).count("1") <= 3 for e in edges)
    assert len(edges) < 5000
    seen = {row.node: row.root for row in components(simhash.links(df, 3)).collect()}
    got = [seen.get(int(np.uint64(f).view(np.int64)), f) for f in fps]
    want = brute_components(fps)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_chain_condition_holds_for_every_near_pair():
    r = np.random.default_rng(0)
    for bits in (0, 1, 2, 3, 5):
        x = np.zeros(3000, np.uint64)
        for k in range(len(x)):
            for b in r.choice(64, r.integers(0, bits + 1), replace=False):
                x[k] |= np.uint64(1) << np.uint64(b)
        assert simhash.chain_ok(x, bits).all()


def test_deduplicate_keeps_one_row_of_each_component_and_all_columns(spark):
    texts = ["a b c d", "A b c d", None, "", "other words here now", "a b c d", "no id", "no id"]
    df = clashing(docs(spark, texts, [5, 2, 3, 9, 7, 2, None, None]))
    out = simhash.deduplicate(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or -1, r.text) for r in out.collect()) == [(-1, "no id"), (2, out.where("doc_id = 2").first().text),
                                                                      (3, None), (7, "other words here now")]


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.deduplicate(docs(spark, [])).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200}
    assert got == want
