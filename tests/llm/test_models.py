import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.data import AWKWARD, clashing, docs, vocabulary_words

from dosewise.llm import lm, quality, toxicity
from dosewise.llm.blocks import Block
from dosewise.llm.plans import QUERIES

SF = "/root/testdata/sf0.01"


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


# --- words as arrays

def test_block_words_and_hashes_equal_python_split():
    texts = [(t or "").encode() for t in AWKWARD] + [b"  lead and trail\t", b"\n", b"a\x0bb\x0cc"]
    b = Block(texts)
    got = [[] for _ in texts]
    for d, s, e in zip(b.doc, b.start, b.end):
        got[d].append(b.data[s:e].tobytes())
    assert got == [t.split() for t in texts]
    seen = {}
    for h, s, e in zip(b.hashes().tolist(), b.start, b.end):
        assert seen.setdefault(h, b.data[s:e].tobytes()) == b.data[s:e].tobytes()
    assert len(set(seen.values())) == len(seen)


# --- language model

@pytest.fixture(scope="module")
def small_corpus():
    r = random.Random(2)
    texts = []
    for k in range(240):
        a, b = (("red", "apple"), ("blue", "sky"))[k % 2]
        texts.append(" ".join(x for _ in range(r.randint(3, 12)) for x in (a, b, *vocabulary_words(k, 1, 30))))
    return AWKWARD + texts


def test_counts_and_base_scores_equal_brute_force(spark, small_corpus):
    df = clashing(docs(spark, small_corpus)).unionByName(clashing(docs(spark, ["dup", "dup", "none"], [7, 7, None])))
    model, rare = lm.train(df, 10)
    got = lm.score(df, model, rare).collect()
    rows = list(enumerate(small_corpus, 1)) + [(7, "dup"), (7, "dup"), (None, "none")]
    toks = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    c = Counter(w for i, t in toks if i is not None and fold(i, 10) for w in t)
    n, v = sum(c.values()), len(c)
    want = Counter((i, len(t), sum(w in c for w in t), n,
                    round(sum(math.log10((c.get(w, 0) + .1) / (n + .1 * (v + 1))) for w in t), 4)) for i, t in toks)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    held = [r for r in got if r.doc_id is not None and not fold(r.doc_id, 10) and r.doc_id > len(AWKWARD)]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_outside_the_dictionary_are_counted(spark, small_corpus, monkeypatch):
    df = docs(spark, small_corpus)
    monkeypatch.setattr(lm.dictionary, "__defaults__", (12,))
    model, rare = lm.train(df, 10)
    assert 0 < len(model.words) <= 12 and rare.count() == model.types - len(model.words)
    few = {r.doc_id: r for r in lm.score(df, model, rare).collect()}
    monkeypatch.setattr(lm.dictionary, "__defaults__", (lm.DICT,))
    whole = {r.doc_id: r for r in lm.score(df, *lm.train(df, 10)).collect()}
    for i, r in few.items():
        assert r.n_known == whole[i].n_known and abs(r.base_score - whole[i].base_score) < 1e-6 * abs(r.base_score) + 1e-9


def test_probabilities_of_all_words_add_up_to_one(spark, small_corpus):
    model, _ = lm.train(docs(spark, small_corpus), 10)
    d = len(model.words)
    for p1, p2 in [(0, 1), (3, 2), (d, 0), (d - 1, d)]:
        x = np.arange(d)
        logp = model.log10(x, np.full(d, p1, np.int32), np.full(d, p2, np.int32))
        rare = 10 ** model.log10(np.array([d]), np.array([p1]), np.array([p2]))[0]
        assert abs((10 ** logp).sum() + rare - 1) < 1e-4


def test_gradient_is_the_slope_of_the_likelihood(spark, small_corpus):
    model, _ = lm.train(docs(spark, small_corpus), 10)
    r = np.random.default_rng(0)
    x, p1, p2 = (r.integers(0, len(model.words) + 1, 500).astype(np.int32) for _ in range(3))
    gw, gu, n = np.zeros_like(model.w), np.zeros_like(model.u), np.zeros((4, lm.ROWS))
    model.gradient(x, p1, p2, gw, gu, n)
    before = model.log10(x, p1, p2).sum() * math.log(10)
    eps = 1e-2
    for k, row, c in [(0, model.row[p1[0]], model.cls[x[0]]), (1, model.row[p2[3]], 0)]:
        model.w[k, row, c] += eps
        after = model.log10(x, p1, p2).sum() * math.log(10)
        model.w[k, row, c] -= eps
        assert abs((after - before) / eps + gw[k, row, c]) < 0.05 * abs(gw[k, row, c]) + 0.05


def test_row_counts_do_not_stop_at_the_precision_of_a_float(spark, small_corpus):
    model, _ = lm.train(docs(spark, small_corpus), 10)
    x = np.zeros(8, np.int32)
    gw, gu, n = np.zeros_like(model.w), np.zeros_like(model.u), np.full((4, lm.ROWS), 1 << 24, np.int64)
    model.gradient(x, x, x, gw, gu, n)
    assert n[0, model.row[0]] == (1 << 24) + 8


def test_language_model_without_training_rows(spark):
    for table in (docs(spark, []), docs(spark, ["a b", None], [None, None])):
        model, rare = lm.train(table, 10)
        assert all(r.base_score == 0 and r.score == 0 and r.n_known == 0 for r in lm.score(table, model, rare).collect())


# --- toxicity

def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(1)
    sizes = np.array([1, 4, 6, 2, 6])
    em, trans = r.normal(0, 2, sizes.sum()), r.normal(0, 1, (2, 2))
    got = toxicity.marginals(em, sizes, trans)
    at = 0
    for n in sizes:
        p, z = np.zeros(n), 0.0
        for states in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(em[at + k] * s for k, s in enumerate(states)) + sum(trans[a, b] for a, b in zip(states, states[1:])))
            z += w
            p += np.array(states) * w
        assert np.allclose(1 / (1 + np.exp(-got[at:at + n])), p / z)
        at += n


def toxic_tables(spark):
    r, rows, labels = random.Random(4), [], []
    for i in range(1, 301):
        w = vocabulary_words(i, r.randint(20, 60), 200)
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["gruk", "zlorp", "vexoo" + r.choice("abcd")]))
        rows.append(" ".join(w))
        labels.append((i, 1, int(bad)))
    return (docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxic_words_are_tagged_and_scores_separate(spark):
    df, labels = toxic_tables(spark)
    model = toxicity.train(df, labels)
    text = {r.doc_id: r.text for r in df.collect()}
    wrong = hits = 0
    for r in toxicity.tag(clashing(df), model).collect():
        wrong += (r.score >= 0.5) != (r.doc_id % 5 == 0)
        for s in r.spans:
            hits += text[r.doc_id][s.start:s.end].startswith(("gruk", "zlorp", "vexoo"))
            assert " " not in text[r.doc_id][s.start:s.end] or text[r.doc_id][s.start:s.end].count("o")
    assert wrong <= 3 and hits >= 100
    odd = toxicity.tag(clashing(docs(spark, AWKWARD)), model).collect()
    assert len(odd) == len(AWKWARD) and all(0 <= r.score <= 1 and not r.spans for r in odd)


LEXICON = [a + b for a in ("gruk", "zlorp", "vexoo", "mwib", "dhaqq") for b in ("esh", "umv")]


def toxic_documents(spark, held, copies):
    """300 documents, every fifth with ``held`` words of the lexicon, and near
    copies of one more that holds the first word of it."""
    r, rows = random.Random(5), []
    for i in range(1, 301):
        w = vocabulary_words(i, r.randint(20, 60), 200)
        for x in r.sample(LEXICON, held) if i % 5 == 0 else ():
            w.insert(r.randrange(len(w)), x)
        rows.append(" ".join(w))
    odd = [f"{a}qx{b}jj{a}{b}" for a in "abcdefgh" for b in "klmno"]
    rows += [" ".join(odd[:k % 20] + odd[k % 20 + 1:30] + LEXICON[:1] + odd[30:]) for k in range(copies)]
    labels = [(i + 1, 1, int(i >= 300 or i % 5 == 4)) for i in range(len(rows))]
    df = docs(spark, rows)
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return labels, [(r.doc_id, r.score, [rows[r.doc_id - 1][s.start:s.end] for s in r.spans])
                    for r in toxicity.tag(df, model).collect()]


def test_toxic_words_that_all_toxic_texts_hold_are_learned(spark):
    labels, got = toxic_documents(spark, len(LEXICON), 0)
    toxic = {i for i, _, y in labels if y}
    assert {i for i, score, _ in got if score >= 0.5} == {i for i, _, spans in got if spans} == toxic


def test_copies_of_a_toxic_text_have_one_vote(spark):
    labels, got = toxic_documents(spark, 3, 150)
    spans = {i: spans for i, _, spans in got}
    assert all(spans[i] == LEXICON[:1] for i in range(301, 451))
    assert sum(bool(spans[i]) == bool(y) for i, _, y in labels[:300]) >= 295


def test_classes_of_copies():
    texts = [" ".join(vocabulary_words(k, 60, 5000)) for k in range(4)]
    texts += [texts[0] + " more", texts[1].replace(" ", "  ").upper(), "", "", "a"]
    got = toxicity.copy_classes(np.stack([toxicity.minima(t.encode()) for t in texts]))
    assert got[4] == got[0] and got[5] == got[1] and got[6] == got[7] and len(set(got.tolist())) == 6


def test_toxicity_without_labels_or_rows(spark):
    df, labels = docs(spark, ["a", None], [1, 1]), "doc_id long, quality int, toxic int"
    none = toxicity.train(df, spark.createDataFrame([], labels))
    assert [r.score for r in toxicity.tag(df, none).collect()] == [0.5, 0.5]
    odd = toxicity.train(df, spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, 1), (9, None, None), (4, 0, 7)], labels))
    assert all(0 < r.score < 0.5 for r in toxicity.tag(df, odd).collect())
    assert toxicity.tag(docs(spark, []), none).count() == 0


# --- quality

def test_quality_gradient_is_the_slope_of_the_loss():
    r = np.random.default_rng(0)
    m = quality.Model(0.5)
    per = np.array([1, 3, 2])
    x, y, w = r.normal(size=(6, quality.FEATURES)), np.array([1.0, 0, 1]), np.array([0.2, 0.5, 0.3])

    def loss():
        z = m.forward(x, per)["logit"]
        return (w * (np.log1p(np.exp(z)) - y * z)).sum()

    g = m.gradient(x, per, y, w)
    for k, p in m.w.items():
        at = tuple(s // 2 for s in p.shape)
        p[at] += 1e-5
        high = loss()
        p[at] -= 2e-5
        low = loss()
        p[at] += 1e-5
        assert abs((high - low) / 2e-5 - g[k][at]) < 1e-5, k


def test_passage_features_do_not_depend_on_neighbours():
    texts = [(t or "").encode() for t in AWKWARD]
    x, per = quality.encode(texts)
    at = 0
    for t, n in zip(texts, per):
        one, k = quality.encode([t])
        assert k[0] == n and np.allclose(one, x[at:at + n], atol=1e-6), t[:20]
        at += n


def test_quality_held_out_accuracy(spark):
    got = QUERIES["op9_attention_mil_quality"](spark, SF).join(
        spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    n, right = got.agg(F.count("*"), F.sum((F.col("predicted") == F.col("quality")).cast("int"))).first()
    assert n > 50 and right >= 0.95 * n


def test_quality_scores_of_awkward_rows_and_missing_labels(spark):
    labels = "doc_id long, quality int, toxic int"
    df = docs(spark, AWKWARD).withColumn("y", F.lit(1))
    none = quality.train(df, spark.createDataFrame([], labels))
    out = quality.score(df, none)
    assert out.columns == [*df.columns, "score"] and {r.score for r in out.collect()} == {0.5}
    some = quality.train(df, spark.createDataFrame([(i, i % 2, 0) for i in range(1, 12)], labels))
    assert all(0 <= r.score <= 1 for r in quality.score(df, some).collect())
    assert quality.score(docs(spark, []), some).count() == 0
    with pytest.raises(ValueError):
        quality.score(clashing(df), none)
