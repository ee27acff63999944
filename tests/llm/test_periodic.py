import hashlib
import random
import zlib

import numpy as np
from tests.llm.data import AWKWARD, clashing, docs

from dosewise.llm import periodic, q_audit


def brute(w, least=6, factor=4):
    """All runs of a word list, by trying every period and every stretch."""
    n, out = len(w), set()
    for q in range(1, n // factor + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, factor * q):
                out.add((i, j - i + q, q))
            i = j
    smallest = {}
    for s, length, q in out:
        smallest[s, length] = min(q, smallest.get((s, length), q))
    return sorted((s, length, q) for (s, length), q in smallest.items())


def brute_row(doc_id, text, least=6, factor=4):
    w = (text or "").translate({c: 0x20 for c in range(9, 14)}).split(" ")
    w = [x for x in w if x]
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w, least, factor)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in
              ("".join(f"{s},{length},{q}\n" for s, length, q in found), " ".join(x for i, x in enumerate(w) if i not in gone))]
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, *digest)


def awkward_runs(seed):
    """A word list with runs inside runs, near misses and rotations."""
    r = random.Random(seed)
    out = []
    for _ in range(r.randint(1, 8)):
        unit = [r.choice("abc") for _ in range(r.choice([1, 1, 2, 3, 5, 6, 7, 18, 19, 20]))]
        if r.random() < 0.3:
            unit = unit * r.randint(2, 6) + [r.choice("abcd")]
        out += unit * r.randint(1, 7) + unit[:r.randint(0, len(unit))]
        if r.random() < 0.4:
            out += [r.choice("abcdefgh") for _ in range(r.randint(0, 6))]
    return out


def test_runs_equal_brute_force_for_many_word_lists():
    lists = [awkward_runs(s) for s in range(300)] + [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 4, ["a", "b"] * 3 + ["a"]]
    w = np.array([zlib.crc32(x.encode()) for t in lists for x in t], np.uint64)
    for least, factor in ((6, 4), (20, 4), (6, 3), (1, 5)):
        text, start, length, period = periodic.runs(w, np.array([len(t) for t in lists]), least, factor)
        got = {}
        for t, *r in zip(text.tolist(), start.tolist(), length.tolist(), period.tolist()):
            got.setdefault(t, []).append(tuple(r))
        for k, t in enumerate(lists):
            assert got.get(k, []) == brute(t, least, factor), (least, factor, t)


def test_every_period_has_one_class_and_a_guaranteed_seed():
    for least, factor in ((6, 4), (20, 4), (6, 3), (50, 7)):
        seen = []
        for lo, hi, k in periodic.classes(5000, least, factor):
            seen += range(lo, hi + 1)
            assert all(k <= max(least, factor * q) - q and k >= q for q in range(lo, hi + 1)), (least, factor, lo, hi, k)
        assert seen == list(range(1, 5000 // factor + 1))


def test_blocks_of_places_change_nothing(monkeypatch):
    w = np.array([zlib.crc32(x.encode()) for x in awkward_runs(5) * 9 + ["z"] * 40], np.uint64)
    whole = periodic.runs(w, np.array([len(w)]))
    monkeypatch.setattr(periodic, "BLOCK", 7)
    assert all((a == b).all() for a, b in zip(whole, periodic.runs(w, np.array([len(w)]))))
    assert len(whole[0])


def op11(spark, tmp_path, df):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(str, (tuple(r) for r in q_audit.op11(spark, str(tmp_path)).collect())))


def test_query_equals_brute_force(spark, tmp_path):
    r = random.Random(3)
    texts = [t for t in AWKWARD if t is None or len(t) < 60_000] + [
        "word " * 700, " ".join(awkward_runs(9)), "é é é é é é 日本 " * 6,
        "\x0b\x0c a a\ta\na\ra a "] + [" ".join(r.choice("abcdefghijkl") for _ in range(r.randint(1, 300))) for _ in range(60)]
    ids = [None, 3, 3, *range(4, len(texts) + 1)]
    df = clashing(docs(spark, texts, ids)).repartition(4)
    assert op11(spark, tmp_path, df) == sorted(str(brute_row(i, t)) for i, t in zip(ids, texts))


def test_empty_table(spark, tmp_path):
    assert op11(spark, tmp_path, docs(spark, [])) == []


def test_a_long_text_is_hashed_in_pieces():
    """2 MB in one text: the runs of a part are found at their places."""
    r = random.Random(1)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(300_000)]
    words[150_000:150_600] = (words[150_000:150_100] * 6)
    words[299_000:299_030] = ["x"] * 30
    text = " ".join(words).encode()
    from dosewise.llm.blocks import located_words
    start, end, h, n = located_words([text])
    assert n.tolist() == [300_000] and text[start[7]:end[7]].decode() == words[7] and text[start[-1]:end[-1]].decode() == words[-1]
    found = list(zip(*(c.tolist() for c in periodic.runs(h, n))))
    assert (0, 150_000, 600, 100) in found and (0, 299_000, 30, 1) in found
