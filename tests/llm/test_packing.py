import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tests.llm.data import AWKWARD, clashing, docs
from tokenizers import Tokenizer

from dosewise.llm.packing import Encoder, Packer, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_tokenizer(tokenizer):
    r, e = random.Random(0), Encoder(PATH)
    assert e.fast is not None
    letters = "ab 's're  \n\t1'd.,!é ñß日 ²<|endoftext|>ªŁ'll x　\x1c"
    for k in range(3000):
        t = "".join(r.choice(letters) for _ in range(r.randint(0, 25)))
        t += ("<|endoftext|>" + t) if k % 50 == 0 else ""
        assert e.encode(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t
    long = "word  two\n\nthree 4's " * 150_000
    assert e.encode(long) == np.array(tokenizer.encode(long, add_special_tokens=False).ids, "<u4").tobytes()


def check_sequences(seqs, window):
    """Gapless offsets; only whole windows and powers of two."""
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window and (at == window or at & (at - 1) == 0)


@pytest.mark.parametrize("seed", range(6))
def test_packer_keeps_every_id_once_without_padding(seed):
    r, seqs, given = random.Random(seed), [], {}
    p = Packer(64, seqs.append)
    for d in range(r.randint(0, 300)):
        n = r.choice([1, 2, 40, 64, r.randint(1, 200)])
        given[d] = np.array([r.randrange(50_000) for _ in range(n)], "<u4").tobytes()
        p.add(d, given[d])
    p.pour()
    got = {}
    for s in seqs:
        size = sum(len(x[2]) // 4 for x in s)
        assert 0 < size <= 64 and (size == 64 or size & (size - 1) == 0)
        for d, start, ids, total in s:
            assert total == len(given[d]) // 4
            got.setdefault(d, []).append((start, ids))
    for d, ids in given.items():
        assert b"".join(i for _, i in sorted(got[d])) == ids


def test_level_choice_minimises_the_sum_of_squares():
    r = random.Random(9)
    p = Packer(16, lambda s: None)
    for _ in range(500):
        size = r.randint(1, 15)
        n = p.count.copy()
        best = None
        for level in [h for h in range(1, 17 - size) if n[h]] + [0]:
            m = n.copy()
            if level:
                m[level] -= 1
            if level + size < 16:
                m[level + size] += 1
            best = min(x for x in [best, int((m * m).sum())] if x is not None)
        p.place([0, 0, b"\0" * 4 * size, size], size)
        assert int((p.count * p.count).sum()) == best


def test_pack_round_trip_on_awkward_documents(spark, tokenizer):
    df = clashing(docs(spark, AWKWARD)).repartition(3)
    rows = pack(df, PATH, window=64, with_ids=True).collect()
    ids, seqs = {}, {}
    for r in rows:
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        ids.setdefault(r.doc_id, []).append((r.start, bytes(r.ids), r.doc_tokens))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    check_sequences(seqs, 64)
    for i, t in enumerate(AWKWARD):
        want = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        got = sorted(ids[i + 1])
        assert b"".join(x[1] for x in got) == np.array(want, "<u4").tobytes()
        assert {x[2] for x in got} == {len(want)}


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = pack(docs(spark, ["same text", "same text", "x"], [1, 1, None]).coalesce(1), PATH).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 2 * rows[0].doc_tokens
    assert any(r.doc_id is None for r in rows)
    assert pack(docs(spark, []), PATH).count() == 0
