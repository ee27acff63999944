import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.data import AWKWARD, clashing, docs

import corpus_pipeline as cp
from dosewise.llm import decontaminate, pii, quality, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out, df = [], spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("pipeline") / f"{k}-{name}")
        stage(spark, df, SF).write.parquet(path)
        new = spark.read.parquet(path)
        out.append((df, new))
        df = new
    return out


def test_stage_names_and_columns(spark, stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(new.columns == columns for _, new in stages[:-1])


def test_every_stage_takes_effect_on_what_was_kept(spark, stages):
    before, after = stages[0]
    low = {r.doc_id for r in quality.score(before, quality.train(before, spark.read.parquet(f"{SF}/labels.parquet")))
           .where("score < 0.3").collect()}
    ids = [({r.doc_id for r in b.collect()}, {r.doc_id for r in a.collect()}) for b, a in stages[:-1]]
    assert low and ids[0][0] - ids[0][1] == low
    comp = {r.doc_id: r.component_id for r in simhash.near_duplicates(stages[1][0]).collect()}
    assert ids[1][1] == set(comp.values()) and stages[1][1].count() == len(ids[1][1])
    hit = {r.doc_id for r in decontaminate.find(stages[2][0], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids[2][0] - ids[2][1] == hit
    assert ids[3][0] == ids[3][1]
    clean = pii.find(stages[3][1]).select(F.size(F.filter("pii_spans", lambda r: r["rank"] < 4)).alias("n")).agg(F.sum("n")).first()[0]
    assert clean == 0
    changed = stages[3][1].where("n_chars <> length(text)").count()
    assert changed == stages[3][0].where("n_chars <> length(text)").count()


def test_packed_ids_are_the_ids_of_the_texts(spark, stages):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(cp.VOCABULARY)
    before, after = stages[4]
    pieces = {}
    for r in after.collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    for r in before.collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for start, n, crc in sorted(pieces[r.doc_id]):
            assert start == at and crc == zlib.crc32(ids[at:at + n].tobytes())
            at += n
        assert at == len(ids)


def test_run_equals_the_stages(spark, stages):
    got = cp.run(spark, SF)
    assert got.columns == stages[-1][1].columns
    assert got.agg(F.sum("length")).first() == stages[-1][1].agg(F.sum("length")).first()


@pytest.mark.parametrize("k", range(5))
def test_awkward_rows_extra_columns_and_empty_tables(spark, k):
    name, stage = cp.STAGES[k]
    df = clashing(docs(spark, AWKWARD + AWKWARD[:3], [*range(1, len(AWKWARD) + 1), 1, 2, None]))
    df = df.withColumn("lang", F.lit(None).cast("string"))
    out = stage(spark, df, SF)
    if name != "packing":
        assert out.columns == df.columns
    out.collect()
    assert stage(spark, df.limit(0), SF).count() == 0
