"""The corpus pipeline: quality, near duplicates, benchmark leaks, personal
data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet under the shared folder and the next stage reads it back.  All
but the last return the columns of ``docs``; extra columns are carried.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewise.llm import decontaminate, packing, pii, quality, simhash
from dosewise.llm.common import free_name
from dosewise.session import ensure_checkpoint_dir, stored

QUALITY = 0.3     # documents with a lower score go
SHINGLE, MAX_BITS = 3, 3
WINDOW = 1024
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels of the
    documents at hand, does not reject.  Without labels nothing is rejected
    unless most labels are 0; null and empty texts are scored as empty."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_name(docs, "quality_score")
    return quality.score(docs, model, score).where(F.col(score) >= QUALITY).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one with the smallest id.
    Empty texts are one component; of repeated rows one stays."""
    return simhash.deduplicate(docs, SHINGLE, MAX_BITS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage.  All rows of a contaminated id go;
    rows without an id cannot be named by the search and stay."""
    found = decontaminate.find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(stored(found.select("doc_id").distinct(), "contaminated"), "doc_id", "left_anti").select(*docs.columns)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows
    the new text.  Null texts stay null."""
    spans = free_name(docs, "pii_spans")
    out = pii.find(docs, "text", spans)
    text = pii.redacted("text", spans)
    columns = {c: F.col(f"`{c}`") for c in docs.columns} | {"text": text.alias("text")}
    if "n_chars" in columns:
        kept = F.when(F.size(spans) == 0, F.col("n_chars")).otherwise(F.length(text).cast(docs.schema["n_chars"].dataType))
        columns["n_chars"] = kept.alias("n_chars")
    return out.select(*columns.values())


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces in sequences of at most ``WINDOW`` ids."""
    return packing.pack(docs, VOCABULARY, WINDOW)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

# Hashing, learned scores and alignments have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
