"""Queries of the learned operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewise.llm import lm, quality, toxicity
from dosewise.llm.common import fold, read, register


@register("op1_maxent_language_model")
def op1(spark, sf_dir):
    """Log10 probability of every document, trained outside fold 0 of 10."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model, rare = lm.train(docs, held_out=10)
    scored = lm.score(docs, model, rare)
    return scored.select("doc_id", (fold(F.col("doc_id"), 10) == 0).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


@register("op9_attention_mil_quality")
def op9(spark, sf_dir):
    """Quality of every document, trained outside fold 0 of 5."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"))


@register("op2_crf_toxicity")
def op2(spark, sf_dir):
    """Toxicity of every document with its toxic spans, trained outside fold 0 of 5."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return toxicity.tag(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"), spans.alias("spans"))
