"""Queries over texts: near duplicates, packing, extraction, fingerprints."""

from __future__ import annotations

import public_tokenizers

from dosewise.llm import decontaminate, extraction, fingerprint, packing, simhash
from dosewise.llm.common import read, register


@register("op6_simhash_near_dedup")
def op6(spark, sf_dir):
    """SimHash components of all documents: 3-word shingles, 3 bits."""
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return out.select("doc_id", "fingerprint", "component_id")


@register("op4_host_suffix_extraction")
def op4(spark, sf_dir):
    """Main text of every page."""
    return extraction.extract(read(spark, sf_dir, "pages"))


@register("op5_sum_of_squares_packing")
def op5(spark, sf_dir):
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), window=1024)


@register("op8_rare_seed_decontamination")
def op8(spark, sf_dir):
    """Documents that contain benchmark items, with alignment scores."""
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register("op7_quartile_bucket_digest")
def op7(spark, sf_dir):
    """Digests of all documents, their edited texts, and likeness to both."""
    return fingerprint.compare(read(spark, sf_dir, "documents"))
