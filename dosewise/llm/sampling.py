"""A bounded sample of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.llm.common import fold


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int, folds: int = 5) -> DataFrame:
    """(doc_id, text, y): at most ``most`` labelled rows of each class, taken in
    the order of a hash of the id, outside fold 0 of ``folds``.

    Only 0 and 1 are labels; rows without an id or label take no part; an id
    with several labels counts as its smallest, an id on several rows gives one
    of them (the smallest text).
    """
    y = (labels.where(F.col(label).isin(0, 1) & (fold(F.col("doc_id"), folds) != 0))
         .groupBy("doc_id").agg(F.min(label).cast("int").alias("y")))
    rank = F.xxhash64(F.col("doc_id").cast("string"))
    picked = None
    for v in (0, 1):
        p = y.where(F.col("y") == v).orderBy(rank, "doc_id").limit(most)
        picked = p if picked is None else picked.unionByName(p)
    return (docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .join(picked, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y")))


def class_sizes(labels: DataFrame, label: str, folds: int = 5) -> tuple[int, int]:
    """How many labelled training rows each class has."""
    rows = (labels.where(F.col(label).isin(0, 1) & (fold(F.col("doc_id"), folds) != 0))
            .groupBy(F.col(label).cast("int").alias("y")).agg(F.countDistinct("doc_id").alias("n")).collect())
    n = {r.y: r.n for r in rows}
    return n.get(0, 0), n.get(1, 0)
