"""Small awkward inputs shared by the tests."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def docs(spark, texts, ids=None):
    """A documents table of the given texts."""
    ids = list(range(1, len(texts) + 1)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)


def clashing(df):
    """Extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    for c in ("fp", "root", "component_id", "score", "uid", "h", "n", "y", "seed", "pid", "words", "bucket", "found",
              "pii_spans", "quality_score", "host", "path", "rule"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("x"))
    return df


AWKWARD = [None, "", " \t\n", "one", "One two", "one two three", "one two three", "x" * 50_000, "word " * 30_000,
           "é ñ ß 日本 😀 ok", "a@b.c +1 555 123 4567 89", "<|endoftext|> 'll re's"]


def vocabulary_words(seed, n, size=400):
    import random
    r = random.Random(seed)
    pool = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 8))) for _ in range(size)]
    return [r.choice(pool) for _ in range(n)]
