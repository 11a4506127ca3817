"""Small tables with the awkward cases that every operator meets."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def documents(spark, rows):
    """Rows of (doc_id, text)."""
    full = [(i, t, "en", None, None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCUMENTS)


PASSAGE = "This passage of well over fifty bytes is shared by several of the documents here, word for word."
ODD = [
    (1, "Plain words, some of them twice. Plain words, some of them twice."),
    (2, None), (3, ""), (4, " \t\n "), (5, "é"), (6, "日本語 テキスト 😀 combining é"),
    (7, "Start. " + PASSAGE + " End of seven."), (8, PASSAGE), (9, PASSAGE), (10, "Other begin " + PASSAGE.upper() + " " + PASSAGE),
    (11, "x" * 300), (12, "x" * 299 + "y"), (13, "ab " * 4000), (None, PASSAGE), (None, None),
    (14, "nul \x00 inside \x1c\x85 text"), (15, "one two three four five six seven eight nine ten eleven"),
    (16, "Same id"), (16, "Same id"), (16, "same id, other text"),
]
EXTRA = ["id", "text_hash", "hash", "row", "fp", "component_id", "score", "block", "doc", "hits", "k", "kept", "label"]


def clashing(df):
    """With extra columns of names that operators use themselves."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in EXTRA])
