"""Fixtures shared by the tests of the training-data operators."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def documents(spark, rows):
    """A documents table of (doc_id, text) or (doc_id, text, lang) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] else 0) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    """The same rows with extra columns whose names clash with names in use."""
    from pyspark.sql import functions as F

    names = ["DOC_ID", "Text", "shard", "slot", "length", "_pid", "_rn", "h", "words", "stratum", "label"]
    return df.select("*", *[F.lit("x").alias(n) for n in names])


ODD_TEXTS = [
    (1, "plain words here, and more."),
    (2, None),
    (3, ""),
    (4, "plain words here, and more."),
    (None, "no id\nbut two lines"),
    (4, "plain words here, and more."),
    (7, "   \n\t "),
    (8, "long " * 9000),
    (9, "é🙂 ünï  \n\n <|endoftext|> don't"),
]
