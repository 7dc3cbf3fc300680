"""Small tables for the tests of the training-data operators."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
# further columns with names that operators use themselves
ODD = ("found", "value", "row", "d", "h", "key", "k1", "label", "score", "a", "words", "size", "taken", "text2")


def words(n, seed, size=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(size)}" for _ in range(n))


def hard_docs(spark, odd=True):
    """Nulls in every column, empty and wordless and very long texts, repeated rows, copies, ties."""
    base = words(60, 1)
    long = words(30_000, 2)
    rows = [
        (1, base, "en", "a", 10), (2, base, "en", "b", 10), (2, base, "en", "b", 10), (3, base + " extra", "en", None, None),
        (4, None, None, None, None), (5, "", "en", "a", 0), (6, "?! ...", "de", "b", 6), (7, long, "en", "a", len(long)),
        (8, long + " tail", None, "c", 1), (None, words(40, 3), "en", "c", 7), (None, None, None, None, None),
        (9, "one two three", "en", "c", 13), (10, "ONE  Two\tthree", "en", "a", 13), (11, "é日本 <|endoftext|> \x1c x  y ", "ja", "a", 5),
        (12, words(80, 4), "en", "a", 1), (13, words(80, 5), "en", "ü", 1), (13, words(80, 6), "en", "ü", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    if odd:
        for name in ODD:
            df = df.selectExpr("*", f"cast(doc_id as string) as {name}")
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def same_rows(left, right):
    return sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))
