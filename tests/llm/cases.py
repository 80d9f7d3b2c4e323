"""Documents with every awkward case, with extra columns named as the operators' own."""

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
ROWS = [
    (1, None, "en", "a"), (2, "", None, "a"), (3, " \t\n\r\x0b\x0c", "en", None), (4, "one two three four five six", "en", "a"), (4, "one two three four five six", "en", "a"),
    (5, "one  two\nthree four five six", "de", "b"), (6, LONG, "en", "b"), (7, LONG + " end", None, "b"), (None, "no id here but some words", "en", "c"), (None, None, None, None),
    (8, "Ünïcödé 漢字 😀 text\nwith lines\nand more", "fr", "c"), (9, "onetwothreefourfivesix", "en", "a"), (10, "x", "en", "zz"), (-3, "negative id", "en", "zz"), (10**15, "far id", "en", "zz"),
]
CLASHING = ("id", "node", "sign", "key", "rank", "size", "taken", "bucket", "lines", "n", "host", "path", "row", "label", "words", "kept", "score", "grams", "pos", "guest", "shard", "n_removed")


def documents(spark, rows=ROWS):
    df = spark.createDataFrame([(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows], SCHEMA)
    for c in CLASHING:
        df = df.withColumn(c, F.lit(f"other {c}"))
    return df


def empty(spark):
    return documents(spark).where("false")
