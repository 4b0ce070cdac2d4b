"""Documents that every operator has to cope with."""

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()), ("kept", T.StringType()), ("rank", T.LongType()), ("td", T.StringType()), ("spans", T.StringType()), ("_text", T.StringType()), ("node", T.StringType()), ("length", T.StringType()))])
LONG = "a very long text indeed, with words " * 6000
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "no id here"), (None, None), (5, "same row"), (5, "same row"), (6, "same row"),
    (7, LONG), (8, "x" * 20000), (9, "Ünï çödé 中文 \U0001f600 word " * 20), (10, "\x00 nul and \x1c separators \x85 too"),
]


def frame(spark, rows):
    """Rows of (doc_id, text), with columns of clashing names filled with other things."""
    return spark.createDataFrame([(i, t, None, "s", -1, "kept", 5, "td", "spans", "other", "node", "length") for i, t in rows], SCHEMA)


def edge(spark):
    return frame(spark, ROWS)


def empty(spark):
    return frame(spark, [])


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))
