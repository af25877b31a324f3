"""Rows that every operator has to cope with, and small helpers of the tests."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
STEMS = ["amber", "basil", "cedar", "delta", "ember", "fable", "grove", "haven", "inlet", "jumbo"]
CLASHING = ["key", "digest", "salt", "norm", "hash", "size", "row", "id", "label", "n", "range", "copy",
            "start", "score", "word", "sample", "__key", "__hash", "__copy", "__bucket", "__n", "a.b"]


def prose(rng, words, vocabulary=400):
    """Sentences of made-up words."""
    said = [f"{STEMS[rng.randrange(10)]}{rng.randrange(vocabulary // 10)}" for _ in range(words)]
    return " ".join(w + "." if i % 9 == 8 else w for i, w in enumerate(said))


def documents(spark, rows, partitions=5):
    """Documents of (doc_id, text) rows; a third are of one source, some of none."""
    full = [(k, t, "en", None if i % 7 == 6 else "hot" if i % 3 == 0 else f"s{i % 5}", 0)
            for i, (k, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS).repartition(partitions)


def odd_rows():
    """Null and empty texts, null and repeated keys, repeated rows, one very long text."""
    return [(1, None), (2, ""), (3, " \n\t"), (None, "no key here at all"), (None, None), (4, "same row twice"),
            (4, "same row twice"), (4, "same key, other text"), (5, "été ÉTÉ naïve Ärger"), (6, "x y " * 30_000),
            (7, "word"), (8, "two words"), (9, "control \x1c sign and separators here")]


def clashing(df):
    """The same rows with columns named as operators name their own."""
    return df.select("*", *[F.lit("clash").alias(n) for n in CLASHING if n not in df.columns])


def values(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=str)
