"""Small inputs for the tests of the training-data operators."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

#: Columns whose names the operators use inside.
CLASH = {"rank": 1, "copies": 2, "key": "k", "tag": 3, "n": 4, "row": 5, "score": 0.5, "_k": 6, "s": 7, "group": "g", "size": 9, "_key": 1, "words": "w"}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, clash=False):
    """A documents table of (doc_id, text[, source]) rows, dealt over a few tasks."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, COLUMNS).repartition(3)
    if clash:
        df = df.withColumns({k: F.lit(v) for k, v in CLASH.items()})
    return df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
