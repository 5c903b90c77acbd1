"""Rows that every operator must handle: nulls, empty and long texts, ties, repeats."""

LONG = "long text with many words and few repeats " * 4000


def documents(spark, rows=None):
    rows = rows if rows is not None else [
        (1, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 10),
        (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \n\t ", "en", "b", 4), (5, "word", "de", "b", 4),
        (None, "a row without an id but with some words in it", "en", None, 1),
        (6, LONG, "en", "c", len(LONG)), (7, "same text twice over here for you and me", "en", "c", 1), (7, "same text twice over here for you and me", "en", "c", 1),
        (8, "émile à la plage ça va où là-bas ünïcode ß 日本語 🙂 naïve", "fr", "c", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


# Names that operators use inside; as input columns they must not clash.
CLASHING = ["id", "node", "score", "comp", "tie", "key", "rank", "pii_hits", "toxic_score", "u", "v", "row", "component"]


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(1).alias(c) for c in CLASHING])


def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
