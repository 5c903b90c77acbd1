"""A training-corpus pipeline over ``documents``: each stage calls one operator of eventflow.llm.

``STAGES`` lists (name, function) pairs; a function takes (spark, docs, sf_dir), works on all rows
its predecessor kept and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. ``run`` applies them in order to the whole table.

Corner cases, the same for every stage: a null text has no word, finding or personal value and stays null (packing:
its end id alone); an empty text likewise; texts of any length are taken whole; rows with a null id stay, each judged
by itself; rows that repeat an id are judged by their texts, and rows that repeat id and text stay or go together; of
equal texts the smallest id stays; other columns, whatever their names, pass through (packing gives its own); an
empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from eventflow.llm import decontam, jaccard, packing, pii, toxicity
from eventflow.llm.shared import shared_dir

#: Learnt weights, Unicode folding, keyed permutations and tokenizers have no SQL form; the tests
#: compare each stage with a brute-force version.
ORACLE_SQL = None
#: Near copies: five words a shingle, Jaccard similarity of 0.8 or more.
SHINGLE_WORDS, SIMILARITY = 5, (80, 100)
#: The corpus's secret is ``spark.eventflow.pii.key``; the test tables hold made-up data and go without.
PII_KEY = "no secret: test tables only"


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon does not reject (all columns kept)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.learn_from(docs, labels))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id."""
    return jaccard.keep_one(docs, size=SHINGLE_WORDS, num=SIMILARITY[0], den=SIMILARITY[1])


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms of the same format."""
    return pii.pseudonymise(docs, key=spark.conf.get("spark.eventflow.pii.key", PII_KEY))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training windows. Few words are kept: the workers still hold what
    other stages keep."""
    import public_tokenizers  # only here: the other stages, and the queries beside this module, do without

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), kept_words=300_000)


STAGES = [("toxicity", toxic_stage), ("near copies", near_copies_stage), ("benchmark decontamination", benchmark_stage),
          ("personal data", pii_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stages hand over Parquet tables in the shared folder. Each table goes when the
    next one stands, the last stays, as the result reads it; after a failure none stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    try:
        for k, (_, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k < len(STAGES) - 1:
                docs.write.parquet(f"{root}/{k}")
                docs = spark.read.parquet(f"{root}/{k}")
                _delete(spark, f"{root}/{k - 1}")
    except BaseException:
        _delete(spark, root)
        raise
    return docs


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
