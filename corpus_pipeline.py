"""From raw documents to packed training sequences.

Each stage takes (spark, documents, folder of the tables) and returns a DataFrame; all but the last return the columns of
documents. Each is written as Parquet and read again as the input of the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyed.llm import convnet, mixing, packing, simhash, substring
from keyed.llm.common import cut, load, ready

#: Probability of good quality below which a document goes.
LEAST_QUALITY = 0.5

#: SQL cannot express the network and the tokenizer; tests hold the stages against plain Python.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text the byte-level network, fitted on the labelled ones, finds good.

    A null or empty text has a score of its own, like any other; copies are judged alike. Rows, null ids and extra columns
    are kept as they are; without labelled rows the score is the prior. No rows give no rows.
    """
    ready(spark)
    net = convnet.train(docs, load(spark, sf_dir, "labels"), F.lit(True))
    scored = docs.withColumn("__score", convnet.probability_column(net))
    return scored.filter(F.col("__score") >= LEAST_QUALITY).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id.

    Null, empty and blank texts have fingerprint zero and are one group. Of rows that repeat an id and its text one stays; a row
    without an id stays only where its group has none with one. Extra columns are kept; no rows give no rows.
    """
    ready(spark)
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that one with a smaller id has; n_chars follows the text.

    Rows without an id or text stay as they are, and so do repeated rows of one id, which do not count against each other.
    A text may end up empty, its row stays. Extra columns are kept; no rows give no rows.
    """
    ready(spark)
    out = substring.remove_repeats(docs)
    shorter = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return shorter.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that each source weighs the square root of its bytes, in a global random order.

    A null source is a source of its own; one without any bytes gets no copies. Rows without an id, and rows of one id, are
    drawn alike. Extra columns are kept; no rows give no rows.
    """
    ready(spark)
    return mixing.mix(docs).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their places in sequences of 2048 tokens at most.

    A null or empty text is one piece of one token; repeated rows and rows without an id are packed one by one. Extra columns
    are not kept; no rows give no rows.
    """
    ready(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing", mix_sources),
    ("packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = cut(docs, f"stage-{n}")
    return docs
