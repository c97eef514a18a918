"""From raw documents to encoded training text, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next one's ``docs``. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.llm import classifier, jaccard, line_dedup, mixing, pieces
from featuremart.llm.common import stored, table, text_of, word_count
from featuremart.llm.queries import LINE_RULE, MIX_SEED, MIX_WEIGHTS, QUALITY_FROM, with_domain

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies: five words, a similarity of 0.8.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Part of the tokens that the mixture keeps; no document twice.
KEPT_SHARE = 0.9


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = classifier.train(docs, table(spark, sf_dir, "labels"))
    return classifier.classify(docs, model, score="_score").where(F.col("_score") >= QUALITY_FROM).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their site's boilerplate lines."""
    cleaned = line_dedup.drop_boilerplate(docs, F.col("source"), "text", **LINE_RULE)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return jaccard.one_per_group(docs, words=NEAR_WORDS, percent=NEAR_PERCENT).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture, none more than once."""
    tree = ["_domain", "lang", "source"]
    mixed = mixing.mix(with_domain(docs, "_domain"), tree, word_count(text_of("text")), KEPT_SHARE, 1, MIX_WEIGHTS, MIX_SEED)
    return mixed.select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text."""
    out = pieces.encode(docs.select(*COLUMNS), pieces.load_vocabulary())
    return out.select("doc_id", "lang", "source", F.size("pieces").cast("bigint").alias("n_pieces"), "pieces")


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("mixture", mixture), ("encoded", encoded)]

#: The first stage fits a model, which SQL can't express; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
