"""The corpus pipeline: stages over the documents, each written and reread as the next one's input.

Every stage takes all rows that its predecessor kept and returns the columns of ``documents``, the last one its
pieces. Further columns are dropped at the start, so none can clash with a stage's own. ``n_chars``
follows the text where a stage changes it. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm import jaccard, langid, mixing, pieces, pii
from rankflow.session import cut, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A document whose language is less likely than this among the learned ones is rejected, as is one without a letter.
# The likelihoods of four languages sum to one, so this hardly ever rejects a text with letters.
MIN_LANGUAGE_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, null ones among them, and those that fit several learned languages alike.

    A text in a language or script that was not learned goes to the nearest learned one and is kept.
    """
    docs = docs.select(*COLUMNS)
    predict = langid.predictor(spark, langid.fit(docs))
    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    found = docs.withColumn("found", predict(lettered))
    kept = (F.col("found.lang") != langid.UNDETERMINED) & (F.col("found.score") >= MIN_LANGUAGE_SCORE)
    return found.filter(kept).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return jaccard.without_near_duplicates(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind."""
    masked = pii.mask_documents(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents by the sources' target weights, up to three times each."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of a seeded segmentation, and whether they spell the text again."""
    encoded = pieces.encode(docs.select(*COLUMNS), check="lossless")
    return encoded.select(
        "doc_id", "lang", "source", "n_chars", F.size("ids").cast("bigint").alias("n_pieces"), "ids", "lossless",
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("encode", encode),
]

# Piece probabilities, votes, knapsacks and sampled segmentations are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as own:
        docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
        for name, stage in STAGES[:-1]:
            # What a stage needs on its way goes with it, and its input once its output is written.
            with scratch(spark) as inner:
                docs = inner.result(cut(stage(spark, docs, sf_dir), name))
            if written is not None:
                own.drop(written)
            written = docs
        return own.result(STAGES[-1][1](spark, docs, sf_dir))
