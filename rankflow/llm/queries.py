"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm import (
    ann, edited, jaccard, kdtree, langid, lexical, mixing, pieces, pii, quality, repair, simhash, urls, warc,
)
from rankflow.llm.common import table
from rankflow.session import cut

# The rules of the URL query.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def _remainder(column: str, divisor: int):
    """crc32 of an id as text, modulo ``divisor``; a null id has none."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(divisor))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also ``near_others`` for ids divisible by 100: other documents of the table whose fingerprints are within the
    radius, equal ones included."""
    rows = cut(edited.fingerprints_with_edits(table(spark, sf_dir, "documents")), "fingerprints")
    asked = F.coalesce(F.col("id") % 100 == 0, F.lit(False))
    asking, others = rows.filter(asked), rows.filter(~asked)
    all_prints = rows.select(F.col("own").alias("fingerprint"))
    near = simhash.count_near(asking.select(F.col("own").alias("fingerprint")), all_prints)
    counted = asking.join(near, F.col("own") == F.col("query"), "left")
    # The document itself is one of the rows.
    counted = counted.withColumn("near_others", F.col("rows") - 1).drop("query", "rows")
    # Rows that do not ask have no part in the join.
    whole = counted.unionByName(others.withColumn("near_others", F.lit(None).cast("bigint")))
    return whole.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        simhash.as_text(F.col("own")).alias("fingerprint"),
        simhash.as_text(F.col("edited")).alias("edited_fingerprint"),
        simhash.likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        simhash.likeness(F.col("own"), F.col("next")).alias("near_next"), "near_others",
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "source",
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(_remainder("doc_id", 4) != 2))
    held_out = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= quality.PREDICT_FROM).cast("int").alias("predicted"),
    )


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number and a hash of its pieces, and whether they spell the text again."""
    encoded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), check="lossless")
    return encoded.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"),
        F.size("ids").cast("bigint").alias("n_pieces"), F.xxhash64("ids").alias("pieces_hash"), "lossless",
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(_remainder("doc_id", 5) != 0))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
    )


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])
    kinds = F.transform(base, lambda x: x["kind"])
    counts = [
        (F.size(base) - F.size(F.array_remove(kinds, i))).cast("bigint").alias(f"n_{kind}")
        for i, kind in enumerate(pii.BASE_KINDS)
    ]
    return found.select(
        F.col("id").alias("doc_id"), *counts,
        F.sha2(pii.listing(base), 256).alias("base_sha256"), pii.listing(F.col("spans")).alias("spans"),
    )


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, rule string")
    judged = urls.judge_urls(table(spark, sf_dir, "pages"), rules)
    return judged.withColumnRenamed("id", "page_id")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


def op13_exact_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kdtree.largest_products(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_mix": op3_mix,
    "op4_quality": op4_quality,
    "op5_pieces": op5_pieces,
    "op6_warc": op6_warc,
    "op7_language": op7_language,
    "op8_personal_data": op8_personal_data,
    "op9_urls": op9_urls,
    "op10_nearest": op10_nearest,
    "op11_lexical_search": op11_lexical_search,
    "op12_repair": op12_repair,
    "op13_exact_products": op13_exact_products,
}
