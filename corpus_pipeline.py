"""Raw documents to token ids: five stages, each one of the operators of lakepipe.llm.

Every stage takes all that the one before kept, is written as Parquet to the shared folder and read
again. Documents leave with their language undetermined (no letters, no text) or too unsure, as
exact or near copies of others (one of each group stays), or as carriers of benchmark items. Columns
besides those of documents pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm import byte_bpe, decontamination, exact_dedup, jaccard_join, language_id
from lakepipe.llm.frames import fresh_name, table
from lakepipe.session import scratch_path, shuffles_removed
from lakepipe.sources.writers import remove

#: A document whose language gets a lower score than this is rejected.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the network knows; learnt from the documents that come in.

    If no document tells its language, the network knows none: then all documents with letters stay.
    Null and empty texts, and texts without letters, go. Rows with null or repeated ids are judged
    like all others, each by its own text. No rows give no rows.
    """
    model = language_id.fit(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    lang, score = fresh_name(docs, "_lang_pred"), fresh_name(docs, "_lang_score")
    found = language_id.identify(docs, model, into=(lang, score))
    keep = (F.col(lang) != language_id.UNDETERMINED) & (F.col(score) >= LEAST_SCORE)
    return found.filter(keep).drop(lang, score)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest id; a null id is smaller than any other.

    Null and empty texts are equal. Of rows that agree in id and text one stays. No rows give no rows.
    """
    return exact_dedup.keep_unique(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that of the smallest id; a null id is smaller than any other.

    Texts without words are like no other and all stay. Rows that agree in id and text stay or go
    together. No rows give no rows.
    """
    return jaccard_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Each row is judged by its own text, so null and repeated ids play no role; null and empty texts
    hold nothing and stay. Without benchmark items all rows stay; no rows give no rows.
    """
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the token ids, and what decoding them gives as a digest; other columns end here.

    One row for each row, null and repeated ids included; null and empty texts have no token ids.
    """
    encoded = byte_bpe.encode(docs.select("doc_id", "text", "lang", "source"), into="ids")
    return byte_bpe.decode(encoded, ids="ids", into="decoded").select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("decontaminate", decontaminate),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        kept = stage(spark, docs, sf_dir)
        with shuffles_removed(spark):
            kept.write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs


#: A trained network and byte-pair merges have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None
