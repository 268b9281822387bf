"""The corpus pipeline: language, near copies, benchmark leaks, personal data,
tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``docs``, extra ones included. Documents are named by ``doc_id``:
rows that share one are kept or dropped together, and rows without one cannot be
named by a decision and are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm import bpe, decontaminate, language, neardup, pii
from wardlens.llm.common import Workspace


def _without(docs: DataFrame, dropped: DataFrame, work: Workspace) -> DataFrame:
    """``docs`` without the listed ids (doc_id)."""
    gone = work.keep(dropped.select(F.col("doc_id").alias("__dropped")), "dropped")
    return docs.join(gone, F.col("doc_id") == F.col("__dropped"), "left_anti")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose text is in none of the languages: no letters, or
    likelier noise than any language. Evidence: the text, the declared
    language (lang) and the source's prior. Null and empty texts are in no
    language and go; of rows that share an id one in a language keeps all; a null
    lang or source is no evidence; texts of any length are read whole."""
    work = Workspace(spark, "pipeline-language")
    model = language.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    evidence = language.text_evidence(docs, model, "doc_id", F.col("text"), F.lower("lang"),
                                      F.col("source"))
    found = language.identify(evidence, model, work)
    rejected = (found.where("key is not null").groupBy(F.col("key").alias("doc_id"))
                .agg(F.max(F.col("lang") != language.UNKNOWN).alias("known")).where("not known"))
    return _without(docs, rejected, work)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each group of near copies.
    Null and empty texts are copies of nothing and stay; repeated rows of one id
    stay together; an empty table stays empty."""
    work = Workspace(spark, "pipeline-neardup")
    return _without(docs, neardup.near_duplicates(docs, work).where("not kept"), work)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item. Null and empty
    texts hold none and stay, as do all documents if there are no items."""
    work = Workspace(spark, "pipeline-decontaminate")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.decontaminate(docs, items, work).where("contaminated"), work)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms; n_chars follows the new text and is
    null for a null text. Rows are treated one by one, so order, ties and
    repeated rows do not matter."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return pii.pseudonymise(rows).select(
        *[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the token ids, and the text they decode to.
    A null text has no ids and decodes to an empty one; every row gives one row,
    also without an id or with a repeated one."""
    decoded = bpe.encode(docs, decoded=True)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

# Language likelihoods and merges of byte pairs are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
