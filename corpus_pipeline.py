"""Corpus pipeline: language, near duplicates, benchmark leaks, personal data, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomart.llm import decontam, forest, langid, mixing, pii
from sonomart.operators.staging import stage

# A document whose best language labels less than this share of its letters is a jumble of languages.
MIN_LANGUAGE_SCORE = 0.35
# Similarity of near duplicates, in percent.
SAME_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or without a leading language; ``lang`` becomes the predicted one.

    The model learns from the labelled rows of ``docs`` that are not held out.
    """
    model = langid.fit(docs.filter(~langid.held_out("doc_id")))
    columns = docs.columns
    # Labels are predicted from a copy of the text, so all columns pass through unchanged.
    renamed = docs.toDF(*[f"in_{i}" for i in range(len(columns))])
    text = f"in_{columns.index('text')}"
    found = langid.predict(renamed, model, renamed.columns, text_col=text)
    kept = found.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*[(F.col("lang_pred") if c == "lang" else F.col(f"in_{i}")).alias(c) for i, c in enumerate(columns)])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each near-duplicate group."""
    return forest.drop_near_duplicates(docs, SAME_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap a test item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; ``n_chars`` follows the text."""
    redacted = pii.redact(docs, pii.fit(docs))
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: id, source and the words to take of each document, which may be several epochs or a part."""
    mixed = mixing.mix(docs)
    return mixed.filter("taken > 0").select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", redact_personal_data),
    ("mixture", mix_sources),
]

# Language, near duplicates and personal data rest on trained models or random signatures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
