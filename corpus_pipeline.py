"""A corpus pipeline of five stages over ``documents``: each takes (spark, docs, sf_dir) and returns a DataFrame.

All stages but the last return the columns of documents (doc_id, text, lang, source, n_chars); the
last returns doc_id, lang, source, n_chars, n_tokens and token_ids. ``run`` applies them in order,
each stage's result written as Parquet to the shared checkpoint folder and read again.

Stages: documents that the quality classifier rejects go; one document (the least id) of each group
of near-duplicates stays; spans of benchmark words are cut out of the texts; personal data becomes
``<KIND>`` marks; texts become token ids. No stage has SQL: models and shingle sets are not
expressible there, so tests hold each one against a brute-force version.

Defined cases: null texts are scored and linked like empty ones and stay null (no tokens); a near-duplicate
group of null ids alone keeps one row; of rows that share the least id one stays; repeated rows are
near-duplicates of each other; very long texts are read whole; an empty table passes through all
stages; columns other than those of documents go. Labels and benchmark are read from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftloom.llm import byte_cnn, decontaminate, near_copies, pii, tokens
from shiftloom.llm._spark import forget, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the byte-level classifier scores at 0.3 or more."""
    weights = byte_cnn.train_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return byte_cnn.keep_good(docs.select(COLUMNS), weights)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least id of each group of near-duplicates (Jaccard 0.8 or more on five-word shingles); of rows that share it, one."""
    return near_copies.keep_first(docs.select(COLUMNS))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every span of benchmark words out of the texts; all documents stay."""
    return decontaminate.cut_spans(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by marks; all documents stay."""
    return pii.mask(docs.select(COLUMNS))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens, token_ids of every document."""
    return tokens.with_tokens(docs.select(COLUMNS))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("tokens", tokens_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's rows go once the next one's are written, the last stage reads its predecessor's."""
    docs, path = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, new = stored(stage(spark, docs, sf_dir))
        if path:
            forget(spark, path)
        path = new
    return STAGES[-1][1](spark, docs, sf_dir)
