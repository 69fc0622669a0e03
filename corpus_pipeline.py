"""A corpus pipeline: each stage takes the documents that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigmill.llm import byte_bpe, decontaminate, near_dedup, span_dedup, toxicity
from sigmill.llm.common import materialize, table, unused
from sigmill.llm.queries import vocabulary_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold.

    Null and empty texts have the score of the bias, which is low, and stay; rows that repeat an id
    are judged each by its text; columns named like the model's (score, predicted) keep their values.
    """
    verdict = unused(docs, "score", "predicted")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, names=tuple(verdict)).where(F.col(verdict[1]) == 0).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Null and empty texts are like nothing and stay, as do rows with a null id; rows that repeat an id
    stay or go together.
    """
    return near_dedup.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the sentences of repeated passages; n_chars follows the text.

    Null texts stay null, texts without a repeat stay byte for byte, as do rows with a null id; every
    row stays. Columns named like the operator's counts keep their values.
    """
    counts = unused(docs, "n_sentences", "n_removed")
    out = span_dedup.remove_repeats(docs, counts=tuple(counts))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(counts[1]) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts have none, and rows with a null id stay."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"), any_case=True).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to; null and empty texts have no tokens, every row stays."""
    return byte_bpe.round_trip(docs, vocabulary_path(), *(c for c in ("lang", "source") if c in docs.columns))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", keep_one_of_each),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_leaks),
    ("byte_bpe", tokenize),
]

#: The classifier and the tokenizer cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
