"""A training corpus in five stages, each on all that the one before has kept.

``run(spark, sf_dir)`` applies ``STAGES`` to the table ``documents``; every stage's result is written as
Parquet to the shared scratch folder and read again. All stages but the last return the columns of the
documents (``n_chars``, where present, follows the text).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.llm import bpe, linedup, minhash, mixing, toxicity
from riskengine.llm.store import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; the classifier learns from this stage's documents
    and the table ``labels``."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines with 50 words or more are deleted. A document all of whose lines were
    such copies goes with them; one that had no words before stays."""
    out = linedup.delete_repeated_runs(docs).where("n_deleted = 0 or n_deleted < n_lines")
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    columns = [(changed[c] if changed.get(c) is not None else F.col("row").getField(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    return out.select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return minhash.keep_one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    taken = mixing.mix(docs).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) per document of the mix."""
    return bpe.encode(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", delete_repeated_lines),
    ("minhash_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("bpe_encode", encode),
]

#: A trained classifier and a tokenizer are not expressible in SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
