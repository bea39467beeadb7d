"""The corpus pipeline: five stages over ``documents``, each written and read again.

Quality rules drop what they reject, the n-gram Jaccard join keeps the smallest id of every group,
decontamination drops documents that hold a benchmark passage, secret scans replace secrets in the
texts, and the last stage encodes and decodes the texts that are left. Stages that drop something decide
by row, with a key of their own that is written once: a row without an id is judged like others, and of
rows that repeat an id and a text one stays. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyspark.llm import bpe, decontaminate, ngram_join, outliers, secrets_crf
from storyspark.llm.common import bounded_batches, documents, without
from storyspark.llm.queries import RANKS, coded_digests
from storyspark.session import written


#: Column that names the rows of a stage's input, for that stage only.
ROW = "_stage_row"
#: Bytes of an Arrow batch of texts, about.
BATCH_BYTES = 4 << 20


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key per row, written once so that every later read sees the same keys."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), "keyed")


def dropped(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows whose key is not in ``gone``, with the columns of the stage's input."""
    return without(rows, written(gone.select(ROW), "gone"), ROW).drop(ROW)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    rows = keyed(docs)
    return dropped(rows, outliers.quality_rules(rows, id_col=ROW).where("NOT kept"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates (five-word shingles, Jaccard 0.8 or more): the one
    with the smallest id; one without id stays only where no other row of the group has any."""
    rows = keyed(docs)
    joined = written(ngram_join.jaccard_join(rows, size=5, percent=80, id_col=ROW).select(ROW, "component_id"), "joined")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)
    stays = (joined.join(rows.select(ROW, "doc_id"), ROW).groupBy("component_id").agg(F.min(order).alias("first"))
             .select(F.col(f"first.{ROW}").alias(ROW)))
    return dropped(rows, joined.join(stays, ROW, "left_anti"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    rows = keyed(docs)
    return dropped(rows, decontaminate.leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=ROW))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced and ``n_chars`` counted anew where the text changed."""
    clean = secrets_crf.redact(docs.withColumn("_before", F.char_length("text")), secrets_crf.learn(docs))
    now = F.char_length("text")
    return clean.withColumn("n_chars", F.when(now == F.col("_before"), F.col("n_chars")).otherwise(now)
                            .cast(docs.schema["n_chars"].dataType)).drop("_before")


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with digests of the ids and of what they decode to.

    The ids are written in between, so that a task holds the worker of one of the two steps, not of both.
    """
    ranks = public_tokenizers.path(RANKS)
    with bounded_batches(spark, BATCH_BYTES):
        ids = written(bpe.encode(docs, ranks), "ids")
    return coded_digests(bpe.decode(ids, ranks))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("byte_level_bpe", byte_level_bpe),
]

#: No SQL: the secret stage is a learned field; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
