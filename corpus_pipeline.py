"""Corpus pipeline: five stages over the table documents, each written as Parquet and read again.

Each stage works on all rows that its predecessor kept, and all but the last
return the columns of documents. Null and empty texts have no words and are
rejected by the first stage; repeated rows are near-duplicates of each other;
an empty table stays empty; columns beyond those of documents are left out.
The tables that a stage has written for itself are dropped when the next stage
begins, which reads the stage's own output and not them.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import drop_tables, listed_tables, materialize, shared_dir, table
from eventide.llm.decontamination import decontaminate
from eventide.llm.jaccard_join import BROADCAST_IDS, jaccard_components
from eventide.llm.quality_rules import quality_rules
from eventide.llm.segmentation import sample_segmentations
from eventide.llm.suffix_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near duplicates: shingles of five words, similarity of 4/5 or more.
SHINGLE, NUM, DEN = 5, 4, 5
#: Bytes of a repeated passage: somewhat less than 50 short words.
PASSAGE = 240
#: Most rows that a stage hands to Python at once (Spark's own default is 10 000): a batch of whole texts is held by the task on both sides.
BATCH_ROWS = 1_000


_written: list[str] = []


def stage(f):
    """A stage, which first drops the tables of the one before."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _written)
        if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, BATCH_ROWS + 1):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        with listed_tables() as paths:
            kept = f(spark, docs, sf_dir)
        _written.extend(paths)
        return kept

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest doc_id (null last), of equal ones that with the smallest text hash.

    Rows are known by a hash of doc_id and text, so two texts under one doc_id
    are judged each, and rows without a doc_id too; of equal rows one stays.
    """
    docs = docs.select(*COLUMNS)
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    classes = jaccard_components(keyed.select(F.col("__key").alias("doc_id"), "text"), SHINGLE, NUM, DEN)
    ids = keyed.groupBy("__key").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    members = materialize(ids.join(classes.select(F.col("doc_id").alias("__key"), "component_id").distinct(), "__key"), "members")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "__key")).alias("first"))
    dropped = members.join(first, "component_id").where("__key <> first.__key").select("__key")
    dropped, repeated = materialize(dropped, "dropped"), materialize(members.where("n > 1").select("__key"), "repeated")
    kept = keyed.join(_sized(dropped), "__key", "left_anti")
    first = kept.join(_sized(repeated), "__key", "left_semi").dropDuplicates(["__key"])
    return kept.join(_sized(repeated), "__key", "left_anti").unionByName(first).select(*COLUMNS)


def _sized(keys: DataFrame) -> DataFrame:
    """Broadcast after a check of its size."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur more than once; a character that a passage's edge cuts goes with it."""
    cleaned = remove_repeats(docs.select(*COLUMNS), PASSAGE)
    return cleaned.withColumn("text", F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))).withColumn(
        "n_chars", F.length("text").cast("long")).select(*COLUMNS)


@stage
def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate.

    The number beside the verdict is not deterministic for Spark, which keeps
    the filter above the verdict's own columns: pushed below them, it would
    take the text apart again for every word that is compared.
    """
    judged = decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return judged.withColumn("__at", F.monotonically_increasing_id()).where("NOT contaminated AND __at >= 0").select(*COLUMNS)


@stage
def segmented(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document."""
    return sample_segmentations(docs.select(*COLUMNS)).drop("text")


STAGES = [
    ("quality_rules", quality), ("jaccard_join", near_duplicates), ("suffix_dedup", repeated_passages), ("decontamination", benchmark_free),
    ("segmentation", segmented),
]
#: Divergences, signatures, suffix runs and sampling have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, step in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        step(spark, docs, sf_dir).write.parquet(path)
        drop_tables(spark, before)  # what this stage has read
        before, docs = [path], spark.read.parquet(path)
    return docs
