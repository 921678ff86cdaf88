"""Cleaning pipeline over `documents`: STAGES lists (name, function) in order.

Each function takes (spark, docs, sf_dir) and returns the rows for the next
stage; all but the last keep the columns of `documents`.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from marketlens.llm.common import shared_folder, table
from marketlens.llm.queries import LONG_RECURRING_FROM, RADIUS, RECURRING_FROM, SHINGLE, TOXIC_FROM, VOCABULARY, held_out

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is under the threshold; all of them where the
    labels allow no model (null and empty texts have the lowest score and stay)."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out("doc_id"))
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    if not model.fitted:
        return docs.select(*COLUMNS)
    return toxicity.score(docs, "text", model, "__score").where(F.col("__score") < TOXIC_FROM).select(*COLUMNS)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the lines of recurring templates; `n_chars` follows (a
    null text stays null, a text may become empty)."""
    kept = line_dedup.drop_recurring_lines(docs, "text", RECURRING_FROM, LONG_RECURRING_FROM)
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long"))
                           .otherwise(F.col("n_chars"))).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the smallest id's (null and empty
    texts are one group, rows that repeat or lack an id count as copies)."""
    return simhash.keep_first(docs, "doc_id", "text", SHINGLE, RADIUS).select(*COLUMNS)


def drop_leaking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark passage (null and empty texts hold none)."""
    return decontaminate.clean(docs, "text", table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed, see `bpe.encode`) and the text that they decode to."""
    done = bpe.round_trip(docs, "text", VOCABULARY, public_tokenizers.PATTERN)
    return done.select("doc_id", F.col("decoded").cast("string").alias("text"), "lang", "source", "n_chars",
                       "n_tokens", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("simhash_near_dedup", keep_one_of_each),
    ("decontamination", drop_leaking),
    ("byte_bpe", encode),
]

# Training a model, SimHash and tokenizing have no SQL form; tests/llm holds
# the pipeline against a brute-force version.
ORACLE_SQL = None


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this run, in whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`.  Each result but the last is written to the
    shared folder and read again, so no stage repeats the work before it; a
    result goes once the next one is written."""
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_folder(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
