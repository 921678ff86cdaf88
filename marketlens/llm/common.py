"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
import tempfile
from typing import Any

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, lengthened until no column of `df` has it (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_key(text: Column) -> list[Column]:
    """128-bit content key of a text as two longs (null reads as empty).

    Rows are joined back to their texts by this key, never by an id, so rows
    that repeat an id, or have none, keep their own result.
    """
    t = F.coalesce(text, F.lit(""))
    # Spark seeds each hash with the one before: the constant goes first, so that
    # the text itself is hashed under a second seed.
    return [F.xxhash64(t), F.xxhash64(F.lit(1), t)]


def send(spark: SparkSession, value: Any) -> Broadcast:
    """Broadcast an object of a class of this subpackage, its code included, for
    workers that have no copy of the package; read it with `received`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast) -> Any:
    return pickle.loads(sent.value)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, which all executors share.

    Only a session on `local[...]` without that setting gets a scratch folder.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="marketlens-ckpt-", dir="/tmp")
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
