"""Intermediate tables written to the shared folder of the session.

A staged table cuts the lineage of a frame that several branches of a job read, keeps
Parquet column pruning and statistics for them, and survives the loss of executors.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def stage_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="coursewise-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parameter_path(root: str, name: str, parameters: dict) -> str:
    """A path that carries a hash of every parameter the data depends on."""
    text = json.dumps(parameters, sort_keys=True, default=str)
    return f"{root.rstrip('/')}/{name}-{hashlib.sha256(text.encode()).hexdigest()[:16]}"


def memoised(spark: SparkSession, root: str, name: str, parameters: dict, build) -> DataFrame:
    """Read the dataset of these parameters, computing and writing it when absent.

    A write that died half way leaves no ``_SUCCESS`` marker, so it is redone.
    """
    path = parameter_path(root, name, parameters)
    try:
        spark.read.text(f"{path}/_SUCCESS")
    except AnalysisException:
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
