"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. Only a local master may leave the setting unset, as in tests: it then gets a
    folder of its own. Elsewhere every executor would write to its own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="kindred-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/kindred-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet under spark.checkpoint.dir and read it again: what several branches of a plan read
    is computed once, and a lost executor costs no more than its running tasks."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
