"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only where it is unset and all runs on one machine (tests) a local one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file:///tmp/vocabmill-shared"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write and reread: cuts the lineage of loops and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
