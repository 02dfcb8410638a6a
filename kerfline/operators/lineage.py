"""Cutting the plan of iterative operators where every machine can read the rows again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints; one of this machine only where there are no others."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (named or f"{tempfile.gettempdir()}/checkpoints/kerfline").rstrip("/")


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing else has."""
    return f"{shared_folder(spark)}/kerfline-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
