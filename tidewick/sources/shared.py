"""The folder that all machines of a cluster share, for tables that later steps read more than once."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; in local mode, as in tests, a temporary one where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    return (found or tempfile.mkdtemp()).rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """The name of a new folder there."""
    return f"{shared_base(spark)}/candles-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The rows of df, computed now and kept there, for plans that use them more than once."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_base(df.sparkSession))
    return df.checkpoint(eager=True)
