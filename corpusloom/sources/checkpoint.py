"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession) -> str | None:
    """Sees to it that there is a checkpoint folder. The session names it in spark.checkpoint.dir. Only where that is unset and all tasks
    run on this machine (local mode, as in tests) a temporary one is made; on a cluster that is an error."""
    sc = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not sc.getCheckpointDir():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint"))
    return sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder."""
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for a table within the checkpoint folder."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
