"""Intermediate results, written once to the folder that the driver and all executors share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; of a session in one process, one of its own if unset.

    On a cluster a folder of one machine is no use to the others, so there it is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints"
    return where


def written(df: DataFrame) -> DataFrame:
    """The rows, read back from the shared folder: computed once however often they are used."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


@contextmanager
def passing_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder where all machines see it, which goes at the end with all that is in it; return only what was ``written`` before."""
    at = f"{shared_folder(spark)}/{name}_{uuid.uuid4().hex}"
    try:
        yield at
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
