"""Stored layers: a frame that several later steps read is written once and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tidemill.session import work_folder


def store(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a frame as Parquet to the shared work folder (or ``folder``) and return it read back.

    This ends the frame's lineage in a way that survives lost executors, computes it once for all
    readers, and lets later joins decide on the stored size instead of a guess.
    """
    spark = df.sparkSession
    path = folder or f"{work_folder(spark)}/layers/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*frames: DataFrame) -> None:
    """Remove the folders of stored frames. Call it only when whatever reads them has been stored itself."""
    for frame in frames:
        path = frame.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(frame.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
