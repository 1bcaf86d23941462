"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    # Timestamps are stored without zone and mean UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the step after it then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "tidemill", **conf: str) -> SparkSession:
    """Get a session with the library's SQL settings.

    Master, memory and shuffle width stay with the cluster's own defaults unless given in ``conf``.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The shared folder for written intermediates and stream checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may go without: it gets a
    temporary folder, kept in the session so that later calls see the same one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
