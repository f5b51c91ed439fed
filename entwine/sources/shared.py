"""The folder for staged tables that driver and executors share."""

from __future__ import annotations

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder in the warehouse, but only for a local master, where the one
    machine shares it with itself."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"
    return found.rstrip("/")
