"""Tables that hold intermediate results on storage every executor can reach."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from incidentlens.sources.files import location, write_table

_PROCESS = uuid.uuid4().hex


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder the session names in ``spark.checkpoint.dir``.

    Where the setting is missing on a single machine, as in tests, the session's warehouse
    folder takes its place; on a cluster that is an error, as the folder may not be shared.
    What is left there is removed when the session's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        base = spark.conf.get("spark.sql.warehouse.dir")
    root = f"{base.rstrip('/')}/incidentlens/{spark.sparkContext.applicationId}-{_PROCESS}"
    file_system, place = location(spark, root)
    file_system.mkdirs(place)
    file_system.deleteOnExit(place)
    return f"{root}/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to a scratch table and read it from there.

    Unlike a cache it does not go back to the source when an executor is lost.
    """
    return write_table(df, scratch_path(df.sparkSession, name))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a dataset; nothing happens if it is not there."""
    file_system, place = location(spark, path)
    file_system.delete(place, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """A job has finished writing the dataset, and it is still there."""
    file_system, place = location(spark, f"{path}/_SUCCESS")
    return file_system.exists(place)
