"""What the file system knows about datasets: the one place with JVM handles.

Starts no job and opens no data file but to write a table.
"""

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the dataset at ``path``; returns what is now there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def location(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def content(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and number of files below ``path``."""
    file_system, place = location(spark, path)
    summary = file_system.getContentSummary(place)
    return summary.getLength(), summary.getFileCount()


def folders(spark: SparkSession, path: str, below: str = "") -> list[str]:
    """Names of the folders directly below ``path``, or below a folder in it that may be missing."""
    file_system, place = location(spark, f"{path}/{below}" if below else path)
    if below and not file_system.exists(place):
        return []
    return sorted(
        status.getPath().getName() for status in file_system.listStatus(place) if status.isDirectory()
    )


def content_version(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Latest modification time, bytes and number of files of a dataset."""
    file_system, place = location(spark, path)
    latest = file_system.getFileStatus(place).getModificationTime()
    files = file_system.listFiles(place, True)
    size = count = 0
    while files.hasNext():
        status = files.next()
        latest, size, count = max(latest, status.getModificationTime()), size + status.getLen(), count + 1
    return latest, size, count


def escaped(spark: SparkSession, value: str) -> str:
    """A value as partition directories spell it."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern stands for, or a path itself."""
    file_system, place = location(spark, pattern)
    return sorted(status.getPath().toString() for status in file_system.globStatus(place) or [])


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    file_system, place = location(spark, path)
    file_system.create(place, True).close()


def exists(spark: SparkSession, path: str) -> bool:
    file_system, place = location(spark, path)
    return file_system.exists(place)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: that of the session's file system if it has none."""
    file_system, place = location(spark, path)
    return file_system.makeQualified(place).toString()
