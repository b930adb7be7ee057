"""Parquet datasets: all flagged records, and the stored ones by borough."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlens.schema import FLAGGED_SCHEMA, PARTITION_COLUMN, STORED_SCHEMA
from incidentlens.sources.files import content, escaped, folders
from incidentlens.sources.files import write_table as write_table
from incidentlens.sources.spread import dealt

#: Records that a task of the store step sorts without adaptive execution: some 100 MB, which it needs not spill.
ROWS_PER_TASK = 250_000

_CLUSTER_COLUMNS = (PARTITION_COLUMN, "ARREST_PRECINCT")


def read_flagged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FLAGGED_SCHEMA).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    max_records_per_file: int = 0,
    rows_per_task: int = ROWS_PER_TASK,
    only_touched: bool = False,
) -> None:
    """Replace the dataset at ``path``, one directory per borough, Snappy Parquet.

    There are only a handful of boroughs, so a plain ``repartition`` by borough
    would leave all but a handful of tasks idle and give the largest borough to
    one of them. Records are therefore spread by borough and precinct. With adaptive
    execution the rebalance hint does it: what exceeds the advisory partition size is
    split, also a single precinct, and small ones are put together. Without it
    :func:`dealt` does, by counts and ``rows_per_task``. Each file then holds few
    precincts, in order, and a precinct filter skips most files and row groups of a
    borough by their statistics. The order costs nothing: Spark sorts by the partition
    column anyway.

    ``only_touched`` leaves the directories of boroughs that ``df`` has no records of.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    spread = df.hint("rebalance", *_CLUSTER_COLUMNS) if adaptive else dealt(df, _CLUSTER_COLUMNS, rows_per_task)
    (
        spread.sortWithinPartitions(*_CLUSTER_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_touched else "static")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(PARTITION_COLUMN)
        .parquet(path)
    )


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Read what :func:`write_partitioned` wrote.

    A missing or empty borough comes back as NULL; other keys come back as the
    text they were, also where they look like numbers.
    """
    return spark.read.schema(STORED_SCHEMA).parquet(path)


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file below ``path``: its partition directory and size.

    Neither column needs the file's content, so no file is opened, but tasks are
    scheduled by size: for totals use :func:`storage_report`.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    directory = F.regexp_extract("path", f"/{PARTITION_COLUMN}=([^/]*)/[^/]*$", 1)
    return files.select(
        F.nullif(directory, F.lit("")).alias("partition"),
        F.col("length").alias("bytes"),
    )


def partition_list(spark: SparkSession, path: str) -> DataFrame:
    """The partition directories of a stored dataset, listed when called."""
    return spark.createDataFrame([(name,) for name in partition_names(spark, path)], "partition string")


def partition_names(spark: SparkSession, path: str) -> list[str]:
    """Values of the partition directories, as directories spell them."""
    start = f"{PARTITION_COLUMN}="
    return [name.removeprefix(start) for name in folders(spark, path) if name.startswith(start)]


def partition_name(spark: SparkSession, value: str | None) -> str:
    """The way directories spell a value; a missing one and an empty one are the same."""
    return escaped(spark, value) if value else "__HIVE_DEFAULT_PARTITION__"


def storage_report(spark: SparkSession, raw_path: str, stored_path: str) -> DataFrame:
    """Size of both datasets in MB, their ratio (0 without data) and the partitions.

    Sizes come from the file system when this is called; no task looks at files.
    """
    raw_mb, stored_mb = [content(spark, path)[0] / (1024 * 1024) for path in (raw_path, stored_path)]
    row = (raw_mb, stored_mb, raw_mb / stored_mb if stored_mb else 0.0, partition_names(spark, stored_path))
    schema = "raw_mb double, stored_mb double, ratio double, partitions array<string>"
    return spark.createDataFrame([row], schema)
