"""Deliveries picked up as they arrive: each file is read once, whenever the job runs.

A file stream lists the folder of deliveries, remembers in its checkpoint what it has
read, and stops when nothing is left. It writes flagged records to a streaming file sink,
whose log makes every batch count once: after a failure the run goes on where the last one
had stopped, and what a lost batch had written is ignored by all readers. Which file a
record came from stays with it, as ``delivery``, and the summaries of the files that have
none yet are added in one scan of those files' records.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from incidentlens.operators.records import flag_coords, keep_valid, typed
from incidentlens.plans import deliveries
from incidentlens.plans.deliveries import DELIVERY
from incidentlens.schema import CORRUPT_COLUMN, EXTENT_RING, INGESTED_SCHEMA, RAW_SCHEMA

RAW, CHECKPOINT, SUMMARIES = "raw", "checkpoint", "summaries"
_DELIVERED = StructType([*INGESTED_SCHEMA.fields, StructField(DELIVERY, StringType())])


def arriving(spark: SparkSession, folder: str, files_per_batch: int = 1000, check_header: bool = True) -> DataFrame:
    """The stream of a folder's CSV files as text columns, with ``delivery``: the file's name."""
    schema = StructType([*RAW_SCHEMA.fields, StructField(CORRUPT_COLUMN, StringType())])
    return (
        spark.readStream.schema(schema)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("header", True)
        .option("quote", '"')
        .option("enforceSchema", not check_header)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
        .withColumn(DELIVERY, F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))))
    )


def flagged(stream: DataFrame) -> DataFrame:
    """Typed and flagged records of a stream or a table, with their delivery."""
    return flag_coords(typed(stream, more=[DELIVERY]), EXTENT_RING).select(*_DELIVERED.names)


def records(spark: SparkSession, out_dir: str) -> DataFrame:
    """All records picked up so far, as the sink's log has them."""
    return spark.read.schema(_DELIVERED).parquet(f"{out_dir}/{RAW}")


def ingest_new(spark: SparkSession, folder: str, out_dir: str, files_per_batch: int = 1000, check_header: bool = True) -> int:
    """Write the records of all files that weren't there before; returns the number of batches."""
    query = (
        flagged(arriving(spark, folder, files_per_batch, check_header))
        .writeStream.format("parquet")
        .option("path", f"{out_dir}/{RAW}")
        .option("checkpointLocation", f"{out_dir}/{CHECKPOINT}")
        .partitionBy(DELIVERY)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return sum(progress["numInputRows"] > 0 for progress in query.recentProgress)


def summarise_new(spark: SparkSession, out_dir: str) -> list[str]:
    """Add the summaries of the deliveries that have none; returns their names.

    Only their partitions are read. A run that fails leaves the summaries as they were.
    """
    summaries = f"{out_dir}/{SUMMARIES}"
    every = records(spark, out_dir)
    done = deliveries.manifest(spark, summaries).select(DELIVERY)
    # Only names of partitions: no file is opened for them.
    new = sorted(r[0] for r in every.select(DELIVERY).distinct().join(done, DELIVERY, "left_anti").collect())
    if new:
        fresh = keep_valid(every.where(F.col(DELIVERY).isin(*new)))
        deliveries.put(spark, summaries, fresh, expected=new)
    return new


def run(spark: SparkSession, folder: str, out_dir: str, files_per_batch: int = 1000, check_header: bool = True) -> list[str]:
    """Pick up new files and add their summaries; returns the deliveries added."""
    ingest_new(spark, folder, out_dir, files_per_batch, check_header)
    return summarise_new(spark, out_dir)
