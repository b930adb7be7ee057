"""Counts that describe a delivery, each report in one pass over its input.

The counts are aggregates, not accumulators or observed metrics: those can
count a task twice when a lost executor makes a stage run again.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.functions.spatial import Ring, within
from incidentlens.schema import CORRUPT_FLAG, EXTENT_RING, QUALITY_COLUMNS


def quality_report(flagged: DataFrame) -> DataFrame:
    """Rows (measure, records): all records, NULLs per column where there are
    any, records with invalid coordinates, and records with too few or too many
    fields where there are any and the input has the flag for them."""
    always = ("all records", "invalid coordinates")
    counts = flagged.agg(
        F.count(F.lit(1)).alias(always[0]),
        *[F.count_if(F.col(name).isNull()).alias(f"null {name}") for name in QUALITY_COLUMNS],
        F.count_if(~F.col("coord_valid")).alias(always[1]),
        *[F.count_if(name).alias("corrupt records") for name in flagged.columns if name == CORRUPT_FLAG],
    )
    return counts.unpivot([], counts.columns, "measure", "records").where(
        F.col("measure").isin(*always) | (F.col("records") > 0)
    )


def store_report(flagged: DataFrame) -> DataFrame:
    """Records read, dropped for their coordinates, and retained. Reads the flag only."""
    return flagged.agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(~F.col("coord_valid")).alias("records_dropped"),
        F.count_if("coord_valid").alias("records_retained"),
    )


def spatial_outliers(records: DataFrame, ring: Ring = EXTENT_RING) -> DataFrame:
    """Records read, and those with a position that is not strictly inside the ring."""
    lon, lat = F.col("Longitude"), F.col("Latitude")
    outside = lon.isNotNull() & lat.isNotNull() & ~within(lon, lat, ring)
    return records.agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(outside).alias("outliers"),
    )
