"""Queries on the stored dataset that should read little of it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def precinct_lookup(stored: DataFrame, precinct: int) -> DataFrame:
    """Records of one precinct. Row groups without it are skipped."""
    return stored.where(F.col("ARREST_PRECINCT") == precinct)


def borough_scan(stored: DataFrame, borough: str) -> DataFrame:
    """Records of one borough. Other directories are not listed into the scan."""
    return stored.where(F.col("ARREST_BORO") == borough)


def category_by_month(stored: DataFrame, precinct: int, category: str) -> DataFrame:
    """Records of one category in one precinct per month, over time."""
    return (
        precinct_lookup(stored, precinct)
        .where(F.col("LAW_CAT_CD") == category)
        .groupBy("ARREST_YEAR", "ARREST_MONTH")
        .agg(F.count(F.lit(1)).alias("arrest_count"))
        .orderBy("ARREST_YEAR", "ARREST_MONTH")
    )


def window_lookup(stored: DataFrame, dates: tuple[str, str], box: tuple[float, float, float, float]) -> DataFrame:
    """Records between two dates, both included, in a box of west, south, east and north.

    Row groups whose statistics lie outside are skipped: many of them where the records
    are stored along a curve of these columns.
    """
    west, south, east, north = box
    return stored.where(
        F.col("ARREST_DATE").between(*[F.lit(day).cast("date") for day in dates])
        & F.col("Longitude").between(west, east)
        & F.col("Latitude").between(south, north)
    )
