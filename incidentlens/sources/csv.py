"""Delivered CSV files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from incidentlens.schema import CORRUPT_COLUMN, RAW_SCHEMA


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    check_header: bool = True,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read delivered files as 19 text columns, in one splittable scan.

    Columns are matched by position. ``check_header`` makes a file whose header
    names other columns, or the same ones in another order, fail rather than
    load into the wrong columns. ``keep_corrupt`` adds a column with the text of
    records that had too few or too many fields.
    """
    schema = RAW_SCHEMA
    reader = spark.read
    if keep_corrupt:
        schema = StructType([*RAW_SCHEMA.fields, StructField(CORRUPT_COLUMN, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return (
        reader.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("enforceSchema", not check_header)
        .csv(path)
    )
