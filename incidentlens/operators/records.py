"""Record-level steps: text to typed records, flags and filters. No shuffle."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.functions.conversion import (
    number,
    truncating_int,
    us_date,
    without_placeholder,
)
from incidentlens.functions.spatial import CITY_GRID, HexGrid, Ring, hex_cell, inside_bounds, within, within_rings
from incidentlens.schema import (
    CORRUPT_COLUMN,
    CORRUPT_FLAG,
    DATE_PATTERN,
    DOUBLE_COLUMNS,
    EXTENT_RING,
    INTEGER_COLUMNS,
    PLACEHOLDER,
    PLACEHOLDER_COLUMNS,
    RAW_COLUMNS,
)


def typed(raw: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Delivered text columns as dates, numbers and text, with month and year.

    Values that do not convert are NULL. The placeholder text becomes NULL in
    the person columns only; elsewhere it is a value like any other. A scan that
    keeps the text of corrupt records gives a flag for them after the others, and
    columns named in ``more`` come last, as they are.
    """

    def convert(name: str):
        text = F.col(name)
        if name == "ARREST_DATE":
            text = us_date(text, DATE_PATTERN)
        elif name in INTEGER_COLUMNS:
            text = truncating_int(text)
        elif name in DOUBLE_COLUMNS:
            text = number(text)
        elif name in PLACEHOLDER_COLUMNS:
            text = without_placeholder(text, PLACEHOLDER)
        return text.alias(name)

    kept = [CORRUPT_COLUMN] if CORRUPT_COLUMN in raw.columns else []
    flag = [F.col(CORRUPT_COLUMN).isNotNull().alias(CORRUPT_FLAG)] if kept else []
    return raw.select(*map(convert, RAW_COLUMNS), *kept, *more).select(
        *RAW_COLUMNS,
        F.month("ARREST_DATE").alias("ARREST_MONTH"),
        F.year("ARREST_DATE").alias("ARREST_YEAR"),
        *flag,
        *more,
    )


def flag_coords(records: DataFrame, ring: Ring = EXTENT_RING) -> DataFrame:
    """Add ``coord_valid``: coordinates present and in the ring's bounds, edges included."""
    valid = inside_bounds(F.col("Longitude"), F.col("Latitude"), ring)
    return records.withColumn("coord_valid", valid)


def keep_valid(flagged: DataFrame) -> DataFrame:
    return flagged.where("coord_valid").drop("coord_valid")


def in_region(records: DataFrame, ring: Ring = EXTENT_RING) -> DataFrame:
    """Records strictly inside the ring; those on its boundary are dropped."""
    return records.where(within(F.col("Longitude"), F.col("Latitude"), ring))


def in_area(records: DataFrame, rings: Sequence[Ring]) -> DataFrame:
    """Records strictly inside an area of several rings: parts, and holes in them."""
    return records.where(within_rings(F.col("Longitude"), F.col("Latitude"), rings))


def add_hex_cell(records: DataFrame, grid: HexGrid = CITY_GRID) -> DataFrame:
    return records.withColumn("hex_cell", hex_cell(F.col("Longitude"), F.col("Latitude"), grid))
