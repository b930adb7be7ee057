"""Column names, table schemas and fixed values of the incident data model."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values: source columns, in file order -----------------------------
RAW_COLUMNS = (
    "ARREST_KEY", "ARREST_DATE", "PD_CD", "PD_DESC", "KY_CD", "OFNS_DESC",
    "LAW_CODE", "LAW_CAT_CD", "ARREST_BORO", "ARREST_PRECINCT",
    "JURISDICTION_CODE", "AGE_GROUP", "PERP_SEX", "PERP_RACE", "X_COORD_CD",
    "Y_COORD_CD", "Latitude", "Longitude", "Location",
)
INTEGER_COLUMNS = (
    "PD_CD", "KY_CD", "ARREST_PRECINCT", "JURISDICTION_CODE", "X_COORD_CD",
    "Y_COORD_CD",
)
DOUBLE_COLUMNS = ("Latitude", "Longitude")
PLACEHOLDER_COLUMNS = ("AGE_GROUP", "PERP_SEX", "PERP_RACE")
QUALITY_COLUMNS = (
    "LAW_CAT_CD", "KY_CD", "AGE_GROUP", "PERP_SEX", "PERP_RACE", "Latitude",
    "Longitude",
)
PLACEHOLDER = "(null)"
DATE_PATTERN = "MM/dd/yyyy"

# --- fixed values: extent in WGS84 degrees, ring vertices as (lon, lat) ------
EXTENT_RING = (
    (-74.3, 40.4), (-73.65, 40.4), (-73.65, 40.95), (-74.3, 40.95), (-74.3, 40.4),
)

# --- fixed values: names and colours shown to readers ------------------------
BOROUGH_NAMES = {
    "B": "Bronx", "K": "Brooklyn", "M": "Manhattan", "Q": "Queens", "S": "Staten Island",
}
CATEGORY_LABELS = {"F": "Felony", "M": "Misdemeanour", "V": "Violation"}
CATEGORY_COLOURS = {"F": "#d73027", "M": "#fc8d59", "V": "#fee090"}
OTHER_COLOUR = "#999999"
MIN_RADIUS_PX = 4
RADIUS_SPAN_PX = 22
HEAT_THRESHOLD = 3
TOP_PRECINCTS = 10

CORRUPT_COLUMN = "_corrupt_record"
CORRUPT_FLAG = "is_corrupt"
PARTITION_COLUMN = "ARREST_BORO"

_TYPES = {
    "ARREST_DATE": DateType(),
    **{name: IntegerType() for name in INTEGER_COLUMNS},
    **{name: DoubleType() for name in DOUBLE_COLUMNS},
}

# What a delivered CSV file holds: text only, so that no value can fail to load.
RAW_SCHEMA = StructType([StructField(name, StringType()) for name in RAW_COLUMNS])

# The same columns typed, with the month and year of the date.
TYPED_SCHEMA = StructType(
    [StructField(name, _TYPES.get(name, StringType())) for name in RAW_COLUMNS]
    + [StructField("ARREST_MONTH", IntegerType()), StructField("ARREST_YEAR", IntegerType())]
)

# Typed records with the coordinate flag: every delivered record.
FLAGGED_SCHEMA = StructType(TYPED_SCHEMA.fields + [StructField("coord_valid", BooleanType())])

# The same as ingested, with a flag for records that had too few or too many fields.
INGESTED_SCHEMA = StructType(FLAGGED_SCHEMA.fields + [StructField(CORRUPT_FLAG, BooleanType())])

# Records with usable coordinates. The partition column comes from directory
# names and is last; declaring it keeps '02' from being read as the number 2.
STORED_SCHEMA = StructType(
    [field for field in TYPED_SCHEMA.fields if field.name != PARTITION_COLUMN]
    + [TYPED_SCHEMA[PARTITION_COLUMN]]
)
