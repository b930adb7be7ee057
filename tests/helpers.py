"""Small inputs for the tests."""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlens.schema import RAW_COLUMNS, RAW_SCHEMA, STORED_SCHEMA

RAW_ROW = dict(
    ARREST_KEY="1", ARREST_DATE="01/31/2025", PD_CD="105", PD_DESC="PD 1", KY_CD="106",
    OFNS_DESC="OFFENSE, 1", LAW_CODE="PL 1", LAW_CAT_CD="F", ARREST_BORO="K",
    ARREST_PRECINCT="75", JURISDICTION_CODE="0", AGE_GROUP="25-44", PERP_SEX="M",
    PERP_RACE="R1", X_COORD_CD="1004525", Y_COORD_CD="185000", Latitude="40.7",
    Longitude="-73.9", Location="POINT (-73.9 40.7)",
)


def raw(spark: SparkSession, *rows: dict) -> DataFrame:
    """Text records that differ from RAW_ROW as given."""
    values = [tuple({**RAW_ROW, **row}[name] for name in RAW_COLUMNS) for row in rows]
    return spark.createDataFrame(values, RAW_SCHEMA)


def stored(spark: SparkSession, *rows: dict) -> DataFrame:
    """Typed records; a row is (boro, precinct, category, lat, lon, date) by name."""
    base = dict(
        ARREST_KEY="1", ARREST_BORO="K", ARREST_PRECINCT=75, LAW_CAT_CD="F", Latitude=40.7,
        Longitude=-73.9, ARREST_DATE=datetime.date(2025, 1, 31),
    )
    values = [
        tuple({**base, **row}.get(name) for name in STORED_SCHEMA.names) for row in rows
    ]
    df = spark.createDataFrame(values, STORED_SCHEMA)
    return df.withColumns(
        {"ARREST_MONTH": F.month("ARREST_DATE"), "ARREST_YEAR": F.year("ARREST_DATE")}
    )


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(row) for row in df.collect()]
