import datetime

import pytest
from helpers import RAW_ROW, raw
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from incidentlens.functions.conversion import number, truncating_int, us_date
from incidentlens.operators.records import typed
from incidentlens.schema import DATE_PATTERN, TYPED_SCHEMA


def convert(spark, values, expression):
    df = spark.createDataFrame([(v,) for v in values], "x string").coalesce(1)
    return [row[0] for row in df.select(expression(F.col("x"))).collect()]


def legacy_cast(spark, values, to):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        return convert(spark, values, lambda x: x.cast(to))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


INTEGERS = [
    "1004525", "1004525.0", "1.", "+1.5", "-0.9", " 1.5 ", "\t1.5\n", "1.x", "x", "", " ", ".",
    ".5", "-.5", "+", "-", "1,234", "1e2", "2147483647.9", "2147483648", "2147483648.0",
    "-2147483648.9", "-2147483649.0", "00012.50", "1.2.3", "1 .5", "--1.0", None,
]


def test_int_equals_legacy_cast(spark):
    assert convert(spark, INTEGERS, truncating_int) == legacy_cast(spark, INTEGERS, "int")


def test_int_examples(spark):
    values = ["1004525.0", "-0.9", "1,234", None, "N/A"]
    assert convert(spark, values, truncating_int) == [1004525, 0, None, None, None]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.+- eE\tx", max_size=12), min_size=50, max_size=200))
def test_int_equals_legacy_cast_on_any_text(spark, values):
    assert convert(spark, values, truncating_int) == legacy_cast(spark, values, "int")


def test_double_equals_legacy_cast(spark):
    values = ["40.7", "-73.9 ", "1e1", "x", "", None, "Infinity", "1,5"]
    assert convert(spark, values, number) == legacy_cast(spark, values, "double")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("01/05/2025", datetime.date(2025, 1, 5)),
        ("02/29/2024", datetime.date(2024, 2, 29)),
        ("02/29/2025", None),
        ("13/45/2025", None),
        ("1/5/2025", None),
        ("01/05/25", None),
        ("01/05/2025 10:00", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, text, expected):
    assert convert(spark, [text], lambda x: us_date(x, DATE_PATTERN)) == [expected]


def test_typed_schema_and_values(spark):
    result = typed(raw(spark, {}))
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in TYPED_SCHEMA
    ]
    row = result.first()
    assert (row.ARREST_MONTH, row.ARREST_YEAR, row.X_COORD_CD) == (1, 2025, 1004525)
    assert row.OFNS_DESC == RAW_ROW["OFNS_DESC"]


def test_placeholder_is_null_in_person_columns_only(spark):
    names = ("AGE_GROUP", "PERP_SEX", "PERP_RACE", "LAW_CAT_CD", "PD_DESC")
    row = typed(raw(spark, dict.fromkeys(names, "(null)"))).first()
    assert [row[name] for name in names] == [None, None, None, "(null)", "(null)"]


def test_bad_values_never_fail(spark):
    bad = dict.fromkeys(RAW_ROW, "?")
    row = typed(raw(spark, bad, dict.fromkeys(RAW_ROW))).first()
    assert row.ARREST_DATE is None and row.PD_CD is None and row.Latitude is None
    assert row.ARREST_YEAR is None and row.LAW_CAT_CD == "?"
