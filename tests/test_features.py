import datetime

from helpers import rows, stored

from incidentlens.operators.aggregates import monthly_trend
from incidentlens.operators.features import (
    borough_month_lines,
    circle_layer,
    heat_points,
    label_layer,
    top_lines,
)
from incidentlens.sources.scratch import materialise

SUMMARY = (
    "ARREST_PRECINCT int, ARREST_BORO string, total_arrests bigint, felonies bigint, "
    "misdemeanors bigint, violations bigint, centroid_lat double, centroid_lon double, "
    "dominant_cat string"
)


def summary(spark, *values):
    base = dict(p=75, b="K", n=10, f=5, m=3, v=1, lat=40.7, lon=-73.9, cat="F")
    return spark.createDataFrame([tuple({**base, **v}.values()) for v in values], SUMMARY)


def test_circle_values(spark):
    row = circle_layer(summary(spark, dict(n=12345, f=6000, m=5000, v=1345))).first()
    assert row.borough_name == "Brooklyn" and row.colour == "#d73027" and row.radius == 26.0
    assert row.tooltip == "Precinct 75 – 12,345 arrests"
    assert (row.popup_precinct, row.popup_total) == ("Precinct 75", "12,345")
    assert (row.popup_felonies, row.popup_misdemeanors) == ("6,000", "5,000")
    assert (row.popup_violations, row.popup_dominant) == ("1,345", "Felony")


def test_circle_names_and_colours(spark):
    df = circle_layer(
        summary(
            spark, dict(b="Z", cat="M"), dict(b=None, cat="V", p=None), dict(b="S", cat="I")
        )
    )
    got = {(r.borough_name, r.colour, r.popup_dominant, r.popup_precinct) for r in df.collect()}
    assert got == {
        ("Z", "#fc8d59", "Misdemeanour", "Precinct 75"),
        ("Unknown", "#fee090", "Violation", "Precinct ?"),
        ("Staten Island", "#999999", "I", "Precinct 75"),
    }


def test_radius_is_relative_to_all_precincts(spark):
    df = summary(spark, dict(n=100, lat=None), dict(n=50), dict(n=0, p=2))
    got = circle_layer(materialise(df)).orderBy("radius")
    assert [r.radius for r in got.collect()] == [4.0, 15.0]


def test_circles_of_nothing(spark):
    assert circle_layer(summary(spark, {}).limit(0)).count() == 0


def test_heat_needs_three_records_and_a_position(spark):
    df = spark.createDataFrame(
        [(1, 2, 40.5, -73.9), (2, 3, 40.6, -73.9), (3, 9, None, -73.9)],
        "hex_cell bigint, arrest_count bigint, cell_lat double, cell_lon double",
    )
    assert rows(heat_points(df)) == [(40.6, -73.9, 3)]
    assert heat_points(df, threshold=1).count() == 2


def test_labels_rank_what_has_a_position(spark):
    df = summary(
        spark, dict(p=1, n=9), dict(p=2, n=8, lat=None), dict(p=None, n=7), dict(p=4, n=7),
        dict(p=5, n=1),
    )
    got = [(r.rank, r.label) for r in label_layer(df, k=4).collect()]
    assert got == [(1, "#1 P1"), (2, "#2 P4"), (3, "#3 P?")]


def test_top_lines_align(spark):
    df = summary(spark, dict(p=7, n=12345), dict(p=114, n=8, b="Q"), dict(p=None, n=1, b=None))
    assert [r.line for r in top_lines(df).collect()] == [
        "Precinct   7 (K): 12345 arrests",
        "Precinct 114 (Q):     8 arrests",
        "Precinct   ? (?):     1 arrests",
    ]


def test_month_lines_are_in_month_order(spark):
    def day(month, year=2025):
        return {"ARREST_DATE": datetime.date(year, month, 1)}

    df = stored(
        spark, day(11), day(2), day(1), day(1, 2024), {"ARREST_BORO": None},
        {"ARREST_BORO": "Z"},
    )
    got = dict(rows(borough_month_lines(monthly_trend(df))))
    assert got == {"Brooklyn": "M1:2 | M2:1 | M11:1", "Z": "M1:1"}
