"""Map-ready tables made from the summaries: circles, heat points, labels, lines."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentlens.operators.aggregates import PRECINCT_KEYS, borough_month_sums, top_k
from incidentlens.schema import (
    BOROUGH_NAMES,
    CATEGORY_COLOURS,
    CATEGORY_LABELS,
    HEAT_THRESHOLD,
    MIN_RADIUS_PX,
    OTHER_COLOUR,
    RADIUS_SPAN_PX,
    TOP_PRECINCTS,
)


def _lookup(names: dict[str, str], key: Column) -> Column:
    """Value for a key from a fixed dictionary, as a constant in the plan; no join."""
    literals = [F.lit(part) for pair in names.items() for part in pair]
    return F.try_element_at(F.create_map(*literals), key)


def _borough_name(code: Column) -> Column:
    return F.coalesce(_lookup(BOROUGH_NAMES, code), code, F.lit("Unknown"))


def _precinct_text(precinct: Column) -> Column:
    return F.coalesce(precinct.cast("string"), F.lit("?"))


def _thousands(count: Column) -> Column:
    return F.format_number(count, 0)


def heat_points(density: DataFrame, threshold: int = HEAT_THRESHOLD) -> DataFrame:
    """Position and weight of cells with at least ``threshold`` records."""
    return (
        density.where(F.col("arrest_count") >= threshold)
        .select("cell_lat", "cell_lon", "arrest_count")
        .dropna()
    )


def circle_layer(summary: DataFrame) -> DataFrame:
    """One circle per precinct: place, radius, colour, and the texts shown with it.

    The radius is relative to the largest total of all precincts, also of those
    without a position. That one number is a scalar subquery over the totals alone. A
    ``summary`` that isn't stored is computed for it once more, from the columns it needs.
    """
    total = F.col("total_arrests")
    largest = summary.agg(F.max("total_arrests")).scalar()
    category = F.col("dominant_cat")
    precinct = F.concat(F.lit("Precinct "), _precinct_text(F.col("ARREST_PRECINCT")))
    return summary.dropna(subset=["centroid_lat", "centroid_lon"]).select(
        *PRECINCT_KEYS,
        _borough_name(F.col("ARREST_BORO")).alias("borough_name"),
        "centroid_lat",
        "centroid_lon",
        (MIN_RADIUS_PX + total / largest * RADIUS_SPAN_PX).alias("radius"),
        F.coalesce(_lookup(CATEGORY_COLOURS, category), F.lit(OTHER_COLOUR)).alias("colour"),
        F.concat(precinct, F.lit(" – "), _thousands(total), F.lit(" arrests")).alias("tooltip"),
        precinct.alias("popup_precinct"),
        _thousands(total).alias("popup_total"),
        _thousands(F.col("felonies")).alias("popup_felonies"),
        _thousands(F.col("misdemeanors")).alias("popup_misdemeanors"),
        _thousands(F.col("violations")).alias("popup_violations"),
        F.coalesce(_lookup(CATEGORY_LABELS, category), category).alias("popup_dominant"),
    )


def label_layer(summary: DataFrame, k: int = TOP_PRECINCTS) -> DataFrame:
    """Rank labels of the top ``k`` precincts; those without a position get no rank.

    The ranking window has no partition, but never sees more than ``k`` rows.
    """
    order = Window.orderBy(
        F.col("total_arrests").desc(), *[F.col(name).asc_nulls_last() for name in PRECINCT_KEYS]
    )
    label = F.concat(
        F.lit("#"), F.col("rank"), F.lit(" P"), _precinct_text(F.col("ARREST_PRECINCT"))
    )
    return (
        top_k(summary, k)
        .dropna(subset=["centroid_lat", "centroid_lon"])
        .withColumn("rank", F.row_number().over(order))
        .select("rank", label.alias("label"), "centroid_lat", "centroid_lon")
    )


def top_lines(summary: DataFrame, k: int = TOP_PRECINCTS) -> DataFrame:
    """The top ``k`` precincts as aligned lines of text."""
    line = F.format_string(
        "Precinct %3s (%s): %5d arrests",
        _precinct_text(F.col("ARREST_PRECINCT")),
        F.coalesce("ARREST_BORO", F.lit("?")),
        F.col("total_arrests"),
    )
    return top_k(summary, k).select(line.alias("line"))


def borough_month_lines(trend: DataFrame) -> DataFrame:
    """One line per borough: ``M1:1,234 | M2:...`` in month order.

    The list has at most twelve parts, whatever the number of records.
    """
    part = F.concat(
        F.lit("M"), F.col("ARREST_MONTH"), F.lit(":"), _thousands(F.col("arrest_count"))
    )
    return (
        borough_month_sums(trend)
        .withColumn("part", part)
        .groupBy("ARREST_BORO")
        .agg(F.expr("listagg(part, ' | ') WITHIN GROUP (ORDER BY ARREST_MONTH)").alias("counts"))
        .select(_borough_name(F.col("ARREST_BORO")).alias("borough_name"), "counts")
    )
