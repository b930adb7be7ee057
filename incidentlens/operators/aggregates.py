"""Summaries per precinct, per month and category, and per hexagonal cell.

All of them are sums, so Spark combines them on the map side: what is shuffled
is groups per task, not records, and a key that holds a third of the records
costs no more than any other. Each can be taken from the records, or from the
small table of :func:`grouped`, which one scan of the records makes for all.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentlens.functions.position import LIMBS, is_position, limbs, mean_degrees
from incidentlens.functions.spatial import cell_ancestor

PRECINCT_KEYS = ("ARREST_PRECINCT", "ARREST_BORO")
MONTH_KEYS = ("ARREST_BORO", "ARREST_YEAR", "ARREST_MONTH", "LAW_CAT_CD")
CELL_KEY = "hex_cell"
_ALL_KEYS = (*PRECINCT_KEYS, "ARREST_YEAR", "ARREST_MONTH", "LAW_CAT_CD", CELL_KEY)
_LAT, _LON = [[f"{name}_{limb}" for limb in LIMBS] for name in ("lat", "lon")]
_SUMS = ("records", "located", *_LAT, *_LON)


def _measures(records: DataFrame, *more: str) -> DataFrame:
    """Give every record the additive measures that a row of :func:`grouped` has."""
    located = is_position(F.col("Latitude"), F.col("Longitude"))
    lat, lon = F.when(located, F.col("Latitude")), F.when(located, F.col("Longitude"))
    present = set(records.columns)
    return records.select(
        *more,
        *[name for name in _ALL_KEYS if name in present],
        lat.alias("Latitude"),
        lon.alias("Longitude"),
        F.lit(1).cast("bigint").alias("records"),
        F.when(located, 1).otherwise(0).cast("bigint").alias("located"),
        *[limb.alias(name) for name, limb in zip(_LAT, limbs(lat), strict=True)],
        *[limb.alias(name) for name, limb in zip(_LON, limbs(lon), strict=True)],
    )


def grouped(celled: DataFrame, *by: str) -> DataFrame:
    """Records with a cell, summed at the three levels that the summaries need.

    Grouping sets make it in one scan. Its size is the sum of the precincts,
    months and cells that occur, each with their categories, whereas grouping by
    all keys at once would shuffle their product from every task. With further
    columns ``by``, such as the delivery, there are such groups for each of their values.
    """
    level = (
        F.when(F.grouping(CELL_KEY) == 0, "cell")
        .when(F.grouping("ARREST_MONTH") == 0, "month")
        .otherwise("precinct")
    )
    return (
        _measures(celled, *by)
        .groupingSets(
            [[*by, *PRECINCT_KEYS, "LAW_CAT_CD"], [*by, *MONTH_KEYS], [*by, CELL_KEY]], *by, *_ALL_KEYS
        )
        .agg(level.alias("level"), *[F.sum(name).alias(name) for name in _SUMS])
    )


def merged(groups: DataFrame) -> DataFrame:
    """Groups of several deliveries as those of all their records; sums are whole numbers."""
    return groups.groupBy(*_ALL_KEYS, "level").agg(*[F.sum(name).alias(name) for name in _SUMS])


def _at(level: str, groups: DataFrame) -> DataFrame:
    return groups.where(F.col("level") == level)


def _centroid(lat_name: str, lon_name: str, exact: bool) -> list[Column]:
    if not exact:
        return [F.avg("Latitude").alias(lat_name), F.avg("Longitude").alias(lon_name)]
    located = F.sum("located")
    return [
        mean_degrees([F.sum(name) for name in _LAT], located).alias(lat_name),
        mean_degrees([F.sum(name) for name in _LON], located).alias(lon_name),
    ]


def _in_category(code: str) -> Column:
    return F.sum(F.when(F.col("LAW_CAT_CD") == code, F.col("records")).otherwise(F.lit(0)))


def _precincts(measured: DataFrame, exact: bool) -> DataFrame:
    felonies, misdemeanors, violations = map(F.col, ("felonies", "misdemeanors", "violations"))
    dominant = (
        F.when(felonies >= F.greatest(misdemeanors, violations), "F")
        .when(misdemeanors >= violations, "M")
        .otherwise("V")
    )
    return (
        measured.groupBy(*PRECINCT_KEYS)
        .agg(
            F.sum("records").alias("total_arrests"),
            _in_category("F").alias("felonies"),
            _in_category("M").alias("misdemeanors"),
            _in_category("V").alias("violations"),
            *_centroid("centroid_lat", "centroid_lon", exact),
        )
        .withColumn("dominant_cat", dominant)
    )


def precincts_from(groups: DataFrame) -> DataFrame:
    return _precincts(_at("precinct", groups), exact=True)


def precinct_summary(records: DataFrame, exact: bool = True) -> DataFrame:
    """Per precinct and borough: totals, category counts, centroid, main category.

    Categories other than F, M and V count in the total only. Of equal
    categories F comes before M before V, and F also stands for none at all.
    Records without a position (a coordinate NULL, NaN, infinite or beyond a full
    turn) don't count in the centroid. ``exact=False`` takes it as a plain ``avg``,
    whose last digits vary from run to run.
    """
    return _precincts(_measures(records), exact)


def _trend(measured: DataFrame, year: int | None) -> DataFrame:
    dated = measured.where("ARREST_YEAR IS NOT NULL AND ARREST_MONTH IS NOT NULL")
    if year is not None:
        dated = dated.where(F.col("ARREST_YEAR") == year)
    return (
        dated.groupBy(*MONTH_KEYS)
        .agg(F.sum("records").alias("arrest_count"))
        .orderBy(*[F.col(name).asc_nulls_first() for name in MONTH_KEYS])
    )


def trend_from(groups: DataFrame, year: int | None = None) -> DataFrame:
    return _trend(_at("month", groups), year)


def monthly_trend(records: DataFrame, year: int | None = None) -> DataFrame:
    """Records per borough, year, month and category, in that order; undated ones left out."""
    return _trend(_measures(records), year)


def _cells(measured: DataFrame, exact: bool) -> DataFrame:
    return (
        measured.where(F.col(CELL_KEY).isNotNull())
        .groupBy(CELL_KEY)
        .agg(F.sum("records").alias("arrest_count"), *_centroid("cell_lat", "cell_lon", exact))
    )


def cells_from(groups: DataFrame) -> DataFrame:
    return _cells(_at("cell", groups), exact=True)


def hex_density(celled: DataFrame, exact: bool = True) -> DataFrame:
    """Per cell: records and their mean position (``exact`` as for the precincts).

    Any id in the column ``hex_cell`` will do, also one made by another function.
    """
    return _cells(_measures(celled), exact)


def levels_from(groups: DataFrame, levels: Sequence[int]) -> DataFrame:
    """Records and their mean position by cell, for several levels of cells at once.

    Takes the small table of groups: every hexagon's sums go to its ancestor of each level,
    in one grouping. A level's records add up to those of all hexagons.
    """
    cells = _at("cell", groups).where(F.col(CELL_KEY).isNotNull())
    ancestors = F.array(*[F.struct(F.lit(n).alias("cell_level"), cell_ancestor(F.col(CELL_KEY), n).alias("_cell")) for n in levels])
    return (
        cells.select(F.inline(ancestors), *_SUMS)
        .groupBy("cell_level", F.col("_cell").alias(CELL_KEY))
        .agg(F.sum("records").alias("arrest_count"), *_centroid("cell_lat", "cell_lon", exact=True))
    )


def hex_levels(celled: DataFrame, levels: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """Cells of several levels with their records and mean position, from records with a cell."""
    cells = _measures(celled).groupBy(CELL_KEY).agg(*[F.sum(name).alias(name) for name in _SUMS])
    return levels_from(cells.withColumn("level", F.lit("cell")), levels)


def totals_from(groups: DataFrame) -> DataFrame:
    """Records, precincts with data, and populated cells, as one row."""
    precinct = F.when(F.col("level") == "precinct", F.struct(*PRECINCT_KEYS))
    cell = (F.col("level") == "cell") & F.col(CELL_KEY).isNotNull()  # a group each
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("level") == "cell", F.col("records"))), F.lit(0)).alias(
            "records_in_region"
        ),
        F.count_distinct(precinct).alias("precincts_with_data"),
        F.count_if(cell).alias("populated_cells"),
    )


def run_summary(celled: DataFrame) -> DataFrame:
    """Records in the region, precincts with data, and populated cells.

    The distinct counts run over the small grouped table, not over the records.
    """
    return totals_from(grouped(celled))


def top_k(summary: DataFrame, k: int) -> DataFrame:
    """The ``k`` precincts with most records; equal ones by precinct, then borough."""
    return summary.orderBy(
        F.col("total_arrests").desc_nulls_last(),
        *[F.col(name).asc_nulls_last() for name in PRECINCT_KEYS],
    ).limit(k)


def borough_month_sums(trend: DataFrame) -> DataFrame:
    """Records per borough and month over all years and categories, in any order."""
    return (
        trend.where("ARREST_BORO IS NOT NULL")
        .groupBy("ARREST_BORO", "ARREST_MONTH")
        .agg(F.sum("arrest_count").alias("arrest_count"))
    )


def borough_month(trend: DataFrame) -> DataFrame:
    """Records per borough and month over all years and categories, in that order."""
    return borough_month_sums(trend).orderBy("ARREST_BORO", "ARREST_MONTH")
