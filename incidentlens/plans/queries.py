"""One query per operator, over the records derived from the given tables.

Each query reads what the step it belongs to reads in the batch job: delivered
CSV files for typing, flagged Parquet for the validity reports, and the stored
dataset for everything after. Those datasets are written once per session, so
filters and column selections reach real Parquet columns, and the join that
derives the records does not run again for every query.
"""

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlens.operators.aggregates import (
    borough_month,
    cells_from,
    hex_density,
    hex_levels,
    monthly_trend,
    precinct_summary,
    precincts_from,
    run_summary,
    top_k,
    trend_from,
)
from incidentlens.operators.areas import area_totals, cover, edges, hex_cover, located
from incidentlens.operators.features import (
    borough_month_lines,
    circle_layer,
    heat_points,
    label_layer,
    top_lines,
)
from incidentlens.operators.lookups import (
    borough_scan,
    category_by_month,
    precinct_lookup,
    window_lookup,
)
from incidentlens.operators.quality import (
    quality_report,
    spatial_outliers,
    store_report,
)
from incidentlens.operators.records import (
    add_hex_cell,
    flag_coords,
    in_area,
    in_region,
    keep_valid,
    typed,
)
from incidentlens.plans import deliveries, job
from incidentlens.plans import corrections as corrected
from incidentlens.plans.fixture import (
    AREA_TABLE,
    SOURCE_TABLES,
    area_vertices,
    corrections,
    raw_records,
)
from incidentlens.schema import TOP_PRECINCTS
from incidentlens.sources.csv import scan_csv
from incidentlens.sources.curve import write_along_curve
from incidentlens.sources.files import content_version
from incidentlens.sources.scratch import is_complete, remove, scratch_path
from incidentlens.sources.store import (
    partition_list,
    read_flagged,
    read_partitioned,
    storage_report,
    write_partitioned,
)
from incidentlens.streaming import pickup

# Parameters of the example queries.
CONCAVE_RING = (
    (-74.2, 40.45), (-73.75, 40.45), (-73.7, 40.85), (-73.95, 40.6), (-74.1, 40.9),
    (-74.25, 40.7), (-74.2, 40.45),
)
LONG_RING = tuple(
    (
        -73.97 + (0.2 + 0.03 * math.sin(5 * angle)) * math.cos(angle),
        40.67 + (0.2 + 0.03 * math.sin(5 * angle)) * math.sin(angle),
    )
    for angle in (2 * math.pi * (step % 90) / 90 for step in range(91))
)
# Two parts, the first with a hole and an island in it.
RINGS = (
    CONCAVE_RING,
    ((-74.15, 40.5), (-74.0, 40.52), (-74.05, 40.6), (-74.18, 40.58), (-74.15, 40.5)),
    ((-74.12, 40.53), (-74.06, 40.54), (-74.1, 40.57), (-74.12, 40.53)),
    ((-73.99, 40.8), (-73.9, 40.75), (-73.85, 40.86), (-73.93, 40.9), (-73.99, 40.8)),
)
PRECINCT, BOROUGH, CATEGORY = 8, "M", "F"
WINDOW_DATES, WINDOW_BOX = ("1995-01-01", "1995-12-31"), (-74.1, 40.5, -73.8, 40.7)

Query = Callable[[SparkSession, str], DataFrame]


_written: dict[tuple, tuple[list, str]] = {}


def _dataset(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    write: Callable[[str], object],
    last: str = "",
    tables: Sequence[str] = SOURCE_TABLES,
) -> str:
    """Path of a derived dataset, written on first use.

    It belongs to the session and to the present content of the source tables;
    one that these have outdated is removed. ``last`` is the table in it that is
    written last.
    """
    versions = [content_version(spark, f"{sf_dir}/{table}.parquet") for table in tables]
    key = (spark.sparkContext.applicationId, sf_dir, name)
    version, path = _written.get(key, (None, None))
    if version != versions or not is_complete(spark, f"{path}{last}"):
        if path:
            remove(spark, path)
        path = scratch_path(spark, name)
        write(path)
        _written[key] = versions, path
    return path


def delivery_path(spark: SparkSession, sf_dir: str) -> str:
    """The records as a delivery of CSV files."""

    def write(path: str) -> None:
        raw_records(spark, sf_dir).write.option("header", True).csv(path)

    return _dataset(spark, sf_dir, "delivery", write)


def flagged_path(spark: SparkSession, sf_dir: str) -> str:
    """All records, typed and flagged, as Parquet."""

    def write(path: str) -> None:
        job.ingest(spark, delivery_path(spark, sf_dir), path)

    return _dataset(spark, sf_dir, job.RAW, write)


def stored_path(spark: SparkSession, sf_dir: str) -> str:
    """The valid records as Parquet by borough."""

    def write(path: str) -> None:
        job.store(spark, flagged_path(spark, sf_dir), path)

    return _dataset(spark, sf_dir, job.STORED, write)


def delivered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_csv(spark, delivery_path(spark, sf_dir))


def typed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(delivered_records(spark, sf_dir))


def flagged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_flagged(spark, flagged_path(spark, sf_dir))


def stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_partitioned(spark, stored_path(spark, sf_dir))


def region_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_region(stored_records(spark, sf_dir))


def celled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_hex_cell(region_records(spark, sf_dir))


def area_edges_path(spark: SparkSession, sf_dir: str) -> str:
    """The edges of the derived areas."""

    def write(path: str) -> None:
        edges(area_vertices(spark, sf_dir)).write.parquet(path)

    return _dataset(spark, sf_dir, "area_edges", write, tables=[AREA_TABLE])


def area_cover_path(spark: SparkSession, sf_dir: str) -> str:
    """The cells that the derived areas cover."""

    def write(path: str) -> None:
        cover(spark.read.parquet(area_edges_path(spark, sf_dir))).write.parquet(path)

    return _dataset(spark, sf_dir, "area_cover", write, tables=[AREA_TABLE])


def area_pairs(spark: SparkSession, sf_dir: str, counted_by: Sequence[str] = ()) -> DataFrame:
    records = stored_records(spark, sf_dir).select("ARREST_KEY", "LAW_CAT_CD", "Longitude", "Latitude")
    return located(records, spark.read.parquet(area_cover_path(spark, sf_dir)), counted_by=counted_by)


def merged_path(spark: SparkSession, sf_dir: str) -> str:
    """The stored records after corrections have been merged into them, some twice."""

    def write(path: str) -> None:
        flagged = flagged_records(spark, sf_dir)
        write_partitioned(keep_valid(flagged), path)
        late = corrections(flagged)
        corrected.merge(spark, path, late.where("delivered = 1"))
        corrected.merge(spark, path, late)

    return _dataset(spark, sf_dir, "merged", write)


def deliveries_path(spark: SparkSession, sf_dir: str) -> str:
    """Summaries of the stored records in four deliveries: added one by one, one of them
    first in part and then replaced, and one more that is taken back."""

    def write(path: str) -> None:
        number = F.pmod(F.crc32(F.col("ARREST_KEY").cast("binary")), F.lit(4))
        named = stored_records(spark, sf_dir).withColumn("delivery", F.concat(F.lit("d"), number))
        deliveries.put(spark, path, named.where("delivery IN ('d0', 'd1')"))
        deliveries.put(spark, path, named.where("delivery = 'd2' AND LAW_CAT_CD = 'F'"))
        deliveries.put(spark, path, named.withColumn("delivery", F.lit("twice")))
        deliveries.put(spark, path, named.where("delivery IN ('d2', 'd3')"))
        deliveries.take_back(spark, path, "twice")

    return _dataset(spark, sf_dir, "deliveries", write, last="/manifest/000000005")


def _picked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of the delivered files, picked up in batches of two."""

    def write(path: str) -> None:
        pickup.run(spark, delivery_path(spark, sf_dir), path, files_per_batch=2)

    path = _dataset(spark, sf_dir, "pickup", write, last=f"/{pickup.SUMMARIES}/manifest/000000001")
    return deliveries.groups(spark, f"{path}/{pickup.SUMMARIES}")


def _along_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored records along a curve."""

    def write(path: str) -> None:
        write_along_curve(stored_records(spark, sf_dir), path)

    return read_partitioned(spark, _dataset(spark, sf_dir, "curve", write))


def _precincts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return precinct_summary(region_records(spark, sf_dir))


def _trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_trend(region_records(spark, sf_dir))


def _coord_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_coords(typed_records(spark, sf_dir)).select(
        "ARREST_KEY", "Latitude", "Longitude", "coord_valid"
    )


def _positions(records: DataFrame, *more: str) -> DataFrame:
    return records.select("ARREST_KEY", "Latitude", "Longitude", *more)


def _short(records: DataFrame) -> DataFrame:
    return records.select(
        "ARREST_KEY", "ARREST_DATE", "LAW_CAT_CD", "ARREST_BORO", "ARREST_PRECINCT"
    )


def _storage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is certain about sizes: there are some, and the ratio is theirs."""
    report = storage_report(spark, flagged_path(spark, sf_dir), stored_path(spark, sf_dir))
    return report.select(
        (F.col("raw_mb") > 0).alias("has_raw"),
        (F.col("stored_mb") > 0).alias("has_stored"),
        (F.abs(F.col("ratio") * F.col("stored_mb") - F.col("raw_mb")) < 1e-9).alias("ratio_fits"),
        F.array_join("partitions", ",").alias("partitions"),
    )


_run_paths: dict[tuple, str] = {}


def _batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on the delivered files; the summary it returns. Replaces its last output."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _run_paths:
        _run_paths[key] = scratch_path(spark, "run")
    return job.run(spark, delivery_path(spark, sf_dir), _run_paths[key])["summary"]


def _job_table(table: str) -> Query:
    """A table that the job has written for the delivered files."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _dataset(
            spark, sf_dir, "job",
            lambda path: job.run(spark, delivery_path(spark, sf_dir), path),
            last=f"/{job.FEATURES}/borough_month_lines.parquet",
        )
        return spark.read.parquet(f"{path}/{table}.parquet")

    return query


def queries() -> dict[str, Query]:
    return {
        "scan_csv": delivered_records,
        "typed_records": typed_records,
        "coord_flag": _coord_flag,
        "raw_roundtrip": flagged_records,
        "store_filter": lambda s, d: keep_valid(flagged_records(s, d)),
        "quality_report": lambda s, d: quality_report(flagged_records(s, d)),
        "store_report": lambda s, d: store_report(flagged_records(s, d)),
        "partitioned_roundtrip": stored_records,
        "partition_list": lambda s, d: partition_list(s, stored_path(s, d)),
        "storage_report": _storage_report,
        "precinct_lookup": lambda s, d: _short(precinct_lookup(stored_records(s, d), PRECINCT)),
        "borough_scan": lambda s, d: _short(borough_scan(stored_records(s, d), BOROUGH)),
        "category_by_month": lambda s, d: category_by_month(
            stored_records(s, d), PRECINCT, CATEGORY
        ),
        "spatial_outliers": lambda s, d: spatial_outliers(stored_records(s, d)),
        "spatial_filter": lambda s, d: _positions(region_records(s, d)),
        "polygon_filter": lambda s, d: _positions(in_region(stored_records(s, d), CONCAVE_RING)),
        "long_polygon_filter": lambda s, d: _positions(in_region(stored_records(s, d), LONG_RING)),
        "rings_filter": lambda s, d: _positions(in_area(stored_records(s, d), RINGS)),
        "area_join": lambda s, d: area_pairs(s, d).select("ARREST_KEY", "area"),
        "area_totals": lambda s, d: area_totals(area_pairs(s, d, ["LAW_CAT_CD"])),
        "area_cells": lambda s, d: hex_cover(s.read.parquet(area_edges_path(s, d))),
        "hex_levels": lambda s, d: hex_levels(celled_records(s, d)),
        "merged_records": lambda s, d: read_partitioned(s, merged_path(s, d)),
        "deliveries_trend": lambda s, d: trend_from(deliveries.groups(s, deliveries_path(s, d))),
        "deliveries_cells": lambda s, d: cells_from(deliveries.groups(s, deliveries_path(s, d))),
        "pickup_precincts": lambda s, d: precincts_from(_picked_up(s, d)),
        "window_lookup": lambda s, d: _short(window_lookup(_along_curve(s, d), WINDOW_DATES, WINDOW_BOX)),
        "hex_assign": lambda s, d: _positions(celled_records(s, d), "hex_cell"),
        "hex_density": lambda s, d: hex_density(celled_records(s, d)),
        "heat_points": lambda s, d: heat_points(hex_density(celled_records(s, d))),
        "precinct_summary": _precincts,
        "monthly_trend": _trend,
        "top_precincts": lambda s, d: top_k(_precincts(s, d), TOP_PRECINCTS),
        "top10_lines": lambda s, d: top_lines(_precincts(s, d)),
        "run_summary": lambda s, d: run_summary(celled_records(s, d)),
        "feature_circles": lambda s, d: circle_layer(_precincts(s, d)),
        "feature_labels": lambda s, d: label_layer(_precincts(s, d)),
        "borough_month": lambda s, d: borough_month(_trend(s, d)),
        "borough_month_lines": lambda s, d: borough_month_lines(_trend(s, d)),
        "batch_run": _batch_run,
        "job_precincts": _job_table(f"{job.AGGREGATED}/precinct_summary"),
        "job_trend": _job_table(f"{job.AGGREGATED}/monthly_trend"),
        "job_cells": _job_table(f"{job.AGGREGATED}/hex_density"),
        "job_top": _job_table(f"{job.AGGREGATED}/top10_precincts"),
        "job_circles": _job_table(f"{job.FEATURES}/circles"),
        "job_heat": _job_table(f"{job.FEATURES}/heat"),
        "job_labels": _job_table(f"{job.FEATURES}/labels"),
        "job_lines": _job_table(f"{job.FEATURES}/borough_month_lines"),
    }
