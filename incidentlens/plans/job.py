"""The batch job: delivered CSV files to stored records, summaries and map tables.

Parquet datasets are the hand-over between the steps, so a failed run can start
again at the step that failed: with ``resume`` the steps are skipped that a run over
the same deliveries and parameters has finished. Every dataset is replaced as a whole:
running a step twice gives the same result as running it once.
"""

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlens.functions.spatial import CITY_GRID, HexGrid, Ring
from incidentlens.operators.aggregates import (
    cells_from,
    grouped,
    precincts_from,
    top_k,
    totals_from,
    trend_from,
)
from incidentlens.operators.features import (
    borough_month_lines,
    circle_layer,
    heat_points,
    label_layer,
)
from incidentlens.operators.quality import quality_report, store_report
from incidentlens.operators.records import add_hex_cell, flag_coords, in_region, keep_valid, typed
from incidentlens.schema import EXTENT_RING, INGESTED_SCHEMA, TOP_PRECINCTS
from incidentlens.sources.csv import scan_csv
from incidentlens.sources.files import content_version, exists, matching, touch
from incidentlens.sources.scratch import remove
from incidentlens.sources.store import (
    read_flagged,
    read_partitioned,
    storage_report,
    write_partitioned,
    write_table,
)

RAW, STORED, AGGREGATED, FEATURES = "raw", "processed", "aggregated", "features"


def _write_all(tables: dict[str, DataFrame]) -> None:
    """Replace several small tables at once; each is a short job of its own."""
    with ThreadPoolExecutor(len(tables)) as pool:
        list(pool.map(write_table, tables.values(), tables.keys()))


def ingest(
    spark: SparkSession,
    csv_path: str | list[str],
    raw_path: str,
    check_header: bool = True,
    ring: Ring = EXTENT_RING,
) -> DataFrame:
    """CSV to typed, flagged Parquet with all records; returns the quality report.

    One pass over the text. The report reads nine columns of what was written, one
    of them the flag for records with too few or too many fields.
    """
    records = typed(scan_csv(spark, csv_path, check_header, keep_corrupt=True))
    write_table(flag_coords(records, ring), raw_path)
    return quality_report(spark.read.schema(INGESTED_SCHEMA).parquet(raw_path))


def store(spark: SparkSession, raw_path: str, stored_path: str) -> DataFrame:
    """Valid records to Parquet by borough; returns the counts, read from the flag alone."""
    flagged = read_flagged(spark, raw_path)
    write_partitioned(keep_valid(flagged), stored_path)
    return store_report(flagged)


def process(
    spark: SparkSession,
    stored_path: str,
    out_dir: str,
    ring: Ring = EXTENT_RING,
    grid: HexGrid = CITY_GRID,
) -> DataFrame:
    """Stored records to the summary tables; returns the run summary.

    The records are scanned once, into a small table of groups that all summaries
    come from. The number of records read is taken from file footers.
    """
    stored = read_partitioned(spark, stored_path)
    celled = add_hex_cell(in_region(stored, ring), grid)
    groups = write_table(grouped(celled), f"{out_dir}/groups.parquet")

    precincts = precincts_from(groups)
    _write_all(
        {
            f"{out_dir}/precinct_summary.parquet": precincts,
            f"{out_dir}/monthly_trend.parquet": trend_from(groups),
            f"{out_dir}/hex_density.parquet": cells_from(groups),
            f"{out_dir}/top10_precincts.parquet": top_k(precincts, TOP_PRECINCTS),
        }
    )

    records_read = stored.agg(F.count(F.lit(1))).scalar()
    return totals_from(groups).select(
        records_read.alias("records_read"),
        (records_read - F.col("records_in_region")).alias("outliers"),
        "*",
    )


def expose(spark: SparkSession, aggregated_dir: str, out_dir: str) -> DataFrame:
    """Summary tables to map tables; returns the monthly lines per borough."""
    precincts = spark.read.parquet(f"{aggregated_dir}/precinct_summary.parquet")
    top = spark.read.parquet(f"{aggregated_dir}/top10_precincts.parquet")
    cells = spark.read.parquet(f"{aggregated_dir}/hex_density.parquet")
    trend = spark.read.parquet(f"{aggregated_dir}/monthly_trend.parquet")

    _write_all(
        {
            f"{out_dir}/circles.parquet": circle_layer(precincts),
            f"{out_dir}/heat.parquet": heat_points(cells),
            f"{out_dir}/labels.parquet": label_layer(top),
            f"{out_dir}/borough_month_lines.parquet": borough_month_lines(trend),
        }
    )
    return spark.read.parquet(f"{out_dir}/borough_month_lines.parquet").orderBy("borough_name")


def fingerprint(spark: SparkSession, csv_path: str | list[str], *parameters) -> str:
    """What a run depends on: the files that are there now, and its parameters."""
    paths = [csv_path] if isinstance(csv_path, str) else list(csv_path)
    found = [place for path in paths for place in matching(spark, path)]
    about = [(place, content_version(spark, place)) for place in found]
    return hashlib.sha256(repr((about, parameters)).encode()).hexdigest()[:32]


def run(
    spark: SparkSession,
    csv_path: str | list[str],
    out_dir: str,
    check_header: bool = True,
    ring: Ring = EXTENT_RING,
    grid: HexGrid = CITY_GRID,
    resume: bool = False,
) -> dict[str, DataFrame]:
    """All four steps. The returned reports are small and computed when shown.

    With ``resume`` steps that are done are left out, and so are their reports. A file in
    ``_steps`` tells of each step that is done; a run that isn't resumed, or that has other
    deliveries or parameters, forgets them first.
    """
    raw, stored = f"{out_dir}/{RAW}", f"{out_dir}/{STORED}"
    aggregated = f"{out_dir}/{AGGREGATED}"
    this = f"{out_dir}/_steps/{fingerprint(spark, csv_path, check_header, ring, grid)}"
    if not resume or not exists(spark, this):
        remove(spark, f"{out_dir}/_steps")
    steps: dict[str, Callable[[], DataFrame]] = {
        "quality": lambda: ingest(spark, csv_path, raw, check_header, ring),
        "store": lambda: store(spark, raw, stored),
        "summary": lambda: process(spark, stored, aggregated, ring, grid),
        "storage": lambda: storage_report(spark, raw, stored),
        "borough months": lambda: expose(spark, aggregated, f"{out_dir}/{FEATURES}"),
    }
    reports = {}
    for name, step in steps.items():
        marker = f"{this}/{name.replace(' ', '_')}"
        if not exists(spark, marker):
            reports[name] = step()
            touch(spark, marker)
    return reports
