"""Summaries kept by delivery: a delivery is added, replaced or taken back on its own.

All summaries come from sums of whole numbers (:func:`aggregates.grouped`), so the sums of
each delivery can be kept, and added up when asked for. The records of the other
deliveries aren't read again, and the result equals that of one run over all of them.

Below a folder there are ``groups/<id>``, written once and never changed, and
``manifest/<version>``, a small table that tells for every delivery which folder counts.
A change writes its groups first and then the next version of the manifest; until that is
complete readers see the version before, so a failure in between changes nothing. Of two
changes at the same time the second one to finish fails and can be repeated.
"""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlens.functions.spatial import CITY_GRID, HexGrid, Ring
from incidentlens.operators.aggregates import grouped, merged
from incidentlens.operators.records import add_hex_cell, in_region
from incidentlens.schema import EXTENT_RING
from incidentlens.sources.files import folders
from incidentlens.sources.scratch import is_complete, remove
from incidentlens.sources.store import write_table

DELIVERY, FOLDER = "delivery", "folder"
_MANIFEST = f"{DELIVERY} string, {FOLDER} string, records long"


def _versions(spark: SparkSession, path: str) -> list[str]:
    """The complete versions of the manifest, oldest first."""
    names = folders(spark, path, "manifest")
    return [name for name in names if is_complete(spark, f"{path}/manifest/{name}")]


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The deliveries that count, the folder of their groups, and their records in the region."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).json(f"{path}/manifest/{versions[-1]}")


def _commit(spark: SparkSession, path: str, rows: DataFrame, seen: list[str]) -> None:
    """Write the version after those that were seen; fails if somebody else has written it."""
    number = 1 + (int(seen[-1]) if seen else 0)
    target = f"{path}/manifest/{number:09d}"
    begun = set(folders(spark, path, "manifest")) - set(_versions(spark, path))
    if f"{number:09d}" in begun:  # left by a driver that was lost
        remove(spark, target)
    rows.coalesce(1).write.mode("errorifexists").json(target)


def put(
    spark: SparkSession,
    path: str,
    records: DataFrame,
    ring: Ring = EXTENT_RING,
    grid: HexGrid = CITY_GRID,
    expected: list[str] | None = None,
) -> None:
    """Add the deliveries that stored records with a column ``delivery`` belong to.

    One that is there already is replaced as a whole. The records are scanned once.
    ``expected`` deliveries are listed also where none of their records counts.
    """
    seen = _versions(spark, path)
    before = manifest(spark, path)
    folder = uuid.uuid4().hex
    celled = add_hex_cell(in_region(records, ring), grid)
    written = write_table(grouped(celled, DELIVERY), f"{path}/groups/{folder}")
    counted = F.coalesce(F.sum(F.when(F.col("level") == "cell", F.col("records"))), F.lit(0))
    new = written.groupBy(DELIVERY).agg(F.lit(folder).alias(FOLDER), counted.alias("records"))
    if expected:
        names = spark.createDataFrame([(name,) for name in expected], f"{DELIVERY} string")
        listed = names.join(new, DELIVERY, "left")
        new = listed.select(DELIVERY, F.lit(folder).alias(FOLDER), F.coalesce("records", F.lit(0).cast("long")).alias("records"))
    _commit(spark, path, before.join(new, DELIVERY, "left_anti").unionByName(new), seen)


def take_back(spark: SparkSession, path: str, *deliveries: str) -> None:
    """Have deliveries count no more."""
    seen = _versions(spark, path)
    rest = manifest(spark, path).where(~F.col(DELIVERY).isin(*deliveries))
    _commit(spark, path, rest, seen)


def by_delivery(spark: SparkSession, path: str) -> DataFrame:
    """The groups of every delivery that counts, with its name."""
    listed = manifest(spark, path)
    names = [r[FOLDER] for r in listed.select(FOLDER).distinct().orderBy(FOLDER).collect()]
    if not names:
        raise ValueError("no delivery has been put there")
    tables = [spark.read.parquet(f"{path}/groups/{name}").withColumn(FOLDER, F.lit(name)) for name in names]
    # A folder may hold deliveries that have been replaced or taken back since.
    return reduce(DataFrame.unionByName, tables).join(listed.select(DELIVERY, FOLDER), [DELIVERY, FOLDER], "left_semi").drop(FOLDER)


def groups(spark: SparkSession, path: str) -> DataFrame:
    """The groups of all deliveries together, for the ``…_from`` functions of the summaries."""
    return merged(by_delivery(spark, path).drop(DELIVERY))


def compact(spark: SparkSession, path: str) -> None:
    """Put the groups of all deliveries in one folder, and remove what counts no more.

    Readers that began with an older version of the manifest may fail.
    """
    seen = _versions(spark, path)
    listed = manifest(spark, path)
    folder = uuid.uuid4().hex
    write_table(by_delivery(spark, path), f"{path}/groups/{folder}")
    _commit(spark, path, listed.withColumn(FOLDER, F.lit(folder)), seen)
    for name in folders(spark, path, "groups"):
        if name != folder:
            remove(spark, f"{path}/groups/{name}")
    for name in _versions(spark, path)[:-1]:
        remove(spark, f"{path}/manifest/{name}")
