"""Late and corrected records merged into the stored ones, by key.

The latest delivery of a key wins, also over its place: a corrected record may move to
another borough, or have coordinates that make it go. Only boroughs that lose or gain
records are written again; the files of the others stay as they are.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlens.operators.records import keep_valid
from incidentlens.schema import PARTITION_COLUMN, STORED_SCHEMA
from incidentlens.sources.scratch import materialise, remove, scratch_path
from incidentlens.sources.store import (
    partition_name,
    partition_names,
    read_partitioned,
    write_partitioned,
    write_table,
)

KEY, ORDER = "ARREST_KEY", "delivered"


def latest(flagged: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """One record for every key: that with the greatest ``order``, a missing one being least.

    Of equal ones the greatest by all columns. Records without a key all stay. The tasks
    combine before the shuffle, so that a key with very many records costs no more.
    """
    rest = [c for c in flagged.columns if c not in (key, order)]
    record = F.struct(order, *rest)
    chosen = flagged.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(record).alias("_record"))
    keyed = chosen.select(key, "_record.*")
    return keyed.unionByName(flagged.where(F.col(key).isNull())).select(*flagged.columns)


def merge(spark: SparkSession, stored_path: str, flagged: DataFrame) -> list[str]:
    """Merge flagged records with a column ``delivered`` into the stored dataset.

    What they say of a key replaces what is stored of it; a record with unusable
    coordinates takes its key's record away. Records without a key are added, each time.
    Returns the names of the partitions written or removed. Running it again changes
    nothing but for records without a key, also after a failure in between.
    """
    changes = materialise(latest(flagged), "changes")
    keys = changes.where(F.col(KEY).isNotNull()).select(KEY)
    # Directories spell an empty borough like a missing one.
    named = changes.withColumn(PARTITION_COLUMN, F.nullif(F.col(PARTITION_COLUMN), F.lit("")))
    fresh = keep_valid(named).select(*STORED_SCHEMA.names)
    stored = read_partitioned(spark, stored_path)
    left = stored.join(keys, KEY, "left_semi").select(PARTITION_COLUMN)
    touched = [r[0] for r in left.unionByName(fresh.select(PARTITION_COLUMN)).distinct().collect()]  # a handful
    if not touched:
        return []
    place = F.col(PARTITION_COLUMN)
    here = place.isin(*[name for name in touched if name is not None])
    if None in touched:
        here = here | place.isNull()
    # Read partitions can't be written to, so the new content is complete before any is.
    rest = stored.where(here).join(keys, KEY, "left_anti").select(*STORED_SCHEMA.names)
    staged_path = scratch_path(spark, "merged")
    staged = write_table(rest.unionByName(fresh), staged_path)
    present = staged.select(PARTITION_COLUMN).distinct().collect()
    filled = {partition_name(spark, r[0]) for r in present}
    write_partitioned(staged, stored_path, only_touched=True)
    names = sorted({partition_name(spark, name) for name in touched})
    for name in set(names) & set(partition_names(spark, stored_path)) - filled:  # its last record has gone
        remove(spark, f"{stored_path}/{PARTITION_COLUMN}={name}")
    remove(spark, staged_path)
    return names
