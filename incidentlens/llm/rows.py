"""Rows of a table with numbers of their own, and without those of given keys."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.sources.scratch import materialise

BROADCAST_KEYS = 2_000_000
ROW = "_row"


def without_keys(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in ``gone``; a missing key equals a missing key.

    The keys are written, counted, and sent to all tasks only if they are few; else
    both sides are shuffled.
    """
    keys = materialise(gone.select(F.col(key).alias("_gone")).distinct(), "gone")
    few = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return docs.join(few, docs[key].eqNullSafe(few["_gone"]), "left_anti")


def numbered(docs: DataFrame, key: str, text: str, collapsed: bool = False) -> DataFrame:
    """The rows with a number ``ROW`` of their own, in the order of keys, missing ones last.

    Keys that are all there, and once, are the numbers themselves. Otherwise rows are
    sorted by key and a digest of the text, and written; with ``collapsed`` one row
    stays of those whose key and text are both equal.
    """
    if docs.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).isEmpty():
        return docs.withColumn(ROW, F.col(key).cast("long"))
    rows = docs.withColumn("_digest", F.sha2(F.col(text).cast("binary"), 256))
    if collapsed:
        rows = rows.dropDuplicates([key, "_digest"])
    # The last column parts a key and text that very many rows share.
    rows = rows.withColumn("_place", F.monotonically_increasing_id())
    rows = rows.orderBy(F.col(key).asc_nulls_last(), "_digest", "_place").drop("_digest", "_place")
    return materialise(rows.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
