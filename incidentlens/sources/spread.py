"""Rows dealt to tasks of equal size by counts, where keys differ much in size."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from incidentlens.sources.scratch import materialise

#: Keys whose sizes are laid out one by one; the list goes to every task.
LISTED_KEYS = 10_000
_SEED = 17


def dealt(df: DataFrame, by: Sequence[str], rows_per_task: int) -> DataFrame:
    """Rows partitioned by keys into tasks of about ``rows_per_task``, whatever the keys' sizes.

    The largest keys are laid side by side, in their order, and cut where a task is full:
    a large key is dealt to several tasks, and small ones share one. No key beyond the
    ``LISTED_KEYS`` largest can have more than that part of all rows; those go by hash.
    Costs a count of the keys' rows, for which only the keys are read, and needs no
    adaptive execution.
    """
    counts = materialise(df.groupBy(*by).count(), "key_sizes")
    names = [f"_key_{i}" for i in range(len(by))]
    before = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)  # of the listed keys only
    listed = counts.orderBy(F.desc("count"), *by).limit(LISTED_KEYS).select(
        *[F.col(key).alias(name) for key, name in zip(by, names, strict=True)],
        F.col("count").alias("_rows"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_ahead"),
    )
    listed = materialise(listed, "listed_keys")
    in_order = listed.agg(F.sum("_rows")).first()[0] or 0
    others = (counts.agg(F.sum("count")).first()[0] or 0) - in_order
    tasks, more_tasks = -(-in_order // rows_per_task), -(-others // rows_per_task)
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(name)) for key, name in zip(by, names, strict=True)])
    place = F.floor((F.col("_ahead") + F.rand(_SEED) * F.col("_rows")) / rows_per_task)
    hashed = F.pmod(F.hash(*by), F.lit(max(more_tasks, 1))) + tasks
    placed = df.join(F.broadcast(listed), same, "left").withColumn("_task", F.coalesce(place, hashed).cast("int"))
    return placed.repartitionById(max(tasks + more_tasks, 1), "_task").select(*df.columns)
