"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.sources.scratch import remove, scratch_path


def _written(df: DataFrame, old: str | None) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, "edges")
    df.write.parquet(path)
    if old:
        remove(df.sparkSession, old)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of a set of edges: one row."""
    hashed = F.xxhash64("node", "root")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(hashed), F.sum(hashed.cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node tells its larger neighbours its smallest one."""
    both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.min("root").alias("least"))
    return (
        both.where("root > node")
        .join(least, "node")
        .select(F.col("root").alias("node"), F.least("node", "least").alias("root"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node tells its smaller neighbours, and itself, its smallest one."""
    least = edges.groupBy("node").agg(F.min("root").alias("least"))
    told = edges.join(least, "node").select(F.col("root").alias("node"), F.col("least").alias("root"))
    own = least.select("node", F.col("least").alias("root"))
    return told.unionByName(own).where("node <> root").distinct()


def components(edges: DataFrame) -> tuple[DataFrame, str]:
    """(node, root) for every node that isn't its component's smallest; and where it is written.

    ``edges`` has two columns of one type. Both steps shuffle by node and combine
    before; tables are written between rounds.
    """
    a, b = edges.columns
    greater, smaller = F.greatest(a, b), F.least(a, b)
    edges = edges.where(f"{a} <> {b}").select(greater.alias("node"), smaller.alias("root")).distinct()
    edges, path = _written(edges, None)
    mark = _mark(edges)
    while mark[0]:
        edges, path = _written(_small_star(_large_star(edges)), path)
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges, path
