"""Merkle manifest of a dataset (operator 12): a tree per source, and one over the sources.

Nodes of a tree are numbered by place. Windows over blocks of 4,096 places give every
node its neighbours as lag and lead columns of fixed offsets; those that lie beyond its
run of 16 are masked by the node's slot and by the run's length. What is left are its
siblings. The first node of a run hashes the run: it is the parent's row. As blocks hold
whole runs, a source with a third of all rows is dealt to many tasks.

Places come from a range sort over all rows, which may cut a source anywhere; counts by
partition, one row per source and partition, say how many rows of the source lie before.

Defined results: missing doc_ids come first, equal ones follow the order of their leaves;
a missing source is a source of its own, the first; a missing doc_id is never tampered
with; repeated rows are leaves of their own; an empty table gives no rows and no root.
Other columns are not looked at.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentlens.sources.scratch import materialise

RUN = 16
#: Places that one window holds; whole runs, and small enough for any task.
BLOCK = RUN**3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of strings, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it; ``-`` for none."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    return digest(*[field(text if name == "text" else F.col(name)) for name in FIELDS])


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def hit_by_crc(key: Column, divisor: int = 5) -> Column:
    """The divisor divides the CRC-32 of the decimal key; false without a key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % divisor == 0, F.lit(False))


def placed(nodes: DataFrame, tree: str, *order: str) -> DataFrame:
    """Nodes with their place in their tree, from 0, and the tree's size: ``pos``, ``n``.

    ``tree`` must not be NULL. Nodes that are equal in the order stand in any order. The
    result is a written table.
    """
    rows = materialise(nodes.withColumn("_any", F.monotonically_increasing_id()), "nodes")
    by = [tree, *order, "_any"]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_any")
    rows = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    rows = rows.withColumn("_task", F.shiftright("_at", 33))
    counts = rows.groupBy(tree, "_task").agg(F.min("_at").alias("_first"), F.count("*").alias("_count"))
    whole = Window.partitionBy(tree)
    before = F.sum("_count").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    bounds = counts.select(
        tree,
        "_task",
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_count").over(whole).alias("n"),
    )
    found = rows.join(bounds, [tree, "_task"]).withColumn("pos", F.col("_at") + F.col("_shift"))
    return materialise(found.drop("_task", "_at", "_shift"), "placed")


def _neighbours(nodes: DataFrame, tree: str, name: str) -> tuple[DataFrame, Column, Column]:
    """Nodes with their run, and the digests before and after each in its run, joined."""
    slot = F.col("pos") % RUN
    length = F.least(F.lit(RUN).cast("long"), F.col("n") - (F.col("pos") - slot))
    window = Window.partitionBy(tree, "_block").orderBy("pos")
    blocked = nodes.withColumn("_block", F.expr(f"pos div {BLOCK}")).withColumn("run", F.expr(f"pos div {RUN}"))
    lags = [F.when(slot >= k, F.lag(name, k).over(window)) for k in range(RUN - 1, 0, -1)]
    leads = [F.when(slot + k < length, F.lead(name, k).over(window)) for k in range(1, RUN)]
    return blocked, F.concat_ws("", *lags), F.concat_ws("", *leads)


def with_siblings(nodes: DataFrame, tree: str, name: str) -> DataFrame:
    """Nodes with ``run`` and the digests of their siblings ``left`` and ``right`` of them."""
    blocked, left, right = _neighbours(nodes, tree, name)
    return blocked.withColumns({"left": left, "right": right}).drop("_block")


def parents(nodes: DataFrame, tree: str, name: str) -> DataFrame:
    """One node for every run, of trees that have more than one node."""
    blocked, _, right = _neighbours(nodes.where("n > 1"), tree, name)
    return (
        blocked.select(tree, "pos", "n", "run", digest(F.col(name), right).alias("digest"))
        .where(F.col("pos") % RUN == 0)
        .select(tree, F.col("run").alias("pos"), F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n"), "digest")
    )


def levels(leaves: DataFrame, tree: str) -> list[DataFrame]:
    """The levels of all trees from their placed leaves up; the last one has roots only."""
    most, found = leaves.agg(F.max("n")).first()[0] or 0, [leaves.select(tree, "pos", "n", "digest")]
    while most > 1:
        found.append(materialise(parents(found[-1], tree, "digest"), "level"))
        most = -(-most // RUN)
    return found


def roots(all_levels: list[DataFrame], tree: str) -> DataFrame:
    """Tree, level and digest of every tree's root."""
    alone = [
        nodes.where("n = 1").select(tree, F.lit(level).alias("level"), F.col("digest").alias("root"))
        for level, nodes in enumerate(all_levels)
    ]
    return reduce(DataFrame.unionAll, alone)


def _path(nodes: DataFrame, tree: str, above: DataFrame) -> DataFrame:
    """Nodes with the siblings on the way up in ``path``, and what ``above`` carries.

    ``above`` has the paths from every run; of a tree with one node, from that node.
    """
    own = F.array(F.struct("left", "right"))
    here = with_siblings(nodes, tree, "digest").join(above.withColumnRenamed("pos", "run"), [tree, "run"])
    path = F.when(F.col("n") > 1, F.concat(own, F.col("path"))).otherwise(F.col("path"))
    return here.withColumn("path", path).drop("left", "right", "run")


def paths(all_levels: list[DataFrame], tree: str, tops: DataFrame) -> DataFrame:
    """What lies above the runs of the leaves: tree, pos of the run, path and further columns.

    ``tops`` has what lies above the roots: tree, level of the root, path, further columns.
    """
    more = [c for c in tops.columns if c not in (tree, "level", "path")]
    ends = tops.withColumn("pos", F.lit(0).cast("long"))

    def ended(level: int) -> DataFrame:
        return ends.where(F.col("level") == level).select(tree, "pos", "path", *more)

    above = ended(len(all_levels) - 1)
    for level in range(len(all_levels) - 1, 0, -1):
        here = _path(all_levels[level], tree, above).select(tree, "pos", "path", *more)
        # Written, so that no plan has the windows of more than one level.
        above = materialise(here.unionAll(ended(level - 1)), "paths")
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, start, lambda node, at: digest(at["left"], node, at["right"]))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaf, subroot, root, proof and the root from the proof, for every document.

    Rows that fulfil ``tampered`` (none by default) have their text in lower case when
    the root is computed from their proof.
    """
    tampered = F.lit(False) if tampered is None else tampered
    text = F.col("text")
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # none comes first, then bytewise
    leaves = docs.select(
        tree.alias("_tree"),
        "doc_id",
        leaf(text).alias("digest"),
        F.when(tampered, leaf(lowered(text))).alias("_changed"),
    )
    leaves = placed(leaves, "_tree", "doc_id", "digest")
    lower = levels(leaves, "_tree")
    subroots = materialise(roots(lower, "_tree"), "subroots")
    sources = subroots.select(F.lit("").alias("_all"), "_tree", F.col("root").alias("digest"))
    sources = placed(sources, "_all", "_tree")
    upper = levels(sources, "_all")
    top = roots(upper, "_all").select("_all", "level", F.array().cast(_PATH).alias("path"), "root")
    above = _path(sources, "_all", paths(upper, "_all", top)).select("_tree", "path", "root")
    tops = subroots.withColumnRenamed("root", "subroot").join(above, "_tree")
    proved = _path(leaves, "_tree", paths(lower, "_tree", materialise(tops, "tops")))
    siblings = F.transform("path", lambda at: F.concat(at["left"], at["right"]))
    start = F.coalesce("_changed", "digest")
    return proved.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        digest(F.concat_ws("", siblings)).alias("proof_sha256"),
        folded(start, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
