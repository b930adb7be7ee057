"""Sharding by balanced label propagation (operator 7).

Documents of equal text are linked. Labels (shards) start by hash; in each round
the members a group has in one shard want to join the shard where the group is
strongest, and may as far as quotas allow: what is free there, and swaps between
two shards. Shards may be over their capacity by a quarter meanwhile; at the end they
give whole groups up again, which are poured where there is room. Members of a group are interchangeable, so a round works on counts by
(group, shard), at most one row per group and shard, however large the group.
Documents without links fill up the shards, whose counts differ by at most one
(law ``rows``).

Rounds exchange small tables through the driver: counts by pair of shards only.
Only DataFrame operations are used.

Defined results: a NULL text has size 1, checksum 0 and no links; empty texts are
equal; repeated rows are documents of their own; an empty table gives no rows;
other columns are not looked at.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from incidentlens.sources.scratch import materialise, remove, scratch_path

SLACK = 4  # a shard may be over its capacity by this part of it until the rounds are over
CHUNK = 1024  # members of a group that are poured together
POOL = -1  # label of documents that a full shard gives up


def numbered(
    df: DataFrame, keys: list[str], order: list[str], name: str, buckets: int, by: list[str] | None = None
) -> DataFrame:
    """Numbers the rows of each key from 0 without gaps, in buckets by hash of ``by`` (or ``order``).

    No task holds a whole key: rows are numbered within their bucket, and buckets
    start where the smaller ones end.
    """
    by_bucket = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*by or order), F.lit(buckets))).withColumn(
        "_number", F.row_number().over(by_bucket).cast("long")
    )
    sizes = rows.groupBy(*keys, "_bucket").agg(F.max("_number").alias("_size"))
    before = Window.partitionBy(*keys or [F.lit(0)]).orderBy("_bucket")
    starts = sizes.withColumn(
        "_start", F.sum("_size").over(before.rowsBetween(Window.unboundedPreceding, -1))
    ).drop("_size")
    return (
        rows.join(starts, [*keys, "_bucket"])
        .withColumn(name, F.col("_number") - 1 + F.coalesce("_start", F.lit(0)))
        .drop("_bucket", "_number", "_start")
    )


def _accepted(moves: DataFrame, quotas: dict[tuple[int, int], int]) -> DataFrame:
    """As many of each pair's moves as its quota allows, large targets first."""
    spark = moves.sparkSession
    table = spark.createDataFrame(
        [(a, b, q) for (a, b), q in quotas.items()], "from int, to int, quota long"
    )
    strength = 63 - F.floor(F.log2(F.col("strength") + 1)).cast("int")
    rows = moves.withColumn("_order", strength * 64 + F.pmod(F.xxhash64("g"), F.lit(64)).cast("int"))
    pair = ["from", "to"]
    sums = rows.groupBy(*pair, "_order").agg(F.sum("n").alias("_sum"))
    earlier = Window.partitionBy(*pair).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    inner = (
        Window.partitionBy(*pair, "_order").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("_before", F.coalesce(F.sum("n").over(inner), F.lit(0)))
        .join(starts, [*pair, "_order"])
        .join(F.broadcast(table), pair)  # a row per pair of shards at most
        .withColumn(
            "n", F.least("n", F.greatest(F.lit(0), F.col("quota") - F.col("_start") - F.col("_before")))
        )
        .where("n > 0")
        .select("g", "from", "to", "n")
    )


def _moved(state: DataFrame, moves: DataFrame) -> DataFrame:
    leave = moves.select("g", F.col("from").alias("shard"), (-F.col("n")).alias("n"))
    enter = moves.select("g", F.col("to").alias("shard"), "n")
    return (
        state.unionByName(leave).unionByName(enter)
        .groupBy("g", "shard").agg(F.sum("n").alias("n")).where("n > 0")
    )


def _by_shard(state: DataFrame, shards: int) -> list[int]:
    """Linked documents by shard: a row per shard comes to the driver."""
    found = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _propagated(state: DataFrame, capacity: list[int], rounds: int) -> DataFrame:
    """The counts by group and shard after the rounds; what is over the capacity has label POOL."""
    spark, shards = state.sparkSession, len(capacity)

    def kept(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "labels")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    state, path = kept(state)
    for _ in range(rounds):
        used = _by_shard(state, shards)
        free = [max(0, c + c // SLACK - u) for c, u in zip(capacity, used, strict=True)]
        is_open = F.col("shard").isin([s for s in range(shards) if free[s]])
        # Equal shards by hash, so that wishes of many small groups go both ways and can be swapped.
        tie = F.xxhash64("g", "shard").alias("tie")
        best = F.struct((~is_open).alias("closed"), (-F.col("n")).alias("less"), tie, "shard")
        group = Window.partitionBy("g")
        wishes = (
            state.withColumn("best", F.min(best).over(group))
            .where((F.col("best.shard") != F.col("shard")) & (F.col("n") <= -F.col("best.less")))
            .select(
                "g",
                F.col("shard").alias("from"),
                F.col("best.shard").alias("to"),
                "n",
                (-F.col("best.less")).alias("strength"),
            )
        )
        wanted = {
            (r["from"], r["to"]): r["n"]
            for r in wishes.groupBy("from", "to").agg(F.sum("n").alias("n")).collect()
        }
        quotas = {(a, b): min(n, wanted.get((b, a), 0)) for (a, b), n in sorted(wanted.items())}
        for a, b in quotas:
            more = min(wanted[a, b] - quotas[a, b], free[b])
            quotas[a, b] += more
            free[b] -= more
        if not any(quotas.values()):
            break
        (state, new), old = kept(_moved(state, _accepted(wishes, quotas))), path
        path = new
        remove(spark, old)
    used = _by_shard(state, shards)
    excess = {(s, POOL): u - c for s, (u, c) in enumerate(zip(used, capacity, strict=True)) if u > c}
    if excess:
        giving = state.where(F.col("shard").isin([s for s, _ in excess])).select(
            "g", F.col("shard").alias("from"), F.lit(POOL).alias("to"), "n", F.lit(0).alias("strength")
        )
        state, _ = kept(_moved(state, _accepted(giving, excess)))
    return state


def _range_of(number: Column, sizes: list[int]) -> Column:
    """Which of consecutive ranges of these sizes a number falls into."""
    end, found = 0, None
    for s, size in enumerate(sizes):
        end += size
        is_here = number < end
        found = F.when(is_here, s) if found is None else found.when(is_here, s)
    return found.cast("int")


def shard(
    docs: DataFrame,
    shards: int = 16,
    key: str = "doc_id",
    text: str = "text",
    rounds: int = 16,
    buckets: int = 256,
) -> DataFrame:
    """Key, size, text checksum, ``g`` (the link group) and shard of every document."""
    spark: SparkSession = docs.sparkSession
    content = F.col(text)
    rows = materialise(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.coalesce(F.octet_length(content), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(content.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.sha2(content, 256).alias("g"),
        ),
        "sizes",
    )
    linked = rows.where("g IS NOT NULL").groupBy("g").agg(F.count(F.lit(1)).alias("group_size"))
    linked = materialise(linked.where("group_size > 1"), "groups")  # so that a large group's join is split
    rows = materialise(rows.join(linked, "g", "left"), "linked")
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    initial = (
        rows.where("group_size > 1")
        .groupBy("g", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    state = _propagated(initial, capacity, rounds)
    upto = Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    places = (
        state.withColumn("end", F.sum("n").over(upto))
        .groupBy("g")  # a row per shard at most
        .agg(F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("places"))
    )
    members = numbered(rows.where("group_size > 1"), ["g"], ["doc_id"], "_member", 64)
    placed = (
        materialise(members, "members")
        .join(materialise(places, "places"), "g")
        .withColumn(
            "shard", F.filter("places", lambda p: F.col("_member") < p["end"])[0]["shard"]
        )
        .withColumn("_chunk", F.xxhash64("g", F.floor(F.col("_member") / CHUNK)))
        .drop("places", "_member")
    )
    filled = _by_shard(state, shards)
    rest = rows.where("group_size IS NULL").withColumns({"shard": F.lit(POOL), "_chunk": F.xxhash64("doc_id")})
    pool = placed.where(F.col("shard") == POOL).unionByName(rest)
    room = [c - u for c, u in zip(capacity, filled, strict=True)]
    # What a group gives up stays together, in chunks, so that only the shards' borders cut it.
    poured = numbered(pool, [], ["_chunk", "doc_id"], "_pooled", buckets, by=["_chunk"])
    poured = poured.withColumn("shard", _range_of(F.col("_pooled"), room)).drop("_pooled")
    out = placed.where(F.col("shard") != POOL).unionByName(poured)
    return out.select(F.col("doc_id").alias(key), "size", "text_crc32", "g", "shard")


def slotted(sharded: DataFrame, key: str = "doc_id", buckets: int = 256) -> DataFrame:
    """The sharded documents with a place in their shard and the law they follow."""
    rows = materialise(sharded, "shards")
    return numbered(rows, ["shard"], [key, "text_crc32"], "slot", buckets).select(
        key,
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
    )
