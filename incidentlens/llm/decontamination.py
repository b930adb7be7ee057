"""Benchmark decontamination by a prefix-filtered set join (operator 2).

A window is a run of item words; it occurs in a document only if all its words
do, so one of them is a sufficient prefix, and the best is the rarest. Words are
ordered by how often the documents use them. A document word that is some
window's prefix gives a candidate position; length and position must leave room
for the window there, and the words are then compared in full.

Only DataFrame operations are used. Documents are joined in place, without a
shuffle, while the benchmark's windows stay below ``BROADCAST_WINDOWS``; beyond
it words are shuffled and documents read again for the comparison.

Defined results: a NULL or empty text has no words; an item without words has no
window; items of equal text all count; rows are judged one by one, also those
without key or with a repeated one; without documents there are no rows, without
items nobody is hit; other columns are not looked at.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from incidentlens.llm.rows import ROW, numbered
from incidentlens.sources.scratch import materialise

BROADCAST_WINDOWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; NULL has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN)
    return F.array_remove(parts, "")


def windows(items: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """The windows of each item: its key, the words joined by a space, their number."""
    words = items.select(F.col(key).alias("item"), words_of(F.col(text)).alias("words"))
    length = F.least(F.size("words"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    return (
        words.where(F.size("words") > 0)
        .select("item", "words", length.alias("length"), F.explode(starts).alias("start"))
        .select("item", F.concat_ws(" ", F.slice("words", F.col("start"), F.col("length"))).alias("window"), "length")
        .distinct()
    )


def _rarest(wins: DataFrame, docs: DataFrame, text: str, small: bool) -> DataFrame:
    """Each distinct window that may occur with its rarest word and that word's place."""
    parts = wins.select("window", "length").distinct().select(
        "window", "length", F.posexplode(F.split("window", " ")).alias("offset", "word")
    )
    vocabulary = parts.select("word").distinct()
    used = docs.select(F.explode_outer(words_of(F.col(text))).alias("word"))
    counts = (
        used.join(F.broadcast(vocabulary) if small else vocabulary, "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    prefix = F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "word", "offset"))
    return (
        parts.join(counts, "word", "left")
        .groupBy("window", "length")
        .agg(prefix.alias("prefix"))
        .where("prefix.uses > 0")
        .select("window", "length", "prefix.word", "prefix.offset")
    )


def occurrences(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", size: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """Where windows occur, (key, start, length, window), and the items' windows.

    Documents are told apart by key, which has to be there. Both are written tables, in proportion to the hits and the benchmark.
    """
    wins = materialise(windows(items, item_key, item_text, size), "windows")
    small = wins.count() <= BROADCAST_WINDOWS
    prefixes = materialise(_rarest(wins, docs, text, small), "prefixes")
    words = docs.select(F.col(key).alias("doc"), words_of(F.col(text)).alias("words"))
    start = F.col("place") - F.col("offset")
    fits = (start >= 0) & (start + F.col("length") <= F.size("words"))
    is_equal = F.concat_ws(" ", F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("length"))) == F.col("window")
    if small:
        found = (
            words.select("doc", "words", F.posexplode_outer("words").alias("place", "word"))
            .join(F.broadcast(prefixes), "word")
            .where(fits)
            .where(is_equal)
        )
    else:
        candidates = (
            words.select("doc", F.posexplode_outer("words").alias("place", "word"))
            .join(prefixes, "word")
            .select("doc", "place", "offset", "length", "window")
        )
        found = candidates.join(words, "doc").where(fits).where(is_equal)
    hits = found.select("doc", start.alias("start"), "length", "window").distinct()
    return materialise(hits, "hits"), wins


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", size: int = 10,
) -> DataFrame:
    """Per document its words, the hit ones and the items (as an array) found in it."""
    docs = numbered(docs, key, text)
    hits, wins = occurrences(docs, items, ROW, text, item_key, item_text, size)
    spans = hits.groupBy("doc", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    earlier = Window.partitionBy("doc").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max("end").over(earlier), F.lit(0))
    hit_words = (
        spans.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", covered)))
        .groupBy("doc")
        .agg(F.sum("new").cast("long").alias("n_hit"))
    )
    found_items = (
        hits.select("doc", "window").distinct()
        .join(wins.select("window", "item"), "window")
        .groupBy("doc")
        .agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    )
    base = docs.select(
        F.col(ROW).alias("doc"), F.col(key).alias("key"), F.size(words_of(F.col(text))).cast("long").alias("n_words")
    )
    return (
        base.join(hit_words.join(found_items, "doc"), "doc", "left")
        .select(
            F.col("key").alias(key),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The result of :func:`contamination` with the items as number and digest."""
    return found.select(
        key,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
