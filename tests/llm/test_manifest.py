"""The Merkle manifest against a plain version that builds every tree in memory."""

import pytest
from pyspark.sql import functions as F

from incidentlens.llm import merkle, queries
import brute

DOCUMENT = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def bag(rows):
    return sorted(map(tuple, rows), key=repr)


def manifest(docs):
    return bag(merkle.manifest(docs, merkle.hit_by_crc(F.col("doc_id"))).collect())


def test_given_documents(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select(*DOCUMENT).collect()
    found = bag(queries.op12_merkle(spark, small).collect())
    assert found == bag(brute.manifest(rows))
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


def test_sources_of_many_sizes(spark):
    """Sources of 1, 16, 17, 256 and 257 rows, one with most rows, more than 16 sources, ties and nulls."""
    sizes = {None: 3, "": 1, "é": 16, "a": 17, "B": 256, "\U0001f600": 257, "￿": 2, "hot": 5000}
    sizes |= {f"s{i}": 1 for i in range(300)}
    rows = []
    for source, size in sizes.items():
        for i in range(size):
            key = len(rows)
            lang, chars = (None if key % 7 == 0 else "en"), (None if key % 11 == 0 else key)
            rows.append((key, source, lang, chars, None if key % 13 == 0 else "Text Ä" * (i % 9)))
    rows += [(None, "hot", "x", 1, "T")] * 40 + [(7, "hot", "x", 1, "T")] * 3 + [(7, "hot", "x", 1, "U"), (None,) * 5]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert manifest(docs) == bag(brute.manifest(rows))


@pytest.mark.parametrize("rows", [[], [(5, "a", None, 1, "X")], [(None,) * 5]])
def test_no_rows_and_one_row(spark, rows):
    assert manifest(spark.createDataFrame(rows, SCHEMA)) == bag(brute.manifest(rows))


def test_clashing_columns_and_long_texts(spark):
    rows = [(i, "a", "b", i, "Ab" * (200_000 if i == 3 else i)) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = {name: F.lit(1) for name in ("pos", "n", "digest", "_tree", "path", "level", "run", "leaf", "root")}
    assert manifest(docs.withColumns(clashing)) == bag(brute.manifest(rows))


def test_any_change_is_noticed(spark):
    """Every field counts, and so does where a value ends."""
    rows = [(1, "ab", "c", None, "x"), (1, "a", "bc", None, "x"), (1, "ab", "c", None, None), (1, "ab", "c", 0, "x")]
    rows.append((1, "ab", "c", None, "-"))
    leaves = spark.createDataFrame(rows, SCHEMA).select(merkle.leaf(F.col("text")).alias("leaf"))
    assert leaves.distinct().count() == len(rows)


def test_no_window_or_join_holds_a_whole_source(spark):
    docs = spark.range(100_000).select(
        F.col("id").alias("doc_id"), F.lit("hot").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("x").alias("text")
    )
    leaves = merkle.placed(docs.select(F.col("source").alias("_tree"), "doc_id", F.col("doc_id").cast("string").alias("digest")), "_tree", "doc_id")
    assert leaves.agg(F.count_distinct("pos"), F.min("pos"), F.max("pos"), F.max("n")).first() == (100_000, 0, 99_999, 100_000)
    assert leaves.where("pos != doc_id").isEmpty()
    plan = merkle.with_siblings(leaves, "_tree", "digest")._jdf.queryExecution().toString()
    assert "hashpartitioning(_tree" in plan and "_block" in plan
