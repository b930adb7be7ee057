"""How many steps the suffix tree takes a word, and that the faster ones give the same."""

import os
import sys
import tempfile
import time
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from test_lists import BUCKETS, _sent

from incidentlens.llm import blocks, suffix_tree

TEXTS = [
    b"", b" \t\n\x0b\x0c\r ", b"one", b"  One two\n\nTHREE\x0btwo \r\n", bytes(range(256)) * 3,
    b"\x85\xa0 \x1c\x1d\x1e\x1f a\x00b \xff\xc3", "café CAFÉ    x 你".encode(), b"one two",
]


def _made(texts: list[bytes]) -> tuple[tuple, tuple]:
    """The rows of a block that is split at once, and of one made word by word."""
    late, plain = blocks._LateBlock(suffix_tree._words), blocks._Block()
    for key, text in enumerate(texts):
        late.add(key, text, len(text))
        plain.add(key, text.lower().split(), len(text))
    return late.row(7, BUCKETS), plain.row(7, BUCKETS)


@pytest.mark.parametrize("texts", [TEXTS, TEXTS[:2], TEXTS[2:3], [b"w%d x" % (i % 999) for i in range(5000)]])
def test_a_block_split_at_once_is_the_same(texts):
    late, plain = _made(texts)
    assert late == plain


def test_distinct_numbers():
    random = np.random.default_rng(2)
    wide = random.integers(0, 2**63, 100, dtype=np.uint64) * np.uint64(2) + np.uint64(1)  # no room for their places
    for keys in (random.integers(0, 50, 1000, dtype=np.uint64), wide[random.integers(0, 100, 1000)], wide[:0], wide[:1]):
        distinct, order, begin, place = suffix_tree._distinct(keys)
        expected = np.unique(keys, return_index=True, return_inverse=True)
        for found, right in zip((distinct, order[begin], place), expected, strict=True):
            assert (found == right).all() and len(found) == len(right)
        assert (order == np.argsort(keys, kind="stable")).all()


def test_blocks_take_no_python_step_a_word(spark, monkeypatch):
    """Calls of Python functions, and by Python code of others, while a block is made."""
    texts = [b" ".join(b"w%d" % (i * j % 997) for j in range(100)) for i in range(200)]
    made, calls = [], 0

    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, function, schema):
            made.append(function)

    class Task:
        get = staticmethod(lambda: type("Of", (), {"partitionId": lambda self: 0})())

    def count(frame, event, argument):
        nonlocal calls
        calls += event in ("call", "c_call")

    monkeypatch.setattr(blocks, "TaskContext", Task)
    whole, options = suffix_tree.word_blocks, []
    monkeypatch.setattr(suffix_tree, "word_blocks", lambda *a, **k: options.append((a, k)) or whole(*a, **k))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_tree.scored(empty).isEmpty()
    arguments, named = options[0]
    whole(Rows(), *arguments[1:], **named)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], ["doc_id", "text"])
    sys.setprofile(count)
    try:
        rows = list(made[0]([batch]))
    finally:
        sys.setprofile(None)
    assert sum(chain.from_iterable(r["counts"][0].as_py() for r in rows)) == 20_000
    assert calls < 20_000  # looking up each word alone is as many


def test_orders_are_not_looked_for_by_token(monkeypatch):
    """Numbers are sorted with their places; orders, which take longer, are found for items at most."""
    table, answers, known, _ = _sent()
    looked, tokens = 0, 400 * 501

    def counted(function):
        def run(values, *more, **named):
            nonlocal looked
            looked += len(values) if values.dtype.itemsize > 2 else 0  # short numbers are sorted by digits
            return function(values, *more, **named)

        return run

    for name in ("unique", "argsort"):
        monkeypatch.setattr(np, name, counted(getattr(np, name)))
    suffix_tree._stage(0, 1, *known)(table, answers)
    assert looked < tokens / 4


def test_buckets_are_as_many_as_the_text_takes(spark, awkward, awkward_docs, no_docs, monkeypatch):
    """One for each partition, or for each 16 MiB; blocks send a list to each."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made, whole = [], suffix_tree.word_blocks
    monkeypatch.setattr(suffix_tree, "word_blocks", lambda *a, **k: made.append(a[4]) or whole(*a, **k))
    scores = sorted(suffix_tree.scored(awkward_docs).collect())
    assert suffix_tree.scored(no_docs).isEmpty()
    size = sum(len((text or "").encode()) for _, text in awkward)
    monkeypatch.setattr(suffix_tree, "BUCKET_BYTES", size // (3 * partitions))
    assert sorted(suffix_tree.scored(awkward_docs).collect()) == scores
    assert made[:2] == [partitions] * 2 and 3 * partitions <= made[2] <= 3 * partitions + 1


def test_no_shuffle_outlasts_its_step(spark, awkward_docs):
    """Files of shuffles don't wait for the driver to collect garbage, and the session is as before."""
    given = os.environ.get("SPARK_LOCAL_DIRS") or spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def files():
        managers = [m for d in given.split(",") for m in Path(d).glob("**/blockmgr-*")]
        return {f for m in managers for f in m.rglob("shuffle_*.data")}

    before, setting = files(), spark.conf.get(name)
    awkward_docs.repartition(3, "doc_id").write.format("noop").mode("overwrite").save()
    assert files() - before  # this is where they are
    before = files()
    suffix_tree.scored(awkward_docs)
    waited = time.time() + 20
    while files() - before and time.time() < waited:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(name) == setting
