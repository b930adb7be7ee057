"""What tasks of the operators hold, in proportion to their block, and what their workers keep."""

import platform
import random
import subprocess
import sys
import tracemalloc

import corpus_pipeline
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from incidentlens.llm import minhash, suffixes


class _Task:
    @staticmethod
    def get():
        return _Task()

    def partitionId(self):
        return 0


def test_cutting_holds_little_more_than_the_block(monkeypatch):
    monkeypatch.setattr(suffixes, "TaskContext", _Task)
    text = random.Random(1).randbytes(400_000).hex().encode()
    rows = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array([text, text, text]), pa.nulls(3, pa.string())], names=["k", "t", "m"]
    )
    buckets = 8
    blocks = pa.Table.from_batches(suffixes._blocked(8 << 20)([rows]))
    digits = pa.Table.from_batches(suffixes._digits(buckets)(blocks.to_batches()))
    by_bucket = lambda t: [t.filter(pa.compute.equal(t["bucket"], b)) for b in set(t["bucket"].to_pylist())]
    flags = pa.concat_tables(map(suffixes._surviving, by_bucket(digits)))
    units = suffixes._units(buckets)(blocks, flags)
    answers = pa.concat_tables([flags, *map(suffixes._refined, by_bucket(units))])

    size = 3 * len(text)
    row, told = blocks.to_pylist()[0], suffixes._flags_of(answers.to_pylist())
    tracemalloc.start()
    try:
        suffixes._Units(row, told, buckets)
        least = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        cut = suffixes._cut(buckets, "k", False)(blocks, answers)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert cut["n_removed"].to_pylist() == [0, len(text), len(text)]
    assert peak - least < 12 * size


def test_hashes_of_words_are_bounded():
    hashes = minhash._WordHashes()
    tracemalloc.start()
    try:
        for start in range(0, 400_000, 1000):
            minhash.shingles(b" ".join(b"word%d" % i for i in range(start, start + 1000)), hashes)
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 25 << 20


_WORKER = """
import re
import numpy as np, pandas, pyarrow as pa
from incidentlens.llm import blocks, minhash, suffixes

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

def rows():
    for start in range(0, 4000, 500):
        texts = [b" ".join(b"w%d" % (k * 7919 % 999_983) for k in range(i * 250, i * 250 + 500)) for i in range(start, start + 500)]
        yield pa.RecordBatch.from_arrays([pa.array(range(start, start + 500)), pa.array(texts)], names=["doc", "text"])

def task():
    for function in (minhash._signed, minhash._packed_sets):
        for _ in (blocks.tidy(function) if TIDY else function)(rows()):
            pass

before = held()
task()
print(held() - before)
"""


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="needs /proc and the GNU C library")
def test_workers_give_back_what_a_task_has_freed():
    def kept(tidy):
        run = [sys.executable, "-c", _WORKER.replace("TIDY", str(tidy))]
        return float(subprocess.run(run, capture_output=True, text=True, check=True).stdout)

    assert kept(True) < 20 < kept(False)


def test_pipeline_tasks_are_tidy(spark, small, monkeypatch):
    """Every Python function of the stages that holds a block or a bucket gives back."""
    given = []
    for kind, name in (
        (type(spark.range(0)), "mapInArrow"), (type(spark.range(0).groupBy()), "applyInArrow"), (PandasCogroupedOps, "applyInArrow")
    ):
        plain = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda self, f, *a, plain=plain, **b: (given.append(f), plain(self, f, *a, **b))[1])
    corpus_pipeline.run(spark, small)
    assert len(given) >= 11
    assert {f.__qualname__.split(".")[0] for f in given} == {"tidy", "tidy_group", "tidy_cogroup"}
