"""Blocks of documents as numbers over a dictionary of their own.

A block is up to ``block_bytes`` of whole texts from one task (a longer text is a
block by itself). Its documents become arrays of word numbers, its distinct words
chunks by the hash of the word. What is known of a word is found once per chunk
and joined back to the blocks by number, so that no row per word is shuffled.
"""

import ctypes
import uuid
import zlib
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.sources.scratch import scratch_path

BLOCK_SCHEMA = (
    "block long, keys array<long>, counts array<int>, words binary, "
    "chunks array<struct<part:int, terms:binary, numbers:binary>>"
)


def give_back() -> None:
    """Return to the system what this process has freed.

    A Python worker goes from task to task, and its allocators keep for the next one what the
    last has freed: without this a worker of several stages holds the largest of all tasks.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library's
    if trim:
        trim(0)


def tidy(function):
    """``function`` of a task's batches; what it has freed is returned at the task's end."""

    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def tidy_group(function):
    """``function`` of a group; what it has freed is returned after each. For large groups."""

    def run(group):
        try:
            return function(group)
        finally:
            give_back()

    return run


def tidy_cogroup(function):
    """The same for a function of two tables."""

    def run(left, right):
        try:
            return function(left, right)
        finally:
            give_back()

    return run


def squeeze(raw: bytes) -> bytes:
    """Bytes compressed, with their size before them."""
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def unsqueeze(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""


def pack(values: np.ndarray) -> bytes:
    """An array as compressed byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return squeeze(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    """The array that :func:`pack` was given."""
    planes = np.frombuffer(unsqueeze(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def rows_of(batches, step: int = 256):
    """Rows of Arrow batches as tuples; few at a time become Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


_CHUNK = pa.struct([("part", pa.int32()), ("terms", pa.binary()), ("numbers", pa.binary())])
_BLOCK = pa.schema(
    [
        ("block", pa.int64()), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())),
        ("words", pa.binary()), ("chunks", pa.list_(_CHUNK)),
    ]
)


class _Block:
    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.keys, self.counts, self.words, self.size = [], [], [], 0

    def add(self, key, words: list[bytes], size: int) -> None:
        number = self.number
        self.words.append(
            np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint32, len(words))
        )
        self.keys.append(key)
        self.counts.append(len(words))
        self.size += size

    def chunks(self, parts: int):
        """Each part's words, joined by line feeds, and their numbers."""
        chunks: dict[int, tuple[list, list]] = {}
        for word, number in self.number.items():
            terms, numbers = chunks.setdefault(zlib.crc32(word) % parts, ([], []))
            terms.append(word)
            numbers.append(number)
        for part, (terms, numbers) in sorted(chunks.items()):
            yield part, b"\n".join(terms), np.array(numbers, np.uint32)

    def row(self, block: int, parts: int) -> tuple:
        packed = [
            {"part": part, "terms": squeeze(terms), "numbers": pack(np.diff(numbers, prepend=np.uint32(0)))}
            for part, terms, numbers in self.chunks(parts)
        ]
        words = np.concatenate(self.words) if self.words else np.empty(0, np.uint32)
        return block, self.keys, self.counts, pack(words), packed


class _LateBlock(_Block):
    """A block whose texts are split and numbered all at once."""

    def __init__(self, split):
        super().__init__()
        self.split, self.texts, self.terms = split, [], None

    def add(self, key, text: bytes, size: int) -> None:
        self.texts.append(text)
        self.keys.append(key)
        self.size += size

    def chunks(self, parts: int):
        words = self.terms.to_pylist()
        part = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(parts)
        order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")  # of short numbers: by digits
        lines = pc.binary_join_element_wise(self.terms.take(pa.array(order)), b"", b"\n")
        starts, lines = np.frombuffer(lines.buffers()[1], np.int32), memoryview(lines.buffers()[2])
        edges = np.flatnonzero(np.diff(part[order].astype(np.int64), prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield int(part[order[a]]), bytes(lines[starts[a] : starts[b] - 1]), order[a:b].astype(np.uint32)

    def row(self, block: int, parts: int) -> tuple:
        words, counts = self.split(self.texts)
        numbered, self.texts = words.dictionary_encode(), []
        self.terms = numbered.dictionary
        self.words, self.counts = [numbered.indices.to_numpy().view(np.uint32)], counts.tolist()
        return super().row(block, parts)


def word_blocks(
    docs: DataFrame, key: str, text: str, split, parts: int, block_bytes: int = 16 << 20, at_once: bool = False
) -> DataFrame:
    """One row per block. ``split`` makes a list of words without line feeds from bytes.

    With ``at_once`` it is given a list of texts, and makes an Arrow array of all their words
    and an array of how many each text has. A NULL text has no bytes. Numbers of blocks are
    unique within the result, which has to be written before it is read twice.
    """

    def new_block():
        return _LateBlock(split) if at_once else _Block()

    def blocks(batches):
        first, block, made = TaskContext.get().partitionId() << 32, new_block(), 0
        for name, content in rows_of(batches):
            content = content or b""
            if block.size and block.size + len(content) > block_bytes:
                yield _arrow([block.row(first + made, parts)], _BLOCK)
                block, made = new_block(), made + 1
            block.add(name, content if at_once else split(content), len(content) + 64)
        if block.keys:
            yield _arrow([block.row(first + made, parts)], _BLOCK)

    rows = docs.select(F.col(key).cast("long"), F.col(text).cast("string").cast("binary"))
    return rows.mapInArrow(tidy(blocks), BLOCK_SCHEMA)


def bucketed(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` written in buckets by a column, so that joins by it don't shuffle it again.

    The name of the table is needed for writing only; the files are scratch data. A driver
    that is lost in between leaves the name in the catalog.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        df.write.format("parquet")
        .option("path", scratch_path(spark, name))
        .bucketBy(buckets, column)
        .saveAsTable(table)
    )
    written = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return written


class _Growing:
    """A table in buckets that rows are added to; see :func:`growing`."""

    def __init__(self, spark, column: str, name: str):
        self.spark, self.column, self.table = spark, column, f"{name}_{uuid.uuid4().hex}"
        self.path = scratch_path(spark, name)
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def add(self, df: DataFrame) -> DataFrame:
        """Add rows, dealt by the column; returns all rows so far, which joins by it don't shuffle."""
        writer = df.repartition(self.buckets, self.column).write.format("parquet").option("path", self.path)
        writer.bucketBy(self.buckets, self.column).mode("append").saveAsTable(self.table)
        return self.spark.table(self.table)


@contextmanager
def growing(spark, column: str, name: str):
    """Rows that are gathered step by step, in buckets by a column; only the files outlast this.

    Like in :func:`bucketed`, the table's name is needed for writing; a driver that is lost
    leaves it in the catalog, without its files once the scratch folder is removed.
    """
    table = _Growing(spark, column, name)
    try:
        yield table
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table.table}")


@contextmanager
def freed_shuffles(spark):
    """Meanwhile the files of a shuffle go as soon as the write or count that made them is done.

    Else they stay until the driver happens to collect garbage. For steps that run each DataFrame once.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def numbers_of(chunk: bytes) -> np.ndarray:
    """The word numbers of a chunk, in the order of its terms."""
    return np.cumsum(unpack(chunk, np.uint32), dtype=np.uint32)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of ranges, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
