"""Removal of repeated passages by a depth-limited radix sort of suffixes (operator 5).

A byte goes if a window of ``DEPTH`` bytes covers it that also starts in a document
with a smaller key. Suffixes are ordered by most-significant-digit passes and only
through ``DEPTH`` bytes; groups that are equal there are exactly the repeated
windows, and a suffix that is alone in its group after a pass drops out.

The first digit is chosen by content, so that neighbouring suffixes share it: the
``GRAM`` bytes with the least hash among those of the window, leftmost of equals.
Equal windows choose equal bytes at the same place, and about one position in
sixteen is chosen, which is all that the first pass has to look at:

1. Blocks of documents send the distinct digits of their windows, as sorted lists by
   bucket; those of one document only drop out.
2. Runs of windows with a surviving digit become units, each distinct one once per
   block. Within a digit's group equal units fall together; where more than one is
   left, their windows go through the remaining passes, eight bytes at a time, and
   every window gets the smallest key of its group.
3. Blocks mark their windows with a smaller key elsewhere and cut the bytes.

A digit of very many windows is not kept in one group: its windows are units of
their own, dealt by their bytes.

Defined results: a NULL text is empty; texts of fewer bytes than a window stay;
rows of equal keys don't remove from each other; a row without key counts as the
last one; an empty table gives no rows; other columns are not looked at.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.llm.blocks import (
    bucketed, pack, ranges, rows_of, squeeze, tidy, tidy_cogroup, tidy_group, unpack, unsqueeze,
)
from incidentlens.sources.scratch import materialise

DEPTH, GRAM = 50, 20
SPAN = DEPTH - GRAM + 1  # digits a window chooses from
HOT = 20_000  # windows' runs with one digit, beyond which they are units of their own
LAST = np.iinfo(np.int64).max  # stands for a missing key
_PIECE, _PLACE = 1 << 17, np.uint64((1 << 18) - 1)
_RUNS_AT_ONCE = 1 << 13  # whose windows are spelled out; a run has SPAN windows at most
_REST = 40  # bits of a digit's hash that are compared within a bucket: a filter only

_RANDOM = np.random.default_rng(50)
_BYTES = _RANDOM.integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_A, _B, _C, _D, _E = (int(x) * 2 + 1 for x in _RANDOM.integers(0, 2**62, 5, np.uint64))
_MIX = np.uint64(0x9E3779B97F4A7C15)  # 2 ** 64 over the golden ratio


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM = 16 + 4 bytes from every position on."""
    h1 = _BYTES[data]
    h2 = h1[:-1] * np.uint64(_A) + h1[1:]
    h4 = h2[:-2] * np.uint64(_B) + h2[2:]
    h8 = h4[:-4] * np.uint64(_C) + h4[4:]
    h16 = h8[:-8] * np.uint64(_D) + h8[8:]
    return _mixed(h16[:-4] * np.uint64(_E) + h4[16:])


def _chosen(data: np.ndarray):
    """For each window of the data, the position of its digit: (first window, positions) by piece."""
    count = len(data) - DEPTH + 1
    for start in range(0, count, _PIECE):
        h = _gram_hashes(data[start : start + _PIECE + DEPTH - 1])
        m = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        for width in (1, 2, 4, 8):
            m = np.minimum(m[:-width], m[width:])
        m = np.minimum(m[: -(SPAN - 16)], m[SPAN - 16 :])
        yield start, (m & _PLACE).astype(np.int64) + start


class _Runs:
    """Runs of windows with one digit: its position and hash, first window and number of windows.

    Found piece by piece, so that what is held grows with the runs and not with the bytes.
    """

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        ends = np.cumsum(lengths)
        self.starts, self.ends = ends - lengths, ends
        # Windows that would reach into the next document don't exist.
        last = ends - np.minimum(lengths, DEPTH - 1)
        firsts, places, lasts, end = [], [], [], len(data) - DEPTH + 1
        for start, chosen in _chosen(data):
            stop = start + len(chosen)
            here = slice(np.searchsorted(ends, start, side="right"), np.searchsorted(last, stop))
            left, right = np.maximum(last[here], start) - start, np.minimum(ends[here], stop) - start
            valid = np.ones(len(chosen), bool)
            valid[ranges(left, right - left)] = False
            new = np.empty(len(chosen), bool)
            new[0] = not (places and valid[0] and lasts[-1] == start - 1 and places[-1][-1] == chosen[0])
            new[1:] = (chosen[1:] != chosen[:-1]) | ~valid[:-1]
            new &= valid
            begin = np.flatnonzero(new)
            if len(begin):
                firsts.append(begin + start)
                places.append(chosen[begin])
            seen = np.flatnonzero(valid)
            lasts.append(int(seen[-1]) + start if len(seen) else -1)
        self.first = np.concatenate(firsts) if firsts else np.empty(0, np.int64)
        self.place = np.concatenate(places) if places else np.empty(0, np.int64)
        self.doc = np.searchsorted(ends, self.first, side="right")
        # A run ends where the next one begins, or with its document's windows.
        following = np.append(self.first[1:], end)[: len(self.first)]
        self.size = np.minimum(following, last[self.doc]) - self.first
        h = np.zeros(len(self.first), np.uint64)
        for k in range(GRAM):
            h = h * np.uint64(_A) + _BYTES[data[self.place + k]]
        self.hash = _mixed(_mixed(h))


def _lists(runs: _Runs, keys: np.ndarray, buckets: int):
    """The distinct digits by bucket, in order; and each run's place in that order."""
    bucket = runs.hash % np.uint64(buckets)
    rest = (runs.hash // np.uint64(buckets)) & np.uint64((1 << _REST) - 1)
    digits, places, counts = np.unique(
        (bucket << np.uint64(_REST)) | rest, return_inverse=True, return_counts=True
    )
    if not len(digits):
        return digits, places, counts, np.zeros(0, bool)
    order = np.argsort(places, kind="stable")
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
    docs = keys[runs.doc][order]
    several = np.minimum.reduceat(docs, begin) != np.maximum.reduceat(docs, begin)
    return digits, places, counts, several


def _block_of(row: dict) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
    body = unsqueeze(row["body"])
    keys = np.array([LAST if k is None else k for k in row["keys"]], np.int64)
    return np.frombuffer(body, np.uint8), body, keys, np.array(row["lengths"], np.int64)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


BLOCKS = "block long, size long, keys array<long>, lengths array<long>, more array<string>, body binary"
_BLOCKS = pa.schema(
    [
        ("block", pa.int64()), ("size", pa.int64()), ("keys", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())), ("more", pa.list_(pa.string())), ("body", pa.binary()),
    ]
)


def _blocked(block_bytes: int):
    def blocks(batches):
        first, made, size = TaskContext.get().partitionId() << 32, 0, 0
        keys, texts, more = [], [], []

        def block():
            row = (first + made, size, keys, list(map(len, texts)), more, squeeze(b"".join(texts)))
            return _batch([row], _BLOCKS)

        for key, text, other in rows_of(batches):
            text = text or b""
            if keys and size + len(text) > block_bytes:
                yield block()
                made, size = made + 1, 0
                keys, texts, more = [], [], []
            keys.append(key)
            texts.append(text)
            more.append(other)
            size += len(text) + 64
        if keys:
            yield block()

    return blocks


DIGITS = "bucket long, block long, digits binary, counts binary"
_DIGITS = pa.schema(
    [("bucket", pa.int64()), ("block", pa.int64()), ("digits", pa.binary()), ("counts", pa.binary())]
)


def _by_bucket(sorted_buckets: np.ndarray):
    """(bucket, slice) of a sorted array."""
    edges = np.flatnonzero(np.diff(sorted_buckets, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(sorted_buckets[a]), slice(a, b)


def _digits(buckets: int):
    """First pass: the digits of each block."""

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data, _, keys, lengths = _block_of(row)
                digits, _, counts, several = _lists(_Runs(data, lengths), keys, buckets)
                rest = digits & np.uint64((1 << _REST) - 1)
                told = np.minimum(counts, 0x7FFF).astype(np.uint16) | (several.astype(np.uint16) << np.uint16(15))
                rows = [
                    (bucket, row["block"], pack(np.diff(rest[part], prepend=np.uint64(0))), pack(told[part]))
                    for bucket, part in _by_bucket((digits >> np.uint64(_REST)).astype(np.int64))
                ]
                yield _batch(rows, _DIGITS)

    return send


ANSWERS = "block long, kind int, bucket long, answer binary"
_ANSWERS = pa.schema(
    [("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("answer", pa.binary())]
)
_FLAGS, _LEAST = 0, 1


def _surviving(table: pa.Table) -> pa.Table:
    """Of a bucket's digits, 1 for those of several documents, 2 for very frequent ones."""
    rows = table.to_pylist()
    lists = [np.cumsum(unpack(r["digits"], np.uint64), dtype=np.uint64) for r in rows]
    told = np.concatenate([unpack(r["counts"], np.uint16) for r in rows])
    _, places = np.unique(np.concatenate(lists), return_inverse=True)
    runs = np.bincount(places, told & np.uint16(0x7FFF))
    several = (np.bincount(places) > 1) | (np.bincount(places, told >> np.uint16(15)) > 0)
    flags = (several.astype(np.uint8) + (several & (runs > HOT)).astype(np.uint8))[places]
    ends = np.cumsum([len(x) for x in lists])
    out = [
        (r["block"], _FLAGS, r["bucket"], pack(flags[end - len(x) : end]))
        for r, x, end in zip(rows, lists, ends, strict=True)
    ]
    return pa.Table.from_batches([_batch(out, _ANSWERS)])


class _Units:
    """The units of a block's surviving runs, in an order that each stage finds again."""

    def __init__(self, row: dict, flags: dict[int, bytes], buckets: int):
        data, self.body, self.keys, self.lengths = _block_of(row)
        self.data = data
        runs = _Runs(data, self.lengths)
        _, places, _, _ = _lists(runs, self.keys, buckets)
        listed = [unpack(flags[b], np.uint8) for b in sorted(flags)]
        flag = (np.concatenate(listed) if listed else np.empty(0, np.uint8))[places]
        normal, hot = np.flatnonzero(flag == 1), np.flatnonzero(flag == 2)
        windows = ranges(runs.first[hot], runs.size[hot])
        # Occurrences: first window, number of windows, document.
        self.first = np.concatenate([runs.first[normal], windows])
        self.size = np.concatenate([runs.size[normal], np.ones(len(windows), np.int64)])
        self.doc = np.concatenate([runs.doc[normal], np.repeat(runs.doc[hot], runs.size[hot])])
        offset = np.concatenate([runs.place[normal] - runs.first[normal], np.zeros(len(windows), np.int64)])
        dealt = (runs.hash % np.uint64(buckets)).astype(np.int64)[normal]
        body, number = self.body, {}
        unit = np.fromiter(
            (
                number.setdefault(body[a:b], len(number))
                for a, b in zip(self.first.tolist(), (self.first + self.size + DEPTH - 1).tolist(), strict=True)
            ),
            np.int64,
            len(self.first),
        )
        _, example = np.unique(unit, return_index=True)
        crc = np.fromiter(
            (zlib.crc32(body[a : a + DEPTH]) % buckets for a in self.first[example[example >= len(normal)]].tolist()),
            np.int64,
        )
        unit_bucket = np.empty(len(example), np.int64)
        is_hot = example >= len(normal)
        unit_bucket[~is_hot] = dealt[example[~is_hot]]
        unit_bucket[is_hot] = crc
        order = np.argsort(unit_bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.unit = rank[unit]
        example = example[order]
        self.bucket, self.offset = unit_bucket[order], offset[example]
        self.unit_first, self.unit_size = self.first[example], self.size[example]
        self.least = np.full(len(order), LAST)
        by_unit = np.argsort(self.unit, kind="stable")
        if len(by_unit):
            begin = np.flatnonzero(np.diff(self.unit[by_unit], prepend=-1))
            self.least = np.minimum.reduceat(self.keys[self.doc][by_unit], begin)


UNITS = "bucket long, block long, body binary, sizes binary, offsets binary, least binary"
_UNITS = pa.schema(
    [
        ("bucket", pa.int64()), ("block", pa.int64()), ("body", pa.binary()),
        ("sizes", pa.binary()), ("offsets", pa.binary()), ("least", pa.binary()),
    ]
)


def _flags_of(answers: list[dict]) -> dict[int, bytes]:
    return {a["bucket"]: a["answer"] for a in answers if a["kind"] == _FLAGS}


def _units(buckets: int):
    """Second pass: the units of each block, with their smallest key in it."""

    def send(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        flags, rows = _flags_of(answers.to_pylist()), []
        for row in blocks.to_pylist():
            units = _Units(row, flags, buckets)
            spans = units.unit_size + DEPTH - 1
            for bucket, part in _by_bucket(units.bucket):
                text = units.data[ranges(units.unit_first[part], spans[part])].tobytes()
                rows.append(
                    (
                        bucket, row["block"], squeeze(text), pack(units.unit_size[part].astype(np.uint16)),
                        pack(units.offset[part].astype(np.uint8)), pack(units.least[part]),
                    )
                )
        return pa.Table.from_batches([_batch(rows, _UNITS)])

    return send


def _smallest_keys(data: np.ndarray, windows: np.ndarray, group: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each window the smallest key among the equal ones of its group.

    One pass for every eight bytes; what is alone after a pass is done.
    """
    out, active = keys.copy(), np.arange(len(windows))
    for depth in range(0, DEPTH, 8):
        digit = np.zeros(len(active), np.uint64)
        for k in range(depth, min(depth + 8, DEPTH)):
            digit = (digit << np.uint64(8)) | data[windows[active] + k]
        order = np.lexsort((digit, group))
        digit, group, active = digit[order], group[order], active[order]
        new = np.ones(len(active), bool)
        new[1:] = (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(new)
        together = np.bincount(group)[group] > 1
        group, active = group[together], active[together]
        if not len(active):
            return out
    begin = np.flatnonzero(np.diff(group, prepend=-1))
    least = np.minimum.reduceat(keys[active], begin)
    out[active] = np.repeat(least, np.diff(np.append(begin, len(active))))
    return out


def _refined(table: pa.Table) -> pa.Table:
    """Of a bucket's units, the smallest key that has each of their windows."""
    rows = table.to_pylist()
    sizes = [unpack(r["sizes"], np.uint16).astype(np.int64) for r in rows]
    size, least = np.concatenate(sizes), np.concatenate([unpack(r["least"], np.int64) for r in rows])
    offset = np.concatenate([unpack(r["offsets"], np.uint8) for r in rows]).astype(np.int64)
    body = b"".join(unsqueeze(r["body"]) for r in rows)
    data = np.frombuffer(body, np.uint8)
    ends = np.cumsum(size + DEPTH - 1)
    starts = ends - (size + DEPTH - 1)
    number: dict[bytes, int] = {}
    same = np.fromiter(
        (number.setdefault(body[a:b], len(number)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)),
        np.int64,
        len(size),
    )
    order = np.argsort(same, kind="stable")
    begin = np.flatnonzero(np.diff(same[order], prepend=-1))
    example, least = order[begin], np.minimum.reduceat(least[order], begin)
    hashes = np.zeros(len(example), np.uint64)
    for k in range(GRAM):
        hashes = hashes * np.uint64(_A) + _BYTES[data[starts[example] + offset[example] + k]]
    _, group, times = np.unique(hashes, return_inverse=True, return_counts=True)
    counts = size[example]
    bounds = np.concatenate([[0], np.cumsum(counts)])
    keys = np.repeat(least, counts)
    mixed = np.flatnonzero(times[group] > 1)
    if len(mixed):
        places = ranges(bounds[mixed], counts[mixed])
        windows = ranges(starts[example][mixed], counts[mixed])
        keys[places] = _smallest_keys(data, windows, np.repeat(group[mixed], counts[mixed]), keys[places])
    out, done = [], 0
    for row, own in zip(rows, sizes, strict=True):
        mine = same[done : done + len(own)]
        done += len(own)
        found = keys[ranges(bounds[mine], counts[mine])]
        out.append((row["block"], _LEAST, row["bucket"], pack(np.diff(found, prepend=np.int64(0)))))
    return pa.Table.from_batches([_batch(out, _ANSWERS)])


def _whole_characters(body: bytes, gone: np.ndarray) -> str:
    """The text of the runs of bytes that stay, without characters that were cut."""
    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=1, append=1)).tolist()
    return "".join(body[a:b].decode("utf-8", "ignore") for a, b in zip(edges[::2], edges[1::2], strict=True))


def _covered(starts: np.ndarray) -> np.ndarray:
    """The bytes of all windows, from marks at their starts."""
    covered, width = starts.copy(), 1
    while width < DEPTH:
        step = min(width, DEPTH - width)
        covered[step:] |= covered[:-step]
        width += step
    return covered


def _cut(buckets: int, key: str, as_text: bool):
    """Third pass: the bytes that stay of each document."""
    schema = pa.schema(
        [
            (key, pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
            ("kept", pa.string() if as_text else pa.binary()), ("more", pa.string()),
        ]
    )

    def cut(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        told, out = answers.to_pylist(), []
        flags = _flags_of(told)
        for row in blocks.to_pylist():
            units = _Units(row, flags, buckets)
            found = {a["bucket"]: a["answer"] for a in told if a["kind"] == _LEAST}
            parts = [np.cumsum(unpack(found[b], np.int64)) for b in sorted(found)]
            least = np.concatenate(parts) if parts else np.empty(0, np.int64)
            bounds = np.concatenate([[0], np.cumsum(units.unit_size)])
            goes = np.zeros(len(units.data), bool)
            for a in range(0, len(units.first), _RUNS_AT_ONCE):
                runs = slice(a, a + _RUNS_AT_ONCE)
                size = units.size[runs]
                smallest = least[ranges(bounds[units.unit[runs]], size)]
                windows = ranges(units.first[runs], size)
                goes[windows[smallest < np.repeat(units.keys[units.doc[runs]], size)]] = True
            covered = _covered(goes)
            ends = np.cumsum(units.lengths).tolist()
            for name, length, more, end in zip(row["keys"], row["lengths"], row["more"], ends, strict=True):
                gone, body = covered[end - length : end], units.body[end - length : end]
                removed = int(np.count_nonzero(gone))
                spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)) if removed else 0
                if as_text:
                    kept = _whole_characters(body, gone) if removed else body.decode()
                else:
                    kept = units.data[end - length : end][~gone].tobytes() if removed else body
                out.append((name, length, removed, spans, kept, more))
        return pa.Table.from_batches([_batch(out, schema)])

    return cut


def without_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carried: list[str] | None = None,
    as_text: bool = False,
    block_bytes: int = 8 << 20,
    bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """Key, bytes, removed bytes, removed spans and the bytes that stay of every document.

    With ``as_text`` these are text, without characters of which a byte goes. The
    columns ``carried``, of types that JSON keeps, come along in a struct ``more``.
    A task holds a block or a bucket; buckets get about ``bucket_bytes`` of text each,
    and there are four for each shuffle partition at least.
    """
    spark = docs.sparkSession
    more = F.to_json(F.struct(*carried)) if carried else F.lit(None).cast("string")
    rows = docs.select(F.col(key).cast("long"), F.col(text).cast("string").cast("binary"), more)
    blocks = bucketed(rows.mapInArrow(tidy(_blocked(block_bytes)), BLOCKS), "block", "blocks")
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // bucket_bytes)
    digits = blocks.drop("more").mapInArrow(tidy(_digits(buckets)), DIGITS)
    flags = materialise(digits.groupBy("bucket").applyInArrow(tidy_group(_surviving), ANSWERS), "flags")
    to_units = blocks.drop("more").groupBy("block").cogroup(flags.groupBy("block"))
    units = to_units.applyInArrow(tidy_cogroup(_units(buckets)), UNITS)
    least = units.groupBy("bucket").applyInArrow(tidy_group(_refined), ANSWERS)
    kind = "string" if as_text else "binary"
    result = f"{key} long, n_bytes long, n_removed long, n_spans long, kept {kind}, more string"
    answers = flags.unionByName(least).groupBy("block")
    cut = blocks.groupBy("block").cogroup(answers).applyInArrow(tidy_cogroup(_cut(buckets, key, as_text)), result)
    if not carried:
        return cut.drop("more")
    return cut.withColumn("more", F.from_json("more", docs.select(*carried).schema))
