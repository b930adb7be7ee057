"""Quality rules: base counts and a hashed n-gram log-likelihood ratio (operator 4).

Texts are bags of byte n-grams, hashed to ``CELLS`` cells. Two multinomials are
counted, one over trusted documents, one over all; a text's score is the mean over
its n-grams of the logarithm of their ratio. Documents below one threshold go; it
is the cut that errs least on labelled documents, a dropped trusted one counting
``DROP_COST`` times a kept bad or toxic one. For the cut a trusted document is scored
without its own n-grams among the trusted ones, as one without label is. Counts,
scores and verdicts cover all documents and whole texts; only cell counts and a
histogram, both of fixed size, reach the driver.

Defined results: a NULL or empty text has no words and fails the base rules; rows
are judged one by one, also repeated ones; without trusted documents all scores are
0 and the base rules decide alone; without bad ones the threshold keeps all trusted
ones; an empty table gives no rows; other columns are not looked at.
"""

import math
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.llm.blocks import rows_of, tidy
from incidentlens.sources.scratch import materialise

CELLS = 1 << 16
GRAM = 4
LEAST_WORDS, MOST_REPEATED = 50, 50  # of the base rules: words, per cent of words
DROP_COST = 10
BROADCAST_LABELS = 2_000_000
_BIN = 0.01
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_SPACES = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))


def cells_of(data: np.ndarray) -> np.ndarray:
    """The cell of the n-gram at each position of a text's bytes; a short text is one."""
    if not len(data):
        return np.empty(0, np.uint16)
    wide = data.astype(np.uint32)
    size = min(GRAM, len(data))
    value = np.zeros(len(data) - size + 1, np.uint32)
    for place in range(size):
        value |= wide[place : len(data) - size + 1 + place] << np.uint32(8 * place)
    value = (value ^ (value >> np.uint32(15))) * np.uint32(0x9E3779B1)
    return (value >> np.uint32(16)).astype(np.uint16)


def _counted(batches):
    """A task's counts by cell: of trusted documents, and of all."""
    counts = np.zeros((2, CELLS), np.int64)
    for text, is_trusted in rows_of(batches):
        found = np.bincount(cells_of(np.frombuffer(text or b"", np.uint8)), minlength=CELLS)
        counts[1] += found
        if is_trusted:
            counts[0] += found
    cells = np.flatnonzero(counts[1])
    yield pa.RecordBatch.from_arrays(
        [pa.array(cells, pa.int32()), pa.array(counts[0][cells]), pa.array(counts[1][cells])],
        names=["cell", "trusted", "raw"],
    )


def _marked(docs: DataFrame, trusted: DataFrame, key: str, text: str) -> DataFrame:
    """Key, bytes and whether the key is among those of ``trusted``, of every document."""
    marks = trusted.select(F.col(key).cast("long").alias("_key")).distinct().withColumn("is_trusted", F.lit(True))
    if marks.count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.join(marks, "_key", "left").select("_key", "text", F.coalesce("is_trusted", F.lit(False)).alias("is_trusted"))


def cell_counts(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """How often each cell is in trusted documents, and in all.

    ``trusted`` has the keys of trusted documents.
    """
    rows = (
        _marked(docs, trusted, key, text)
        .select("text", "is_trusted")
        .mapInArrow(tidy(_counted), "cell int, trusted long, raw long")
        .groupBy("cell")
        .agg(F.sum("trusted").alias("trusted"), F.sum("raw").alias("raw"))
        .collect()
    )  # CELLS rows at most
    counts = np.zeros((2, CELLS), np.int64)
    for row in rows:
        counts[:, row["cell"]] = row["trusted"], row["raw"]
    return counts


def weights(counts: np.ndarray) -> np.ndarray:
    """The logarithm of the ratio for each cell, add-one smoothed; zeros without trusted text."""
    if not counts[0].any():
        return np.zeros(CELLS)
    target, raw = counts + 1.0
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def unseen_score(cells: np.ndarray, trusted: np.ndarray, raw: np.ndarray) -> float:
    """The score of a trusted document from the other trusted ones; 0 if there are none.

    ``trusted`` are counts, ``raw`` the logarithms of the smoothed shares.
    """
    total = int(trusted.sum()) - len(cells)
    if not len(cells) or not total:
        return 0.0
    own, times = np.unique(cells, return_counts=True)
    ratio = np.log((trusted[own] - times + 1) / (total + CELLS)) - raw[own]
    return float((ratio * times).sum() / len(cells))


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated 3-word windows."""
    data = np.frombuffer(text, np.uint8)
    words = text.split()
    symbols = int(np.count_nonzero(_SYMBOLS[data]))
    chars = int(np.count_nonzero(((data & 0xC0) != 0x80) & ~_SPACES[data]))
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    repeated = 0
    if len(words) > 3:
        number: dict[bytes, int] = {}
        n = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        pairs = np.unique(n[:-1] * len(number) + n[1:], return_inverse=True)[1]
        _, place, times = np.unique(pairs[:-1] * len(number) + n[2:], return_inverse=True, return_counts=True)
        again = times[place] > 1
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[k : len(again) + k] |= again
        repeated = int(np.count_nonzero(covered))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


MEASURES = (
    "{key} long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "score double, unseen_score double"
)


def measures(
    docs: DataFrame, trusted: DataFrame, counts: np.ndarray, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Base counts and score of every document; the latter also as if it had no label."""
    schema = pa.schema(
        [(key, pa.int64())]
        + [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        + [("score", pa.float64()), ("unseen_score", pa.float64())]
    )
    packed = weights(counts).astype(np.float32).tobytes()
    shares = np.log((counts[1] + 1.0) / (counts[1].sum() + CELLS))

    def measure(batches):
        table, rows = np.frombuffer(packed, np.float32), []

        def batch():
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        for name, content, is_trusted in rows_of(batches):
            content = content or b""
            cells = cells_of(np.frombuffer(content, np.uint8))
            score = float(table[cells].mean(dtype=np.float64)) if len(cells) else 0.0
            unseen = unseen_score(cells, counts[0], shares) if is_trusted else score
            rows.append((name, *base_counts(content), score, unseen))
            if len(rows) == 5000:
                yield batch()
                rows.clear()
        if rows:
            yield batch()

    return _marked(docs, trusted, key, text).mapInArrow(tidy(measure), MEASURES.format(key=key))


def base_failed():
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def threshold(measured: DataFrame, labels: DataFrame, key: str = "doc_id", good: str = "good") -> float:
    """The cut that errs least on labelled documents, midway between the scores it parts.

    ``good`` is 1 for documents that are to stay, 0 for those that are to go.
    """
    scored = measured.where(~base_failed()).select(key, F.floor(F.col("unseen_score") / _BIN).cast("int").alias("bin"))
    rows = (
        scored.join(labels.select(key, F.col(good).cast("int").alias("good")), key)
        .groupBy("bin")
        .agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
        .orderBy("bin")
        .collect()
    )  # bounded: a ratio of smoothed counts has a bounded logarithm
    lost, caught = 0, 0
    best, cut = 0, -math.inf
    for row, following in zip_longest(rows, rows[1:]):
        lost, caught = lost + (row["good"] or 0), caught + (row["bad"] or 0)
        if following and caught - DROP_COST * lost > best:
            best, cut = caught - DROP_COST * lost, (row["bin"] + 1 + following["bin"]) / 2 * _BIN
    return cut


def judged(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Key, base counts, score and verdict of every document.

    ``labels`` has the key, ``quality`` (1 is good) and ``toxic`` (1 is toxic); good
    documents that aren't toxic are the trusted ones, bad and toxic ones are to go.
    """
    good = F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality"))
    labels = labels.select(key, good.alias("good")).where("good IN (0, 1)")
    trusted = labels.where("good = 1")
    counts = cell_counts(docs, trusted, key, text)
    measured = materialise(measures(docs, trusted, counts, key, text), "measures")
    cut = threshold(measured, labels, key)
    return measured.drop("unseen_score").withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= F.lit(cut))
    )
