"""MinHash near-duplicate detection (operator 6).

Documents are sets of five-word shingles; those with 75 % of their union in common
are linked, and groups are the connected components.

1. Every set gets ``BANDS * ROWS`` universal hash minima. Equal sets are one class,
   whose smallest document stands for it from here on.
2. Classes that agree in a band share a bucket. A pair at the threshold meets in no
   bucket with a chance of 3e-7 (``(1 - 0.75 ** ROWS) ** BANDS``). Buckets with the
   same members count once.
3. Links are confirmed on full sets: first each class with the hub of its buckets,
   the class that meets others most often. Then buckets with several parts are gone
   through in pairs of chunks of bounded size: a task compares the classes of two
   chunks that are not connected yet, on full sets, and returns a forest of the links,
   at most one row per class. No pair is returned only to be looked up, and no link
   between different parts is lost. Signatures rule a pair out only far below the
   threshold.
4. Components are found after each of these steps, by large-star and small-star.

Defined results: a NULL, empty or blank text has an empty set and no links; fewer
than five words are one shingle; every row gives one row; texts of one key that are
the smallest key's of their class are one group; a row without key joins the group of
its equals or none; an empty table gives no rows; other columns
are not looked at.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.llm.blocks import give_back, pack, ranges, rows_of, tidy, unpack
from incidentlens.llm.components import components
from incidentlens.sources.scratch import materialise, remove

WORDS, PERCENT = 5, 75
BANDS, ROWS = 40, 4
HASHES = BANDS * ROWS
# Share of equal minima below which a pair can't be at the threshold: 5.5 standard deviations.
LEAST_EQUAL = PERCENT / 100 - 5.5 * (PERCENT / 100 * (1 - PERCENT / 100) / HASHES) ** 0.5
BLOCK, BLOCK_SHINGLES = 2_048, 1_000_000  # classes of a bucket, and shingles, that are compared at once
BROADCAST_KEYS = 1_000_000
WORDS_KEPT = 100_000  # whose hashes a task keeps; some 13 MB

_RANDOM = np.random.default_rng(20240229)
_MULTIPLIERS = _RANDOM.integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 2**63, HASHES, np.uint64)
_PLACES = _RANDOM.integers(0, 2**63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)  # 2 ** 64 over the golden ratio


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


class _WordHashes(dict):
    """64-bit hashes of words; forgets them all when there are many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        found = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return found


def shingles(text: bytes | None, hashes: _WordHashes) -> np.ndarray:
    """The set of a text's shingles, as sorted 64-bit hashes."""
    words = (text or b"").lower().split()  # bytes: both know ASCII only
    if not words:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for place in range(size):
        total += values[place : len(values) - size + 1 + place] * _PLACES[place]
    return np.unique(_mixed(total))


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minima for each set, none of them empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((HASHES, len(sets)), np.uint64)
    for k in range(HASHES):
        out[k] = np.minimum.reduceat(flat * _MULTIPLIERS[k] + _OFFSETS[k], starts)
    return out.T


def _digest(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def _band_keys(minima: np.ndarray) -> np.ndarray:
    keys = np.empty((len(minima), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(minima), band, np.uint64)
        for row in range(band * ROWS, (band + 1) * ROWS):
            key = _mixed(key + minima[:, row])
        keys[:, band] = key
    return keys.view(np.int64)


SIGNED = "doc long, n_shingles long, digest binary, bands array<long>, signature binary"
_SIGNED = pa.schema(
    [
        ("doc", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
        ("bands", pa.list_(pa.int64())), ("signature", pa.binary()),
    ]
)


def _signed(batches):
    """Size, digest, band keys and signature (a byte per minimum) of each set."""
    hashes = _WordHashes()

    def batch(docs: list, sets: list[np.ndarray]):
        full = [s for s in sets if len(s)]
        minima = _minima(full) if full else np.empty((0, HASHES), np.uint64)
        keys = iter(_band_keys(minima))
        signs = iter((minima >> np.uint64(16)).astype(np.uint8))
        columns = (
            docs,
            [len(s) for s in sets],
            [_digest(s) for s in sets],
            [next(keys) if len(s) else None for s in sets],
            [next(signs).tobytes() if len(s) else None for s in sets],
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _SIGNED, strict=True)], schema=_SIGNED
        )

    docs, sets, size = [], [], 0
    for doc, text in rows_of(batches):
        docs.append(doc)
        sets.append(shingles(text, hashes))
        size += len(sets[-1])
        if size > 50_000 or len(docs) >= 5_000:
            yield batch(docs, sets)
            docs, sets, size = [], [], 0
    if docs:
        yield batch(docs, sets)


def _packed_sets(batches):
    hashes = _WordHashes()

    def batch(rows):
        columns = zip(*rows, strict=True)
        types = (pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc", "digest", "members"]
        )

    rows = []
    for doc, text in rows_of(batches):
        found = shingles(text, hashes)
        rows.append((doc, _digest(found), pack(np.diff(found, prepend=np.uint64(0)))))
        if len(rows) == 500:
            yield batch(rows)
            rows = []
    if rows:
        yield batch(rows)


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def _is_linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _confirmed_in_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of a hub's chunk of partners, those that are linked with it."""
    rows = list(zip(pdf["hub"], pdf["doc"], pdf["members"], strict=True))
    own = next((_unpacked(m) for hub, doc, m in rows if hub == doc), None)
    linked = [doc for hub, doc, m in rows if hub != doc and own is not None and _is_linked(own, _unpacked(m))]
    return pd.DataFrame({"a": pd.Series([rows[0][0]] * len(linked), dtype="int64"), "b": pd.Series(linked, dtype="int64")})


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked on full sets.

    Partners of one ``a`` come in chunks of about 64, each with one copy of its set.
    """
    chunks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 64).alias("chunks"))
    keyed = pairs.join(chunks, "a").select(
        F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), "chunks").alias("chunk"), F.col("b").alias("doc")
    )
    hubs = keyed.select("hub", "chunk").distinct().withColumn("doc", F.col("hub"))
    rows = keyed.unionByName(hubs).join(sets, "doc").select("hub", "chunk", "doc", "members")
    return rows.groupBy("hub", "chunk").applyInPandas(_confirmed_in_chunk, "a long, b long")


def _links_in_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) between parts of a block, confirmed on full sets; a forest of them.

    Signatures and sizes choose whom a class is compared with; what the links found
    so far connect isn't compared again. At most one row for each class.
    """
    pdf = pdf.drop_duplicates("digest").sort_values("doc", ignore_index=True)
    signs = np.frombuffer(b"".join(pdf["signature"]), np.uint8).reshape(-1, HASHES)
    docs, sizes, home = pdf["doc"].to_numpy(), pdf["n_shingles"].to_numpy(), pdf["chunk"].to_numpy()
    label = pdf["part"].to_numpy().copy()
    two_chunks = pdf["low"].iloc[0] != pdf["high"].iloc[0]
    _, members = np.unique(np.concatenate([_unpacked(m) for m in pdf["members"]]), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    is_own = np.zeros(len(members), bool)
    found = []
    for i in range(len(pdf) - 1):
        rest = slice(i + 1, None)
        ok = label[rest] != label[i]
        ok &= 100 * np.minimum(sizes[rest], sizes[i]) >= PERCENT * np.maximum(sizes[rest], sizes[i])
        if two_chunks:
            ok &= home[rest] != home[i]
        others = i + 1 + np.flatnonzero(ok)
        equal = np.count_nonzero(signs[others] == signs[i], axis=1)
        others = others[equal >= LEAST_EQUAL * HASHES]
        if not len(others):
            continue
        own = members[starts[i] : starts[i] + sizes[i]]
        is_own[own] = True
        hits = is_own[members[ranges(starts[others], sizes[others])]]
        is_own[own] = False
        common = np.add.reduceat(hits, np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
        others = others[100 * common >= PERCENT * (sizes[others] + sizes[i] - common)]
        parts, first = np.unique(label[others], return_index=True)
        found += [(docs[i], docs[j]) for j in others[first]]
        label[np.isin(label, parts)] = label[i]
    columns = zip(*found, strict=True) if found else ((), ())
    return pd.DataFrame({name: pd.Series(c, dtype="int64") for name, c in zip("ab", columns, strict=True)})


def _links(pdf: pd.DataFrame) -> pd.DataFrame:
    """:func:`_links_in_block`; most blocks are small, only large ones leave much behind."""
    found = _links_in_block(pdf)
    if pdf["n_shingles"].sum() >= BLOCK_SHINGLES // 10:
        give_back()
    return found


def _blocks(members: DataFrame, classes: DataFrame, sets: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of buckets with several parts and their sets, in pairs of chunks.

    A chunk has about BLOCK classes, or BLOCK_SHINGLES shingles if that is less.
    """
    rows = members.join(parts.select(F.col("node").alias("doc"), "root"), "doc", "left").select(
        "bucket", "doc", "digest", "n_shingles", F.coalesce("root", "doc").alias("part")
    )
    mixed = rows.groupBy("bucket").agg(
        F.min("part").alias("least"),
        F.max("part").alias("most"),
        F.ceil(
            F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
        ).alias("chunks"),
    )
    rows = rows.join(mixed.where("least <> most").select("bucket", "chunks"), "bucket")
    chunk = F.pmod(F.xxhash64("doc"), "chunks")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    rows = rows.withColumn("chunk", chunk).withColumn("other", other)
    keys = ["doc", "digest"]
    return rows.join(classes.select(*keys, "signature"), keys).join(sets, keys).select(
        "bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        "chunk", "doc", "digest", "part", "n_shingles", "signature", "members",
    )


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size of the set and component (its smallest key) of every document."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").cast("binary").alias("text"))
    signed = materialise(rows.mapInArrow(tidy(_signed), SIGNED), "signed")
    full = signed.where("digest IS NOT NULL AND doc IS NOT NULL")
    least = F.min(F.struct("doc", "n_shingles", "bands", "signature")).alias("least")
    classes = materialise(full.groupBy("digest").agg(least).select("digest", "least.*"), "classes")

    spread = classes.select("doc", "digest", "n_shingles", F.explode("bands").alias("bucket"))
    hashed = F.xxhash64("digest")
    shared = (
        spread.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("size"), F.sum(hashed.cast("decimal(30,0)")).alias("s"), F.bit_xor(hashed).alias("x"))
        .where("size > 1")
        .groupBy("size", "s", "x")
        .agg(F.min("bucket").alias("bucket"), F.count(F.lit(1)).alias("times"))
    )
    members = materialise(spread.join(shared.select("bucket", "size", "times"), "bucket"), "members")

    wanted = members.select("doc").distinct()
    texts = rows.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted, "doc", "left_semi")
    sets = materialise(texts.mapInArrow(tidy(_packed_sets), "doc long, digest binary, members binary"), "sets")

    meets = members.groupBy("doc").agg(F.sum((F.col("size") - 1) * F.col("times")).alias("meets"))
    rank = F.struct("meets", (-F.col("doc")).alias("least"))
    weighed = members.join(meets, "doc").select("bucket", "doc", rank.alias("rank"))
    hubs = weighed.groupBy("bucket").agg(F.max("rank").alias("hub"))
    stars = (
        weighed.join(hubs, "bucket")
        .groupBy("doc")
        .agg(F.max("hub").alias("hub"))
        .select((-F.col("hub.least")).alias("a"), F.col("doc").alias("b"))
        .where("a <> b")
    )

    parts, path = components(_confirmed(stars, sets))
    links = (
        _blocks(members, classes, sets, parts)
        .groupBy("bucket", "low", "high")
        .applyInPandas(_links, "a long, b long")
        .unionByName(parts.select(F.col("root").alias("a"), F.col("node").alias("b")))
    )
    parts, _ = components(links)
    remove(spark, path)

    out = signed.select("doc", "n_shingles", "digest").join(
        classes.select("digest", F.col("doc").alias("first")), "digest", "left"
    )
    out = out.join(parts.select(F.col("node").alias("first"), "root"), "first", "left")
    return out.select(
        F.col("doc").alias(key), "n_shingles", F.coalesce("root", "first", "doc").alias("component_id")
    )


def kept_first(grouped: DataFrame, key: str = "doc_id") -> DataFrame:
    """Marks the document that stays of each group: the one with the smallest key."""
    return grouped.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
