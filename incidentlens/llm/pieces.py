"""SentencePiece encoding and decoding through a table of distinct chunks (operator 11).

In a vocabulary whose pieces have white space markers at their start only, nothing is
merged across the place before a run of markers. A text is therefore cut there: every
chunk is a run of markers with the characters up to the next one, and a text's ids are
its chunks' ids in order. Blocks of documents keep chunk numbers; the distinct chunks of
a block go, by hash, to the task that encodes and decodes each distinct chunk once, and
the ids come back to the block. The decoded chunk comes back only where it differs from
the chunk itself.

A chunk is kept without its first marker, which the library puts in front of every
text: ``encode`` of the rest gives the chunk's ids, and decoded chunks are joined by one
space. Line feeds, which separate terms in a block, are the byte FF there, which no
UTF-8 text has.

Defined results: a NULL or empty text has no ids and decodes to the empty text; white
space counts in full, also at the ends; every input row gives one row, also repeated
ones and those without a key (their key is NULL); an empty table gives none; other
columns are not looked at.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.llm.blocks import (
    bucketed,
    numbers_of,
    pack,
    ranges,
    rows_of,
    unpack,
    unsqueeze,
    word_blocks,
)

VOCABULARY = "piece_bpe_32k.model"
SCHEMA = "{key} long, n_tokens long, ids array<int>, decoded string"
MARKER = "▁"
#: A task forgets the chunks it has met beyond so many, and may then encode one again.
KNOWN_CHUNKS = 1_000_000
_ENCODED_SCHEMA = "block long, part int, lengths binary, ids binary, changed array<struct<at:int, text:string>>"
_CHANGED = pa.list_(pa.struct([("at", pa.int32()), ("text", pa.string())]))
_ENCODED = pa.schema(
    [("block", pa.int64()), ("part", pa.int32()), ("lengths", pa.binary()), ("ids", pa.binary()), ("changed", _CHANGED)]
)
_RUNS = re.compile(rb" +[^ ]+| +$")


def chunks_of(text: bytes) -> list[bytes]:
    """The chunks of a text in UTF-8, each without its first marker; line feeds are FF."""
    text = text.replace(b"\n", b"\xff").replace(MARKER.encode(), b" ")
    if not text:
        return []
    found = text.split(b" ")
    return found if b"" not in found else [run[1:] for run in _RUNS.findall(b" " + text)]


def _processor(path: str):
    """The library's processor, if its model keeps pieces from crossing markers."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    for number in range(processor.get_piece_size()):
        if MARKER in processor.id_to_piece(number).lstrip(MARKER):
            raise ValueError("the vocabulary has a piece with a marker behind another character")
    if processor.encode("a  b") != processor.encode("a") + processor.encode(" b"):
        raise ValueError("the model must keep white space and put a marker before a text")
    return processor


def _encoded(path: str):
    """Chunks of a block and part to their ids, in the order of the block's terms."""

    def encode(batches):
        processor, known, part = _processor(path), {}, None
        alone = processor.piece_to_id(MARKER)
        for block, here, terms in rows_of(batches, 16):
            if here != part or len(known) > KNOWN_CHUNKS:
                known, part = {}, here
            chunks = unsqueeze(terms).split(b"\n")
            new = [chunk for chunk in chunks if chunk not in known]
            for start in range(0, len(new), 10_000):
                some = new[start : start + 10_000]
                texts = [chunk.replace(b"\xff", b"\n").decode() for chunk in some]
                ids = [found or [alone] for found in processor.encode(texts, num_threads=1)]
                decoded = processor.decode(ids, num_threads=1)
                for chunk, text, found, back in zip(some, texts, ids, decoded, strict=True):
                    known[chunk] = np.array(found, np.int32).tobytes(), None if back == text else back
            found = [known[chunk] for chunk in chunks]
            ids = [entry[0] for entry in found]
            lengths = np.fromiter(map(len, ids), np.uint32, len(ids)) // 4
            changed = [{"at": i, "text": entry[1]} for i, entry in enumerate(found) if entry[1] is not None]
            row = (block, here, pack(lengths), pack(np.frombuffer(b"".join(ids), np.int32)), changed)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, _ENCODED, strict=True)], schema=_ENCODED
            )

    return encode


def _joined(key: str):
    """A block's documents and its chunks' ids to ids and decoded texts, by position."""
    schema = pa.schema(
        [(key, pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    )

    def some_documents(keys, ends, chunks, starts, lengths, flat, decoded) -> pa.Table:
        sizes = lengths[chunks]
        before = np.concatenate([[0], np.cumsum(sizes)])
        bounds = before[ends]
        ids = flat[ranges(starts[chunks], sizes)]
        texts = [
            b" ".join([decoded[i] for i in chunks[a:b].tolist()]).replace(b"\xff", b"\n").decode()
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
        ]
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
        columns = [pa.array(keys, pa.int64()), pa.array(np.diff(bounds), pa.int64()), lists, pa.array(texts, pa.string())]
        return pa.Table.from_arrays(columns, schema=schema)

    def join(blocks: pa.Table, encoded: pa.Table):
        out = []
        answers = {
            row["part"]: (unpack(row["lengths"], np.uint32), unpack(row["ids"], np.int32), row["changed"])
            for row in encoded.drop_columns(["block"]).to_pylist()
        }
        for row in blocks.to_pylist():
            count = sum(len(lengths) for lengths, _, _ in answers.values())
            starts, lengths = np.zeros(count, np.int64), np.zeros(count, np.int64)
            decoded, flat, offset = [b""] * count, [], 0
            for chunk in row["chunks"]:
                numbers, terms = numbers_of(chunk["numbers"]), unsqueeze(chunk["terms"]).split(b"\n")
                sizes, ids, changed = answers[chunk["part"]]
                for entry in changed:
                    terms[entry["at"]] = entry["text"].encode().replace(b"\n", b"\xff")
                for number, term in zip(numbers.tolist(), terms, strict=True):
                    decoded[number] = term
                ends = np.cumsum(sizes, dtype=np.int64)
                starts[numbers], lengths[numbers] = offset + ends - sizes, sizes
                flat.append(ids)
                offset += len(ids)
            flat = np.concatenate(flat) if flat else np.empty(0, np.int32)
            words = unpack(row["words"], np.uint32)
            ends = np.cumsum([0, *row["counts"]])
            for a in range(0, len(row["counts"]), 512):
                b = min(a + 512, len(row["counts"]))
                here = ends[a : b + 1] - ends[a]
                some = words[ends[a] : ends[b]]
                out.append(some_documents(row["keys"][a:b], here, some, starts, lengths, flat, decoded))
        return pa.concat_tables(out) if out else schema.empty_table()

    return join


def encode_decode(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    parts: int | None = None,
    block_bytes: int = 32 << 20,
) -> DataFrame:
    """Per document its ids and the text they decode to, without begin or end ids.

    ``vocabulary`` is the path of a model on every executor. A task holds one block, or
    the distinct chunks of one of the ``parts`` they are dealt to by hash (four for each
    shuffle partition by default); a chunk comes from a block once, however often it
    occurs there.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or 4 * partitions
    blocks = bucketed(word_blocks(docs, key, text, chunks_of, parts, block_bytes), "block", "piece_blocks")
    encoded = (
        blocks.select("block", F.explode("chunks").alias("c"))
        .select("block", "c.part", "c.terms")
        .repartition(partitions, "part")
        .sortWithinPartitions("part")
        .mapInArrow(_encoded(vocabulary), _ENCODED_SCHEMA)
    )
    return (
        blocks.groupBy("block")
        .cogroup(encoded.groupBy("block"))
        .applyInArrow(_joined(key), SCHEMA.format(key=key))
    )


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and SHA-256 digests of what :func:`encode_decode` returns."""
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select(
        key, "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
