"""BPE encoding and decoding through a table of distinct words (operator 1).

Texts are split at ASCII white space, which the tokenizer drops, so a text's ids
are its words' ids in order. Blocks of documents keep word numbers; chunks of
distinct words go to the task that encodes each distinct word once, and the ids
come back by number. Decoding takes every id's piece from the vocabulary, whose
size is fixed by the tokenizer, and joins the pieces by position.

Defined results: a NULL or empty text has no ids and decodes to the empty text;
every input row gives one row, also repeated ones and those without a key; an
empty table gives none; other columns are not looked at.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.llm.blocks import (
    bucketed, numbers_of, pack, ranges, rows_of, tidy, tidy_cogroup, unpack, unsqueeze, word_blocks,
)

VOCABULARY = "word_bpe_49k.json"
SCHEMA = "{key} long, n_tokens long, ids array<int>, decoded string"
_WORDS = pa.schema(
    [("block", pa.int64()), ("numbers", pa.binary()), ("lengths", pa.binary()), ("ids", pa.binary())]
)


def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encoded_words(path: str):
    """Chunks of words to chunks of ids; a task encodes a word once."""

    def encode(batches):
        tokenizer, known = _tokenizer(path), {}
        for block, terms, numbers in rows_of(batches, 64):
            words = unsqueeze(terms).split(b"\n")
            new = [w for w in words if w not in known]
            for start in range(0, len(new), 10_000):
                some = new[start : start + 10_000]
                for word, e in zip(
                    some,
                    tokenizer.encode_batch([w.decode() for w in some], add_special_tokens=False),
                    strict=True,
                ):
                    known[word] = np.array(e.ids, np.int32).tobytes()
            ids = [known[w] for w in words]
            lengths = np.fromiter(map(len, ids), np.uint32, len(ids)) // 4
            flat = np.frombuffer(b"".join(ids), np.int32)
            row = (block, numbers, pack(lengths), pack(flat))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, _WORDS, strict=True)], schema=_WORDS
            )

    return encode


def _joined(path: str, key: str):
    """A block's documents and its words' ids to ids and decoded texts."""
    schema = pa.schema(
        [(key, pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    )
    pieces: list = []

    def join(docs: pa.Table, words: pa.Table):
        if not pieces:
            tokenizer = _tokenizer(path)
            table = [""] * tokenizer.get_vocab_size(with_added_tokens=True)
            for piece, number in tokenizer.get_vocab(with_added_tokens=True).items():
                table[number] = piece
            pieces.append(pa.array(table, pa.large_string()))
        doc_rows, word_rows = docs.to_pylist(), words.to_pylist()
        chunks = [
            (numbers_of(r["numbers"]), unpack(r["lengths"], np.uint32), unpack(r["ids"], np.int32))
            for r in word_rows
        ]
        n_words = 1 + max((int(c[0][-1]) for c in chunks), default=-1)
        starts, lengths = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64)
        offset = 0
        for numbers, sizes, ids in chunks:
            ends = np.cumsum(sizes, dtype=np.int64)
            starts[numbers], lengths[numbers] = offset + ends - sizes, sizes
            offset += len(ids)
        flat = np.concatenate([c[2] for c in chunks]) if chunks else np.empty(0, np.int32)
        out = []
        for row in doc_rows:
            words_of_block = unpack(row["words"], np.uint32)
            ends = np.cumsum([0, *row["counts"]])
            for a in range(0, len(row["counts"]), 512):
                b = min(a + 512, len(row["counts"]))
                here = words_of_block[ends[a] : ends[b]]
                ids = flat[ranges(starts[here], lengths[here])]
                before = np.concatenate([[0], np.cumsum(lengths[here])])
                offsets = before[ends[a : b + 1] - ends[a]]
                lists = pa.LargeListArray.from_arrays(
                    pa.array(offsets, pa.int64()), pieces[0].take(pa.array(ids))
                )
                out.append(
                    pa.Table.from_arrays(
                        [
                            pa.array(row["keys"][a:b], pa.int64()),
                            pa.array(np.diff(offsets), pa.int64()),
                            pa.ListArray.from_arrays(
                                pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())
                            ),
                            pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                        ],
                        schema=schema,
                    )
                )
        return pa.concat_tables(out) if out else schema.empty_table()

    return join


def encode_decode(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    parts: int | None = None,
    block_bytes: int | None = None,
) -> DataFrame:
    """Per document its ids and the text they decode to, special tokens included.

    ``vocabulary`` is the path of a tokenizer without decoder that drops white
    space, on every executor. ``parts`` chunks of words are made per block; a task
    holds the distinct words of some of them, so it should grow with the input:
    four for each shuffle partition by default. Blocks of fewer ``block_bytes`` take less
    memory, and more disk.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or 4 * partitions
    size = {"block_bytes": block_bytes} if block_bytes else {}
    blocks = bucketed(word_blocks(docs, key, text, bytes.split, parts, **size), "block", "bpe_blocks")
    words = (
        blocks.select("block", F.explode("chunks").alias("c"))
        .select("block", "c.part", "c.terms", "c.numbers")
        .repartition(partitions, "part")
        .select("block", "terms", "numbers")
        .mapInArrow(tidy(_encoded_words(vocabulary)), "block long, numbers binary, lengths binary, ids binary")
    )
    documents = blocks.select("block", "keys", "counts", "words")
    return (
        documents.groupBy("block")
        .cogroup(words.groupBy("block"))
        .applyInArrow(tidy_cogroup(_joined(vocabulary, key)), SCHEMA.format(key=key))
    )


def digests(encoded: DataFrame, key: str = "doc_id", more: list[str] | None = None) -> DataFrame:
    """Counts and SHA-256 digests of what :func:`encode_decode` returns, and columns of it."""
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encoded.select(
        key,
        "n_tokens",
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *(more or []),
    )
