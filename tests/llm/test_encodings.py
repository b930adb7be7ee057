"""SentencePiece encoding through distinct chunks against the library on whole texts."""

import random

import pytest
from pyspark.sql import functions as F

from incidentlens.llm import pieces, queries
import brute

ODD = [
    " ", "  ", "\n", "▁", "a", "b", "the", "\r", "\x00", "\t", "é", "你", "\U0001f600", "<s>", "</s>", "<unk>",
    "<0x0A>", "1", "23", "\xa0", "　", "�", "ing", "  \n", "   ",
]


@pytest.fixture(scope="module")
def model():
    return queries.vocabulary_path(pieces.VOCABULARY)


@pytest.fixture(scope="module")
def odd_texts():
    chance = random.Random(3)
    return ["".join(chance.choices(ODD, k=chance.randint(0, 12))) for _ in range(3000)]


def found(encoded):
    return [tuple(r) for r in pieces.digests(encoded).collect()]


def test_given_and_awkward_documents(spark, small, given, awkward, awkward_docs, no_docs, model):
    assert set(map(tuple, queries.op11_pieces(spark, small).collect())) == brute.pieces(given, model)
    rows = found(pieces.encode_decode(awkward_docs, model))
    assert len(rows) == len(awkward) and set(rows) == brute.pieces(awkward, model)
    assert pieces.encode_decode(no_docs, model).isEmpty()


def test_markers_line_feeds_and_special_names(spark, odd_texts, model):
    docs = spark.createDataFrame(list(enumerate(odd_texts)), "doc_id long, text string").repartition(3)
    encoded = pieces.encode_decode(docs, model, block_bytes=2000, parts=5)
    assert set(found(encoded)) == brute.pieces(enumerate(odd_texts), model)


def test_round_trip_of_texts_without_markers(spark, odd_texts, model):
    texts = [(i, t) for i, t in enumerate(odd_texts) if "▁" not in t]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    back = pieces.encode_decode(docs, model).join(docs, "doc_id")
    assert back.where(F.col("decoded") != F.col("text")).isEmpty() and back.count() == len(texts)


def test_repeated_rows_missing_keys_and_a_small_memory(spark, awkward, model, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_CHUNKS", 2)
    keyless = [(None, text) for _, text in awkward[:12]]
    docs = spark.createDataFrame([*awkward[:12], *awkward[:12], *keyless], "doc_id long, text string")
    rows = found(pieces.encode_decode(docs, model, block_bytes=300))
    assert len(rows) == 36
    assert set(rows) == brute.pieces([*awkward[:12], *keyless], model)


def test_chunks_are_encoded_once_per_block():
    text = "a rose is  a rose \nis a▁rose "
    chunks = [b"a", b"rose", b"is", b" a", b"rose", b"\xffis", b"a", b"rose", b""]
    assert pieces.chunks_of(text.encode()) == chunks
    assert pieces.chunks_of(b"") == [] and pieces.chunks_of(b" ") == [b" "]
