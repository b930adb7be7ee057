"""How many bytes the lists of the suffix tree take."""

import numpy as np
import pyarrow as pa
import pyarrow.compute

from incidentlens.llm import blocks, suffix_tree
from incidentlens.llm.blocks import unpack

BUCKETS = 16


def _sent():
    """A block of 400 documents, and the n-grams it sends after single words."""
    random, block = np.random.default_rng(1), blocks._Block()
    for key in range(400):
        words = [b"w%d" % w for w in random.zipf(1.3, 500) % 20_000]
        block.add(key, words, 0)
    batch = blocks._arrow([block.row(0, BUCKETS)], blocks._BLOCK)
    terms = pa.Table.from_batches(list(suffix_tree._terms([batch])))
    answers = pa.concat_tables(
        suffix_tree._counted_terms(terms.filter(pa.compute.equal(terms["bucket"], b))) for b in range(BUCKETS)
    )
    told = [r for r in answers.to_pylist() if r["kind"] == suffix_tree._SUMMARY]
    distinct, total, width = sum(r["distinct"] for r in told), sum(r["total"] for r in told), max(r["words"] for r in told) + 1
    table = pa.Table.from_batches([batch])
    known = (BUCKETS, 400, total, distinct, width)
    return table, answers, known, suffix_tree._stage(0, 1, *known)(table, answers)


def test_lists_take_few_bytes():
    sent = [r for r in _sent()[3].to_pylist() if r["kind"] == suffix_tree._TOTALS + 1]
    count = sum(len(unpack(r["amounts"], np.uint64)) for r in sent)
    assert count > 30_000
    assert sum(len(r["items"]) + len(r["nexts"]) for r in sent) < 3 * count  # hashes took more than 4 bytes


def test_lists_tell_every_item_apart():
    table, answers, known, sent = _sent()
    row = table.to_pylist()[0]
    tokens = suffix_tree._Tokens(row, answers.to_pylist(), *known)
    tokens.grams(1)
    at = tokens.eligible[1]
    pairs = set(zip(tokens.ids[at - 1].tolist(), tokens.ids[at].tolist(), strict=True))
    lists = [r for r in sent.to_pylist() if r["kind"] == suffix_tree._TOTALS + 1]
    told = {(r["bucket"], int(x)) for r in lists for x in suffix_tree._items(r, known[-1])}
    assert len(told) == len(pairs) == sum(len(unpack(r["amounts"], np.uint64)) for r in lists)


def test_too_many_contexts_are_an_error():
    rest = np.array([1 << 60], np.uint64)
    try:
        suffix_tree._listed(np.zeros(1, np.uint64), rest, BUCKETS)
    except OverflowError:
        return
    raise AssertionError("items would have been mixed up")
