"""Language-model scoring with a probabilistic suffix tree (operator 9).

Symbols are words, and one end after each text. States are contexts of up to
``DEPTH`` preceding words. A context of enough occurrences is kept if it predicts
its next symbols better than its suffix does: the divergence test sums, over its
occurrences, the logarithm of the two probabilities' ratio, each occurrence left out
of the counts that predict it. The distribution of a state is smoothed with that of
its suffix, down to the root's add-one frequencies; a token is scored by the longest
kept suffix of what precedes it in its text.

Documents are blocks of word numbers (see ``blocks``). Words, n-grams and contexts
get their totals in buckets, from sorted lists that each block sends, and the answers
come back in the order of the list: no row per token is shuffled, and a frequent
context is spread over the buckets of its n-grams. Lists hold no hashes but numbers:
a bucket numbers its words, frequent ones first, and those n-grams that are contexts
of the next depth. A next word goes to the bucket that its number and its context's
add up to, so that of both only what the bucket doesn't tell is sent. Every training
document is counted; what is gathered grows with the corpus.

Defined results: a NULL or empty text is one end token; a row without key has the
empty name, and so is trained on; repeated rows count each; without training
documents every token has probability 1 at the root; an empty table gives no rows;
other columns are not looked at.
"""

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.llm.blocks import bucketed, freed_shuffles, growing, numbers_of, pack, unpack, unsqueeze, word_blocks
from incidentlens.sources.files import write_table
from incidentlens.sources.scratch import remove, scratch_path

DEPTH = 2
LEAST_COUNT = 8  # occurrences of a context that is tested
LEAST_GAIN = 3.0  # nats over all its occurrences for a context to be kept
STRENGTH = 4.0  # of the suffix's distribution in a state's, in occurrences
GAIN_UNIT = 2.0**-20  # nats; each block's part of a gain is rounded to whole units, so that sums are exact
FOLDS, HELD_OUT = 7, 2
BUCKET_BYTES = 16 << 20  # of text for each bucket, which is held by one task

_TERMS, _TOTALS, _KEPT, _SUMMARY = 0, 10, 20, 30  # kinds of answers; totals and contexts plus their depth

ANSWERS = "block long, kind int, bucket long, answer binary, more binary, distinct long, total long, words long"
_ANSWERS = pa.schema(
    [
        ("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("answer", pa.binary()),
        ("more", pa.binary()), ("distinct", pa.int64()), ("total", pa.int64()), ("words", pa.int64()),
    ]
)
SENT = "kind int, bucket long, block long, items binary, nexts binary, amounts binary"
_SENT = pa.schema(
    [
        ("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("items", pa.binary()),
        ("nexts", pa.binary()), ("amounts", pa.binary()),
    ]
)


def is_held_out(key: int | None) -> bool:
    return zlib.crc32(str("" if key is None else key).encode()) % FOLDS == HELD_OUT


def _folded(whole: np.ndarray) -> np.ndarray:
    """Signed whole numbers as unsigned ones, small if they are near zero."""
    return ((whole << 1) ^ (whole >> 63)).view(np.uint64)


def _unfolded(folded: np.ndarray) -> np.ndarray:
    return (folded >> np.uint64(1)).view(np.int64) ^ -(folded & np.uint64(1)).view(np.int64)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts, and how many each has."""
    given = pa.array(texts, pa.binary())
    # Kernels for ASCII take strings, but look at single bytes only, like those of Python's bytes.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.StringArray.from_buffers(len(given), *given.buffers()[1:])))
    words = lists.values
    words = pa.Array.from_buffers(pa.binary(), len(words), words.buffers(), offset=words.offset)
    is_word = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty one
    before = np.concatenate([[0], np.cumsum(is_word.to_numpy(zero_copy_only=False))])
    return words.filter(is_word), np.diff(before[lists.offsets.to_numpy()])


def _trained(keys: list) -> np.ndarray:
    return np.array([not is_held_out(k) for k in keys], bool)


def _terms(batches):
    """The words of each block with their uses in training documents."""
    for batch in batches:
        for row in batch.to_pylist():
            words, counts = unpack(row["words"], np.uint32), np.array(row["counts"], np.int64)
            trained = np.repeat(_trained(row["keys"]), counts)
            uses = np.bincount(words[trained], minlength=int(words.max()) + 1 if len(words) else 0)
            rows = [
                (_TERMS, c["part"], row["block"], c["terms"], None, pack(uses[numbers_of(c["numbers"])].astype(np.uint64)))
                for c in row["chunks"]
            ]
            yield from _table(rows, _SENT).to_batches()


def _counted_terms(table: pa.Table) -> pa.Table:
    """Numbers and totals of a bucket's words, for each block that has them; and a summary.

    Frequent words have small numbers, which take less room in lists.
    """
    rows = table.to_pylist()
    lists = [unsqueeze(row["items"]).split(b"\n") for row in rows]
    numbered = pa.array(chain.from_iterable(lists), pa.binary()).dictionary_encode()
    places = np.split(numbered.indices.to_numpy(), np.cumsum([len(x) for x in lists])[:-1])
    totals = np.zeros(len(numbered.dictionary), np.uint64)
    for row, place in zip(rows, places, strict=True):
        totals[place] += unpack(row["amounts"], np.uint64)  # a block has a word once
    rank = np.empty(len(totals), np.uint32)
    rank[np.argsort(-totals.astype(np.int64), kind="stable")] = np.arange(len(totals), dtype=np.uint32)
    out = [
        (r["block"], _TERMS, r["bucket"], pack(totals[p]), pack(rank[p]), None, None, None)
        for r, p in zip(rows, places, strict=True)
    ]
    known = int(np.count_nonzero(totals)), int(totals.sum()), len(totals)
    summary = (None, _SUMMARY, rows[0]["bucket"], None, None, *known)
    return _table([*out, summary], _ANSWERS)


def _shift(buckets: int) -> np.uint64:
    """Bits below the bucket's in the keys that lists are ordered by."""
    return np.uint64(64 - int(buckets).bit_length())


def _listed(bucket: np.ndarray, rest: np.ndarray, buckets: int):
    """Keys of different items that ascend by ``rest``, in order of the buckets, and that order."""
    shift = _shift(buckets)
    if len(rest) and int(rest.max()) >> int(shift):
        raise OverflowError("more contexts than 64 bits tell apart; it takes more shuffle partitions")
    order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")  # of short numbers: by digits
    return ((bucket << shift) | rest)[order], order


def _distinct(keys: np.ndarray):
    """Distinct whole numbers in order, the order of the given ones (stable), where each starts in it, and each one's place."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()).bit_length() + bits <= 64:
        # Numbers with their places are sorted in a fraction of the time that it takes to find an order.
        ordered = keys << np.uint64(bits)
        ordered |= np.arange(len(keys), dtype=np.uint64)
        ordered.sort()
        order = (ordered & np.uint64((1 << bits) - 1)).view(np.int64)
        ordered >>= np.uint64(bits)
    else:
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    is_new = np.ones(len(order), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=is_new[1:])
    begin = np.flatnonzero(is_new)
    distinct = ordered[begin]
    del keys, ordered
    place, numbers = np.empty(len(order), np.int64), np.cumsum(is_new)
    numbers -= 1
    place[order] = numbers
    return distinct, order, begin, place


def _places(order: np.ndarray) -> np.ndarray:
    """Where each item is in this order."""
    places = np.empty(len(order), np.int64)
    places[order] = np.arange(len(order))
    return places


def _send(kind: int, block: int, listed: np.ndarray, amounts: np.ndarray, buckets: int, width: int | None) -> list[tuple]:
    """A list for each bucket. With a width, items are pairs: what is left of them is the next word's part."""
    shift = _shift(buckets)
    bucket = (listed >> shift).astype(np.int64)
    items, nexts = listed & ((np.uint64(1) << shift) - np.uint64(1)), None
    if width is not None:
        items, nexts = np.divmod(items, np.uint64(width))
        nexts = nexts.astype(np.uint32)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    return [
        (
            kind, int(bucket[a]), block, pack(np.diff(items[a:b], prepend=np.uint64(0))),
            None if nexts is None else pack(nexts[a:b]), pack(amounts[a:b]),
        )
        for a, b in zip(edges[:-1], edges[1:], strict=True)
    ]


def _items(row: dict, width: int) -> np.ndarray:
    items = np.cumsum(unpack(row["items"], np.uint64), dtype=np.uint64)
    return items if row["nexts"] is None else items * np.uint64(width) + unpack(row["nexts"], np.uint32)


def _reduced(last: int, width: int):
    """Of a bucket's lists: totals and their owners for n-grams, the verdict for contexts.

    N-grams that are contexts of the next depth, if there is one, are numbered.
    """

    def reduce(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        kind, is_totals = rows[0]["kind"], rows[0]["kind"] < _KEPT
        lists = [_items(r, width) for r in rows]
        ends, numbers = np.cumsum([0] + [len(x) for x in lists]), None
        items = np.concatenate(lists)
        del lists
        _, order, begin, place = _distinct(items)
        del items
        amounts = np.concatenate([unpack(r["amounts"], np.uint64) for r in rows])
        if is_totals:
            totals = np.add.reduceat(amounts[order], begin)
            answers = totals[place]
            answers *= np.uint64(2)
            answers[order[begin]] += np.uint64(1)
            if kind - _TOTALS < last:
                often = totals >= LEAST_COUNT
                number = np.cumsum(often, dtype=np.uint64)
                numbers = [
                    pack(np.diff(number[p][often[p]], prepend=np.uint64(0))) for p in np.split(place, ends[1:-1])
                ]
        else:
            # Whole numbers: a float holds their sums, up to 2^33 nats, without rounding.
            answers = (np.bincount(place, _unfolded(amounts)) * GAIN_UNIT >= LEAST_GAIN).astype(np.uint8)[place]
        out = [
            (r["block"], kind, r["bucket"], pack(answers[start:end]), more, None, None, None)
            for r, start, end, more in zip(rows, ends[:-1], ends[1:], numbers or [None] * len(rows), strict=True)
        ]
        return _table(out, _ANSWERS)

    return reduce


class _Tokens:
    """A block's tokens with what is known of them so far.

    By depth, items are the block's different n-grams of ``depth`` + 1 tokens after a context that
    occurs often enough, in order of their lists; at depth 0 all its words, by their ids. What is told
    of n-grams is kept once per item, with the place of each eligible token's item.
    """

    def __init__(
        self, row: dict, answers: list[dict], buckets: int, n_ends: int, total: int, distinct: int, width: int
    ):
        self.block, self.buckets, self.width = row["block"], buckets, width
        self.answers = {(a["kind"], a["bucket"]): a for a in answers}
        counts = np.array(row["counts"], np.int64)
        words = unpack(row["words"], np.uint32)
        known = int(words.max()) + 1 if len(words) else 0
        uses, ids = np.full(known + 1, n_ends, np.uint64), np.zeros(known + 1, np.uint64)  # the end has id 0
        for chunk in row["chunks"]:
            answer, numbers = self.answers[_TERMS, chunk["part"]], numbers_of(chunk["numbers"])
            uses[numbers] = unpack(answer["answer"], np.uint64)
            ids[numbers] = unpack(answer["more"], np.uint32) * np.uint64(buckets) + np.uint64(chunk["part"] + 1)
        _, order, _, places = _distinct(ids)  # no two are the same
        self.ends = np.cumsum(counts + 1)
        size = int(self.ends[-1]) if len(self.ends) else 0
        self.is_end = np.zeros(size, bool)
        self.is_end[self.ends - 1] = True
        self.words = np.full(size, places[known])
        self.words[~self.is_end] = places[words]
        self.starts = self.ends - counts - 1
        self.trained = np.repeat(_trained(row["keys"]), counts + 1)
        self.counts = {0: uses[order]}  # of each item, by depth
        self.numbers = {0: ids[order]}  # likewise, of those that are contexts
        self.place = {0: self.words}  # the item of each eligible token
        self.eligible = {0: np.arange(size)}
        self.roots = (self.counts[0] + 1.0) / (total + distinct + 1.0)  # of each word
        self.listing: dict[int, tuple] = {}
        self.context: dict[int, tuple] = {}
        self.before: dict[int, np.ndarray] = {}  # the item that ends before each eligible token

    @property
    def ids(self) -> np.ndarray:
        return self.numbers[0][self.words]

    def _told(self, kind: int, listed: np.ndarray) -> list[dict]:
        """The answers to a list, by bucket."""
        bucket = listed >> _shift(self.buckets)
        return [self.answers[kind, b] for b in bucket[np.diff(bucket, prepend=~bucket[:1]) != 0].tolist()]

    def _answer(self, kind: int, listed: np.ndarray, dtype) -> np.ndarray:
        parts = [unpack(a["answer"], dtype) for a in self._told(kind, listed)]
        return np.concatenate(parts) if parts else np.empty(0, dtype)

    def _numbers(self, kind: int, listed: np.ndarray, often: np.ndarray) -> np.ndarray:
        """The numbers that buckets gave to the n-grams that occur often enough."""
        bucket, out = listed >> _shift(self.buckets), np.zeros(len(listed), np.uint64)
        parts = [np.cumsum(unpack(a["more"], np.uint64), dtype=np.uint64) for a in self._told(kind, listed)]
        if parts:
            out[often] = np.concatenate(parts) * np.uint64(self.buckets) + bucket[often]
        return out

    def contexts(self, depth: int):
        """The contexts of this depth, as a list, and the place of each eligible token's context in it."""
        numbers, context = self.context[depth]
        listed, order = _listed(numbers % np.uint64(self.buckets), numbers // np.uint64(self.buckets), self.buckets)
        return listed, _places(order)[context]

    def grams(self, depth: int) -> None:
        """Lists the n-grams after contexts of this depth that occur often enough."""
        before, item = self.eligible[depth - 1], self.place[depth - 1]
        is_context = (self.counts[depth - 1] >= LEAST_COUNT)[item] & ~self.is_end[before]
        self.eligible[depth], item = before[is_context] + 1, item[is_context]
        self.before[depth] = item
        # Contexts get numbers of their own, in the order of those that the buckets gave.
        here = np.zeros(len(self.counts[depth - 1]), bool)
        here[item] = True
        here = np.flatnonzero(here)
        here = here[np.argsort(self.numbers[depth - 1][here], kind="stable")]
        own = np.empty(len(self.counts[depth - 1]), np.int64)
        own[here] = np.arange(len(here))
        self.context[depth] = self.numbers[depth - 1][here], own[item]
        bits, buckets = np.uint64(len(self.numbers[0]).bit_length()), np.uint64(self.buckets)
        pairs = (own[item].view(np.uint64) << bits) | self.words[self.eligible[depth]].view(np.uint64)
        pairs, by_pair, begin, place = _distinct(pairs)
        context = self.context[depth][0][pairs >> bits]
        word = self.numbers[0][pairs & ((np.uint64(1) << bits) - np.uint64(1))]
        rest = context * np.uint64(self.width) + word // buckets
        listed, order = _listed((context + word) % buckets, rest, self.buckets)
        self.listing[depth] = listed, by_pair[begin][order]  # with a token of each item
        self.place[depth] = _places(order)[place]

    def grams_to_send(self, depth: int) -> list[tuple]:
        listed = self.listing[depth][0]
        uses = np.bincount(self.place[depth][self.trained[self.eligible[depth]]], minlength=len(listed))
        return _send(_TOTALS + depth, self.block, listed, uses.astype(np.uint64), self.buckets, self.width)

    def count(self, depth: int, last: int) -> np.ndarray:
        """Takes the totals of n-grams; returns which of the listed ones this block accounts for."""
        listed = self.listing[depth][0]
        told = self._answer(_TOTALS + depth, listed, np.uint64)
        self.counts[depth] = totals = told >> np.uint64(1)
        if depth < last:
            self.numbers[depth] = self._numbers(_TOTALS + depth, listed, totals >= LEAST_COUNT)
        return (told & np.uint64(1)).astype(bool)

    def refined(self, chance: np.ndarray, depth: int) -> np.ndarray:
        """The chances of tokens, given those one level higher, where contexts are kept."""
        listed, place = self.contexts(depth)
        kept = np.flatnonzero(self._answer(_KEPT + depth, listed, np.uint8).astype(bool)[place])
        at, out = self.eligible[depth][kept], chance.copy()
        given = self.counts[depth - 1][self.before[depth][kept]]
        count = self.counts[depth][self.place[depth][kept]]
        out[at] = (count + STRENGTH * chance[at]) / (given + STRENGTH)
        return out

    def gains_to_send(self, chance: np.ndarray, depth: int, owned: np.ndarray) -> list[tuple]:
        """What each context would gain over its suffix, from the n-grams accounted for here."""
        listed, place = self.contexts(depth)
        example = self.listing[depth][1][owned]
        old = chance[self.eligible[depth][example]]
        count, given = self.counts[depth][owned].astype(float), self.counts[depth - 1][self.before[depth][example]]
        new = (np.maximum(count - 1, 0) + STRENGTH * old) / (given - 1.0 + STRENGTH)
        gain = np.bincount(place[example], count * np.log(new / old), minlength=len(listed))
        units = _folded(np.rint(gain / GAIN_UNIT).astype(np.int64))
        return _send(_KEPT + depth, self.block, listed, units, self.buckets, None)


def _stage(depth: int, last: int, *known):
    """Sends what contexts of ``depth`` gain and the n-grams of the next depth."""

    def send(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        told, out = answers.to_pylist(), []
        for row in blocks.to_pylist():
            tokens = _Tokens(row, told, *known)
            chance = tokens.roots[tokens.words]
            for d in range(1, depth + 1):
                tokens.grams(d)
                owned = tokens.count(d, last)
                if d < depth:
                    chance = tokens.refined(chance, d)
                else:
                    out += tokens.gains_to_send(chance, d, owned)
            if depth < last:
                tokens.grams(depth + 1)
                out += tokens.grams_to_send(depth + 1)
        return _table(out, _SENT)

    return send


def _scored(depth: int, key: str, *known):
    schema = pa.schema(
        [
            (key, pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("base_score", pa.float64()), ("score", pa.float64()),
        ]
    )

    def score(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        told, out = answers.to_pylist(), []
        for row in blocks.to_pylist():
            tokens = _Tokens(row, told, *known)
            chance = tokens.roots[tokens.words]
            for d in range(1, depth + 1):
                tokens.grams(d)
                tokens.count(d, depth)
                chance = tokens.refined(chance, d)
            known_words, base = (tokens.counts[0] > 0)[tokens.words], np.log10(tokens.roots)[tokens.words]
            sums = [np.add.reduceat(x, tokens.starts) for x in (known_words, base, np.log10(chance))]
            out.append(
                pa.Table.from_arrays(
                    [
                        pa.array(row["keys"], pa.int64()), pa.array(~_trained(row["keys"])),
                        pa.array(np.array(row["counts"], np.int64) + 1), pa.array(sums[0].astype(np.int64)),
                        pa.array(sums[1]), pa.array(sums[2]),
                    ],
                    schema=schema,
                )
            )
        return pa.concat_tables(out) if out else schema.empty_table()

    return score


def _buckets(docs: DataFrame, text: str) -> int:
    """Buckets for all words and n-grams. As each block sends a list to each, they are no more than it takes."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def scored(
    docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH, block_bytes: int = 8 << 20
) -> DataFrame:
    """Key, fold, counts of tokens, base score and model score of every document."""
    with freed_shuffles(docs.sparkSession):
        return _scores(docs, key, text, depth, block_bytes)


def _scores(docs: DataFrame, key: str, text: str, depth: int, block_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    buckets = _buckets(docs, text)
    parts = word_blocks(docs, key, text, _words, buckets, block_bytes, at_once=True)
    blocks = bucketed(parts, "block", "lm_blocks")
    train = blocks.select(F.explode("keys").alias("key"))
    remainder = F.crc32(F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary")) % FOLDS
    n_ends = train.where(remainder != HELD_OUT).count()
    terms = blocks.mapInArrow(_terms, SENT).groupBy("bucket").applyInArrow(_counted_terms, ANSWERS)
    path = scratch_path(spark, "terms")
    answers = write_table(terms, path)
    sums = answers.where(F.col("kind") == _SUMMARY).agg(F.sum("distinct"), F.sum("total"), F.max("words")).first()
    distinct, total = (sums[0] or 0) + (n_ends > 0), (sums[1] or 0) + n_ends
    width = (sums[2] or 0) + 1  # of a word's number over the number of buckets
    known = (buckets, n_ends, total, distinct, width)
    by_block = blocks.groupBy("block")
    # Answers are dealt to their blocks once, and not again by every later stage.
    with growing(spark, "block", "lm_answers") as told:
        answers = told.add(answers.where(F.col("kind") == _TERMS))
        remove(spark, path)
        for d in range(depth + 1):
            sent = by_block.cogroup(answers.groupBy("block")).applyInArrow(_stage(d, depth, *known), SENT)
            reduced = sent.groupBy("kind", "bucket").applyInArrow(_reduced(depth, width), ANSWERS)
            answers = told.add(reduced)
    result = f"{key} long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return (
        by_block.cogroup(answers.groupBy("block"))
        .applyInArrow(_scored(depth, key, *known), result)
        .withColumn("train_tokens", F.lit(total).cast("long"))
    )
