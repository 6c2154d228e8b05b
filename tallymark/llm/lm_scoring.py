"""Language-model scores of documents by stupid backoff over the corpus's own n-grams.

Counts and scores are one relation of n-grams, exploded, aggregated and joined by hash:

1. documents are dealt into blocks; each block gives its different n-grams and their counts;
2. these are shuffled to count tables that are partitioned by the n-gram's hash, and summed;
3. the sums go back to the blocks that asked, are joined to the exploded n-grams, and the
   scores are summed for each document.

A document is scored by what the others say: its own n-grams are taken out of the counts, as
else each of them would count as seen. Words and pairs are asked for first. A longer n-gram
that another document holds is held there with both of its parts, so it is asked for only
where other documents have both: where they have not, its count is known to be zero. An n-gram that every document holds is one row of each block,
not of each document, so there is no hot key. N-grams travel sorted and packed, some five
bytes each.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tallymark.llm.texts import rows_of

ORDER = 3
BACKOFF = 0.4
MIN_COUNT = 1  # in other documents; an n-gram of two words or more that is rarer counts as unseen
BLOCK_BYTES = 8 << 20  # of text in a block, about
BUCKET_BYTES = 8 << 20  # of text for each part of the count tables, about
MICRO = 1e6  # scores are whole millionths of a natural logarithm, so sums are exact
LOW_BYTES = 5

ASKED = "block int, bucket int, grams binary, counts binary"
ANSWERED = "block int, stage int, bucket int, counts binary"
SCORED = "doc_id long, n_tokens long, n_backed_off long, score_micronats long"


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers, compressed byte plane by byte plane; the low planes of n-gram
    hashes are random, and stored as they are."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 0
    low = planes[:, :LOW_BYTES].tobytes() if width > LOW_BYTES else b""
    high = planes[:, LOW_BYTES:width] if width > LOW_BYTES else planes[:, :width]
    return bytes([width]) + low + zlib.compress(high.T.tobytes(), 1)


def unpack(data: bytes, n: int) -> np.ndarray:
    width = data[0]
    planes = np.zeros((n, 8), np.uint8)
    first = LOW_BYTES if width > LOW_BYTES else 0
    if first:
        planes[:, :first] = np.frombuffer(data, np.uint8, n * first, 1).reshape(n, first)
    rest = np.frombuffer(zlib.decompress(data[1 + n * first :]), np.uint8)
    planes[:, first:width] = rest.reshape(width - first, n).T
    return planes.view("<u8").reshape(-1)


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hash of an n-gram from that of its beginning and that of its last word."""
    number = (left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    number = (number + right) * np.uint64(0xC2B2AE3D27D4EB4F)
    return number ^ (number >> np.uint64(29))


class Block:
    """The n-grams of a block of texts: one hash for each place and length."""

    def __init__(self, texts: pa.ChunkedArray, order: int):
        """``texts``: compressed UTF-8."""
        parts = [self._hashes(zlib.decompress(text.as_py())) for text in texts]
        self.sizes = np.array([len(part) for part in parts], np.int64)
        hashes = np.concatenate([np.empty(0, np.uint64), *parts])
        n = len(hashes)
        #: Words before each place in its text.
        self.history = np.arange(n) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.text = np.repeat(np.arange(len(self.sizes), dtype=np.uint64), self.sizes)
        self.grams: list[np.ndarray] = [hashes]
        for length in range(2, order + 1):
            longer = np.zeros(n, np.uint64)
            longer[1:] = _mix(self.grams[-1][:-1], hashes[1:])
            self.grams.append(longer)

    @staticmethod
    def _hashes(text: bytes) -> np.ndarray:
        words = text.lower().split()
        return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))

    def own(self, length: int) -> np.ndarray:
        """How often the n-gram that ends at each place occurs in the place's own text."""
        here = _mix(self.grams[length - 1], self.text)
        here[self.history < length - 1] = 0
        _, inverse, n = np.unique(here, return_inverse=True, return_counts=True)
        return n[inverse]

    def places(self, length: int, counts: list[np.ndarray], min_count: int) -> np.ndarray:
        """Where an n-gram of this length ends that other texts may hold, by its parts' counts there."""
        there = self.history >= length - 1
        if length > 2:
            frequent = counts[length - 2] >= min_count
            there[1:] &= frequent[1:] & frequent[:-1]
        return np.flatnonzero(there)


def stages(order: int) -> list[list[int]]:
    """Lengths that are asked for together."""
    return [[1, 2][:order], *[[length] for length in range(3, order + 1)]]


TOTAL = np.uint64(0)  # stands for the empty n-gram, whose count is the number of words


def _cut(grams: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket, the hashes with the same first bits, begins in sorted hashes."""
    heads = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.r_[0, np.searchsorted(grams, heads), len(grams)]


def _known(block: Block, answers: pa.Table | None, order: int, n_stages: int, min_count: int):
    """The number of all words; the sums that the first stages gave for the words; and those of
    each length less the text's own, for each place; 0 where none was asked for."""
    counts: list[np.ndarray] = []
    words, total = np.zeros(len(block.history)), 0
    for stage, lengths in enumerate(stages(order)[:n_stages]):
        found = sorted(
            (bucket, data)
            for bucket, data, of in zip(*(answers.column(n).to_pylist() for n in ("bucket", "counts", "stage")))
            if of == stage
        )
        sums = [np.empty(0, np.uint64), *(unpack(d[4:], int.from_bytes(d[:4], "little")) for _, d in found)]
        known = np.concatenate(sums).astype(np.float64)
        if stage == 0:
            total, known = int(known[0]), known[1:]
        places = [block.places(length, counts, min_count) for length in lengths]
        grams, inverse = np.unique(
            np.concatenate([block.grams[k - 1][at] for k, at in zip(lengths, places)]), return_inverse=True
        )
        if len(known) != len(grams):
            raise RuntimeError("a block was not answered for all of its n-grams")
        begin = 0
        for length, at in zip(lengths, places):
            count = np.zeros(len(block.history))
            count[at] = known[inverse[begin : begin + len(at)]]
            begin += len(at)
            if length == 1:
                words = count
            counts.append(np.where(count > 0, count - block.own(length), 0))
    return total, words, counts


def _ask(order: int, stage: int, bits: int, min_count: int):
    """The n-grams of one stage that a block asks for, in a row for each bucket."""

    def ask(texts: pa.Table, answers: pa.Table | None) -> pa.Table:
        number = texts.column("block")[0].as_py() if len(texts) else 0
        block = Block(texts.column("text"), order)
        _, _, known = _known(block, answers, order, stage, min_count)
        wanted = [block.grams[k - 1][block.places(k, known, min_count)] for k in stages(order)[stage]]
        grams, counts = np.unique(np.concatenate(wanted), return_counts=True)
        if stage == 0:
            grams, counts = np.r_[TOTAL, grams], np.r_[int(block.sizes.sum()), counts]
        bounds = _cut(grams, bits)
        rows = [
            (number, bucket, (b - a).item().to_bytes(4, "little") + pack(np.diff(grams[a:b], prepend=np.uint64(0))), pack(counts[a:b]))
            for bucket, (a, b) in enumerate(zip(bounds, bounds[1:]))
            if a < b
        ]
        columns = list(zip(*rows)) if rows else [()] * 4
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["block", "bucket", "grams", "counts"]
        )

    return ask


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, as they are the bulk of what is dealt to the blocks."""
    for batch in batches:
        packed = [zlib.compress((text or "").encode("utf-8"), 1) for (text,) in rows_of([batch], "text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("block"), pa.array(packed, pa.binary())],
            ["doc_id", "block", "text"],
        )


def _first(ask):
    """``ask`` of the first stage, before there are answers."""

    def first(texts: pa.Table) -> pa.Table:
        return ask(texts, None)

    return first


def _answer(stage: int):
    """The sums of one part of the count tables, for each block that asked."""

    def answer(table: pa.Table) -> pa.Table:
        grams, counts = [], []
        for packed, counted in zip(table.column("grams"), table.column("counts")):
            data = packed.as_py()
            n = int.from_bytes(data[:4], "little")
            grams.append(np.cumsum(unpack(data[4:], n), dtype=np.uint64))
            counts.append(unpack(counted.as_py(), n))
        sizes = [len(g) for g in grams]
        _, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.uint64)
        sums = np.split(total[inverse], np.cumsum(sizes)[:-1])
        return pa.table(
            {
                "block": table.column("block"),
                "stage": pa.array([stage] * len(sums), pa.int32()),
                "bucket": table.column("bucket"),
                "counts": pa.array([len(s).to_bytes(4, "little") + pack(s) for s in sums], pa.binary()),
            }
        )

    return answer


def place_scores(block: Block, words: np.ndarray, counts: list[np.ndarray], total: int, backoff: float, min_count: int):
    """Score of every place in millionths, and whether it was backed off.

    ``words``: how often all texts have the place's word. ``counts``: how often the others
    have the n-gram of each length that ends at the place, where there is one.
    """
    n = len(block.history)
    score = np.log(words) - math.log(total) if n else np.zeros(0)
    used = np.ones(n, np.int64)
    for length in range(2, len(counts) + 1):
        seen = (block.history >= length - 1) & (counts[length - 1] >= min_count)
        at = np.flatnonzero(seen)
        score[at] = np.log(counts[length - 1][at]) - np.log(counts[length - 2][at - 1])
        used[at] = length
    steps = np.minimum(block.history + 1, len(counts)) - used
    return np.rint((score + steps * math.log(backoff)) * MICRO).astype(np.int64), steps > 0


def _score(order: int, backoff: float, min_count: int):
    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        ids = texts.column("doc_id")
        block = Block(texts.column("text"), order)
        total, words, counts = _known(block, answers, order, len(stages(order)), min_count)
        scores, backed_off = place_scores(block, words, counts, total, backoff, min_count)
        ends = np.cumsum(block.sizes)

        def per_text(values: np.ndarray) -> np.ndarray:
            sums = np.r_[0, np.cumsum(values)]
            return sums[ends] - sums[ends - block.sizes]

        return pa.table(
            {
                "doc_id": ids,
                "n_tokens": pa.array(block.sizes, pa.int64()),
                "n_backed_off": pa.array(per_text(backed_off.astype(np.int64)), pa.int64()),
                "score_micronats": pa.array(per_text(scores), pa.int64()),
            }
        )

    return score


def score_documents(
    docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, min_count: int = MIN_COUNT
) -> DataFrame:
    """``doc_id, n_tokens, n_backed_off, score_micronats, mean_score`` of every row.

    Each word, with A-Z in lower case, scores count(n-gram) / count(its beginning) for the
    longest n-gram that ends at it, of at most ``order`` words, and occurs in other rows, both
    counted over all other rows; every word that this n-gram is shorter than the longest one
    there is costs the factor ``backoff``; a single word scores its share of all words, the
    row's own included, so that a word which no other row has can be scored too. With a
    ``min_count`` above 1, rarer n-grams count as unseen.
    The logarithms are summed in millionths; ``mean_score`` is the sum over the number of
    words, null if there are none. A null or empty text has no words. Repeated rows are
    text like any other: they count, and get equal rows. Other columns are not read. No
    rows give no rows.
    """
    if order < 1 or min_count < 1:
        raise ValueError("order and min_count must be positive")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(size / BLOCK_BYTES))
    bits = max(1, math.ceil(math.log2(max(1, size / BUCKET_BYTES))))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int")
    dealt = slim.withColumn("block", block).mapInArrow(_deal, "doc_id long, block int, text binary")
    answers: list[DataFrame] = []
    for stage in range(len(stages(order))):
        ask = _ask(order, stage, bits, min_count)
        if stage == 0:
            asked = dealt.groupBy("block").applyInArrow(_first(ask), ASKED)
        else:
            earlier = reduce(DataFrame.unionAll, answers).groupBy("block")
            asked = dealt.groupBy("block").cogroup(earlier).applyInArrow(ask, ASKED)
        answers.append(asked.groupBy("bucket").applyInArrow(_answer(stage), ANSWERED))
    scored = (
        dealt.groupBy("block")
        .cogroup(reduce(DataFrame.unionAll, answers).groupBy("block"))
        .applyInArrow(_score(order, backoff, min_count), SCORED)
    )
    mean = F.col("score_micronats").cast("double") / F.when(F.col("n_tokens") > 0, F.col("n_tokens")) / MICRO
    return scored.withColumn("mean_score", mean)
