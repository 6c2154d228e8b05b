"""Passages that occur more than once, by suffix trees over groups of suffixes that begin alike.

A window is ``window`` words in a row; a passage is repeated as far as its windows are.

1. Of each window the sequence of ``PREFIX`` words with the least hash is its prefix. Equal
   windows have the same one at the same place, and neighbours mostly share it, so a suffix
   tree needs the suffixes around one word in six only. Documents are dealt into blocks;
   a block gives its different prefixes and how often each occurs.
2. A prefix that occurs once in the corpus has one leaf and no repeat: it is left out. One
   that occurs more often than a group may hold is made longer, up to the whole window,
   of which a block sends the first place only. So groups fit in memory.
3. A group's suffixes are sorted by doubling to the order of a suffix tree's leaves. Leaves
   that are equal over a window lie below one deep internal node; all but the node's first
   place are repeats.
4. The repeats go back to the blocks and are cut out of the texts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.texts import BLANKS, rows_of, text_or_empty
from tallymark.llm.tokens import STOP, numbered

WINDOW, PREFIX = 20, 10
BLOCK_BYTES = 8 << 20  # of text in a block, about
GROUP_BYTES = 8 << 20  # of text for each group of suffixes, about
MOST_PLACES = 1000  # of a prefix in one group; beyond, it is made longer
SMALLEST = -(2**63)  # stands for a null doc_id
_BLANKS = bytes.maketrans(BLANKS.encode(), b" " * len(BLANKS))

ASKED = "prefix long, block int, n long"
SUFFIXES = "bucket long, block int, id long, hash long, start int, n int, words binary, first_id long, first_start int"
RUNS = "block int, id long, hash long, start int, n int, first_id long, first_start int"
CUT = "doc_id long, n_words long, n_removed long, text string"


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    number = (left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    number = (number + right) * np.uint64(0xC2B2AE3D27D4EB4F)
    return number ^ (number >> np.uint64(29))


def _sequences(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` words from each place on, where there are so many."""
    whole, done, power, size = None, 0, hashes, 1
    while length >> (size.bit_length() - 1):
        if length & size:
            part = power[done:] if done else power
            whole = power if whole is None else _mix(whole[: len(part)], part[: len(whole)])
            done += size
        power, size = _mix(power[:-size], power[size:]) if len(power) > size else power[:0], 2 * size
    return whole[: max(0, len(hashes) - length + 1)]


def _word_hashes(dictionary: pa.Array) -> np.ndarray:
    """A number for each word, from its bytes alone: a polynomial in 64 bits, mixed. It only
    decides what is looked at together; what is equal is decided by the words."""
    if not len(dictionary):
        return np.empty(0, np.uint64)
    _, offsets, data = dictionary.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(dictionary) + 1)
    letters = np.frombuffer(data, np.uint8, int(bounds[-1])).astype(np.uint64) + np.uint64(1)
    sizes = np.diff(bounds)
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
    place = np.arange(len(letters)) - np.repeat(bounds[:-1], sizes)
    sums = np.add.reduceat(letters * powers[place], bounds[:-1])
    return _mix(sums, sizes.astype(np.uint64))


class Block:
    """The words of a block's texts as numbers, and each window's prefix."""

    def __init__(self, texts: pa.Table, window: int, prefix: int):
        data = [zlib.decompress(text.as_py()).translate(_BLANKS) for text in texts.column("text")]
        self.ids = texts.column("id").to_numpy()
        self.hashes = texts.column("hash").to_numpy()
        self.words, self.dictionary, stop = numbered(b"".join(text + b" " + STOP + b" " for text in data))
        is_stop = self.words == stop
        ends = np.flatnonzero(is_stop)
        self.begins = np.r_[0, ends[:-1] + 1]
        self.sizes = ends - self.begins
        self.row = np.repeat(np.arange(len(ends)), self.sizes + 1)
        hashed = _word_hashes(self.dictionary)[self.words]
        n = len(self.words) - window + 1
        if n <= 0:
            self.starts = self.at = self.prefixes = np.empty(0, np.int64)
            self.windows = np.empty(0, np.uint64)
            return
        stops = np.r_[0, np.cumsum(is_stop)]
        whole = stops[window:] == stops[:-window]
        keys = _sequences(hashed, prefix)
        seen = np.lib.stride_tricks.sliding_window_view(keys, window - prefix + 1)
        #: First word of every window, of the prefix of each, and the prefix.
        self.starts = np.flatnonzero(whole)
        self.at = self.starts + seen[self.starts].argmin(axis=1)
        self.prefixes = keys[self.at].view(np.int64)
        self.windows = _sequences(hashed, window)[self.starts]

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Where neighbouring windows with the same prefix place begin, and how many they are."""
        if not len(self.starts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        new = np.r_[True, (np.diff(self.at) != 0) | (np.diff(self.starts) != 1)]
        begin = np.flatnonzero(new)
        return begin, np.diff(np.r_[begin, len(self.starts)])

    def texts(self, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
        """The words from each place up to another, joined by blanks."""
        taken = self.dictionary.take(pa.array(self.words))
        whole = pa.LargeListArray.from_arrays(pa.array([0, len(taken)], pa.int64()), taken)
        joined = pc.binary_join(whole, pa.scalar(b" ", pa.large_binary()))[0].as_py()
        offsets = np.r_[0, np.cumsum(pc.binary_length(taken).to_numpy() + 1)]
        return [joined[a:b] for a, b in zip(offsets[begin].tolist(), (offsets[end] - 1).tolist())]


def _ask(window: int, prefix: int) -> Callable[[pa.Table], pa.Table]:
    """A block's different prefixes, and the number of their places."""

    def ask(texts: pa.Table) -> pa.Table:
        block = Block(texts, window, prefix)
        begin, _ = block.groups()
        found, n = np.unique(block.prefixes[begin], return_counts=True)
        number = np.full(len(found), texts.column("block")[0].as_py() if len(texts) else 0, np.int32)
        return pa.table({"prefix": pa.array(found, pa.int64()), "block": number, "n": pa.array(n, pa.int64())})

    return ask


def _first_places(block: Block, places: np.ndarray, window: int) -> np.ndarray:
    """For each of the windows the one of its equals that comes first; all by hash, then by
    words: a window that only shares the hash is its own first."""
    row = block.row[block.starts[places]]
    start = block.starts[places] - block.begins[row]
    order = np.lexsort((start, block.ids[row], block.windows[places]))
    keys = block.windows[places][order]
    head = np.r_[True, keys[1:] != keys[:-1]]
    first = np.empty(len(places), np.int64)
    first[order] = places[order][np.flatnonzero(head)][np.cumsum(head) - 1]
    same = np.ones(len(places), bool)
    for step in range(window):
        same &= block.words[block.starts[places] + step] == block.words[block.starts[first] + step]
    return np.where(same, first, places)


def _send(window: int, prefix: int, n_buckets: int, most: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The suffixes of a block that may be repeated, with their words, for their groups."""

    def send(texts: pa.Table, shared: pa.Table) -> pa.Table:
        names = [part.split()[0] for part in SUFFIXES.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int32()]
        if not len(texts) or not len(shared):
            return pa.table([pa.array([], t) for t in types], names=names)
        block = Block(texts, window, prefix)
        number = texts.column("block")[0].as_py()
        known, total = shared.column("prefix").to_numpy(), shared.column("total").to_numpy()
        begin, size = block.groups()
        few = np.isin(block.prefixes[begin], known[total <= most])
        rows: list[tuple[np.ndarray, ...]] = []

        # Suffixes around a prefix, in one piece of text.
        first = begin[few]
        bucket = block.prefixes[first].view(np.uint64) % np.uint64(n_buckets)
        rows.append((bucket.astype(np.int64), first, size[few], np.full(len(first), -1)))

        # Beyond that, whole windows. All but a block's first are known to be repeats.
        places = np.flatnonzero(np.isin(block.prefixes, known[total > most]))
        if len(places):
            firsts = _first_places(block, places, window)
            bucket = (block.windows[places] % np.uint64(n_buckets)).astype(np.int64)
            later = _later(block, places, firsts)
            rows.append((bucket[later], places[later], np.ones(later.sum(), np.int64), firsts[later]))
            keep, where = np.unique(firsts, return_index=True)
            rows.append((bucket[where], keep, np.ones(len(keep), np.int64), np.full(len(keep), -1)))
            # A row that is repeated as a whole has places of its own beside the first.
            twin = (firsts != places) & ~later
            rows.append((bucket[twin], places[twin], np.ones(twin.sum(), np.int64), np.full(twin.sum(), -1)))

        bucket, place, n, of = (np.concatenate(column) for column in zip(*rows))
        start, row = block.starts[place], block.row[block.starts[place]]
        of_row = block.row[block.starts[of]]
        sent = of >= 0
        texts_of = block.texts(start, start + n + window - 1)
        words = [None if known else text for known, text in zip(sent.tolist(), texts_of)]
        columns = [
            bucket, np.full(len(place), number), block.ids[row], block.hashes[row], start - block.begins[row], n, words,
            pa.array(block.ids[of_row], mask=~sent),
            pa.array((block.starts[of] - block.begins[of_row]).astype(np.int32), mask=~sent),
        ]
        return pa.table([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(columns, types)], names=names)

    return send


def _later(block: Block, places: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Which of the windows come later than their first: by doc_id, then by place."""
    row, of = block.row[block.starts[places]], block.row[block.starts[firsts]]
    start, of_start = block.starts[places] - block.begins[row], block.starts[firsts] - block.begins[of]
    return (block.ids[row] > block.ids[of]) | ((block.ids[row] == block.ids[of]) & (start > of_start))


def leaves(words: np.ndarray, depth: int, at: np.ndarray) -> np.ndarray:
    """Rank of the suffixes at some places by their first ``depth`` words; equal ones are
    leaves of one node that deep. Ranks of longer beginnings come from several of shorter
    ones, as many as one number holds, so the length doubles at least from step to step."""
    rank, known = words, 1
    while True:
        base = int(rank.max(initial=0)) + 2
        parts = min(int(62 / math.log2(base)), -(-depth // known))
        reach = min(depth, known * parts)
        where = at if reach == depth else np.arange(len(words))
        padded = np.r_[rank + 1, np.zeros(depth, np.int64)]  # 0 stands for the end
        key = np.zeros(len(where), np.int64)
        for part in range(parts):
            # The last part may overlap the one before.
            key = key * base + padded[where + min(part * known, reach - known)]
        rank, known = np.unique(key, return_inverse=True)[1].astype(np.int64), reach
        if known == depth:
            return rank


def _grow(window: int) -> Callable[[pa.Table], pa.Table]:
    """The repeats among a group's suffixes, each with its first place, as runs of windows."""

    def grow(group: pa.Table) -> pa.Table:
        names = [part.split()[0] for part in RUNS.split(", ")]
        done = pc.is_valid(group.column("first_id"))
        known = group.filter(done).select(names)
        new = group.filter(pc.invert(done))
        if not len(new):
            return known
        sizes = new.column("n").to_numpy().astype(np.int64)
        words, _, stop = numbered(b"".join(w.as_py() + b" " + STOP + b" " for w in new.column("words")))
        begins = np.r_[0, np.flatnonzero(words == stop)[:-1] + 1]
        row = np.repeat(np.arange(len(sizes)), sizes)
        step = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        node = leaves(words, window, begins[row] + step)
        ids = new.column("id").to_numpy()[row]
        start = new.column("start").to_numpy()[row].astype(np.int64) + step
        order = np.lexsort((start, ids, node))
        head = np.r_[True, node[order][1:] != node[order][:-1]]
        first = np.empty(len(row), np.int64)
        first[order] = order[np.flatnonzero(head)][np.cumsum(head) - 1]
        first_id, first_start = ids[first], start[first]
        later = (first_id < ids) | (first_start < start)
        # Neighbours whose first places are neighbours too become one run.
        at = np.flatnonzero(later)
        joined = (
            (np.diff(at) == 1) & (np.diff(row[at]) == 0) & (np.diff(first_start[at]) == 1) & (first_id[at][1:] == first_id[at][:-1])
        )
        run = np.flatnonzero(np.r_[True, ~joined]) if len(at) else at
        n = np.diff(np.r_[run, len(at)])
        where = at[run]
        found = pa.table(
            {
                "block": new.column("block").take(pa.array(row[where])),
                "id": pa.array(ids[where], pa.int64()),
                "hash": new.column("hash").take(pa.array(row[where])),
                "start": pa.array(start[where], pa.int32()),
                "n": pa.array(n, pa.int32()),
                "first_id": pa.array(first_id[where], pa.int64()),
                "first_start": pa.array(first_start[where], pa.int32()),
            }
        )
        return pa.concat_tables([known, found])

    return grow


def _cut(window: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The texts of a block without the words of repeated windows."""

    def cut(texts: pa.Table, runs: pa.Table) -> pa.Table:
        marked: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for ident, hashed, start, n in zip(*(runs.column(c).to_pylist() for c in ("id", "hash", "start", "n"))):
            marked.setdefault((ident, hashed), []).append((start, start + n + window - 1))
        counted, removed, kept = [], [], []
        for ident, hashed, text in zip(*(texts.column(c) for c in ("id", "hash", "text"))):
            words = zlib.decompress(text.as_py()).translate(_BLANKS).split()
            counted.append(len(words))
            stays, upto = [], 0
            for begin, end in sorted(marked.get((ident.as_py(), hashed.as_py()), ())):
                stays += words[upto:begin]
                upto = max(upto, end)
            stays += words[upto:]
            removed.append(len(words) - len(stays))
            kept.append(b" ".join(stays).decode())
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "n_words": pa.array(counted, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "text": pa.array(kept, pa.string()),
            }
        )

    return cut


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, as they are the bulk of what is dealt to the blocks."""
    for batch in batches:
        packed = [zlib.compress(text.encode(), 1) for (text,) in rows_of([batch], "text")]
        columns = [batch.column(c) for c in ("block", "id", "hash", "doc_id")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], ["block", "id", "hash", "doc_id", "text"])


def _dealt(docs: DataFrame) -> tuple[DataFrame, int]:
    """The documents in blocks, and the size of all texts."""
    ident = F.col("doc_id").cast("long")
    slim = docs.select(ident.alias("doc_id"), F.coalesce(ident, F.lit(SMALLEST)).alias("id"), text_or_empty("text").alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Rows that are repeated as a whole are dealt apart by the partition that they are read in.
    block = F.pmod(F.xxhash64("id", "text", F.spark_partition_id()), F.lit(max(1, math.ceil(size / BLOCK_BYTES))))
    hashed = slim.select(block.cast("int").alias("block"), "id", F.xxhash64("text").alias("hash"), "doc_id", "text")
    return hashed.mapInArrow(_deal, "block int, id long, hash long, doc_id long, text binary"), size


def _runs(dealt: DataFrame, size: int, window: int, prefix: int, most: int) -> DataFrame:
    by_block = dealt.groupBy("block")
    asked = by_block.applyInArrow(_ask(window, prefix), ASKED)
    # At most a row for each block has the same prefix, so a window over it stays small.
    total = F.sum("n").over(Window.partitionBy("prefix"))
    shared = asked.withColumn("total", total).where("total > 1").select("block", "prefix", "total")
    n_buckets = max(1, math.ceil(size / GROUP_BYTES))
    send = _send(window, prefix, n_buckets, most)
    suffixes = by_block.cogroup(shared.groupBy("block")).applyInArrow(send, SUFFIXES)
    return suffixes.groupBy("bucket").applyInArrow(_grow(window), RUNS)


def _checked(window: int, prefix: int) -> None:
    if not 1 <= prefix <= window:
        raise ValueError("prefix must have at least one word, and no more than window")


def cut_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, most: int = MOST_PLACES) -> DataFrame:
    """``doc_id, n_words, n_removed, text``: every row without its repeated words.

    A word is repeated if a window that covers it has words which also start earlier: in a
    document of smaller ``doc_id``, or at an earlier place of a row with the same one. All
    windows are judged on the input. ``text`` has the words that stay, joined by a blank.
    A null ``doc_id`` is below all others; rows that share one count as one document, so
    rows that are repeated as a whole are cut alike. A null, empty or blank text has no
    words; one of fewer words than a window stays as it is. Other columns are not read. No
    rows give no rows. ``prefix`` and ``most`` decide the grouping, and change no result.
    """
    _checked(window, prefix)
    dealt, size = _dealt(docs)
    runs = _runs(dealt, size, window, prefix, most)
    return dealt.groupBy("block").cogroup(runs.groupBy("block")).applyInArrow(_cut(window), CUT)


def passages(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, most: int = MOST_PLACES) -> DataFrame:
    """``doc_id, start, n_words, first_doc_id, first_start``: the repeated passages, as long as
    they run on in the document and at their first place alike; places are counted in words
    from 0. See ``cut_repeats``; a passage of rows that are repeated as a whole is one row."""
    _checked(window, prefix)
    dealt, size = _dealt(docs)
    runs = _runs(dealt, size, window, prefix, most)
    windows = runs.select("id", "hash", "first_id", (F.col("first_start") - F.col("start")).alias("apart"), "start", "n").distinct()
    same = Window.partitionBy("id", "hash", "first_id", "apart").orderBy("start")
    before = F.max(F.col("start") + F.col("n")).over(same.rowsBetween(Window.unboundedPreceding, -1))
    opened = windows.withColumn("opens", F.coalesce((F.col("start") > before).cast("int"), F.lit(1)))
    placed = opened.withColumn("nth", F.sum("opens").over(same))
    merged = placed.groupBy("id", "hash", "first_id", "apart", "nth").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("end")
    )
    named = [F.when(F.col(c) != SMALLEST, F.col(c)) for c in ("id", "first_id")]
    return merged.select(
        named[0].alias("doc_id"), F.col("start").cast("long").alias("start"),
        (F.col("end") - F.col("start") + window - 1).cast("long").alias("n_words"),
        named[1].alias("first_doc_id"), (F.col("start") + F.col("apart")).cast("long").alias("first_start"),
    )
