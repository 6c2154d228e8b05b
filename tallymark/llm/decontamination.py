"""Copied runs of benchmark texts in documents, found by the q-gram lemma.

A document leaks a benchmark text if it holds any run of at least ``PASSAGE`` characters of
it, wherever the run begins, within one edit in ten (a shorter text counts as a whole). A
longer run within its edits has a half within its own, so runs of under twice that length
are all that have to be looked for.

A region of a document that differs from a run of m characters by k edits shares at least
m - q + 1 - k q of its q-grams, on diagonals that are at most k apart. Shared q-grams are
counted in bands of diagonals that overlap, so that any such region lies in one band whole;
where a stretch of a benchmark text reaches the bound in a band, the same bound is tried on
all shorter grams of the band, and all runs that begin there and reach it as well are
verified by an alignment restricted to the band.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.shared import written
from tallymark.llm.texts import rows_of

Q = 8
FINE = 4  # characters of the shorter grams that are compared before an alignment
PASSAGE = 64  # characters; the shortest run that counts, but for shorter benchmark texts
LONGEST = 2 * PASSAGE - 1  # characters; longer runs hold one of these
EDITS = 0.1  # of a run's length
BLOCK_CHARS = 2_000_000  # benchmark characters that are broadcast at once
FILTER_BITS = 20
STRIDE = 1 << 14  # characters of a document after which its next segment begins
OVERLAP = 2 * LONGEST  # characters that segments share: any run with its edits lies in one whole
MOST_HITS = 1 << 17  # q-grams that a segment may share with the benchmark; else it is halved
STARTS = 1 << 10  # places of a benchmark text whose runs are verified together
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def edit_budget(length: int, edits: float = EDITS, q: int = Q) -> int:
    """Edits allowed in a run: its share, as long as the lemma still asks for a q-gram."""
    return max(0, min(int(edits * length), (length - q) // q))


def gram_size(length: int, edits: float = EDITS) -> int:
    """Characters of the grams by which a text is looked for: ``Q``, or ``FINE`` for one so
    short that the lemma would ask for fewer than its share of edits with longer ones."""
    short = length < PASSAGE and edit_budget(length, edits, Q) < int(edits * length)
    return FINE if short else Q


def _folded() -> np.ndarray:
    """Of each of the first 65,536 code points, its lower case if that is one code point;
    space for the blanks."""
    table = np.arange(0x10000, dtype=np.uint32)
    for code in range(0x10000):
        lower = chr(code).lower()
        if len(lower) == 1:
            table[code] = ord(lower)
    table[9:14] = 32
    return table


FOLDED = _folded()


def codes(text: str) -> np.ndarray:
    """Code points in lower case, one for each of the text's, blanks as spaces."""
    found = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if found.size and found.max() < len(FOLDED):
        return FOLDED[found]
    return np.where(found < len(FOLDED), FOLDED[np.minimum(found, len(FOLDED) - 1)], found)


def grams(of: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit number of the q-gram at each place."""
    n = len(of) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    wide = of.astype(np.uint64)
    number = wide[:n].copy()
    for shift in range(1, q):
        number *= MULTIPLIER
        number += wide[shift : shift + n]
    return number ^ (number >> np.uint64(29))


def passages(text: str) -> list[tuple[int, int]]:
    """Where the passages of a benchmark text begin and end; together they are the text.

    Found runs are reported by the passage in which they begin; they may end beyond it.
    """
    n = max(1, len(text) // PASSAGE)
    bounds = [len(text) * i // n for i in range(n + 1)]
    return list(zip(bounds, bounds[1:]))


def bounds(length: int, budgets: np.ndarray, q: int = Q) -> list[tuple[int, int]]:
    """(span, needed): any run of a text of this length, within its edits, shares at least
    ``needed`` q-grams that begin at most ``span`` after the run's begin, for one of these.

    One for each number of edits; a longer run of as many edits shares one more for each
    character more.
    """
    found = {}
    for m in range(min(length, PASSAGE), min(length, LONGEST) + 1):
        found.setdefault(int(budgets[m]), (m - q, m - q + 1 - int(budgets[m]) * q))
    return list(found.values())


@dataclass
class Index:
    """The q-grams of a block of benchmark texts, sorted, with a filter before them."""

    items: np.ndarray  # of each passage, its row in the block
    item_ids: list
    places: np.ndarray  # of each passage, its place in the benchmark text
    passage: np.ndarray  # of each row, its first passage; one more at the end
    texts: list  # of each row, its code points
    budgets: np.ndarray  # edits allowed in a run, by its length
    bounds: list  # of each row
    fine: list  # of each row, the same for grams of FINE characters
    needed: np.ndarray  # of each row, the fewest q-grams that a band must share
    shift: np.ndarray  # bands are 2 ** shift diagonals wide, and begin at every half of that
    offset: int  # added to diagonals, so that no band is negative
    numbers: np.ndarray
    first: np.ndarray
    row: np.ndarray
    place: np.ndarray
    filter: np.ndarray
    q: int


def build_indexes(rows: list[tuple[int, str]], edits: float = EDITS) -> list[Index]:
    """An index for each size of grams; texts of fewer than ``Q`` characters identify nothing."""
    known = [(item_id, text) for item_id, text in rows if len(text) >= Q]
    by_size = [(q, [row for row in known if gram_size(len(row[1]), edits) == q]) for q in (Q, FINE)]
    return [index for q, part in by_size if (index := build_index(part, q, edits)) is not None]


def build_index(rows: list[tuple[int, str]], q: int = Q, edits: float = EDITS) -> Index | None:
    """None if no text has q characters."""
    rows = [(item_id, text) for item_id, text in rows if len(text) >= q]
    if not rows:
        return None
    texts = [codes(text) for _, text in rows]
    begins = [[begin for begin, _ in passages(text)] for _, text in rows]
    budgets = np.array([edit_budget(m, edits, q) for m in range(LONGEST + 1)])
    limits = [bounds(len(text), budgets, q) for text in texts]
    fine = [bounds(len(text), budgets, FINE) for text in texts]
    found = [grams(text, q) for text in texts]
    numbers = np.concatenate(found)
    row = np.repeat(np.arange(len(texts)), [len(f) for f in found])
    place = np.concatenate([np.arange(len(f)) for f in found])
    order = np.argsort(numbers, kind="stable")
    unique, first = np.unique(numbers[order], return_index=True)
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[unique >> np.uint64(64 - FILTER_BITS)] = True
    # A region with k edits lies on k + 1 diagonals at most, which half a band holds.
    most = [int(budgets[min(len(text), LONGEST)]) for text in texts]
    shift = np.array([int(np.ceil(np.log2(k + 1))) + 1 for k in most])
    counts = [len(b) for b in begins]
    return Index(
        np.repeat(np.arange(len(rows)), counts), [item_id for item_id, _ in rows], np.concatenate(begins),
        np.cumsum([0, *counts]), texts, budgets, limits, fine, np.array([min(n for _, n in limit) for limit in limits]),
        shift, max(map(len, texts)) + (1 << int(shift.max())),
        unique, np.append(first, len(order)), row[order], place[order], bits, q,
    )


def looked_up(text: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the q-grams of a text that the benchmark has, their rank there, and how
    often it has each."""
    numbers = grams(text, index.q)
    likely = np.flatnonzero(index.filter[numbers >> np.uint64(64 - FILTER_BITS)])
    number = np.searchsorted(index.numbers, numbers[likely])
    number[number == len(index.numbers)] = 0
    same = index.numbers[number] == numbers[likely]
    likely, number = likely[same], number[same]
    return likely, number, index.first[number + 1] - index.first[number]


def candidates(text: np.ndarray, index: Index, seen=None) -> list[tuple[int, int, int, np.ndarray]]:
    """(row, lowest and highest diagonal, begins of runs) of the bands that share enough
    q-grams with some runs of a benchmark text."""
    at, number, counts = looked_up(text, index) if seen is None else seen
    if not len(at):
        return []
    entry = np.repeat(index.first[number], counts) + _within(counts)
    at, row, place = np.repeat(at, counts), index.row[entry], index.place[entry]
    # A row that shares too few q-grams in all does so in every band.
    kept = (np.bincount(row, minlength=len(index.needed)) >= index.needed)[row]
    at, row, place = at[kept], row[kept], place[kept]
    if not len(at):
        return []
    # Bands lie over halves: each diagonal is in the band that begins at its half, and in the
    # one before. Hits are counted by half, and those of two neighbours added up.
    half = (at - place + index.offset) >> (index.shift[row] - 1)
    keys, of, counts = np.unique((row << 40) | half, return_inverse=True, return_counts=True)
    after = np.minimum(np.searchsorted(keys, keys + 1), len(keys) - 1)
    two = keys[after] == keys + 1
    alone = np.append(True, keys[1:] != keys[:-1] + 1)  # no hit lies in the half before
    needed = index.needed[keys >> 40]
    whole = np.flatnonzero(counts + np.where(two, counts[after], 0) >= needed)
    upper = np.flatnonzero(alone & (counts >= needed))
    if not len(whole) and not len(upper):
        return []
    order = np.argsort(of, kind="stable")
    ends = np.cumsum(counts)
    begins = ends - counts
    found = []
    for i, down in [*((i, 0) for i in whole.tolist()), *((i, 1) for i in upper.tolist())]:
        last = int(after[i]) if two[i] and not down else i
        # A text's q-gram counts once in a band, however often the document repeats it.
        places = np.unique(place[order[begins[i] : ends[last]]])
        r, b = divmod(int(keys[i]) - down, 1 << 40)
        starts = _begins(places, len(index.texts[r]), index.bounds[r])
        if len(starts):
            shift = int(index.shift[r])
            lowest = (b << (shift - 1)) - index.offset
            found.append((r, lowest, lowest + (1 << shift) - 1, starts))
    return sorted(found, key=lambda f: f[:2])


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the counts."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _begins(places: np.ndarray, length: int, limits: list[tuple[int, int]]) -> np.ndarray:
    """Where runs can begin in a text of this length that shares the q-grams at ``places``."""
    tried = [(span, n) for span, n in limits if n <= len(places)]
    if not any((places[n - 1 :] - places[: len(places) - n + 1] <= span).any() for span, n in tried):
        return places[:0]
    last = length - min(length, PASSAGE)
    blocks = np.unique(places[:, None] // PASSAGE - np.arange(LONGEST // PASSAGE + 2))
    starts = (blocks[:, None] * PASSAGE + np.arange(PASSAGE)).ravel()
    starts = starts[(starts >= 0) & (starts <= last)]
    enough = np.zeros(len(starts), bool)
    for span, needed in limits:
        shared = np.searchsorted(places, starts + span, "right") - np.searchsorted(places, starts)
        enough |= shared >= needed
    return starts[enough]


def region(of: np.ndarray, text: np.ndarray, starts: np.ndarray, low: int, high: int):
    """The stretch of a benchmark text that holds the runs from ``starts``, and beside each
    of its characters the document's on the diagonals from ``low`` to ``high``."""
    first = int(starts[0])
    piece = of[first : int(starts[-1]) + LONGEST]
    padded = np.full(len(piece) + high - low, 0xFFFFFFFF, np.uint32)
    source = np.arange(first + low, first + low + len(padded))
    inside = (source >= 0) & (source < len(text))
    padded[inside] = text[source[inside]]
    return piece, np.lib.stride_tricks.sliding_window_view(padded, high - low + 1)


def compare(of: np.ndarray, text: np.ndarray, starts: np.ndarray, low: int, high: int, limits: list[tuple[int, int]]):
    """Of each start: the length of the longest run that the text holds unchanged in the band,
    up to ``LONGEST``, its first place in the text, and whether enough grams of ``FINE``
    characters are in the band for a run with edits."""
    piece, beside = region(of, text, starts, low, high)
    at = starts - starts[0]
    same = beside == piece[:, None]
    n = max(0, len(piece) - FINE + 1)
    shared = np.logical_and.reduce([same[i : i + n] for i in range(FINE)]).any(axis=1)
    before = np.append(0, np.cumsum(shared))
    enough = np.zeros(len(at), bool)
    for span, needed in limits:
        enough |= before[np.minimum(at + span + 1, n)] - before[np.minimum(at, n)] >= needed
    if not enough.any():
        return np.zeros(len(at), int), starts + low, enough
    other = np.where(same, len(piece), np.arange(len(piece))[:, None])
    other = np.minimum.accumulate(other[::-1], axis=0)[::-1]
    length = np.minimum(other[at] - at[:, None], LONGEST)
    best = length.argmax(axis=1)
    return length[np.arange(len(at)), best], starts + low + best, enough


def align(of: np.ndarray, text: np.ndarray, starts: np.ndarray, low: int, high: int, budgets: np.ndarray):
    """Of each start: edits, length, begin and end of the run of fewest edits, and the longest
    of those, that aligns to a region of the text on the diagonals from ``low`` to ``high``.
    More edits than any budget if there is none.

    One table for each start, all filled together, with one row for each character of the
    run; cell d of row i stands for the text's place start + i + low + d. Each cell also
    carries where its region began.
    """
    piece, beside = region(of, text, starts, low, high)
    least, far = min(len(of), PASSAGE), int(budgets.max()) + 1
    best = np.full((len(starts), 4), far)
    steps = np.arange(high - low + 1)
    owner, at = np.arange(len(starts)), starts - starts[0]
    origin = starts[:, None] + low + steps
    cost = np.where((origin >= 0) & (origin <= len(text)), 0, far)
    for i in range(LONGEST):
        alive = (at + i < len(piece)) & (cost.min(axis=1) < far)
        if not alive.all():
            owner, at, cost, origin = owner[alive], at[alive], cost[alive], origin[alive]
        if not len(at):
            break
        place = (at + int(starts[0]) + low + i + 1)[:, None] + steps
        match = cost + (beside[at + i] != piece[at + i][:, None])
        # The run's character has no partner.
        skip, skip_origin = np.full_like(cost, far), np.zeros_like(origin)
        skip[:, :-1], skip_origin[:, :-1] = cost[:, 1:] + 1, origin[:, 1:]
        better = skip < match
        new = np.where(better, skip, match)
        new_origin = np.where(better, skip_origin, origin)
        new = np.where((place >= 0) & (place <= len(text)), new, far)
        # Text characters without a partner: along the row, each costs one.
        ahead = new - steps
        reach = np.minimum.accumulate(ahead, axis=1)
        source = np.maximum.accumulate(np.where(ahead == reach, steps, 0), axis=1)
        cost = np.minimum(reach + steps, far)
        origin = np.take_along_axis(new_origin, source, axis=1)
        if i + 1 >= least:
            fewest = cost.min(axis=1)
            good = np.flatnonzero((fewest <= budgets[i + 1]) & (fewest <= best[owner, 0]))
            cell = cost[good].argmin(axis=1)
            values = (fewest[good], np.full(len(good), i + 1), origin[good, cell], place[good, cell])
            best[owner[good]] = np.stack(values, axis=1)
    return best


def _together(starts: np.ndarray) -> list[np.ndarray]:
    return np.split(starts, np.flatnonzero(np.diff(starts // STARTS)) + 1) if len(starts) else []


def segments(text: np.ndarray, index: Index) -> Iterator[tuple[int, np.ndarray, tuple]]:
    """Begin and characters of overlapping segments of a text that share q-grams with the
    benchmark, and what was looked up. Any run with its edits lies in one of them whole.

    A segment that shares very many, as rows of one character do, is halved, down to twice
    the overlap. One whose characters an earlier segment had is left out: all that it holds
    is held there as well, at an earlier place.
    """
    waiting = [(begin, min(len(text), begin + STRIDE + OVERLAP)) for begin in range(0, max(1, len(text) - OVERLAP), STRIDE)]
    waiting.reverse()
    had: set[bytes] = set()
    several = len(waiting) > 1
    while waiting:
        begin, end = waiting.pop()
        part = text[begin:end]
        seen = looked_up(part, index)
        if not len(seen[0]):
            continue
        if several:
            mark = hashlib.sha256(part.tobytes()).digest()
            if mark in had:
                continue
            had.add(mark)
        if int(seen[2].sum()) > MOST_HITS and len(part) > 2 * OVERLAP:
            half = begin + (len(part) - OVERLAP) // 2
            waiting += [(half, end), (begin, half + OVERLAP)]
            several = True
            continue
        yield begin, part, seen


Found = dict[int, tuple[int, int, int, int, int]]


def _segment_matches(of: np.ndarray, seen: tuple, index: Index) -> Found:
    """Of each passage in which a run begins that a segment holds, the best such run: edits,
    negative length, start in the benchmark text, begin and end in the segment."""
    best: Found = {}

    def passage_of(r: int, starts: np.ndarray) -> np.ndarray:
        first, end = index.passage[r], index.passage[r + 1]
        return first + np.searchsorted(index.places[first:end], starts, "right") - 1

    def note(r: int, starts: np.ndarray, edits, length, begin, end) -> None:
        columns = (passage_of(r, starts), edits, -length, starts, begin, end)
        for p, *found in zip(*(column.tolist() for column in columns)):
            best[p] = min(best.get(p, tuple(found)), tuple(found))

    close = []
    for r, low, high, starts in candidates(of, index, seen):
        item = index.texts[r]
        for part in _together(starts):
            length, begin, enough = compare(item, of, part, low, high, index.fine[r])
            long = length >= min(len(item), PASSAGE)
            note(r, part[long], np.zeros_like(length[long]), length[long], begin[long], begin[long] + length[long])
            if enough.any():
                close.append((r, low, high, part[enough]))
    whole = np.array(sorted(best), int)
    for r, low, high, part in close:
        part = part[~np.isin(passage_of(r, part), whole)]
        if len(part):
            edits, length, begin, end = align(index.texts[r], of, part, low, high, index.budgets).T
            good = edits <= index.budgets.max()
            note(r, part[good], edits[good], length[good], begin[good], end[good])
    return best


def matches(text: str, index: Index) -> list[tuple[int, int, int, int]]:
    """(passage, edits, begin, end) of every passage in which a run begins that a text holds,
    with the best such run: of fewest edits, the longest of those, and the first of those."""
    best: Found = {}
    for begin, part, seen in segments(codes(text), index):
        for p, (edits, length, start, first, end) in _segment_matches(part, seen, index).items():
            found = (edits, length, start, first + begin, end + begin)
            best[p] = min(best.get(p, found), found)
    return [(p, edits, begin, end) for p, (edits, _, _, begin, end) in sorted(best.items())]


def holds_any(text: str, indexes: list[Index]) -> bool:
    """Whether a text holds a run of any benchmark text."""
    of = codes(text)
    return any(_segment_matches(part, seen, index) for index in indexes for _, part, seen in segments(of, index))


MATCH = "doc_id long, item_id long, passage_start long, edits long, start long, end long"


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark, read once through the driver in blocks of bounded size."""
    rows: list[tuple[int, str]] = []
    size = 0
    kept = benchmark.where("text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for row in kept.distinct().toLocalIterator():
        rows.append((row[0], row[1]))
        size += len(row[1])
        if size >= BLOCK_CHARS:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, passage_start, edits, start, end``: a row for each passage of the
    benchmark in which a run begins that a document's whole text holds within the edit
    budget, with the best such run. Runs begin at any character and have at least
    ``PASSAGE`` of them, or are a shorter text as a whole.

    ``passage_start`` is in code points of the benchmark text, ``start`` and ``end`` of the
    run in the document's. Letters are compared in lower case, blanks as spaces. Null and empty
    texts and texts of fewer than q characters hold and identify nothing. Repeated benchmark rows
    count once; repeated documents give repeated rows. The benchmark is the query set: it
    goes to the executors in blocks of ``BLOCK_CHARS`` characters (and one text at most).
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = list(_each_block(slim, benchmark, lambda rows, shared: rows.mapInArrow(_search(shared), MATCH), "leaks"))
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], MATCH)


def _each_block(docs: DataFrame, benchmark: DataFrame, search, name: str, chained: bool = False) -> Iterator[DataFrame]:
    """``search`` over the documents, or chained over what the one before left, for each block
    of the benchmark. If there are several, each is finished and written, and its index taken
    off the executors, before the next is sent, so one block is all they ever hold."""
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark)
    rows = next(blocks, None)
    several = False
    while rows is not None:
        following = next(blocks, None)
        several |= following is not None
        indexes = build_indexes(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        rows = following
        if not indexes:
            continue
        shared = context.broadcast(indexes)
        found = search(docs, shared)
        if several:
            found = written(found, name)
            shared.unpersist()
        if chained:
            docs = found
        yield found


def _search(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc_id, index.item_ids[index.items[p]], int(index.places[p]), edits, begin, end)
                for doc_id, text in rows_of([batch], "doc_id", "text")
                if text
                for index in shared.value
                for p, edits, begin, end in matches(text, index)
            ]
            columns = zip(*rows) if rows else [()] * 6
            names = ["doc_id", "item_id", "passage_start", "edits", "start", "end"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return search


def _keep(shared):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = [not text or not holds_any(text, shared.value) for (text,) in rows_of([batch], "text")]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return keep


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text holds no run of the benchmark.

    Every row is judged by its own text, whatever its ``doc_id``, where it is read.
    """
    kept = docs
    for kept in _each_block(docs, benchmark, lambda rows, shared: rows.mapInArrow(_keep(shared), docs.schema), "clean", True):
        pass
    return kept
