"""Phrases that stand together more often than their parts would, from a de Bruijn graph.

A node is a sequence of one word less than the longest phrase, an edge the longest phrase
itself: it leads from its first words to its last ones and weighs as often as it occurs.

1. Every word of a piece begins one edge, or near the piece's end a shorter correction.
   Equal ones are added up where they are read, then by node.
2. What leaves a node, with its corrections, is the count of the node's own phrase; the same
   sum over the nodes that begin alike gives every shorter phrase, down to the words.
3. Edges that no other edge joins or leaves on the way are compacted to one path that
   keeps their weights; the longest phrases are read back from the paths.
4. Phrases are cut in two at every place, joined to the counts of both parts, and scored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import quote
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.shared import written
from tallymark.llm.texts import text_or_empty
from tallymark.llm.tokens import STOP, chunks, numbered

MAX_WORDS, MIN_COUNT, INSIDE_PERCENT, BEST = 3, 10, 50, 2000
ENDS = b".,;:!?\n\x0b\x0c\r"  # what ends a piece
_PIECES = bytes.maketrans(ENDS + b"\t", STOP * len(ENDS) + b" ")
BUCKET_BYTES = 8 << 20  # of text for each part of the graph, about
SAMPLE_DOCS, BUSY_SHARE, SALTS = 4096, 256, 64
BATCH_ROWS = 1 << 16
TAB = "\t"
PATH_STEP = 256  # edges of a path in one row
ROUNDS = 60  # doubling steps; a longer path than 2^60 edges means a fault
EXACT = "decimal(14,0)"  # holds any count; products of two, a million times, stay exact
EDGES = "cell int, gram string, n long"


def _edges(lang: str, data: bytes, length: int, busy: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray] | None:
    """``cell, gram, n`` of the different edges of a lang's pieces, in their order. A gram of
    fewer than ``length`` words is a correction; one without any counts all words."""
    words, dictionary, stop = numbered(data)
    starts = np.flatnonzero(words != stop)
    if not len(starts):
        return None
    n_words = len(dictionary)
    padded = np.concatenate([words, np.full(length, stop, np.int64)])
    alive, key = np.ones(len(starts), bool), np.zeros(len(starts), np.int64)
    places = []
    for step in range(length):
        word = padded[starts + step]
        alive = alive & (word != stop)
        places.append(np.where(alive, word + 1, 0))
        if step and key.max(initial=0) >= 2**62 // (n_words + 1):
            key = np.unique(key, return_inverse=True)[1]
        key = key * (n_words + 1) + places[-1]
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    places = [place[first] for place in places]
    wide = pa.large_string()
    columns = [pc.take(dictionary, pa.array(place - 1, mask=place == 0)).cast(wide) for place in places]
    columns[0] = pc.binary_join_element_wise(pa.scalar(quote(lang, safe=""), wide), columns[0], pa.scalar(TAB, wide))
    gram = pc.binary_join_element_wise(*columns, pa.scalar(" ", wide), null_handling="skip")
    # The dictionary's place 0 stands for no word.
    known = [b"", *dictionary.to_pylist()]
    hashed = np.fromiter((crc32(word) for word in known), np.int64, len(known))
    cell = hashed[places[0]] ^ crc32(lang.encode())
    if length > 2:
        heads = np.fromiter((int.from_bytes(word[:2]) for word in known), np.int64, len(known))
        cell = cell * 1_000_003 + heads[places[1]]
    cell = (cell * 2_654_435_761 >> 7) % 2**31
    salted = -1 - (cell * 31 + hashed[places[-1]] % SALTS) % 2**31
    cell = np.where(np.isin(cell, busy), salted, cell)
    everything = pa.array([quote(lang, safe="") + TAB], wide)
    return np.r_[crc32(lang.encode()) >> 1, cell], pa.concat_arrays([everything, gram]), np.r_[len(starts), counts]


def edges(docs: DataFrame, length: int, busy: Sequence[int] = ()) -> DataFrame:
    """``cell, gram, n``: edges and corrections, added up for each batch of ``docs`` (``lang,
    text``). A frequent one is a row of each batch, not of each place.

    ``gram`` is the lang, quoted as in an address, a tab and the words. Nodes of the same first
    word whose second begins alike share a cell, so rows that look alike travel together. A
    ``busy`` cell is dealt out by the last word, to cells below zero.
    """
    crowded = np.array(sorted(busy), np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                langs = part.column("lang")
                for lang in langs.unique().to_pylist():
                    texts = part.column("text").filter(pc.equal(langs, lang)).to_pylist()
                    data = "\n".join(texts).encode().lower().translate(_PIECES)
                    found = _edges(lang, data.replace(STOP, b" " + STOP + b" "), length, crowded)
                    if found:
                        cell, gram, n = found
                        for at in range(0, len(n), BATCH_ROWS):
                            end = at + BATCH_ROWS
                            columns = [pa.array(cell[at:end], pa.int32()), gram[at:end].cast(pa.string()), pa.array(n[at:end], pa.int64())]
                            yield pa.RecordBatch.from_arrays(columns, ["cell", "gram", "n"])

    return docs.mapInArrow(count, EDGES)


def _busy(docs: DataFrame, length: int) -> list[int]:
    """Cells that hold more than one in ``BUSY_SHARE`` of the words of a few thousand
    documents: at most that many. They only decide how the graph is dealt out."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    found = edges(docs.sample(share, seed=11), length).where(~F.col("gram").endswith(TAB))
    rows = found.groupBy("cell").agg(F.sum("n").alias("n"))
    rows = written(rows, "sampled-cells")
    total = rows.agg(F.sum("n")).first()[0] or 0
    return [row.cell for row in rows.where(F.col("n") > total / BUSY_SHARE).collect()]


def _words(gram: Column, n: int) -> Column:
    return F.substring_index(gram, " ", n)


def counts(docs: DataFrame, length: int = MAX_WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, gram, n``: phrases of 1 to ``length`` words, joined by a blank, that occur
    ``min_count`` times or more, and for each lang the empty one with the number of all words."""
    slim = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty("text").alias("text")
    )
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A node's edges stay together, so that its flow needs no second shuffle; those of a busy
    # cell are spread and the flows of its nodes are added up once more.
    dealt = edges(slim, length, _busy(slim, length)).repartition(max(1, -(-size // BUCKET_BYTES)), "cell")
    edge = dealt.groupBy("cell", "gram").agg(F.sum("n").alias("n"))
    # The count in the condition keeps it behind the shuffle, which both readers share.
    whole = F.when(F.col("n") >= min_count, F.size(F.split("gram", " "))) == length
    flow = dealt.groupBy("cell", _words(F.col("gram"), length - 1).alias("node")).agg(F.sum("n").alias("n"))
    # A node below the threshold is no phrase, but part of what begins like it.
    frequent = (F.col("n") >= min_count) | (F.col("cell") < 0)
    size_of = F.size(F.split("node", " "))
    shorter = F.array(*[
        F.when((size_of >= m) & frequent if m == length - 1 else size_of >= m, _words(F.col("node"), m)) for m in range(2, length)
    ], _words(F.col("node"), 1))
    begins = flow.select("n", F.explode(F.array_compact(shorter)).alias("gram"))
    derived = begins.groupBy("gram").agg(F.sum("n").alias("n"))
    derived = derived.where((F.col("n") >= min_count) | F.col("gram").endswith(TAB))
    both = edge.where(whole).select("gram", "n").unionByName(derived)
    # No word holds a tab, and no quoted lang a tab or a blank.
    lang, words = F.url_decode(F.substring_index("gram", TAB, 1)), F.substring_index("gram", TAB, -1)
    return both.select(lang.alias("lang"), words.alias("gram"), "n")


def paths(grams: DataFrame, length: int = MAX_WORDS) -> DataFrame:
    """``lang, words, weights``: the edges of ``length`` words, compacted.

    An edge continues another if the node between them has one edge in and one out. Every
    edge finds its path's beginning by doubling its step back, round after round. A path
    goes into rows of at most ``PATH_STEP`` edges; edges of a ring, which begins nowhere,
    stay single.
    """
    edge = grams.where(F.size(F.split("gram", " ")) == length)
    edge = edge.select("lang", "gram", "n")
    to, out = F.expr("substring(gram, length(substring_index(gram, ' ', 1)) + 2)"), _words(F.col("gram"), length - 1)
    into = edge.groupBy("lang", to.alias("node")).agg(F.count("*").alias("n_in"), F.min("gram").alias("before"))
    outof = edge.groupBy("lang", out.alias("node")).agg(F.count("*").alias("n_out"), F.min("gram").alias("gram"))
    joint = into.where("n_in = 1").join(outof.where("n_out = 1"), ["lang", "node"]).where("before <> gram")
    steps = edge.join(joint.select("lang", "gram", "before"), ["lang", "gram"], "left").select(
        "lang", "gram", "n", F.coalesce("before", "gram").alias("back"),
        F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("hops"),
    )
    steps = written(steps, "path-steps")
    moving, left = F.col("hops") > 0, None
    heads = steps.where(~moving).select("lang", F.col("gram").alias("back"))
    for _ in range(ROUNDS):
        open_ = steps.where(moving).join(heads, ["lang", "back"], "left_anti").count()
        if open_ == 0 or open_ == left:  # all have arrived, or only rings are left
            break
        left = open_
        further = steps.select("lang", F.col("gram").alias("back"), F.col("back").alias("far"), F.col("hops").alias("more"))
        steps = written(
            steps.join(further, ["lang", "back"]).select(
                "lang", "gram", "n", F.col("far").alias("back"), (F.col("hops") + F.col("more")).alias("hops")
            ),
            "path-steps",
        )
    arrived = heads.withColumn("arrived", F.lit(True))
    placed = steps.join(arrived, ["lang", "back"], "left").select(
        "lang", "gram", "n",
        F.when(F.col("arrived"), F.col("back")).otherwise(F.col("gram")).alias("head"),
        F.when(F.col("arrived"), F.col("hops")).otherwise(0).alias("at"),
    )
    rows = placed.groupBy("lang", "head", F.floor(F.col("at") / PATH_STEP).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("at", "gram", "n"))).alias("edges")
    )
    first = F.split(F.get("edges", F.lit(0))["gram"], " ")
    lasts = F.transform("edges", lambda e: F.substring_index(e["gram"], " ", -1))
    words = F.concat(F.slice(first, 1, length - 1), lasts)
    return rows.select("lang", words.alias("words"), F.transform("edges", lambda e: e["n"]).alias("weights"))


def mine(
    docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
    inside_percent: int = INSIDE_PERCENT, best: int = BEST,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of 2 to ``max_words`` words.

    A-Z is lower-cased; a piece ends at one of ``ENDS``, words at blanks and tabs. ``a`` is
    the phrase's count in its lang's pieces, overlaps included, ``l`` and ``r`` those of its
    two parts at the cut that scores lowest (of equal ones the first), ``n`` the lang's
    words, ``score`` floor(1000000 a a / (l r)). A phrase that lies within a longer one with
    at least ``inside_percent`` of its count is left out. Ties in score go by count, then by
    the phrase's bytes. A null lang is ``und``; a null, empty or blank text has no words;
    repeated rows count as often as they occur; other columns are not read. No rows, or no
    phrase that is frequent enough, give no rows.
    """
    if max_words < 2 or min_count < 1 or best < 1:
        raise ValueError("max_words must be 2 or more, min_count and best positive")
    grams = written(counts(docs, max_words, min_count), "phrase-counts")
    compacted = written(paths(grams, max_words), "phrase-paths")
    longest = compacted.select("lang", "words", F.posexplode("weights").alias("i", "a")).select(
        "lang", F.slice("words", F.col("i") + 1, F.lit(max_words)).alias("words"), "a"
    )
    shorter = grams.select("lang", F.split("gram", " ").alias("words"), F.col("n").alias("a"))
    shorter = shorter.where((F.size("words") >= 2) & (F.size("words") < max_words))
    found = longest.unionByName(shorter).select("lang", "words", F.array_join("words", " ").alias("phrase"), "a")
    found = written(found, "phrases")

    size = F.size("words")
    begin = F.sequence(F.lit(1), size)
    inner = F.flatten(F.transform(
        begin,
        lambda i: F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), size - 1)), lambda m: F.struct(i.alias("i"), m.alias("m"))),
    ))
    inner = F.filter(inner, lambda part: (part["m"] < size) & (part["i"] + part["m"] - 1 <= size))
    within = found.where(size > 2).select("lang", "words", "a", F.explode(inner).alias("part")).select(
        "lang", F.array_join(F.slice("words", F.col("part.i"), F.col("part.m")), " ").alias("phrase"), "a"
    )
    longer = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = found.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))
    )
    cut = kept.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("begins"),
        F.array_join(F.slice("words", F.col("k") + 1, size), " ").alias("ends"),
    )
    known = grams.where("gram <> ''")
    cut = cut.join(known.select("lang", F.col("gram").alias("begins"), F.col("n").alias("l")), ["lang", "begins"])
    cut = cut.join(known.select("lang", F.col("gram").alias("ends"), F.col("n").alias("r")), ["lang", "ends"])
    a, l, r = (F.col(name).cast(EXACT) for name in "alr")
    score = F.expr("1000000BD") * (a * a)
    cut = cut.withColumn("share", score).withColumn("pair", l * r).withColumn("score", F.expr("share div pair"))
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("least"))
    scored = scored.select("lang", "phrase", "a", "least.score", "least.l", "least.r")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each of a lang's parts first, so that no task orders all of a lang.
    part = F.pmod(F.hash("phrase"), F.lit(SALTS))
    some = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    few = scored.withColumn("part", part).withColumn("nth", some).where(F.col("nth") <= best)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = grams.where("gram = ''").select("lang", "n")
    return ranked.where(F.col("rank") <= best).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
