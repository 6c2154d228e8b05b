"""Benchmark passages: exact and edited ones are found, others not."""

import random
import tracemalloc

import numpy as np
import pytest

from tallymark.llm import decontamination as d

BENCHMARK = "item_id long, text string"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def distance(passage, text):
    """Fewest edits from the passage to any region of the text."""
    row = np.zeros(len(text) + 1, int)
    codes = np.array([ord(c) for c in text])
    for i, c in enumerate(passage):
        new = np.r_[i + 1, np.minimum(row[:-1] + (codes != ord(c)), row[1:] + 1)]
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row.min())


@pytest.mark.parametrize("seed", range(6))
def test_against_full_alignment(seed):
    rng = random.Random(seed)
    for _ in range(25):
        passage = sentence(rng, 14)[: rng.randrange(40, 64)]
        edited = list(passage)
        for _ in range(rng.randrange(0, 10)):
            at = rng.randrange(len(edited))
            edited[at : at + rng.randrange(2)] = rng.choice(["", "x", "yz"])
        text = sentence(rng, rng.randrange(20)) + "".join(edited) + sentence(rng, rng.randrange(20))
        found = d.matches(text, d.build_index([(1, passage)]))
        true, budget = distance(passage, text), d.edit_budget(len(passage))
        assert bool(found) == (true <= budget)
        if found:
            (_, edits, begin, end), = found
            assert edits == true == distance(passage, text[begin:end])


def test_edge_cases(spark, documents):
    rng = random.Random(9)
    long, short = sentence(rng, 60), sentence(rng, 12)
    benchmark = spark.createDataFrame(
        [(1, long), (1, long), (2, short), (3, None), (4, ""), (5, "tiny"), (None, sentence(rng, 15))], BENCHMARK
    )
    rows = [
        (1, "before " + long.upper().replace(" ", "\n") + " after"),
        (2, short),
        (3, sentence(rng, 20_000) + short[:30] + "#" + short[30:]),
        (4, None),
        (5, ""),
        (6, "tiny"),
        (7, sentence(rng, 300)),
        (2, short),
        (8, long[:150]),
    ]
    docs = documents(rows).withColumnRenamed("lang", "item_id").withColumnRenamed("source", "edits")
    found = d.leaks(docs, benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 1), (2, 2), (3, 2), (8, 1)}
    assert found.where("doc_id = 2").count() == 2
    assert {r.edits for r in found.where("doc_id = 3").collect()} == {1}
    kept = d.clean(docs, benchmark)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {4, 5, 6, 7}
    assert d.leaks(documents([]), benchmark).collect() == []
    assert d.leaks(docs, benchmark.limit(0)).collect() == []


def test_blocks_of_the_benchmark_give_the_same(spark, documents, given, monkeypatch):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = documents(sorted(given.items()))
    whole = sorted(map(tuple, d.leaks(docs, benchmark).collect()))
    assert whole
    monkeypatch.setattr(d, "BLOCK_CHARS", 3_000)
    assert sorted(map(tuple, d.leaks(docs, benchmark).collect())) == whole


def test_given_passages_are_found(spark, given):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    index = d.build_index(rows)
    for doc_id, text in given.items():
        found = {index.item_ids[index.items[p]] for p, *_ in d.matches(text, index)}
        assert {item for item, passage in rows if passage in text} <= found


def holds(item, text, least=64):
    """Whether the text holds any run of the item, whatever its place and length, within one edit
    in ten."""
    codes = np.array([ord(c) for c in text])
    steps = np.arange(len(text) + 1)
    for begin in range(len(item) - least + 1):
        row = np.zeros(len(text) + 1, int)
        for i, c in enumerate(item[begin:], 1):
            new = np.r_[i, np.minimum(row[:-1] + (codes != ord(c)), row[1:] + 1)]
            row = np.minimum.accumulate(new - steps) + steps
            if i >= least and 10 * row.min() <= i:
                return True
    return False


@pytest.mark.parametrize("length", [127, 190, 300])
def test_copied_runs_are_found_wherever_they_begin(length):
    rng = random.Random(length)
    item = sentence(rng, 80)[:length]
    index = d.build_index([(1, item)])
    for run in (64, 80, 114, 120):
        for begin in range(length - run + 1):
            text = sentence(rng, 20) + " # " + item[begin : begin + run] + " # " + sentence(rng, 20)
            found = d.matches(text, index)
            assert found and min(edits for _, edits, *_ in found) == 0, (run, begin)


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_all_runs_aligned(seed):
    rng = random.Random(seed)
    answers = set()
    for _ in range(12):
        item = sentence(rng, 60)[: rng.randrange(64, 200)]
        begin = rng.randrange(len(item) - 50)
        edited = list(item[begin : begin + rng.randrange(50, 140)])
        for _ in range(rng.randrange(0, 14)):
            at = rng.randrange(len(edited))
            edited[at : at + rng.randrange(2)] = rng.choice(["", "x", "yz"])
        text = sentence(rng, rng.randrange(12)) + "".join(edited) + sentence(rng, rng.randrange(12))
        found = d.matches(text, d.build_index([(1, item)]))
        answers.add(bool(found))
        assert bool(found) == holds(item, text)
        for _, edits, start, end in found:
            assert any(
                distance(item[b : b + m], text[start:end]) == edits
                for b in range(len(item) - 63)
                for m in range(max(64, end - start - edits), min(127, end - start + edits, len(item) - b) + 1)
            )
    assert answers == {False, True}


def test_a_straddling_copy_is_not_clean(spark, documents):
    rng = random.Random(3)
    item = sentence(rng, 60)[:190]
    docs = documents([(1, sentence(rng, 30) + item[35:155] + sentence(rng, 30)), (2, sentence(rng, 60))])
    benchmark = spark.createDataFrame([(7, item)], BENCHMARK)
    assert {(r.doc_id, r.item_id) for r in d.leaks(docs, benchmark).collect()} == {(1, 7)}
    assert {r.doc_id for r in d.clean(docs, benchmark).collect()} == {2}


def test_every_row_is_judged_by_its_own_text(spark, documents):
    rng = random.Random(4)
    leak, fine = sentence(rng, 40), sentence(rng, 30)
    benchmark = spark.createDataFrame([(1, leak)], BENCHMARK)
    docs = documents([(None, fine), (None, leak), (3, fine), (4, leak), (4, fine), (4, None)])
    kept = d.clean(docs, benchmark)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(None, fine), (3, fine), (4, fine), (4, None)], key=repr)


def test_cleaning_block_by_block(spark, documents, monkeypatch):
    rng = random.Random(5)
    items = [sentence(rng, 20) for _ in range(9)]
    benchmark = spark.createDataFrame(list(enumerate(items)), BENCHMARK)
    docs = documents([(i, sentence(rng, 10) + (items[i] if i < 9 else "")) for i in range(14)])
    monkeypatch.setattr(d, "BLOCK_CHARS", 200)
    assert sorted(r.doc_id for r in d.clean(docs, benchmark).collect()) == [9, 10, 11, 12, 13]
    assert {(r.doc_id, r.item_id) for r in d.leaks(docs, benchmark).collect()} >= {(i, i) for i in range(9)}


@pytest.mark.parametrize("character", ["=", "-+"])
def test_long_rows_of_one_character_take_little_memory(character):
    rng = random.Random(6)
    item = sentence(rng, 10) + " " + character * (200 // len(character)) + " " + sentence(rng, 10)
    (index,) = d.build_indexes([(1, item)])
    text = character * (400_000 // len(character)) + " " + item + " " + character * 5_000
    tracemalloc.start()
    found = d.matches(text, index)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
    assert {edits for _, edits, *_ in found} == {0}
    assert found[0][2] >= 0 and len(found) == len(d.passages(item))


def test_segments_give_what_the_whole_gives(monkeypatch):
    rng = random.Random(7)
    items = [(i, sentence(rng, 30) + "=" * 40 + sentence(rng, 20)) for i in range(4)]
    (index,) = d.build_indexes(items)
    parts = []
    for _ in range(60):
        item = rng.choice(items)[1]
        begin = rng.randrange(len(item) - 60)
        parts += [sentence(rng, rng.randrange(12)), item[begin : begin + rng.randrange(30, 150)], "=" * rng.randrange(30)]
    text = " ".join(parts)
    whole = d.matches(text, index)
    monkeypatch.setattr(d, "STRIDE", 700)
    assert d.matches(text, index) == whole and len(whole) > 10
    monkeypatch.setattr(d, "MOST_HITS", 300)
    assert d.matches(text, index) == whole


@pytest.mark.parametrize("length", [10, 14, 20, 23, 30, 31, 40, 63])
def test_short_texts_have_one_edit_in_ten(length):
    rng = random.Random(length)
    for _ in range(20):
        item = sentence(rng, 30)[:length]
        edited = list(item)
        for at in rng.sample(range(1, length - 1), length // 10):
            edited[at] = "#"
        indexes = d.build_indexes([(1, item)])
        text = sentence(rng, 5) + " " + "".join(edited) + " " + sentence(rng, 5)
        assert any(d.matches(text, index) for index in indexes)
        assert d.holds_any(text, indexes)
