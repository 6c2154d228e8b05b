"""Toxicity: the kernel, held-out recall, gapped insults, edge cases."""

import zlib

import numpy as np
import pytest

from tallymark.llm import toxicity as t

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = docs.join(labels, "doc_id").select("doc_id", "text", "toxic").orderBy("doc_id").collect()
    return [(r.text, r.toxic, zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows]


@pytest.fixture(scope="module")
def machine(labelled):
    learnt = [(text, toxic) for text, toxic, out in labelled if not out]
    return t.train([text for text, _ in learnt], np.array([toxic for _, toxic in learnt]))


def test_kernel_is_that_of_all_subsequences():
    def slow(text):
        of, _ = t.symbols(text)
        found = {}
        for i in range(len(of)):
            for (a, b, c), weight in zip(t.FORMS, t.WEIGHTS):
                if i + c < len(of):
                    key = tuple(int(of[i + k]) for k in (0, a, b, c))
                    found[key] = found.get(key, 0) + weight
        return found

    words = ["idiot", "worthless", "clown"]
    numbers, weights = t.landmark_table(words)
    rows = {int(n): w for n, w in zip(numbers, weights)}
    for j, word in enumerate(words):
        own = slow(word)
        size = sum(v * v for v in own.values()) ** 0.5
        for key, value in own.items():
            number = sum(s * t.SYMBOLS ** (3 - i) for i, s in enumerate(key))
            assert abs(rows[number][j] - value / size) < 1e-9


def test_held_out_recall_and_precision(labelled, machine):
    tested = [(t.probability(text, machine) >= t.THRESHOLD, toxic) for text, toxic, out in labelled if out]
    hits = sum(p and y for p, y in tested)
    assert hits >= 0.9 * sum(y for _, y in tested)
    assert sum(p and not y for p, y in tested) <= 0.02 * len(tested)


@pytest.mark.parametrize(
    "text", ["you idiot thing", "you id-iot", "you i d i o t there", "you idxiot", "you worthl.ess one", "mor on, ha"]
)
def test_gaps_and_inserted_characters(machine, text):
    assert t.probability(f"the thing and of there. {text} the and.", machine) >= t.THRESHOLD


def test_a_single_insult_in_a_clean_document(labelled, machine):
    clean = [text for text, toxic, out in labelled if out and not toxic][:120]
    planted = [f"{text[: len(text) // 2]} you clown {text[len(text) // 2 :]}" for text in clean]
    found = sum(t.probability(text, machine) >= t.THRESHOLD for text in planted)
    assert found >= 0.85 * len(planted)


def test_thinned_leaves_the_best_marked_sentence():
    assert t.thinned(np.array([-1.0, 0.5, 2.0, -0.2, 0.1])).tolist() == [-1.0, 2.0, -0.2]
    assert t.thinned(np.array([-1.0, 0.5])) is None


def test_long_texts_in_pieces_score_as_a_whole(machine, monkeypatch):
    text = "the thing and of there. you clown the and. " * 40
    whole = t.text_margins(text, machine.weights, machine.offset)
    monkeypatch.setattr(t, "AT_ONCE", 64)
    assert np.allclose(t.text_margins(text, machine.weights, machine.offset), whole, atol=1e-4)


def test_edge_cases(spark, documents, machine):
    rows = [(1, None), (2, ""), (3, "!!! ..."), (4, "x" * 400_000), (5, "you idiot"), (5, "you idiot"), (None, "fine")]
    docs = documents(rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "predicted")
    found = t.score(docs, machine).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert {r.doc_id: r.predicted for r in found}[1] == 0
    assert t.score(documents([]), machine).collect() == []
    labels = spark.createDataFrame([(1, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    assert {r.score for r in t.classify(docs, labels).collect()} == {0.0}


def test_held_out_rows_are_never_learnt(spark, documents):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = documents([(i, "you idiot" if i % 2 else "the thing") for i in held])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in held], "doc_id long, quality int, toxic int")
    assert t.fit(docs, labels) is None


def test_long_documents_are_learnt_from(spark, documents):
    clean = "the thing and of there. some more words here. "
    rude = "you worthless clown. what an idiot you are. "
    texts = [(i, (clean + (rude if i % 2 else "")) * (900 if i % 2 else 10)) for i in range(60)]
    assert all(len(text) > t.CHARS_PER_DOC for i, text in texts if i % 2)
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in texts], "doc_id long, quality int, toxic int")
    found = t.classify(documents(texts), labels).collect()
    assert all(r.predicted == r.doc_id % 2 for r in found)


def test_excerpts():
    text = "".join(f"Sentence {i} of the text. " for i in range(3_000))
    short = t.excerpt(text)
    assert t.CHARS_PER_DOC - 1_000 < len(short) <= t.CHARS_PER_DOC and t.excerpt(short) == short
    assert int(short.rsplit("Sentence ")[-1].split()[0]) > 2_900
    assert 19_000 <= len(t.excerpt("x" * 100_000)) <= t.CHARS_PER_DOC
    assert "".join(t.SENTENCE.findall(text + "\n\n||")) == text + "\n\n||"


def test_score_is_that_of_all_subsequences(machine):
    """Every place scored by listing its subsequences one by one, up to the probability."""

    def slow(text):
        of, starts = t.symbols(text)
        padded = [*of.tolist(), *[0] * (t.SPAN + t.STRETCH)]
        places = []
        for begin in range(len(of)):
            total = 0.0
            for i in range(begin, min(begin + t.SPAN - t.STRETCH + 1, len(of))):
                for (a, b, c), weight in zip(t.FORMS, t.WEIGHTS):
                    number = 0
                    for k in (0, a, b, c):
                        number = number * t.SYMBOLS + padded[i + k]
                    total += weight * float(machine.weights[number])
            places.append(total + machine.offset)
        ends = [*starts[1:].tolist(), len(of)]
        best = [max(places[s:e]) for s, e in zip(starts.tolist(), ends)]
        top = sorted(best, reverse=True)[:3]
        top += [top[-1]] * (3 - len(top))
        marked = sum(m > 0 for m in best)
        found = [*[min(3.0, max(-3.0, m)) for m in top], np.log1p(marked), 1000 * marked / (len(text) + 200)]
        value = sum((f - c) / s * w for f, c, s, w in zip(found, machine.centre, machine.scale, machine.calibration))
        return 1 / (1 + np.exp(-np.clip(value + machine.calibration[-1], -30, 30)))

    for text in ("", "fine words. and more!", "you clown | of the and.\nworthless", "i d i o t", "Über die id-iot x" * 3):
        assert abs(t.probability(text, machine) - slow(text)) < 1e-3


def test_the_sample_is_bounded_whatever_the_ids(spark, documents, monkeypatch):
    seen = {}
    monkeypatch.setattr(t, "train", lambda texts, toxic, shares: seen.update(texts=texts, toxic=toxic.tolist(), shares=shares))
    rows = [(8, f"text number {i}") for i in range(400)] + [(i, f"rude {i}") for i in range(100, 400)] + [(None, "no id")] * 50
    labels = spark.createDataFrame([(8, 1, 0), *[(i, 1, 1) for i in range(100, 400)], (None, 1, 1)], "doc_id long, quality int, toxic int")
    t.fit(documents(rows), labels, per_label=30)
    assert seen["toxic"].count(0) == 30 and seen["toxic"].count(1) == 30
    t.fit(documents(rows[:20] + [(100 + i, f"rude {i}") for i in range(20)]), labels, per_label=30)
    assert seen["toxic"].count(0) == 20 and seen["toxic"].count(1) >= 10
