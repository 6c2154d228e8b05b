"""Stupid backoff against counting in Python."""

import math
from collections import Counter

import numpy as np
import pytest

from tallymark.llm.lm_scoring import pack, score_documents, unpack


def brute(rows, order, backoff, min_count):
    texts = [(text or "").encode().lower().split() for _, text in rows]
    counts = Counter()
    for words in texts:
        for n in range(1, order + 1):
            counts.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    total = sum(map(len, texts))
    found = []
    for (doc_id, _), words in zip(rows, texts):
        score = backed = 0
        own = Counter(tuple(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1))
        other = {gram: counts[gram] - own[gram] for gram in own}
        for i in range(len(words)):
            longest = min(order, i + 1)
            for n in range(longest, 0, -1):
                gram = tuple(words[i - n + 1 : i + 1])
                if n == 1 or other[gram] >= min_count:
                    break
            if n == 1:
                value = np.log(counts[gram]) - np.log(total)
            else:
                value = np.log(other[gram]) - np.log(other[gram[:-1]])
            value += (longest - n) * math.log(backoff)
            score += int(np.rint(value * 1e6))
            backed += n < longest
        found.append((doc_id, len(words), backed, score))
    return sorted(found, key=repr)


ROWS = [
    (1, "the cat sat on the mat"),
    (2, "The cat sat on a hat \t the cat"),
    (3, None),
    (4, ""),
    (5, " \n "),
    (6, "one"),
    (6, "one"),
    (None, "the cat"),
    (7, "the " * 5000),
    (8, "à la É une \x0b mat"),
]


def test_only_other_documents_tell(spark, documents):
    alone = score_documents(documents([(1, "a b c a b c"), (2, "x")])).collect()
    assert {r.doc_id: (r.n_tokens, r.n_backed_off) for r in alone} == {1: (6, 5), 2: (1, 0)}
    copied = score_documents(documents([(1, "a b c a b c"), (2, "a b c a b c")])).collect()
    assert {r.n_backed_off for r in copied} == {0}


@pytest.mark.parametrize("order,min_count", [(1, 2), (2, 2), (3, 2), (3, 1), (2, 1), (5, 3), (5, 1)])
def test_small_corpus(spark, documents, order, min_count):
    frame = documents(ROWS).withColumnRenamed("lang", "n_tokens").withColumnRenamed("source", "block")
    found = score_documents(frame, order, 0.4, min_count).drop("mean_score").collect()
    assert sorted(map(tuple, found), key=repr) == brute(ROWS, order, 0.4, min_count)


def test_mean_score_and_no_rows(spark, documents):
    found = {r.doc_id: r.mean_score for r in score_documents(documents(ROWS)).collect()}
    assert found[3] is None and found[4] is None and found[1] < 0
    assert score_documents(documents([])).collect() == []


def test_many_blocks_give_the_same(spark, given, monkeypatch, documents):
    rows = sorted(given.items())[:60]
    whole = sorted(map(tuple, score_documents(documents(rows)).collect()))
    monkeypatch.setattr("tallymark.llm.lm_scoring.BLOCK_BYTES", 8_000)
    monkeypatch.setattr("tallymark.llm.lm_scoring.BUCKET_BYTES", 4_000)
    assert sorted(map(tuple, score_documents(documents(rows)).collect())) == whole


@pytest.mark.parametrize("values", [[], [0], [1, 255], [1 << 40, 3], [(1 << 64) - 1, 0, 7]])
def test_packing(values):
    given = np.array(values, np.uint64)
    assert unpack(pack(given), len(given)).tolist() == values
