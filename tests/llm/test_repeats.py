"""Repeated passages against plain comparison of all windows."""

import random
from collections import defaultdict

import pytest

from tallymark.llm import repeats
from tallymark.llm.repeats import SMALLEST


def plain(rows, window):
    """Rows (doc_id, text) to (doc_id, n_words, n_removed, text)."""
    firsts = {}
    worded = [(SMALLEST if d is None else d, (t or "").encode().split(), d) for d, t in rows]
    for ident, words, _ in worded:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            firsts[key] = min(firsts.get(key, (ident, i)), (ident, i))
    out = []
    for ident, words, given in worded:
        gone = set()
        for i in range(len(words) - window + 1):
            if firsts[tuple(words[i : i + window])] < (ident, i):
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((given, len(words), len(gone), kept))
    return sorted(out, key=repr)


def cut(docs, **how):
    return sorted((tuple(r) for r in repeats.cut_repeats(docs, **how).collect()), key=repr)


def texts(seed, n=50):
    rng = random.Random(seed)
    common = [" ".join(rng.choice("abcdefgh") + str(i % 5) for i in range(k)) for k in (12, 25, 60)]
    rows = [(None, None), (1, ""), (2, " \n\t"), (3, "= " * 60), (4, "= " * 35), (None, common[2]), (None, common[2])]
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(5)):
            parts.append(rng.choice([*common, " ".join(rng.choice("xyzé") for _ in range(rng.randrange(9)))]))
        rows.append((rng.choice([None, rng.randrange(30), 100 + i]), rng.choice([" ", "\n", "\x0b"]).join(parts)))
    rows += [rows[-1]] * 3 + [(200 + i, common[1] + " = " * i) for i in range(40)]
    return rows


@pytest.mark.parametrize("window,prefix,most", [(20, 10, 1000), (20, 10, 3), (7, 3, 5), (5, 5, 1), (3, 1, 2), (1, 1, 1)])
def test_same_as_comparing(spark, documents, window, prefix, most):
    rows = texts(window + most)
    docs = documents(rows).repartition(3)
    assert cut(docs, window=window, prefix=prefix, most=most) == plain(rows, window)


def test_many_blocks_and_groups(spark, documents, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 500)
    monkeypatch.setattr(repeats, "GROUP_BYTES", 700)
    rows = texts(3)
    for most in (1000, 4):
        assert cut(documents(rows).repartition(5), window=8, prefix=4, most=most) == plain(rows, 8)


def test_one_id_on_a_third_of_all_rows(spark, documents):
    rng = random.Random(4)
    rows = [(7 if i % 3 else i, " ".join(rng.choice("ab") for _ in range(40))) for i in range(90)]
    assert cut(documents(rows), window=6, prefix=3) == plain(rows, 6)


def test_very_long_text(spark, documents):
    rng = random.Random(5)
    words = [rng.choice("abcdefghijklmnopqrstuvw") + str(rng.randrange(50)) for _ in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[30_000:30_100])), (3, "- " * 100_000)]
    found = {r[0]: r[1:3] for r in cut(documents(rows))}
    assert found == {1: (60_000, 0), 2: (100, 100), 3: (100_000, 99_999)}


def test_passages(spark, documents):
    rng = random.Random(6)
    shared = [f"s{rng.randrange(1000)}" for _ in range(30)]
    filler = [f"f{i}" for i in range(200)]
    rows = [(1, " ".join(filler[:5] + shared)), (2, " ".join(filler[10:20] + shared + filler[20:30])), (3, " ".join(filler[40:90]))]
    found = [tuple(r) for r in repeats.passages(documents(rows)).collect()]
    assert found == [(2, 10, 30, 1, 5)]


def test_passages_cover_what_is_cut(spark, documents):
    rows = [(i, t) for i, (_, t) in enumerate(texts(8))]
    covered = defaultdict(set)
    words = {i: (t or "").encode().split() for i, t in rows}
    for doc, start, n, first, at in repeats.passages(documents(rows), 8, 4, 6).collect():
        covered[doc].update(range(start, start + n))
        assert words[doc][start : start + n] == words[first][at : at + n] and (first, at) < (doc, start)
    assert {(d, len(w), len(covered[d])) for d, w in words.items()} == {r[:3] for r in plain(rows, 8)}


def test_empty_and_clashing_columns(spark, documents):
    assert cut(documents([])) == []
    columns = "doc_id long, text string, id int, hash int, block int, n int, start int, prefix int, bucket int"
    rows = [(1, "a b c d", *[0] * 7), (2, "x a b c", *[0] * 7)]
    assert cut(spark.createDataFrame(rows, columns), window=3, prefix=2) == [(1, 4, 0, "a b c d"), (2, 4, 3, "x")]


def test_wrong_parameters(documents):
    with pytest.raises(ValueError):
        repeats.cut_repeats(documents([]), window=5, prefix=6)
