"""Phrase mining against plain counting of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tallymark.llm import phrases


def plain(rows, max_words=3, min_count=10, inside=50, best=2000):
    f = defaultdict(Counter)
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            for m in range(1, max_words + 1):
                f[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, count in f.items():
        n = sum(c for gram, c in count.items() if len(gram) == 1)
        candidates = [g for g, c in count.items() if len(g) >= 2 and c >= min_count]
        longer = Counter()
        for g in candidates:
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    longer[g[i : i + m]] = max(longer[g[i : i + m]], count[g])
        scored = []
        for g in candidates:
            a = count[g]
            if g in longer and 100 * longer[g] >= inside * a:
                continue
            score, _, l, r = min(
                (1000000 * a * a // (count[g[:k]] * count[g[k:]]), k, count[g[:k]], count[g[k:]]) for k in range(1, len(g))
            )
            scored.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def found(frame):
    return sorted(tuple(row[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for row in frame.collect())


def texts(seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["A", "b", "é", "of", "the", "x\x00y", "|", "日本"]
    copies = " ".join(rng.choice("klmnopqrs") + str(i % 7) for i in range(40))
    rows = [(None, "en"), ("", None), (" . ;\n", "fr"), ("a b " * 40, "ring"), (copies, "en")]
    for _ in range(n):
        words = (rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",\n", "\t"]) for _ in range(rng.randrange(40)))
        rows.append((" ".join(words), rng.choice(["en", "fr", None])))
    return rows + [(copies, "en")] * 12


@pytest.mark.parametrize("length,min_count,inside,best", [(3, 10, 50, 2000), (2, 5, 50, 7), (4, 4, 80, 30)])
def test_same_as_counting(spark, documents, length, min_count, inside, best):
    rows = texts(length)
    docs = documents([(i, text, lang) for i, (text, lang) in enumerate(rows)])
    assert found(phrases.mine(docs, length, min_count, inside, best)) == plain(rows, length, min_count, inside, best)


def test_busy_nodes_change_nothing(spark, documents, monkeypatch):
    rows = texts(9)
    docs = documents([(i, text, lang) for i, (text, lang) in enumerate(rows)]).repartition(4)
    cells = [row.cell for row in phrases.edges(docs.na.fill("").where("doc_id % 3 > 0"), 3).collect()]
    monkeypatch.setattr(phrases, "_busy", lambda docs, length: cells)
    assert found(phrases.mine(docs)) == plain(rows)


def test_paths_hold_every_edge_once(spark, documents):
    rows = texts(5)
    docs = documents([(i, text, lang) for i, (text, lang) in enumerate(rows)])
    grams = phrases.counts(docs, 3, 2)
    longest = {(r.lang, r.gram): r.n for r in grams.collect() if r.gram.count(" ") == 2}
    seen = Counter()
    lengths = []
    for row in phrases.paths(grams, 3).collect():
        assert len(row.words) == len(row.weights) + 2
        lengths.append(len(row.weights))
        for i, weight in enumerate(row.weights):
            gram = (row.lang, " ".join(row.words[i : i + 3]))
            seen[gram] += 1
            assert longest[gram] == weight
    assert seen == Counter(longest.keys())
    assert max(lengths) >= 20  # the copied text is one path


def test_long_paths_are_cut(spark, documents, monkeypatch):
    monkeypatch.setattr(phrases, "PATH_STEP", 8)
    text = " ".join(f"w{i}" for i in range(100))
    grams = phrases.counts(documents([(i, text) for i in range(3)]), 3, 3)
    rows = phrases.paths(grams, 3).collect()
    assert sorted(len(r.weights) for r in rows) == sorted([8] * 12 + [2])


def test_empty_and_clashing_columns(spark, documents):
    assert found(phrases.mine(documents([]))) == []
    assert found(phrases.mine(documents([(1, None), (2, " ")]))) == []
    rows = [("x y z. x y", "en")] * 11
    docs = spark.createDataFrame(
        [(t, l, 1, 2, 3, 4, 5) for t, l in rows], "text string, lang string, n int, cell int, gram int, node int, words int"
    )
    assert found(phrases.mine(docs)) == plain(rows)


def test_langs_with_blanks_and_tabs(spark, documents):
    rows = [("x y z. x y", lang) for lang in ("e n", "e\tn", "%20+é", "", None) for _ in range(10)]
    docs = documents([(i, text, lang) for i, (text, lang) in enumerate(rows)])
    assert found(phrases.mine(docs)) == sorted(
        plain([r for r in rows if r[1] != ""]) + [("", *r[1:]) for r in plain([r for r in rows if r[1] is None])]
    )


def test_wrong_parameters(documents):
    with pytest.raises(ValueError):
        phrases.mine(documents([]), max_words=1)
