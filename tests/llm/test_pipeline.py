"""The pipeline, stage by stage, against a brute-force version in Python."""

import math
import re

from pyspark.sql import functions as F

import corpus_pipeline
from tallymark.llm import decontamination as d
from tallymark.llm import simhash
from tests.llm.test_decontamination import distance
from tests.llm.test_mixing import check
from tests.llm.test_simhash import brute

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality_kept(docs, labels):
    """Base rules, and cutoffs where the labels prove one (see the operator)."""
    facts, base = {}, {}
    for i, (text, lang) in docs.items():
        words = WORD.findall(text)
        triples = list(zip(words, words[1:], words[2:]))
        twice = {x for x in triples if triples.count(x) > 1} if len(triples) < 3000 else None
        if twice is None:
            from collections import Counter

            twice = {x for x, n in Counter(triples).items() if n > 1}
        covered = {p for k, x in enumerate(triples) if x in twice for p in (k, k + 1, k + 2)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        facts[i] = {
            "symbols": (symbols, sum(map(len, words)), 0.03),
            "dup_lines": (len(lines) - len(set(lines)), len(lines), 0.01),
            "repeats": (len(covered), len(words), 0.01),
        }
        base[i] = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    seen = [(i, q) for i, q in labels if i in docs and not base[i]]
    strata = {docs[i][1] for i, _ in seen}
    rejected = {i for i in docs if base[i]}
    for lang in strata:
        own = [(i, q) for i, q in seen if docs[i][1] == lang]
        n = sum(q == 1 for _, q in own)
        for rule in ("symbols", "dup_lines", "repeats"):
            risk = facts[own[0][0]][rule][2]
            level, tail, most = 0.05 / (3 * len(strata)), 0.0, -1
            for k in range(n + 1):
                tail += math.comb(n, k) * risk**k * (1 - risk) ** (n - k)
                if tail > level:
                    break
                most = k
            gains = {}
            for c in range(1, 51):
                over = [q for i, q in own if 100 * facts[i][rule][0] > c * facts[i][rule][1]]
                good, bad = over.count(1), over.count(0)
                if good <= most and bad > good:
                    gains[c] = bad - good
            tied = [c for c in gains if gains[c] == max(gains.values())]
            if tied:
                cut = tied[(len(tied) - 1) // 2]
                rejected |= {
                    i for i in docs if docs[i][1] == lang and 100 * facts[i][rule][0] > cut * facts[i][rule][1]
                }
    return {i: row for i, row in docs.items() if i not in rejected}


def without_shared_lines(docs):
    def key(line):
        return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for i, (text, _) in docs.items():
        for line in set(map(key, text.split("\n"))):
            if len(line) >= 20:
                holders.setdefault(line, set()).add(i)
    gone = {line: max(ids) for line, ids in holders.items() if len(ids) >= 3}
    return {
        i: ("\n".join(x for x in text.split("\n") if gone.get(key(x), i) <= i), lang)
        for i, (text, lang) in docs.items()
    }


def test_against_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    source = {r.doc_id: r.source for r in rows}
    docs = {r.doc_id: (r.text, r.lang) for r in rows}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()]
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = quality_kept(docs, labels)
    docs = without_shared_lines(docs)
    groups = brute([(i, text) for i, (text, _) in docs.items()])
    docs = {i: row for i, row in docs.items() if groups[i][1] == i}

    def leaks(text):
        text = " ".join(re.split(r"[\x20\x09-\x0D]", text.lower()))
        for _, item in benchmark:
            item = " ".join(re.split(r"[\x20\x09-\x0D]", item.lower()))
            for begin, end in d.passages(item):
                passage = item[begin:end]
                # Without a shared piece of this length there are more edits than allowed.
                budget = d.edit_budget(len(passage))
                piece = len(passage) // (budget + 1)
                pieces = [passage[k * piece : (k + 1) * piece] for k in range(budget + 1)]
                if any(p in text for p in pieces) and distance(passage, text) <= budget:
                    return True
        return False

    docs = {i: row for i, row in docs.items() if not leaks(row[0])}
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: r.size for r in found} == {i: len(WORD.findall(t)) for i, (t, _) in docs.items()}
    check([(i, text, None, source[i]) for i, (text, _) in docs.items()], found)


def test_stages_on_difficult_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "x " * 40_000), (4, "few words"), (4, "few words"), (None, None), (5, "a b c " * 30)]
    for _, stage in corpus_pipeline.STAGES:
        docs = documents(rows)
        wide = docs.withColumnRenamed("n_chars", "size")
        for frame in (docs, docs.limit(0), wide):
            out = stage(spark, frame, SMALL)
            out.collect()
            if stage is not corpus_pipeline.STAGES[-1][1]:
                assert out.columns == frame.columns


def test_stage_names_and_number():
    assert len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.ORACLE_SQL is None


HELPERS = (
    "of counts kept stratum stratum_of cut_symbols cut_dup_lines cut_repeats id hash line drops cut n_lines n_dropped first_id "
    "row row_number nth fingerprint root leaking_id rest whole cell order_key target taken source_size labelled_id good"
).split()


def test_stages_with_columns_of_any_name_and_a_map(spark, documents):
    text = "some words of a text that is long enough to be kept by the rules of the corpus " * 6
    rows = [(1, text, "en", "s"), (1, text, "en", "s"), (None, text + " x", "en", "s"), (3, "few", "en", "t")]
    docs = documents(rows)
    docs = docs.select("*", *[F.lit(at).alias(name) for at, name in enumerate(HELPERS)], F.create_map(F.lit("a"), F.lit(1)).alias("map_column"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        found = out.collect()
        if name != "source_mixing":
            assert out.columns == docs.columns
            for r in found:
                assert [r[h] for h in HELPERS] == list(range(len(HELPERS))) and r.map_column == {"a": 1}
    once = simhash.keep_first(docs).collect()
    assert sorted((r.doc_id or 0) for r in once) in ([0, 1, 3], [1, 3])
