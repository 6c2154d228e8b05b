"""Fingerprints and components against brute force."""

import random
import re

import pytest
from xxhash import xxh64_intdigest

from tallymark.llm import components, simhash


def plain_fingerprint(text, length=3):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) >= length:
        parts = [" ".join(words[i : i + length]) for i in range(len(words) - length + 1)]
    else:
        parts = [" ".join(words)] if words else []
    hashes = [xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def brute(rows, max_bits=2):
    of = {i: plain_fingerprint(t) for i, t in rows}
    roots = brute_roots(sorted(of), lambda a, b: (of[a] ^ of[b]).bit_count() <= max_bits)
    return {i: ("%016x" % of[i], roots[i]) for i in of}


def test_given_documents(spark, documents, given):
    found = simhash.near_copies(documents(sorted(given.items()))).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == brute(given.items())


def test_edge_cases(spark, documents):
    long = " ".join(f"Word{i}" for i in range(70_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "a b"), (7, long), (8, long.lower())]
    frame = documents(rows).withColumnRenamed("lang", "fingerprint").withColumnRenamed("source", "root")
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_copies(frame).collect()}
    assert found == brute(rows)
    repeated = simhash.near_copies(documents([(5, "x y z w"), (5, "x y z w"), (None, "x y z w"), (None, "q")]))
    assert sorted(((r.doc_id, r.component_id) for r in repeated.collect()), key=repr) == sorted(
        [(5, 5), (5, 5), (None, 5), (None, None)], key=repr
    )
    assert simhash.near_copies(documents([])).collect() == []


@pytest.mark.parametrize("max_bits", [0, 2, 4])
def test_links_join_all_within_the_distance(spark, max_bits):
    rng = random.Random(max_bits)
    values = {0, -1, -(2**63)}
    for _ in range(12):
        base = rng.getrandbits(64) - 2**63
        for _ in range(6):
            flips = sum(1 << b for b in rng.sample(range(63), rng.randrange(1, 5)))
            values.add(base ^ flips)
    nodes = sorted(values)
    frame = spark.createDataFrame([(v,) for v in nodes], "fingerprint long")
    roots = {r.node: r.root for r in components.component_roots(simhash.linked(frame, max_bits)).collect()}
    expected = brute_roots(nodes, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits)
    assert {n: roots.get(n, n) for n in nodes} == expected


def test_odd_distances_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.linked(spark.createDataFrame([(1,)], "fingerprint long"), 3)


def test_components_of_paths_stars_and_nothing(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    rng = random.Random(4)
    mess = [tuple(sorted(rng.sample(range(2000, 2080), 2))) for _ in range(70)]
    links = spark.createDataFrame(path + star + mess + mess, "a long, b long")
    roots = {r.node: r.root for r in components.component_roots(links).collect()}
    pairs = {*path, *star, *mess}
    nodes = sorted({n for pair in pairs for n in pair})
    expected = brute_roots(nodes, lambda a, b: (a, b) in pairs)
    assert {n: roots.get(n, n) for n in nodes} == expected
    assert components.component_roots(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group_stays(spark, documents):
    rows = [(3, "a b c d"), (1, "A b c d"), (1, "A b c d"), (7, "quite another text here"), (None, "a b c d")]
    kept = simhash.keep_first(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "a b c d"), (1, "A b c d"), (7, rows[3][1])]


def test_one_row_without_an_id_stays_of_each_group(spark, documents):
    far = " ".join(f"word{i}" for i in range(60))
    rows = [(None, "a b c d")] * 3 + [(None, "A B c d"), (None, far, "en"), (None, far, "de"), (None, None), (None, " ")]
    rows += [(7, "quite another text here"), (8, "quite another text here")]
    docs = documents(rows).withColumnRenamed("source", "root").withColumnRenamed("n_chars", "fingerprint")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text, r.lang) for r in kept.collect()]
    assert [r for r in found if r[0] == 7] == [(7, rows[-1][1], None)] and len(found) == 4
    # One of each group, whichever; a repeated row is one choice.
    assert {(r[1] or "").strip().lower() for r in found if r[0] is None} == {"a b c d", far, ""}
    assert set(found) <= {(*row, None)[:3] for row in rows}
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(map(tuple, simhash.keep_first(docs.repartition(3)).collect()), key=repr)
