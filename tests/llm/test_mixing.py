"""Source mixing against water-filling by hand."""

from collections import defaultdict

from tallymark.llm.mixing import mix


def filled(sizes, weights=(5, 2, 1), epochs=3):
    """Targets by clamping and sharing again, one round after the other."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * share >= epochs * sizes[s]}
        if not over:
            return target | {s: weight[s] * share for s in open_}
        for s in over:
            target[s] = epochs * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def check(rows, found):
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    wanted = filled(sizes)
    source_of = {doc_id: source for doc_id, _, _, source in rows}
    taken = defaultdict(int)
    for r in found:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source]
        assert abs(r.target - wanted[source]) < 1e-6 * max(1, wanted[source])
        assert 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 0.5


ROWS = [(i, "w " * (1 + i * 7 % 50), None, f"s{i % 5}") for i in range(300)]
ROWS += [(i, "w " * 40, None, "small") for i in range(300, 303)]
ROWS += [(303, "w " * 90_000, None, "z huge"), (304, None, None, None), (305, "a b", None, None)]
ROWS += [(306, "", None, "empty"), (307, "é\x0bñ", None, "é")]


def test_targets_are_met(spark, documents):
    found = mix(documents(ROWS)).collect()
    assert len(found) == len(ROWS)
    check(ROWS, found)
    assert found and sorted(map(tuple, mix(documents(ROWS[::-1])).collect())) == sorted(map(tuple, found))


def test_matches_sql(spark, documents, same_as_sql):
    docs = documents(ROWS)
    same_as_sql("op8_mixing", mix(docs), documents=docs)


def test_repeats_nulls_clashes_and_no_rows(spark, documents):
    rows = [(1, "a b c", None, "x"), (1, "a b c", None, "x"), (None, "d e", None, "x"), (2, "f", None, None)]
    docs = documents(rows).withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "target")
    found = mix(docs).collect()
    assert len(found) == 4 and sum(r.taken for r in found) in (8, 9, 10)
    assert mix(documents([])).collect() == []
    assert [r.taken for r in mix(documents([(1, "", None, "x"), (2, None, None, "y")])).collect()] == [0, 0]
