"""Distinct counts from bitmaps, windows as a table, levels at once, slices and dense trends."""

import datetime as dt
import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallymark.operators import checks, compare, distinct, intervals, measures, slices, terms
from tallymark.sources import staging


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# === Bitmaps =============================================================================


def test_bitmaps_give_exact_distincts_of_any_group(spark):
    rng = random.Random(1)
    keys = [None, -5, 0, 1, 32768, 32769, 10**12, *range(40_000, 40_050)]
    rows = [(rng.choice("ab"), rng.choice(["x", "y", None]), rng.choice(keys), rng.random() < 0.4) for _ in range(2000)]
    frame = spark.createDataFrame(rows, "a string, b string, k long, flag boolean")
    counts = {"keys": ("k", None), "flagged": ("k", "flag")}
    made = distinct.bitmaps(frame, ["a", "b"], counts).cache()
    for dims in ([], ["a"], ["b"], ["a", "b"]):
        plain = frame.groupBy(*dims).agg(F.countDistinct("k").alias("keys"), F.expr("count(DISTINCT k) FILTER (WHERE flag)").alias("flagged"))
        assert sorted(distinct.merged(made, dims, list(counts)).collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_bitmaps_are_built_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    assert plan_of(distinct.bitmaps(frame, ["g"], {"n": ("id", None)})).count("bitmap_construct_agg") >= 2
    assert distinct.merged(distinct.bitmaps(frame.where("id < 0"), ["g"], {"n": ("id", None)}), ["g"], ["n"]).collect() == []


def test_number_keys(spark):
    words = [f"w{i % 700}" for i in range(2000)] + [None]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    numbers = {r.word: r.number for r in distinct.number_keys(frame, "word").collect()}
    assert sorted(numbers.values()) == list(range(700)) and set(numbers) == set(words) - {None}
    again = {r.word: r.number for r in distinct.number_keys(frame.repartition(5), "word").collect()}
    assert again == numbers


# === Windows as a table ==================================================================


def test_each_row_once_for_every_window(spark):
    rng = random.Random(2)
    start = dt.date(1969, 12, 1)  # bins go on below the epoch
    days = [start + dt.timedelta(rng.randrange(400)) for _ in range(500)]
    windows = []
    for i in range(300):
        first = start + dt.timedelta(rng.randrange(-50, 450))
        windows.append((i, first, first + dt.timedelta(rng.choice([0, 1, 2, 6, 30, 90, 500, -1]))))
    windows += [(900, None, start), (901, start, None)]
    rows = spark.createDataFrame([*enumerate(days), (999, None)], "row int, day date")
    table = spark.createDataFrame(windows, "window int, first_day date, last_day date")
    found = intervals.in_window_table(rows, "day", table)
    expected = sorted((r, w) for r, d in enumerate(days) for w, a, b in windows if a and b and a <= d <= b)
    assert sorted((r["row"], r["window"]) for r in found.collect()) == expected
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert set(found.columns) == {"row", "day", "window", "first_day", "last_day"}


def test_no_windows_and_no_rows(spark):
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "row int, day date")
    table = spark.createDataFrame([], "window int, first_day date, last_day date")
    assert intervals.in_window_table(rows, "day", table).collect() == []
    one = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 1, 1))], table.schema)
    assert intervals.in_window_table(rows.limit(0), "day", one).collect() == []
    assert len(intervals.in_window_table(rows, "day", one).collect()) == 1


# === Levels ==============================================================================


def test_levels_at_once(spark):
    rows = [("n", "x", 1, 5), ("n", None, 1, 7), ("s", "x", 2, 1), (None, "x", 2, 2)]
    frame = spark.createDataFrame(rows, "a string, b string, k int, v int")
    chosen = [measures.count_rows("rows"), measures.count_distinct("keys", "k"), measures.total("v", "v")]
    levels = {"all": [], "by a": ["a"], "by both": ["a", "b"], "by b": ["b"]}
    found = measures.evaluate_levels(frame, chosen, levels)
    for name, dims in levels.items():
        plain = {tuple(r) for r in measures.evaluate(frame, chosen, dims).collect()}
        own = found.where(F.col("level") == name)
        assert {tuple(r) for r in own.select(*dims, "rows", "keys", "v").collect()} == plain
    assert plan_of(found).count("Scan ExistingRDD") == 1
    with pytest.raises(ValueError):
        measures.evaluate_levels(frame, chosen, {"x": ["a", "b"], "y": ["b", "a"]})


# === Slices ==============================================================================


def brute_slices(rows, dims, min_share, depth):
    """Rows: (values, num, den, num before, den before)."""
    totals = [sum(r[i] for r in rows) for i in range(1, 5)]
    out = {}
    for size in range(1, depth + 1):
        for group in itertools.combinations(range(len(dims)), size):
            sums = defaultdict(lambda: [0, 0, 0, 0])
            for values, *numbers in rows:
                key = tuple(values[i] if i in group else None for i in range(len(dims)))
                sums[key] = [a + b for a, b in zip(sums[key], numbers)]
            for key, (n1, d1, n0, d0) in sums.items():
                w1, w0 = d1 / totals[1] if totals[1] else 0, d0 / totals[3] if totals[3] else 0
                if max(w1, w0) < min_share:
                    continue
                r1, r0 = n1 / d1 if d1 else None, n0 / d0 if d0 else None
                now, then = (r1 if r1 is not None else r0) or 0, (r0 if r0 is not None else r1) or 0
                level = (totals[0] / totals[1] + totals[2] / totals[3]) / 2
                by_rate, by_mix = (w1 + w0) / 2 * (now - then) * 100, (w1 - w0) * ((now + then) / 2 - level) * 100
                out[",".join(dims[i] for i in group), key] = (n1, d1, n0, d0, round(by_rate + by_mix, 3))
    return out


@pytest.mark.parametrize("min_share, depth", [(0.0, 3), (0.03, 3), (0.1, 2), (0.2, 1)])
def test_slices_against_all(spark, min_share, depth):
    rng = random.Random(3)
    dims = ["a", "b", "c"]
    rows = []
    for values in itertools.product(["x", "y", None], ["p", "q"], [True, False, None]):
        d1, d0 = rng.choice([0, 1, 20, 60]), rng.choice([0, 3, 40])
        rows.append((values, rng.randint(0, d1), d1, rng.randint(0, d0), d0))
    frame = spark.createDataFrame(
        [(*v, *n) for v, *n in rows], "a string, b string, c boolean, r_num long, r_den long, r_num_prior long, r_den_prior long"
    )
    found = slices.rate_slices(frame, "r", dims, min_share, depth).collect()
    got = {(r.fixed, (r.a, r.b, r.c)): (r.r_num, r.r_den, r.r_num_prior, r.r_den_prior, round(r.points, 3)) for r in found}
    expected = brute_slices(rows, dims, min_share, depth)
    assert len(found) == len(got) and set(got) == set(expected)
    assert all(got[k][:4] == expected[k][:4] and abs(got[k][4] - expected[k][4]) < 0.002 for k in got)
    assert [r.points for r in found] == sorted(r.points for r in found)


def test_slices_of_one_set_of_dimensions_add_up(spark):
    rows = [("x", 10, 40, 30, 60), ("y", 5, 60, 20, 40)]
    frame = spark.createDataFrame(rows, "a string, r_num long, r_den long, r_num_prior long, r_den_prior long")
    found = slices.rate_slices(frame, "r", ["a"], 0.0).collect()
    assert abs(sum(r.points for r in found) - (15 / 100 - 50 / 100) * 100) < 1e-6
    assert slices.rate_slices(frame.limit(0), "r", ["a"]).collect() == []
    with pytest.raises(ValueError):
        slices.rate_slices(frame, "r", [])


# === Dense trends ========================================================================


def test_dense_trend_shows_periods_without_rows(spark):
    rows = [("n", "2024-01-01", 1.0), ("n", "2024-01-01", 3.0), ("n", "2024-04-01", 8.0), (None, "2024-02-01", 4.0), ("n", None, 1.0)]
    frame = spark.createDataFrame(rows, "g string, m string, v double").withColumn("m", F.col("m").cast("date"))
    chosen = [measures.count_rows("rows"), measures.average("mean", "v")]
    found = [
        (r.m.month, r.g, r.has_rows, r["rows"], r.rows_before, r.rows_change, r.mean, r.mean_before, r.mean_change)
        for r in compare.dense_trend(frame, chosen, "m", ["g"]).collect()
    ]
    assert found == [
        (1, None, False, 0, None, None, None, None, None), (1, "n", True, 2, None, None, 2.0, None, None),
        (2, None, True, 1, 0, 1, 4.0, None, None), (2, "n", False, 0, 2, -2, None, 2.0, None),
        (3, None, False, 0, 1, -1, None, 4.0, None), (3, "n", False, 0, 0, 0, None, None, None),
        (4, None, False, 0, 0, 0, None, None, None), (4, "n", True, 1, 0, 1, 8.0, None, None),
    ]


def test_dense_trend_without_groups_and_of_a_rate(spark):
    rows = [("2024-01-01", 1, 2), ("2024-01-15", 1, 1)]
    frame = spark.createDataFrame(rows, "w string, num int, den int").withColumn("w", F.col("w").cast("date"))
    found = compare.dense_trend(frame, measures.rate("r", "num", "den"), "w", step="7 days").collect()
    assert [(r.w.day, r.has_rows, r.r_num, r.r_rate, r.r_rate_points) for r in found] == [
        (1, True, 1, 0.5, None), (8, False, 0, None, None), (15, True, 1, 1.0, None)
    ]
    assert compare.dense_trend(frame.limit(0), measures.rate("r", "num", "den"), "w").collect() == []


# === Row reconciliation ==================================================================


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
def test_reconcile_rows(spark, buckets):
    same = [(i, f"n{i}", i * 2) for i in range(200)]
    source = spark.createDataFrame([*same, (500, "a", 1), (501, "b", 2), (502, None, 3), (503, "d", 4), (504, "e", 5), (504, "e", 5)], "k int, name string, v int")
    gold = spark.createDataFrame([*reversed(same), (500, "a", 9), (501, "x", 8), (502, None, 3), (504, "e", 5), (505, "f", 6), (None, "g", 7)], "k int, name string, v int")
    found = checks.reconcile_rows(source, gold, ["k"], ["name", "v"], buckets)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(500, 1, 1, ["v"]), (501, 1, 1, ["name", "v"]), (503, 1, 0, []), (504, 2, 1, []), (505, 0, 1, []), (None, 0, 1, [])], key=repr
    )
    assert checks.reconcile_rows(source, source, ["k"], ["name", "v"], buckets).collect() == []
    with pytest.raises(ValueError):
        checks.reconcile_rows(source, gold, [], ["v"])


# === Terms ===============================================================================


def test_terms_against_plain_search(spark):
    rng = random.Random(5)
    words = ["a", "b", "c", "dé", "E"]
    texts = [(i, " ".join(rng.choice(words) + rng.choice(["", ",", "-"]) for _ in range(rng.randrange(30)))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, "a a a a")]
    given = ["a", "A b", "a a", "dé", "b c a", "e a b c", "zzz", "a zzz", "", " , ", "a-b"]
    frame = spark.createDataFrame(texts, "id int, text string")
    table = spark.createDataFrame([(t,) for t in given + ["a"]], "term string")

    def split(text):
        return [w for w in "".join(ch if ch.isalnum() else " " for ch in (text or "").lower()).split()]

    expected = defaultdict(int)
    for i, text in texts:
        for term in given:
            n = len(split(term))
            for at in range(len(split(text)) - n + 1):
                if n and split(text)[at : at + n] == split(term):
                    expected[i, term] += 1
    found = terms.candidates(frame, "id", "text", table, "term")
    assert {(r.id, r.term): r.times for r in found.collect()} == expected
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


def test_terms_shuffle_the_places_of_their_pairs_only(spark):
    # All words of the terms are in every text; side by side they stand in the last two only.
    rng = random.Random(7)
    texts = [" ".join(f"{'ab'[i % 2]}{rng.randrange(40)}" for i in range(1000)) for _ in range(100)] + ["a1 a2 a3 a4", "b1 b2 a3 a4 b5 b1 b2 b3"]
    given = [("a1 a2 a3",), ("a2 a3 a4",), ("b1 b2 b3",), ("b1 b2 b3 b4",), ("a3 a4",)]
    indexed = staging.written(terms.index(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "id", "text"), "words")
    table = staging.written(spark.createDataFrame(given, "term string"), "terms")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "65536")
    try:
        found = terms.occurrences(indexed, table, "id", "term")
        rows = sorted(map(tuple, found.collect()))
    finally:
        spark.conf.set(threshold, before)
    assert rows == [(100, "a1 a2 a3", 0), (100, "a2 a3 a4", 1), (100, "a3 a4", 2), (101, "a3 a4", 2), (101, "b1 b2 b3", 5)]
    assert 0 < shuffled_rows(found) < 100


def shuffled_rows(frame):
    """Rows that the shuffles of an executed frame wrote."""

    def of(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return of(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return of(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
        return own + sum(of(node.children().apply(i)) for i in range(node.children().size()))

    return of(frame._jdf.queryExecution().executedPlan())
