"""Quality rules with risk-controlled cutoffs, in built-in functions only.

Fixed base rules come first. Of the documents that pass them, each further rule rejects
those whose share of something is above a cutoff. The cutoff is chosen for each stratum
from labelled documents, among those cutoffs for which an exact binomial test shows, with
correction for the number of tests, that no more than the rule's risk of good documents
is rejected. Without enough labels in a stratum a rule rejects nothing there.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.shared import fresh, written
from tallymark.llm.texts import BLANKS, GAP, text_or_empty

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
STEPS = 50  # cutoffs of 1 to 50 percent
#: Part and whole of each rule's share, and its risk: the share of good documents it may reject.
RULES = {
    "symbols": ("n_symbols", "word_chars", 0.03),
    "dup_lines": ("n_dup_lines", "n_word_lines", 0.01),
    "repeats": ("n_repeat_words", "n_words", 0.01),
}
CONFIDENCE_LOST = 0.05  # chance that any bound of any stratum and rule is wrong
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count(column: Column) -> Column:
    return F.size(column).cast("long")


def _triples(hashes: Column) -> Column:
    """One hash for each window of three words."""
    last = F.size(hashes) - 3
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )


def _covered(triples: Column) -> Column:
    """Number of words in windows that occur twice or more: equal windows meet by sorting."""

    def twins(placed: Column) -> Column:
        n = F.size(placed) - 1
        places = F.zip_with(
            F.slice(placed, F.lit(1), n),
            F.slice(placed, F.lit(2), n),
            lambda x, y: F.when(x["hash"] == y["hash"], F.array(x["at"], y["at"])).otherwise(
                F.array().cast("array<int>")
            ),
        )
        starts = F.array_distinct(F.flatten(places))
        words = F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))
        return _count(F.array_distinct(words))

    placed = F.transform(triples, lambda h, at: F.struct(h.alias("hash"), at.alias("at")))
    return bind(F.sort_array(placed), twins)


def _repeated(hashes: Column) -> Column:
    def judged(triples: Column) -> Column:
        none = F.size(F.array_distinct(triples)) == F.size(triples)
        return F.when(none, F.lit(0).cast("long")).otherwise(_covered(triples))

    enough = F.size(hashes) >= 4
    return F.when(enough, bind(_triples(hashes), judged)).otherwise(F.lit(0).cast("long"))


def counts(text: Column) -> Column:
    """Struct of the counts that the rules are made of, over the whole text."""
    text = text_or_empty(text)
    words = F.filter(F.split(text, GAP), lambda word: word != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    by_word = bind(
        words,
        lambda w: F.struct(
            _count(w).alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            bind(F.transform(w, lambda word: F.xxhash64(word)), _repeated).alias("n_repeat_words"),
        ),
    )
    by_line = bind(
        lines,
        lambda kept: F.struct(
            _count(kept).alias("n_word_lines"),
            (_count(kept) - _count(F.array_distinct(kept))).alias("n_dup_lines"),
        ),
    )
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols")
    return F.struct(by_word.alias("by_word"), by_line.alias("by_line"), symbols)


def with_counts(docs: DataFrame, struct: str) -> DataFrame:
    """``docs`` with a struct of all counts and ``base_failed``.

    The counts come out of a one-element array, which filters that follow do not pass, so
    they are made once for each row.
    """
    raw = docs.select("*", F.explode(F.array(counts(F.col("text")))).alias(struct))
    part = F.col(struct)
    flat = {
        **{name: part["by_word"][name] for name in ("n_words", "word_chars", "n_repeat_words")},
        **{name: part["by_line"][name] for name in ("n_word_lines", "n_dup_lines")},
        "n_symbols": part["n_symbols"],
    }
    failed = (flat["n_words"] < MIN_WORDS) | (
        100 * flat["n_repeat_words"] > MAX_REPEATED_PERCENT * flat["n_words"]
    )
    return raw.withColumn(
        struct, F.struct(*[c.alias(name) for name, c in flat.items()], failed.alias("base_failed"))
    )


def _level(part: Column, whole: Column) -> Column:
    """The strictest step that still rejects: the largest c with 100 part > c whole."""
    exact = F.when(whole > 0, F.expr("-1") + F.ceil(100 * part / whole)).otherwise(F.lit(-1))
    return F.least(exact, F.lit(STEPS)).cast("int")


def most_errors(n: Column, risk: float, level: Column) -> Column:
    """Largest k whose binomial tail P(X <= k), X ~ Bin(n, risk), is at most ``level``; -1 if none.

    Up to k rejected of n good documents refute, at that level, a rate above ``risk``.
    """
    odds = math.log(risk) - math.log1p(-risk)
    first = F.struct(
        (n * math.log1p(-risk)).alias("log_term"), F.lit(0.0).alias("tail"), F.lit(-1).alias("most")
    )

    def step(state: Column, k: Column) -> Column:
        tail = state["tail"] + F.exp(state["log_term"])
        return F.struct(
            # At k = n the next term is void; the guard keeps its logarithm defined.
            (state["log_term"] + F.log(F.greatest(n - k, F.lit(1)) / (k + 1)) + odds).alias("log_term"),
            tail.alias("tail"),
            F.when(tail <= level, k).otherwise(state["most"]).alias("most"),
        )

    ks = F.sequence(F.lit(0), F.least(n, F.ceil(n * risk) + 1).cast("int"))
    return F.aggregate(ks, first, step, lambda state: state["most"])


def cutoffs(judged: DataFrame, labels: DataFrame, rules: Mapping = RULES, lost: float = CONFIDENCE_LOST) -> DataFrame:
    """``stratum, rule, cutoff``: chosen percentages; strata and rules without one are absent.

    ``judged``: ``doc_id, stratum, counts`` (see ``with_counts``). Stricter cutoffs reject
    more, so the tests of one stratum and rule go from the mildest cutoff on and stop at
    the first that fails, which needs no correction; ``lost`` is divided by the number of
    strata and rules. Among the proven cutoffs the one with most bad less good documents
    rejected is taken, the middle one of those that tie, and none if it gains nothing.
    """
    labelled = labels.where("quality is not null").select(
        F.col("doc_id").alias("labelled_id"), (F.col("quality") == 1).alias("good")
    ).distinct()
    seen = judged.join(labelled, F.col("doc_id") == F.col("labelled_id")).where("not counts.base_failed")
    per_rule = F.explode(
        F.array(*[
            F.struct(
                F.lit(rule).alias("rule"),
                _level(F.col(f"counts.{part}"), F.col(f"counts.{whole}")).alias("level"),
            )
            for rule, (part, whole, _) in rules.items()
        ])
    )
    histogram = (
        seen.select("stratum", "good", per_rule.alias("at"))
        .groupBy("stratum", "at.rule", "at.level")
        .agg(F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad"))
    )
    # From here on: strata x rules x steps rows. Level 0 stands for all documents.
    steps = histogram.select(
        "stratum", "rule", F.explode(F.sequence(F.lit(0), F.greatest("level", F.lit(0)))).alias("cutoff"), "n_good", "n_bad"
    ).groupBy("stratum", "rule", "cutoff").agg(F.sum("n_good").alias("good"), F.sum("n_bad").alias("bad"))
    totals = steps.where("cutoff = 0").select("stratum", "rule", F.col("good").alias("n"))
    bounds = totals.withColumn("n_tests", F.count("*").over(Window.partitionBy()))
    level = F.lit(lost) / F.col("n_tests")
    most = reduce(
        lambda chain, rule: chain.when(F.col("rule") == rule, most_errors(F.col("n"), rules[rule][2], level)),
        rules,
        F.when(F.lit(False), F.lit(-1)),
    )
    bounds = bounds.select(F.col("stratum").alias("s"), F.col("rule").alias("r"), most.alias("most"))
    proven = steps.where("cutoff > 0").join(
        bounds, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("rule") == F.col("r"))
    ).where("good <= most and bad > good")
    ranked = proven.groupBy("stratum", "rule", (F.col("bad") - F.col("good")).alias("gain")).agg(
        F.sort_array(F.collect_list("cutoff")).alias("tied")
    )
    best = ranked.groupBy("stratum", "rule").agg(F.max_by("tied", "gain").alias("tied"))
    return best.select(
        "stratum", "rule", F.get("tied", ((F.size("tied") - 1) / 2).cast("int")).alias("cutoff")
    )


def learned(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each stratum that has a cutoff: ``stratum`` and each rule's cutoff.

    ``counted``: ``doc_id, stratum, counts``, as written once.
    """
    chosen = cutoffs(counted, labels)
    pivoted = chosen.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in RULES]
    )
    # Written, so that its true size decides how it is joined to the documents.
    return written(pivoted, "cutoffs")


def _verdict(counted: DataFrame, labels: DataFrame, stratum: str, counts: str, kept: str) -> DataFrame:
    """The rows of ``counted``, which is read twice and so should be written, with the verdict."""
    narrow = counted.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(stratum).alias("stratum"), F.col(counts).alias("counts")
    )
    cuts = learned(narrow, labels)
    of, *names = fresh(counted, "stratum_of", *[f"cut_{rule}" for rule in RULES])
    cuts = cuts.select(F.col("stratum").alias(of), *[F.col(f"cut_{rule}").alias(n) for rule, n in zip(RULES, names)])
    over = reduce(
        lambda x, y: x | y,
        [
            F.coalesce(100 * F.col(f"{counts}.{part}") > F.col(name) * F.col(f"{counts}.{whole}"), F.lit(False))
            for name, (part, whole, _) in zip(names, RULES.values())
        ],
    )
    joined = counted.join(cuts, F.col(stratum).eqNullSafe(F.col(of)), "left")
    return joined.withColumn(kept, ~F.col(f"{counts}.base_failed") & ~over).drop(of, *names)


def keep(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs``, with all columns and no other, that the rules keep.

    A null or empty text has no words and fails the base rules. A null stratum is a stratum.
    Labels with a null quality or an unknown document count for nothing; of a document
    that is labelled good and bad both labels count. Repeated rows get equal verdicts, and
    count as often as they occur. No rows give no rows, no labels reject nothing beyond
    the base rules. The texts are counted once, and written beside their counts.
    """
    counts, kept = fresh(docs, "counts", "kept")
    counted = written(with_counts(docs, counts), "counted")
    return _verdict(counted, labels, stratum, counts, kept).where(kept).select(*docs.columns)


def verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every row; see ``keep``."""
    counted = with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(stratum).alias("stratum"), "text"), "counts")
    counted = written(counted.select("doc_id", "stratum", "counts"), "counts")
    judged = _verdict(counted, labels, "stratum", "counts", "kept")
    return judged.select(
        "doc_id", *[F.col(f"counts.{name}").alias(name) for name in COUNTS], F.col("counts.base_failed").alias("base_failed"), "kept"
    )
