"""What free text says of a thing it mentions: done, denied, past, planned, about someone else.

A text is cut into clauses. In each, mentions, cues and ends are found by their patterns and
put down in order, one sign each. A fold over the signs then carries the scopes: a cue opens
one for the mentions that follow, up to an end, or reaches back to those before it, or both.
What remains is every mention with the set of scopes it stands in.

Everything is a built-in expression, so it runs where the text is read. The signs of a clause
are few; the fold's cost is that of the mentions and cues, not of the words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.columns import as_column

NOTHING = r"(?!)"  # matches no text

# Scopes, as bits of a mention's mask.
NEGATED, PAST, OTHER, PLANNED, OFFERED = 1, 2, 4, 8, 16
SCOPES = {"negated": NEGATED, "past": PAST, "other": OTHER, "planned": PLANNED, "offered": OFFERED}

FORWARD, BACKWARD, BOTH = "forward", "backward", "both"
FIRST_SIGN = 0xE000  # of the private use area: no text's own character


@dataclass(frozen=True)
class Mention:
    """What is looked for: a name and its pattern. ``needs`` is what must stand in the same
    clause for the mention to count, as a pattern over the clause."""

    name: str
    pattern: str
    needs: str = ""


@dataclass(frozen=True)
class Cue:
    """A pattern that puts mentions into a scope, after it, before it, or on both sides.

    Inside a scope of its own kind a cue adds nothing, also not to what stands before it.
    """

    pattern: str
    scope: int
    direction: str = FORWARD


@dataclass(frozen=True)
class End:
    """A pattern after which the given scopes no longer reach forward."""

    pattern: str
    scopes: int


@dataclass(frozen=True)
class Lift:
    """A pattern that takes the given scopes off all mentions of its clause; with ``before``
    also off those of the clause before, if its own has none."""

    pattern: str
    scopes: int
    before: bool = False


@dataclass(frozen=True)
class ScopeRules:
    """Everything a text is read by. Patterns are matched in lower case, earlier ones first:
    what one has taken, a later one does not see. ``neutral`` ones take text and say nothing.

    ``topic``, ``other_topic``: what a clause must be about, and what it is about instead, so
    that the topic of the clause before does not carry over. ``refusal``: a clause that holds
    it, and no mention and no topic, takes back the clause before.
    """

    mentions: tuple[Mention, ...]
    cues: tuple[Cue, ...] = ()
    ends: tuple[End, ...] = ()
    lifts: tuple[Lift, ...] = ()
    neutral: tuple[str, ...] = ()
    topic: str = ""
    other_topic: str = NOTHING
    refusal: str = NOTHING
    boundary: str = r"[.;!?\n]+"

    def any_mention(self) -> str:
        """A pattern that every text with a mention matches; ``(?i)`` included."""
        return "(?i)" + "|".join(f"(?:{mention.pattern})" for mention in self.mentions)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once for the row, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _signed(rules: ScopeRules) -> list[tuple[str, str, object]]:
    """Sign, pattern and meaning of everything that leaves one, in the order of matching:
    cues and lifts before mentions, so that a cue may hold a mention's words; ends last."""
    meant = [*rules.cues, *rules.lifts, *rules.mentions, *rules.ends]
    return [(chr(FIRST_SIGN + at), item.pattern, item) for at, item in enumerate(meant)]


def _signs(clause: Column, rules: ScopeRules) -> Column:
    """The clause's signs, one character each, in order; all other text is gone."""
    text = F.lower(clause)
    for pattern in rules.neutral:
        text = F.regexp_replace(text, pattern, "  ")
    signed = _signed(rules)
    for sign, pattern, _ in signed:
        text = F.regexp_replace(text, pattern, f" {sign} ")
    if not signed:
        return F.lit("")
    return F.regexp_replace(text, f"[^{signed[0][0]}-{signed[-1][0]}]+", "")


def _fold(signs: Column, rules: ScopeRules) -> Column:
    """Array of (name, mask) of a clause's mentions, from its signs."""
    opens, reaches, closes, names = [], [], [], []
    for _, _, item in _signed(rules):
        cue = isinstance(item, Cue)
        opens.append(item.scope if cue and item.direction != BACKWARD else 0)
        reaches.append(item.scope if cue and item.direction != FORWARD else 0)
        closes.append(item.scopes if isinstance(item, End) else 0)
        names.append(item.name if isinstance(item, Mention) else None)

    def entry(values: list, at: Column) -> Column:
        return F.get(F.array(*[F.lit(value) for value in values]), at)

    start = F.struct(
        F.lit(0).alias("open"), F.array().cast("array<struct<name:string,mask:int>>").alias("found")
    )

    def step(state: Column, sign: Column) -> Column:
        def of(at: Column) -> Column:
            back = entry(reaches, at).bitwiseAND(F.bitwise_not(state["open"]))
            reached = F.when(back == 0, state["found"]).otherwise(
                F.transform(state["found"], lambda m: F.struct(m["name"].alias("name"), m["mask"].bitwiseOR(back).alias("mask")))
            )
            name = entry(names, at)
            new = F.array(F.struct(name.alias("name"), state["open"].alias("mask")))
            still = state["open"].bitwiseAND(F.bitwise_not(entry(closes, at)))
            return F.struct(
                still.bitwiseOR(entry(opens, at)).alias("open"),
                F.when(name.isNull(), reached).otherwise(F.concat(reached, new)).alias("found"),
            )

        return bind(F.ascii(sign) - F.lit(FIRST_SIGN), of)

    each = F.filter(F.split(signs, ""), lambda sign: sign != "")
    return F.aggregate(each, start, step, lambda state: state["found"])


def _lifted(signs: Column, rules: ScopeRules, before: bool) -> Column:
    """The scopes that a clause's lifts take off its mentions, or off those before it."""
    off = F.lit(0)
    for sign, _, item in _signed(rules):
        if isinstance(item, Lift) and (item.before or not before):
            off = off.bitwiseOR(F.when(signs.contains(sign), item.scopes).otherwise(0))
    return off


def read_clauses(text: Column | str, rules: ScopeRules) -> Column:
    """Every clause in the text's order, as a struct: ``clause``, ``about`` the topic, ``taken``
    back by the one that follows, and ``mentions``, an array of (name, mask)."""
    mention_signs = "".join(sign for sign, _, item in _signed(rules) if isinstance(item, Mention))

    def mentions_none(signs: Column) -> Column:
        return F.translate(signs, mention_signs, "") == signs

    def one(clause: Column) -> Column:
        return bind(
            F.lower(clause),
            lambda low: F.struct(
                F.trim(clause).alias("clause"),
                _signs(clause, rules).alias("signs"),
                low.rlike(rules.topic).alias("topic"),
                low.rlike(rules.other_topic).alias("other"),
                low.rlike(rules.refusal).alias("refusal"),
                F.array(*[
                    F.lit(mention.name) if not mention.needs else F.when(low.rlike(mention.needs), F.lit(mention.name))
                    for mention in rules.mentions
                ]).alias("counted"),
            ),
        )

    def joined(parts: Column) -> Column:
        size = F.size(parts)
        nothing = F.lit(None)
        before = F.concat(F.array(nothing), F.slice(parts, F.lit(1), size - 1))
        after = F.concat(F.slice(parts, F.lit(2), size), F.array(nothing))
        beside = F.arrays_zip(parts.alias("this"), before.alias("before"), after.alias("after"))

        def read(entry: Column) -> Column:
            this, then, later = entry["this"], entry["before"], entry["after"]
            carried = F.coalesce(then["topic"], F.lit(False)) & ~this["other"]
            alone = mentions_none(later["signs"])
            taken = later["refusal"] & alone & (~later["topic"] if rules.topic else F.lit(True))
            off = _lifted(this["signs"], rules, False).bitwiseOR(
                F.when(alone, _lifted(later["signs"], rules, True)).otherwise(0)
            )
            left = F.bitwise_not(off)
            mentions = F.transform(
                F.filter(_fold(this["signs"], rules), lambda m: F.array_contains(this["counted"], m["name"])),
                lambda m: F.struct(m["name"].alias("name"), m["mask"].bitwiseAND(left).alias("mask")),
            )
            return F.struct(
                this["clause"].alias("clause"),
                (this["topic"] | carried).alias("about"),
                F.coalesce(taken, F.lit(False)).alias("taken"),
                mentions.alias("mentions"),
            )

        return F.transform(beside, read)

    clauses = F.transform(F.split(as_column(text), rules.boundary), one)
    return bind(clauses, joined)


def scoped_phrases(text: Column | str, rules: ScopeRules) -> Column:
    """Every clause with a mention in no scope that is about the topic and not taken back, in
    the text's order; empty without one. Texts without any mention are not folded."""
    clauses = bind(
        read_clauses(text, rules),
        lambda read: F.transform(
            F.filter(
                read,
                lambda c: c["about"] & ~c["taken"] & F.exists(c["mentions"], lambda m: m["mask"] == 0),
            ),
            lambda c: c["clause"],
        ),
    )
    empty = F.array().cast("array<string>")
    return F.coalesce(F.when(as_column(text).rlike(rules.any_mention()), clauses), empty)


def mention_rows(text: Column | str, rules: ScopeRules) -> Column:
    """Array of every mention: ``clause`` (its number from 0), ``name``, ``about``, ``taken`` and
    a flag for each scope."""
    def flat(read: Column) -> Column:
        return F.flatten(F.transform(read, lambda c, at: F.transform(c["mentions"], lambda m: F.struct(
            at.alias("clause"), m["name"].alias("name"), c["about"].alias("about"), c["taken"].alias("taken"),
            *[(m["mask"].bitwiseAND(F.lit(bit)) != 0).alias(name) for name, bit in SCOPES.items()],
        ))))

    found = bind(read_clauses(text, rules), flat)
    return F.when(as_column(text).rlike(rules.any_mention()), found)
