"""Conversations as training windows of a limited size, in built-in functions only.

Prefix sums of the turns' tokens cut a conversation into spans of whole turns. Each span
becomes a window: the system turn, a limited history of turns before the span, and the
span's turns. The answers of the span are marked as loss; what is repeated is not, so that
each answer is learnt once. Control strings inside texts are escaped, reversibly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.shared import written
from tallymark.llm.texts import text_or_empty, word_count

# The template's marks.
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM, ASSISTANT = "system", "assistant"
MARK_TOKENS = 4  # of a turn: its start, role, end and line break
BUDGET, HISTORY = 512, 128  # tokens of a window, and of its repeated history
CELL = 256  # turn numbers whose prefix sums are made together
NO_CONVERSATION = -(2**63)  # stands for a null conv_id, so that joins compare plain numbers


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\\`` and ``<|`` becomes ``<\|``, so that no mark is left in a text."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escape_role(role: Column) -> Column:
    r"""As a text; a line break, which ends the role, becomes ``\n``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # An odd backslash before the n; pairs before it are backslashes themselves.
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


ORDER = ("turn", "role", "tokens", "digest")  # of a conversation's turns, null first


def placed(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """``conv_id, position, role, text, tokens, is_system, begin, window``: every turn with its
    place, the tokens before it (without the system turn's) and the window of its span.

    The prefix sums go over cells of turn numbers first, and then over the turns of one
    cell, so a conversation of any length is spread over many tasks. The room of a window is
    the budget less the history and the conversation's system turn. Turns that lie whole
    between two multiples of the room are one span; a turn that lies across a multiple is a
    span of its own. So only a window of a single new turn can be over the budget.
    """
    counted = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_CONVERSATION)).alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        text_or_empty("role").alias("role"),
        text_or_empty("text").alias("text"),
    ).withColumns({"tokens": word_count(F.col("text")) + MARK_TOKENS, "digest": F.md5("text")})
    counted = counted.withColumn("cell", F.coalesce(F.floor(F.col("turn") / CELL), F.lit(-(2**62))))
    cells = counted.groupBy("conv_id", "cell").agg(
        F.sum("tokens").alias("cell_tokens"),
        F.count("*").alias("cell_turns"),
        F.min(F.struct("turn", "role", "tokens")).alias("first"),
    )
    up_to = Window.partitionBy("conv_id").orderBy("cell")
    earlier = up_to.rowsBetween(Window.unboundedPreceding, -1)
    head = F.first("first").over(up_to)
    cells = cells.select(
        F.col("conv_id").alias("of"),
        F.col("cell").alias("of_cell"),
        F.coalesce(F.sum("cell_tokens").over(earlier), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("cell_turns").over(earlier), F.lit(0)).alias("turns_before"),
        F.when(head["role"] == SYSTEM, head["tokens"]).otherwise(F.lit(0)).alias("system_tokens"),
    )
    inside = Window.partitionBy("conv_id", "cell").orderBy(*ORDER)
    sums = counted.withColumns(
        {
            "nth": F.row_number().over(inside) - 1,
            "sum": F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    same = (F.col("conv_id") == F.col("of")) & (F.col("cell") == F.col("of_cell"))
    joined = sums.join(cells, same).withColumn("position", F.col("turns_before") + F.col("nth"))
    is_system = (F.col("position") == 0) & (F.col("role") == SYSTEM)
    system = F.col("system_tokens")
    room = F.greatest(F.lit(budget - history) - system, F.lit(1))
    before = F.col("tokens_before") + F.col("sum") - F.col("tokens")
    begin = F.when(is_system, F.lit(0)).otherwise(before - system)
    first_cell, last_cell = F.floor(begin / room), F.floor((begin + F.col("tokens") - 1) / room)
    window = F.when(is_system, F.lit(0)).otherwise(2 * first_cell + (first_cell != last_cell).cast("long"))
    return joined.select(
        "conv_id", "position", "role", "text", "tokens", is_system.alias("is_system"),
        begin.cast("long").alias("begin"), window.cast("long").alias("window"),
    )


def repeats(turns: DataFrame, history: int) -> DataFrame:
    """``conv_id, position, again``: the windows that repeat a turn of an earlier one."""
    slim = turns.select("conv_id", "position", "is_system", "begin", "window")
    windows = slim.groupBy("conv_id", "window").agg(
        F.min(F.when(~F.col("is_system"), F.col("begin"))).alias("opens"),
        F.bool_or("is_system").alias("has_system"),
    )
    targets = windows.select(
        F.col("conv_id").alias("of"), F.col("window").alias("to"), "opens", "has_system",
        F.floor(F.col("opens") / history).alias("at"),
    )
    same = F.col("conv_id") == F.col("of")
    headed = slim.where("is_system").join(targets.where(~F.col("has_system")), same)
    # A turn is history of the windows that open up to ``history`` tokens after its begin.
    # They open in the turn's stretch of so many tokens, or in the next: an equi-join.
    stretch = F.floor(F.col("begin") / history)
    earlier = slim.where(~F.col("is_system")).withColumn("stretch", F.explode(F.array(stretch, stretch + 1)))
    near = (
        same
        & (F.col("stretch") == F.col("at"))
        & (F.col("begin") < F.col("opens"))
        & (F.col("begin") >= F.col("opens") - history)
    )
    recalled = earlier.join(targets.where("opens > 0"), near)
    found = headed.select("conv_id", "position", "to").unionAll(recalled.select("conv_id", "position", "to"))
    return found.groupBy("conv_id", "position").agg(F.collect_list("to").alias("again"))


def members(turns: DataFrame, history: int) -> DataFrame:
    """``conv_id, window, position, repeated, role, text, tokens``: the turns of each window.

    The windows are planned without the texts, which are dealt out once at the end.
    """
    again = repeats(turns, history).withColumnsRenamed({"conv_id": "of", "position": "of_position"})
    same = (F.col("conv_id") == F.col("of")) & (F.col("position") == F.col("of_position"))
    own = F.array(F.struct(F.col("window"), F.lit(False).alias("repeated")))
    more = F.transform(
        F.coalesce("again", F.array().cast("array<long>")),
        lambda to: F.struct(to.alias("window"), F.lit(True).alias("repeated")),
    )
    dealt = turns.join(again, same, "left").withColumn("to", F.explode(F.concat(own, more)))
    return dealt.select("conv_id", "to.window", "to.repeated", "position", "role", "text", "tokens")


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """``conv_id, window, formatted, n_repeated, loss, n_tokens``: one row for each window.

    ``loss`` lists the places (start from 0, and length, in code points) of the answers to
    learn in ``formatted``; the first ``n_repeated`` turns repeat earlier windows.
    Turns are ordered by ``turn`` (null first), then role, number of tokens and the text's
    MD5; repeated rows are turns of their own. A null role or text counts as empty; a null ``conv_id`` is a
    conversation. The first turn is the system turn if its role is ``system``.
    ``history`` must be positive and below ``budget``. Other columns are not read; no rows
    give no rows.
    """
    if not 0 < history < budget:
        raise ValueError("the history must be positive and below the budget")
    # Written, as both the plan of the windows and their texts come from it.
    turns = written(placed(conversations, budget, history), "turns")
    grouped = members(turns, history).groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("position", "repeated", "role", "text"))).alias("turns"),
        F.count_if("repeated").alias("n_repeated"),
        F.sum("tokens").alias("n_tokens"),
    )
    heads = F.transform("turns", lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")))
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    learn = F.transform("turns", lambda t: (t["role"] == ASSISTANT) & ~t["repeated"])
    conv_id = F.nullif(F.col("conv_id"), F.lit(NO_CONVERSATION)).alias("conv_id")
    parted = grouped.select(
        conv_id, "window", "n_repeated", "n_tokens", F.arrays_zip(heads.alias("head"), bodies.alias("body"), learn.alias("learn")).alias("parts")
    )
    tail = len(END) + 1

    def add(state: Column, part: Column) -> Column:
        start = state["length"] + F.length(part["head"])
        size = F.length(part["body"])
        here = F.array(F.struct(start.alias("start"), size.alias("length")))
        none = F.array().cast("array<struct<start:int,length:int>>")
        return F.struct(
            (start + size + tail).alias("length"),
            F.concat(state["loss"], F.when(part["learn"], here).otherwise(none)).alias("loss"),
        )

    zero = F.struct(
        F.lit(0).alias("length"), F.array().cast("array<struct<start:int,length:int>>").alias("loss")
    )
    text = F.array_join(
        F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), ""
    )
    return parted.select(
        "conv_id", "window", text.alias("formatted"), "n_repeated",
        F.aggregate("parts", zero, add, lambda state: state["loss"]).alias("loss"), "n_tokens",
    )


def read_back(formed: DataFrame) -> DataFrame:
    """``conv_id, window, turns, answers``: the new turns and the text under the loss, as
    parsed from ``formatted`` alone, unescaped."""
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda piece: piece != "")

    def parsed(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
        at = F.position(F.lit("\n"), body)
        return F.struct(
            unescape_role(F.substring(body, F.lit(1), at - 1)).alias("role"),
            unescape(F.substring(body, at + 1, F.length(body))).alias("text"),
        )

    new = F.slice(pieces, F.col("n_repeated").cast("int") + 1, F.greatest(F.size(pieces), F.lit(1)))
    answers = F.transform(
        "loss", lambda at: unescape(F.substring(F.col("formatted"), at["start"] + 1, at["length"]))
    )
    return formed.select(
        "conv_id", "window", F.length("formatted").cast("long").alias("formatted_chars"),
        F.transform(new, parsed).alias("turns"), answers.alias("answers"),
    )


def digests(formed: DataFrame) -> DataFrame:
    """One row for each conversation, of what its windows hold.

    A digest runs over a conversation's whole text, so here, and only here, the texts of
    one conversation come together.
    """
    whole = read_back(formed).select(
        "conv_id", "window", "formatted_chars", F.size("turns").alias("n_turns"),
        F.array_join(
            F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
        ).alias("turns"),
        F.array_join("answers", "").alias("answers"),
    ).groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.sum("formatted_chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("window", "turns", "answers"))).alias("parts"),
    )
    turns = F.array_join(F.transform("parts", lambda p: p["turns"]), "")
    answers = F.array_join(F.transform("parts", lambda p: p["answers"]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(turns, 256).alias("turns_sha256"),
        F.length(answers).cast("long").alias("loss_chars"), F.sha2(answers, 256).alias("loss_sha256"),
        "formatted_chars",
    )
