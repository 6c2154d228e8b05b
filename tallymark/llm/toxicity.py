"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel compares two short texts by the subsequences of four symbols that they share,
each weighted by how far it is stretched; so a word with an inserted character, or with
gaps, is still close to the word itself. The kernel to a few landmark words (Nyström's
method) gives each place of a text a short vector, and a linear support vector machine is
trained on the places that labelled sentences are marked by. As both are linear in the
subsequences, the trained machine is one table of a weight for each subsequence: a whole
text is scored by looking up its subsequences, in time and memory that grow with its length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tallymark.llm.shared import written
from tallymark.llm.texts import held_out, rows_of

SYMBOLS = 40  # a break, a to z, and 13 classes of other letters
LENGTH = 4  # symbols of a subsequence
STRETCH = 7  # symbols from its first to its last, at most
DECAY = 0.8  # for each symbol that it is stretched by
SPAN = 14  # symbols of a place
LANDMARKS = 160
RIDGE = 1e-3
DOCS_PER_LABEL = 1_500  # bound of the training sample
CHARS_PER_DOC = 20_000  # of longer documents, so much in sentences chosen by hash is learnt from
ROUNDS = 3  # of choosing the marking places and training again
THINNED_WEIGHT = 0.1  # of toxic documents with all insults but one left out
SPELLINGS = 1  # gapped or inserted-character variants of each marking place
AT_ONCE = 1 << 18  # symbols of a text that are scored together
THRESHOLD = 0.3
WORD = regex.compile(r"\p{L}+")
SENTENCE = regex.compile(r"[^\n!.?|]{1,1000}[\n!.?|]*|[\n!.?|]+")  # a very long one in pieces

#: Places of a subsequence's other symbols after its first, and the weight of each form.
FORMS = list(combinations(range(1, STRETCH), LENGTH - 1))
WEIGHTS = [DECAY ** (c + 1 - LENGTH) for _, _, c in FORMS]


def _symbol_table() -> np.ndarray:
    table = np.zeros(0x10000, np.uint8)
    for code in range(0x10000):
        if 97 <= code <= 122:
            table[code] = code - 96
        elif code > 127 and not 0xD800 <= code < 0xE000 and chr(code).isalpha():
            table[code] = 27 + code % (SYMBOLS - 27)
    return table


TABLE = _symbol_table()


def symbols(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's symbols, runs of other characters being one break; and the places where
    sentences begin.

    Single characters other than letters and blanks between two letters are left out, and
    so are breaks between letters that stand alone: spelled-out words become words.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    found = TABLE[np.minimum(codes, 0xFFFF)]
    letter = found > 0
    before, after = np.r_[False, letter[:-1]], np.r_[letter[1:], False]
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    joint = ~letter & ~blank & before & after
    # A letter alone: no letter on either side. Breaks between two such are left out.
    alone = letter & ~before & ~after
    alone_before, alone_after = np.r_[False, alone[:-1]], np.r_[alone[1:], False]
    joint |= ~letter & alone_before & alone_after
    ends = np.isin(codes, [10, 33, 46, 63, 124]) & ~joint
    keep = ~joint & (letter | before | np.r_[True, np.zeros(max(0, len(codes) - 1), bool)][: len(codes)])
    sentence = np.cumsum(ends) - ends
    kept = np.r_[0, found[keep], 0].astype(np.int32)
    sentence = np.r_[0, sentence[keep], sentence[-1] if len(sentence) else 0]
    starts = np.flatnonzero(np.r_[True, sentence[1:] != sentence[:-1]])
    return kept, starts


def subsequences(of: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each form, the number of the subsequence that begins at each place.

    The text counts as followed by breaks, so that every place begins one of each form.
    """
    n = len(of)
    padded = np.r_[of, np.zeros(STRETCH, np.int32)]
    by_power = [padded * SYMBOLS**p for p in range(LENGTH)]
    for (a, b, c), weight in zip(FORMS, WEIGHTS):
        yield (
            by_power[3][:n] + by_power[2][a : n + a] + by_power[1][b : n + b] + by_power[0][c : n + c]
        ), weight


def place_sums(values: np.ndarray) -> np.ndarray:
    """Sum over the places of one span, for the span that begins at each symbol."""
    total = np.cumsum(np.concatenate([np.zeros((1, *values.shape[1:]), np.float64), values]), axis=0)
    n = len(values)
    return total[np.minimum(np.arange(n) + SPAN - STRETCH + 1, n)] - total[:-1]


def landmark_table(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The subsequences that landmarks have, and each one's weight in each landmark; the
    landmarks are of length one in the kernel's space."""
    rows: dict[int, dict[int, float]] = {}
    for j, word in enumerate(words):
        of, _ = symbols(word)
        found: Counter = Counter()
        for (*_, last), (numbers, weight) in zip(FORMS, subsequences(of)):
            for number in numbers[: max(0, len(of) - last)]:
                found[int(number)] += weight
        size = np.sqrt(sum(v * v for v in found.values()))
        for number, value in found.items():
            rows.setdefault(number, {})[j] = value / size
    numbers = np.array(sorted(rows))
    weights = np.zeros((len(numbers), len(words)))
    for i, number in enumerate(numbers):
        for j, value in rows[int(number)].items():
            weights[i, j] = value
    return numbers, weights


@dataclass
class Machine:
    """The trained machine, folded into one weight for each subsequence."""

    weights: np.ndarray  # of every subsequence
    offset: float
    calibration: np.ndarray  # of the document's facts
    centre: np.ndarray
    scale: np.ndarray


def margins(of: np.ndarray, weights: np.ndarray, offset: float) -> np.ndarray:
    """The machine's output for the place that begins at each symbol."""
    value = np.zeros(len(of), np.float32)
    for numbers, weight in subsequences(of):
        value += np.float32(weight) * weights[numbers]
    return place_sums(value) + offset


def text_margins(text: str, weights: np.ndarray, offset: float) -> np.ndarray:
    """The best margin of each sentence of a text. Long texts are scored in overlapping
    pieces, with the result of the whole."""
    of, starts = symbols(text)
    if len(of) <= AT_ONCE:
        best = margins(of, weights, offset)
    else:
        overlap = SPAN + STRETCH
        best = np.concatenate(
            [
                margins(of[at : at + AT_ONCE + overlap], weights, offset)[:AT_ONCE]
                for at in range(0, len(of), AT_ONCE)
            ]
        )
    return np.maximum.reduceat(best, starts)


def facts(sentence_margins: np.ndarray, n_symbols: int) -> np.ndarray:
    """What a document's probability is made of: the best margins, and how many and how
    dense the sentences are that are marked."""
    top = np.sort(sentence_margins)[::-1][:3]
    top = np.r_[top, np.full(3 - len(top), top[-1])]
    marked = int((sentence_margins > 0).sum())
    return np.r_[np.clip(top, -3, 3), np.log1p(marked), 1000 * marked / (n_symbols + 200)]


def thinned(sentence_margins: np.ndarray) -> np.ndarray | None:
    """The sentences that a toxic document has if only its best marked one is left of those
    that are marked; None if there is nothing to leave out."""
    marked = np.flatnonzero(sentence_margins > 0)
    if len(marked) < 2:
        return None
    left_out = marked[marked != marked[sentence_margins[marked].argmax()]]
    return np.delete(sentence_margins, left_out)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method; the last weight is the offset."""
    x = np.c_[x, np.ones(len(x))]
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        beta += np.linalg.solve(hessian, x.T @ (weight * (y - p)) - ridge * beta)
    return beta


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine by Newton steps; y is 1 or -1."""
    z = np.c_[x, np.ones(len(x))]
    beta = np.zeros(z.shape[1])
    penalty = ridge * len(x) * np.r_[np.ones(x.shape[1]), 1e-6]
    for _ in range(30):
        active = y * (z @ beta) < 1
        a = z[active]
        hessian = (a * weight[active, None]).T @ a + np.diag(penalty)
        new = np.linalg.solve(hessian, a.T @ (weight[active] * y[active]))
        if np.allclose(new, beta, atol=1e-6):
            break
        beta = new
    return beta[:-1], float(beta[-1])


def choose_landmarks(texts: list[str], toxic: np.ndarray, n: int) -> dict[str, float]:
    """The words whose share of toxic documents is most above that of the others, less one
    standard error, and by how much."""
    counts = (Counter(), Counter())
    for text, label in zip(texts, toxic):
        counts[int(label)].update(set(WORD.findall(text.lower())))
    n_toxic, n_other = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    lift = {
        word: count / n_toxic - counts[0][word] / n_other - (count / n_toxic / n_toxic) ** 0.5
        for word, count in counts[1].items()
        if len(word) >= LENGTH - 1
    }
    chosen = sorted(lift, key=lambda word: (-lift[word], word))[:n]
    return {word: lift[word] for word in chosen if lift[word] > 0}


def _varied(of: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The same symbols with one more letter somewhere inside."""
    at = int(rng.integers(2, max(3, len(of) - 2)))
    return np.r_[of[:at], rng.integers(1, 27), of[at:]].astype(np.int32)[: SPAN + STRETCH]


def train(texts: list[str], toxic: np.ndarray, shares: tuple[float, float] | None = None, seed: int = 5) -> Machine | None:
    """The machine for labelled texts; None unless both labels occur.

    ``shares``: of clean and toxic documents where the texts come from, if the texts are
    another mixture; probabilities are calibrated to these.

    Only documents are labelled, so a toxic one's sentences are taken as toxic where the
    machine of the round before finds them so, the best one always; all sentences of the
    other documents are clean.
    """
    toxic = np.asarray(toxic)
    if not 0 < toxic.sum() < len(toxic):
        return None
    rng = np.random.default_rng(seed)
    lift = choose_landmarks(texts, toxic, LANDMARKS)
    if not lift:
        return None
    numbers, landmarks = landmark_table(list(lift))
    rows = np.full(SYMBOLS**LENGTH, len(numbers), np.int32)
    rows[numbers] = np.arange(len(numbers))
    # Nyström: with G = K(landmarks, landmarks), the vector of x is G^(-1/2) K(landmarks, x).
    values, vectors = np.linalg.eigh(landmarks.T @ landmarks)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0) + RIDGE)) @ vectors.T
    projected = np.vstack([landmarks @ root, np.zeros(landmarks.shape[1])])

    def table(beta: np.ndarray) -> np.ndarray:
        return (projected @ beta).astype(np.float32)[rows]

    def vector(of: np.ndarray) -> np.ndarray:
        """Of the place that begins at the first symbol."""
        total = np.zeros(projected.shape[1])
        for found, weight in subsequences(of):
            total += weight * projected[rows[found[: SPAN - STRETCH + 1]]].sum(axis=0)
        return total

    parsed = [symbols(text) for text in texts]
    weights, offset = np.zeros(SYMBOLS**LENGTH, np.float32), 0.0
    weights[numbers] = landmarks @ np.array(list(lift.values()))
    for _ in range(ROUNDS):
        x, y = [], []
        for (of, starts), label in zip(parsed, toxic):
            place = margins(of, weights, offset)
            ends = np.r_[starts[1:], len(of)]
            best = [s + int(place[s:e].argmax()) for s, e in zip(starts, ends)]
            best.sort(key=lambda at: -place[at])
            if label:
                best = best[:1] + [at for at in best[1:8] if offset and place[at] > 0]
            for at in best[:8]:
                piece = of[at : at + SPAN + STRETCH]
                x.append(vector(piece))
                y.append(1 if label else -1)
                for _ in range(SPELLINGS if label and place[at] > 0 and offset else 0):
                    x.append(vector(_varied(piece, rng)))
                    y.append(1)
        x, y = np.array(x), np.array(y)
        share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
        beta, offset = _svm(x, y, share)
        weights = table(beta)
    found = [(text_margins(text, weights, offset), len(text), label) for text, label in zip(texts, toxic)]
    documents = np.array([facts(best, n) for best, n, _ in found])
    centre, scale = documents.mean(axis=0), documents.std(axis=0) + 1e-9
    # Labelled documents repeat their insults. Thinned copies, of low weight, show what a
    # document with a single one looks like.
    fewer = [facts(rest, n) for best, n, label in found if label and (rest := thinned(best)) is not None]
    rows = np.vstack([documents, *fewer])
    answers = np.r_[toxic, np.ones(len(fewer))]
    own = np.array([(toxic == 0).mean(), (toxic == 1).mean()])
    by_label = (np.array(shares) if shares else own) / own
    trust = np.r_[by_label[toxic], np.full(len(fewer), THINNED_WEIGHT * by_label[1])]
    return Machine(weights, offset, _logistic((rows - centre) / scale, answers, trust), centre, scale)


def probability(text: str | None, machine: Machine) -> float:
    text = text or ""
    found = facts(text_margins(text, machine.weights, machine.offset), len(text))
    value = ((found - machine.centre) / machine.scale) @ machine.calibration[:-1] + machine.calibration[-1]
    return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def excerpt(text: str, chars: int = CHARS_PER_DOC) -> str:
    """The whole text, or of a longer one sentences chosen by hash, in their order, that have
    ``chars`` characters in all, or up to a sentence less."""
    if len(text) <= chars:
        return text
    parts = SENTENCE.findall(text)
    order = sorted(range(len(parts)), key=lambda i: xxh64_intdigest(f"{i} {parts[i]}"))
    sizes = np.cumsum([len(parts[i]) for i in order])
    return "".join(parts[i] for i in sorted(order[: max(1, int((sizes <= chars).sum()))]))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = DOCS_PER_LABEL) -> Machine | None:
    """Trained on at most ``per_label`` documents of each label, all if there are no more,
    chosen by hash of ``doc_id`` and text, whatever their length; of a long one on an excerpt.
    Rows that are repeated as a whole count once. Rows held out are never read."""
    learnable = labels.where("toxic is not null").where(~held_out())
    learnable = learnable.select(F.col("doc_id").alias("labelled_id"), F.col("toxic").cast("long").alias("toxic")).distinct()
    texts = docs.where(F.length("text") > 0).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("number", F.xxhash64(F.lit("toxicity"), "doc_id", "text"))
    # Numbers without texts first, so that only the texts of chosen rows are moved.
    numbers = written(
        texts.select("doc_id", "number").join(learnable, F.col("doc_id") == F.col("labelled_id")).select("toxic", "number").distinct(),
        "labelled-numbers",
    )
    sizes = written(numbers.groupBy(F.col("toxic").alias("of")).agg(F.count("*").alias("n")), "label-sizes")
    # By hash about twice as many as are wanted, whatever the size; then the first of those.
    some = numbers.join(sizes, F.col("toxic") == F.col("of")).where(F.pmod(F.col("number"), F.col("n")) < 2 * per_label)
    nth = F.row_number().over(Window.partitionBy("toxic").orderBy("number"))
    chosen = some.withColumn("nth", nth).where(F.col("nth") <= per_label)
    chosen = written(chosen.select(F.col("number").alias("chosen"), "toxic", "n"), "toxic-sample")
    once = texts.join(chosen, F.col("number") == F.col("chosen")).groupBy("number", "toxic", "n").agg(F.min("text").alias("text"))
    sampled = once.select(F.col("number").alias("doc_id"), "toxic", "text", "n")

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([excerpt(text) for (text,) in rows_of([batch], "text")], pa.string())
            columns = [batch.column("doc_id"), batch.column("toxic"), texts, batch.column("n")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "text", "n"])

    rows = sampled.mapInArrow(shorten, "doc_id long, toxic long, text string, n long").collect()
    rows = sorted(map(tuple, rows))
    sizes = {int(toxic == 1): n for _, toxic, _, n in rows}
    if len(sizes) < 2:
        return None
    shares = tuple(sizes[label] / sum(sizes.values()) for label in (0, 1))
    return train([text for _, _, text, _ in rows], np.array([int(toxic == 1) for _, toxic, *_ in rows]), shares)


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row's whole text.

    A null text counts as empty and gets a score like any other. Without a machine (no
    labels of both kinds to learn from) every score is 0. Labels, ``lang``, ``source`` and
    other columns are not read; repeated rows get equal rows; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = shared.value
        for batch in batches:
            found = [
                probability(text, trained) if trained else 0.0 for (text,) in rows_of([batch], "text")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = slim.mapInArrow(apply, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled rows that are not held out, then score every row."""
    return score(docs, fit(docs, labels))
