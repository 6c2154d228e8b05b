"""Language of a text by a convolutional network over its bytes.

Filters of several widths over byte embeddings, the maximum of each over a window of fixed
length, and a softmax. Trained with numpy on a bounded sample of labelled texts, applied
to every window of every whole text; a text's probabilities are the mean of its windows'.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.shared import written
from tallymark.llm.texts import held_out, rows_of

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 8  # of each width
EMBEDDING = 8
TEXTS_PER_LANGUAGE = 1_500  # bound of the training sample
WINDOWS_PER_TEXT = 4
SHORT_WORDS = 12
EPOCHS, BATCH, RATE = 8, 64, 0.004
AT_ONCE = 1024  # windows that are scored together
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


def windows(text: str) -> np.ndarray:
    """The lower-cased text's bytes as rows of one window each; the last is filled with 0."""
    raw = np.frombuffer(text.lower().encode("utf-8"), np.uint8)
    n = max(1, -(-raw.size // WINDOW))
    filled = np.zeros(n * WINDOW, np.uint8)
    filled[: raw.size] = raw
    return filled.reshape(n, WINDOW)


class Network:
    """The parameters, and what goes forward. Softmax over ``classes``."""

    def __init__(self, classes: Sequence[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = list(classes)
        self.embedding = rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.embedding[0] = 0
        self.kernels = [
            rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS
        ]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.dense = rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        self.offset = np.zeros(len(classes), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.kernels, self.bias, self.dense, self.offset]

    def responses(self, batch: np.ndarray) -> list[np.ndarray]:
        """Of each width, (windows, places, filters). A filter's weights times all 256
        embeddings are 256 rows, so every byte of a place adds one looked-up row."""
        found = []
        for kernel in self.kernels:
            tables = [self.embedding @ part for part in kernel]
            places = WINDOW - len(tables) + 1
            total = tables[0][batch[:, :places]]
            for shift, rows in enumerate(tables[1:], 1):
                total += rows[batch[:, shift : shift + places]]
            found.append(total)
        return found

    def head(self, pooled: np.ndarray) -> np.ndarray:
        logits = np.maximum(pooled + self.bias, 0) @ self.dense + self.offset
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        return odds / odds.sum(axis=1, keepdims=True)

    def probabilities(self, batch: np.ndarray) -> np.ndarray:
        pooled = np.concatenate([r.max(axis=1) for r in self.responses(batch)], axis=1)
        return self.head(pooled)

    def gradients(self, batch: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy. Only the places that win the pooling pass it on."""
        responses = self.responses(batch)
        best = [r.argmax(axis=1) for r in responses]
        pooled = np.concatenate([r.max(axis=1) for r in responses], axis=1)
        active = np.maximum(pooled + self.bias, 0)
        error = (self.head(pooled) - np.eye(len(self.classes), dtype=np.float32)[target]) / len(batch)
        back = (error @ self.dense.T) * (active > 0)
        embedding = np.zeros_like(self.embedding)
        kernels = []
        rows = np.arange(len(batch))[:, None]
        for i, (kernel, at) in enumerate(zip(self.kernels, best)):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            slope = np.zeros_like(kernel)
            for shift in range(len(kernel)):
                seen = batch[rows, at + shift]
                slope[shift] = np.einsum("nf,nfe->ef", part, self.embedding[seen])
                np.add.at(embedding, seen, part[:, :, None] * kernel[shift].T[None])
            kernels.append(slope)
        embedding[0] = 0
        return [embedding, *kernels, back.sum(axis=0), active.T @ error, error.sum(axis=0)]


def train(batch: np.ndarray, target: np.ndarray, classes: Sequence[str], seed: int = 7) -> Network:
    """Adam over shuffled batches; the same rows give the same network."""
    network = Network(classes, seed)
    rng = np.random.default_rng(seed)
    parameters = network.parameters()
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(batch))
        for start in range(0, len(batch), BATCH):
            picked = order[start : start + BATCH]
            step += 1
            for p, g, m, v in zip(parameters, network.gradients(batch[picked], target[picked]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def sample(docs: DataFrame, texts_per_language: int = TEXTS_PER_LANGUAGE) -> DataFrame:
    """``number, lang, window``: some windows of at most so many texts of each language, all
    of a language that has no more.

    Which texts and windows depends on a hash of ``doc_id`` and text alone. Rows that are
    repeated as a whole count once; rows without an id, or of the same one, are rows like any
    others. Rows held out are not in it.
    """
    learnable = docs.where("lang is not null and text is not null and text <> ''").where(~held_out())
    slim = learnable.select("lang", F.col("text").cast("string").alias("text"), F.xxhash64(F.lit("language"), "doc_id", "text").alias("number"))
    # Written, so that its true size decides how it is joined.
    sizes = written(slim.groupBy(F.col("lang").alias("of")).agg(F.approx_count_distinct("number").alias("n_texts")), "languages")
    # By hash about twice as many as are wanted, whatever the size; then the first of those.
    some = slim.join(sizes, F.col("lang") == F.col("of")).where(F.pmod(F.col("number"), F.col("n_texts")) < 2 * texts_per_language)
    once = some.groupBy("lang", "number").agg(F.min("text").alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("number"))
    chosen = once.withColumn("nth", nth).where(F.col("nth") <= texts_per_language)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for number, text, lang in rows_of([batch], "number", "text", "lang"):
                rows = windows(text)
                rng = np.random.default_rng(number % 2**63)
                picked = rng.permutation(len(rows))[:WINDOWS_PER_TEXT]
                cuts = [rows[i].tobytes() for i in sorted(picked)]
                # And one short piece, as short texts are to be told apart as well.
                words = text.split()
                at = rng.integers(len(words)) if words else 0
                cuts.append(windows(" ".join(words[at : at + rng.integers(1, SHORT_WORDS)]))[0].tobytes())
                found += [(number, lang, cut) for cut in cuts]
            numbers, langs, pieces = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(langs, pa.string()), pa.array(pieces, pa.binary())],
                ["number", "lang", "window"],
            )

    return chosen.select("number", "text", "lang").mapInArrow(cut, "number long, lang string, window binary")


def fit(docs: DataFrame) -> Network | None:
    """The network for the sample's languages; None if there is nothing to learn from."""
    rows = sorted(map(tuple, sample(docs).collect()))
    if not rows:
        return None
    classes = sorted({lang for _, lang, _ in rows})
    batch = np.frombuffer(b"".join(bytes(cut) for *_, cut in rows), np.uint8).reshape(-1, WINDOW)
    target = np.array([classes.index(lang) for _, lang, _ in rows])
    return train(batch, target, classes)


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row's whole text.

    ``und`` with score 0 if the text is null or has no letter, or if there is no network
    because nothing could be learnt. ``lang``, ``source`` and other columns are not read;
    repeated rows get equal rows; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found: list[tuple[str, float]] = []
            waiting: list[np.ndarray] = []
            owners: list[int] = []
            sums: dict[int, np.ndarray] = {}
            n_windows: dict[int, int] = {}

            def flush() -> None:
                if waiting:
                    stacked = np.concatenate(waiting)
                    of = np.repeat(owners, [len(w) for w in waiting])
                    for start in range(0, len(stacked), AT_ONCE):
                        result = model.probabilities(stacked[start : start + AT_ONCE])
                        part = of[start : start + AT_ONCE]
                        heads = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                        for owner, total in zip(part[heads], np.add.reduceat(result, heads, axis=0)):
                            sums[owner] = sums.get(owner, 0) + total
                    waiting.clear()
                    owners.clear()

            texts = 0
            pending = 0
            for (text,) in rows_of([batch], "text"):
                if model is not None and text and LETTER.search(text):
                    rows = windows(text)
                    waiting.append(rows)
                    owners.append(texts)
                    n_windows[texts] = len(rows)
                    pending += len(rows)
                    if pending >= AT_ONCE:
                        flush()
                        pending = 0
                texts += 1
            flush()
            for i in range(texts):
                if i in sums:
                    mean = sums[i] / n_windows[i]
                    at = int(mean.argmax())
                    found.append((model.classes[at], min(1.0, float(mean[at]))))
                else:
                    found.append((UNKNOWN, 0.0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([p for _, p in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = slim.mapInArrow(score, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, then predict every row."""
    return predict(docs, fit(docs))
