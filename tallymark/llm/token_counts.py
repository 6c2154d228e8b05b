"""Token counts of a byte-level BPE vocabulary, with a shortcut for whole tokens.

Before the texts are read, every vocabulary entry is merged on its own; those that come
out as one token are proven whole. A text is cut into pre-tokens, which BPE never joins,
so a pre-token that is a proven entry counts as one without a merge. Only the rest are
merged, once for each different pre-token that a worker meets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.texts import rows_of

# Fixed value: the pre-token pattern of byte-level vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 1_000_000  # merged pre-tokens that a worker keeps
LONG_PIECE = 100  # longer pre-tokens are merged, but not kept
PIECES_AT_ONCE = 100_000


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte in the vocabulary file: printable bytes stand
    for themselves, the others for the characters from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary(dict):
    """Number of tokens of each pre-token: proven entries, and merged ones as they are met."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.symbols = byte_symbols()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special]
        self.pattern = regex.compile(PRE_TOKEN)
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def merged(self, piece: str) -> int:
        spelled = piece.encode("utf-8").decode("latin-1").translate(self.symbols)
        return len(self.tokenizer.model.tokenize(spelled))

    def __missing__(self, piece: str) -> int:
        count = self.merged(piece)
        if len(piece) <= LONG_PIECE:
            if len(self) >= len(self.proven) + REMEMBERED:
                self.clear()
                self.update(self.proven)
            self[piece] = count
        return count

    def prove(self) -> list[str]:
        """Vocabulary entries that are valid text and come out of the merges as one token."""
        bytes_of = {symbol: byte for byte, symbol in self.symbols.items()}
        found = []
        for entry in self.tokenizer.get_vocab(with_added_tokens=False):
            try:
                piece = bytes(bytes_of[symbol] for symbol in entry).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                continue
            if piece and self.merged(piece) == 1:
                found.append(piece)
        return found

    def learn(self, proven: list[str]) -> Vocabulary:
        self.proven = dict.fromkeys(proven, 1)
        self.update(self.proven)
        return self

    def count(self, text: str) -> int:
        """Tokens of a text. A special token's string inside of it is that one token."""
        total = len(self.cut.findall(text)) if self.cut else 0
        for part in self.cut.split(text) if self.cut else [text]:
            if len(part) <= PIECES_AT_ONCE:
                total += sum(map(self.__getitem__, self.pattern.findall(part)))
            else:
                total += sum(self[found.group()] for found in self.pattern.finditer(part))
        return total


@lru_cache(maxsize=4)
def proven_entries(definition: str) -> tuple[str, ...]:
    return tuple(Vocabulary(definition).prove())


@lru_cache(maxsize=2)
def worker_vocabulary(definition: str, proven: tuple[str, ...]) -> Vocabulary:
    """Built once for each Python worker."""
    return Vocabulary(definition).learn(list(proven))


def count_tokens(docs: DataFrame, vocabulary_file: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row's whole ``text``.

    ``vocabulary_file``: a byte-level BPE definition for the ``tokenizers`` library, read
    by the driver. The vocabulary (its size is fixed, a few MB) is broadcast.
    A null text counts as empty: no bytes, no tokens. A null ``doc_id`` stays null; repeated
    rows give repeated rows; other columns are not read; no rows give no rows.
    """
    with open(vocabulary_file, encoding="utf-8") as file:
        definition = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((definition, proven_entries(definition)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = worker_vocabulary(*shared.value)
        for batch in batches:
            sizes, counts = [], []
            for (text,) in rows_of([batch], "text"):
                text = text or ""
                sizes.append(len(text.encode("utf-8")))
                counts.append(vocabulary.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = counted.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
