"""Near copies by SimHash, found with meet-in-the-middle ball hashing.

Two fingerprints at most ``max_bits`` apart have a point between them that is at most half
of that away from both. Every fingerprint emits all variants within the half radius, the
variants are shuffled, and fingerprints that meet on one are verified and linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from xxhash import xxh64_intdigest

from tallymark.llm.components import component_roots
from tallymark.llm.shared import fresh, row_number_of, written
from tallymark.llm.texts import rows_of

BITS = 64
SEED = 42
AT_ONCE = 1 << 16  # shingles whose bits are unpacked together


def shingles(text: str | None, length: int) -> Iterator[bytes]:
    """Runs of ``length`` words of the text with A-Z in lower case; repeats included.

    A text of fewer words is one shingle, a text without words has none.
    """
    words = (text or "").encode("utf-8").lower().split()
    if len(words) <= length:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(islice(words, start, None) for start in range(length))))


def fingerprint(text: str | None, length: int) -> int:
    """A bit is set if it is set in over half of the shingles' hashes. Signed, as Spark's long."""
    hashes = map(partial(xxh64_intdigest, seed=SEED), shingles(text, length))
    ones, total = np.zeros(BITS, np.int64), 0
    while (part := np.fromiter(islice(hashes, AT_ONCE), dtype="<u8")).size:
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
        total += part.size
    packed = np.packbits(2 * ones > total, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, fingerprint`` (long) of every row's whole text."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, length) for (text,) in rows_of([batch], "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fingerprint"]
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(compute, "doc_id long, fingerprint long")


def flips(radius: int) -> list[int]:
    """All patterns of at most ``radius`` set bits, as signed longs."""
    masks = [sum(1 << bit for bit in bits) for n in range(radius + 1) for bits in combinations(range(BITS), n)]
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]


def linked(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``a, b`` with a < b: verified links that join all fingerprints within ``max_bits``.

    ``nodes``: different fingerprints, so at most as many meet on a variant as there are
    variants (65 for two bits). All that meet on one are within ``max_bits`` of each other,
    so linking each to the smallest of them loses no connection, without listing all pairs.
    """
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits must be even: fingerprints meet in the middle")
    masks = flips(max_bits // 2)
    variant = F.explode(F.array(*[F.col("fingerprint").bitwiseXOR(F.lit(mask)) for mask in masks]))
    met = nodes.select("fingerprint", variant.alias("variant"))
    hub = F.min("fingerprint").over(Window.partitionBy("variant"))
    pairs = met.select(hub.alias("a"), F.col("fingerprint").alias("b")).where("a <> b").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def as_hex(column: Column) -> Column:
    return F.lpad(F.lower(F.hex(column)), BITS // 4, "0")


def _members(marked: DataFrame, max_bits: int) -> DataFrame:
    """``fingerprint, root, component_id`` of every different fingerprint."""
    # Exact copies fall together here, so a group of any size is one node from now on.
    nodes = written(
        marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "nodes"
    )
    roots = component_roots(linked(nodes, max_bits))
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return written(rooted.join(named, "root").select("fingerprint", "root", "component_id"), "members")


def near_copies(docs: DataFrame, length: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked; the
    component is the smallest ``doc_id`` reachable over links, the own one included.
    Null, empty and blank texts have the fingerprint zero and are linked like any other.
    Repeated rows get equal rows. A row without ``doc_id`` takes part, but names no
    component (null if no row of its component has one). Other columns are not read.
    """
    marked = written(fingerprints(docs, length), "fingerprints")
    members = _members(marked, max_bits)
    return marked.join(members, "fingerprint").select(
        "doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, length: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, with all columns, that are their component's ``component_id``,
    and of its rows without ``doc_id`` one.

    Of rows that share this ``doc_id``, and of those without one, the row with the smallest
    hash of all columns stays. Columns may have any name and type, maps included.
    """
    marked = written(fingerprints(docs, length), "fingerprints")
    members = _members(marked, max_bits)
    print_, root, first_id, number, row = fresh(docs, "fingerprint", "root", "first_id", "row_number", "row")
    first = members.join(marked, "fingerprint").where("doc_id = component_id")
    first = first.select(F.col("doc_id").alias(first_id)).distinct()
    named = docs.join(first, F.col("doc_id").cast("long") == F.col(first_id), "left_semi")

    def one_of(rows: DataFrame, *keys: Column) -> DataFrame:
        # A mergeable aggregate, so that a group of any size is cut down where its rows are.
        numbered = rows.select(*keys, row_number_of(docs).alias(number), F.struct(*[f"`{c}`" for c in docs.columns]).alias(row))
        least = numbered.groupBy(*[c for c in numbered.columns if c not in (number, row)]).agg(F.min_by(row, number).alias(row))
        return least.select(f"{row}.*")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(text, length) for (text,) in rows_of([batch], "text")], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, print_])

    nameless = docs.where("doc_id is null")
    nameless = nameless.mapInArrow(compute, StructType([*docs.schema.fields, StructField(print_, LongType())]))
    roots = members.select(F.col("fingerprint").alias(print_), F.col("root").alias(root))
    once = one_of(named, F.col("doc_id").cast("long").alias(first_id))
    return once.unionByName(one_of(nameless.join(roots, print_), F.col(root)))
