"""Words of many texts at once, as numbers of a dictionary, for operators on word sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STOP = b"\n"  # stands between the parts of a text; no word holds it
CHUNK_BYTES = 16 << 20  # of text that is turned to numbers at a time


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``limit`` bytes of text each, or of a single longer one."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def numbered(data: bytes) -> tuple[np.ndarray, pa.Array, int]:
    """Words between blanks as places in their dictionary, the sorted dictionary, and the
    place of ``STOP`` in it (-1 if it does not occur)."""
    pieces = pc.split_pattern(pa.array([data], pa.large_binary()), pattern=b" ").flatten()
    words = pieces.filter(pc.not_equal(pc.binary_length(pieces), 0))
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    dictionary = coded.dictionary.take(order)
    stop = pc.index(dictionary, pa.scalar(STOP, pa.large_binary())).as_py()
    return rank[coded.indices.to_numpy()], dictionary, stop
