"""Helpers shared by the Python operators: bounded chunks of a text column and its words as flat arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 8 << 20


def release() -> None:
    """Give what this Python worker has freed back to the system; allocators keep it otherwise, for as long as the worker lives."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library than glibc
        pass


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that releases memory at its start and after each batch it has given.

    Workers outlive their tasks and stages, and an executor's memory holds them beside whatever runs there next.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for out in run(batches):
            yield out
            del out
            release()

    return task


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column with NULL read as the empty text, with 64-bit offsets."""
    column = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(column.cast(pa.large_string()), "")


def chunks(batch: pa.RecordBatch, name: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch whose texts take about ``limit`` bytes (one text may take more)."""
    texts = text_column(batch, name)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(texts):
        base = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start), texts.slice(start, stop - start)
        start = stop


def split_words(texts: pa.Array, spaces_only: bool = False) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of every word, distinct words, offset of each text's first word and the end).

    Words are what lies between ASCII white space (0x20, 0x09-0x0D) and are never empty;
    with ``spaces_only`` they are what lies between single spaces, empty ones included.
    """
    lists = pc.split_pattern(texts, " ") if spaces_only else pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    words = coded.dictionary
    if spaces_only:
        return codes, words, offsets
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:
        keep = codes != empty
        before = np.concatenate(([0], np.cumsum(keep)))
        codes, offsets = codes[keep], before[offsets]
    return codes, words, offsets


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``pool[s:s+n]`` over all (s, n)."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(total, dtype=at.dtype)
    return pool[at]


def run_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets; 0 for empty runs."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64 if values.dtype.kind in "iub" else np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]
