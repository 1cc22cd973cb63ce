"""Columnar text helpers that run inside tasks: words and hashes of Arrow text columns.

A batch of texts is one byte buffer with document offsets. Words are found with
array operations over that buffer and numbered by their distinct bytes, so the
costly work of an operator is done once per distinct word of a slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text bytes worked on at once in a task.
SLICE_BYTES = 4 << 20


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``limit`` text bytes, one row at least."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the offsets of each; NULL is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """``codes[bounds[i]:bounds[i + 1]]`` numbers the words of text ``i`` in ``vocabulary``."""

    codes: np.ndarray
    bounds: np.ndarray
    vocabulary: pa.Array

    def document(self) -> np.ndarray:
        """The number of the text that each word stands in."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray | None = None) -> pa.Array:
    """The byte strings ``data[starts[i]:ends[i]]``; ``kept`` marks the bytes between them to leave out."""
    sizes = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    body = np.ascontiguousarray(data if kept is None else data[kept])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]
    )


def numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word as the number of its bytes among the distinct ones."""
    if not len(words):
        return np.zeros(0, np.int32), pa.array([], pa.large_binary())
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def split_words(column: pa.Array, lower: bool = False) -> Words:
    """Words of texts: runs of bytes other than 0x20 and 0x09-0x0D; ``lower`` lower-cases A-Z."""
    data, offsets = text_bytes(column)
    blank = np.zeros(256, bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        data = table[data]
    word = ~blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1] | edge[1:-1]
    end[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    codes, vocabulary = numbered(pieces(data, starts, ends, word))
    return Words(codes, np.searchsorted(starts, offsets), vocabulary)


def word_hashes(vocabulary: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(
        (xxhash.xxh3_64_intdigest(w, seed) for w in vocabulary.to_pylist()), np.uint64, len(vocabulary)
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ragged_range(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of ``counts``."""
    total = int(counts.sum())
    firsts = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(firsts, counts)


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words, and the bounds of each text's runs.

    A text of fewer words has one run of all its words, one without words none.
    """
    hashes = word_hashes(words.vocabulary)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    counts = np.diff(words.bounds)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    at = np.repeat(words.bounds[:-1], runs) + ragged_range(runs)
    length = np.repeat(np.minimum(counts, size), runs)
    out = np.full(len(at), 0x9E3779B97F4A7C15, np.uint64) + length.astype(np.uint64)
    for k in range(size):
        inside = k < length
        step = hashes[np.where(inside, at + k, 0)] if len(hashes) else np.zeros(0, np.uint64)
        out = np.where(inside, mixed(out * np.uint64(3) + step), out)
    return out, bounds


def distinct_by_text(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text in ascending order, and their bounds."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[first], np.searchsorted(owner[first], np.arange(len(bounds)))
