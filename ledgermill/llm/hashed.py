"""Hashed features of texts and linear scorers over them, trained by summed gradients."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgermill.llm.ragged import split_words, text_bytes, word_hashes
from ledgermill.llm.vectors import SCHEMA, task_array, tree_sum

WORD_SLOTS = 1 << 16
#: Kinds of bytes; three in a row give a shape.
KINDS = 16
#: Texts whose shapes are counted at once.
BLOCK_ROWS = 256
SLOTS = WORD_SLOTS + KINDS**3
WORD_WEIGHT = 0.25
ROUNDS = 40


def byte_kinds() -> np.ndarray:
    """Small letter (and all beyond ASCII), capital, digit, white space, line end, and groups of signs."""
    kinds = np.zeros(256, np.int64)
    kinds[65:91], kinds[48:58] = 1, 2
    kinds[[0x20, 0x09, 0x0B, 0x0C]], kinds[[0x0A, 0x0D]] = 3, 4
    for kind, signs in enumerate((".", ",", "!", "?", "|", "%", "$", "&#*", "\"'", "()[]{}<>"), 5):
        kinds[[ord(s) for s in signs]] = kind
    for code in range(33, 127):
        if not chr(code).isalnum() and not kinds[code]:
            kinds[code] = 15
    return kinds


@dataclass
class Features:
    """Slots and values of all texts in a row; ``bounds`` parts them by text."""

    slots: np.ndarray
    values: np.ndarray
    bounds: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """Product of every text with each column of the weights."""
        rows = len(self.bounds) - 1
        owners = self.owners()
        return np.stack(
            [np.bincount(owners, self.values * weights[self.slots, k], rows) for k in range(weights.shape[1])], axis=1
        )


def shape_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number times the number of shapes plus shape, of each shape in a text, and how often it is there.

    ``BLOCK_ROWS`` texts are counted at once, so the table of counts has a fixed size.
    """
    rows, size = len(offsets) - 1, KINDS**3
    table = byte_kinds().astype(np.int32)
    places, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first in range(0, rows, BLOCK_ROWS):
        ends = offsets[first : first + BLOCK_ROWS + 1]
        kind = table[data[ends[0] : ends[-1]]]
        if len(kind) < 3:
            continue
        owner = np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends))
        shapes = (kind[:-2] * KINDS + kind[1:-1]) * KINDS + kind[2:]
        count = np.bincount((owner[:-2] * size + shapes)[owner[:-2] == owner[2:]])
        there = np.flatnonzero(count)
        places.append(there + first * size)
        counts.append(count[there])
    return np.concatenate(places), np.concatenate(counts)


def text_features(column: pa.Array) -> Features:
    """Words present and shapes by the root of their share; a NULL or empty text has none."""
    rows = len(column)
    words = split_words(column, lower=True)
    slot = (word_hashes(words.vocabulary, 3) % np.uint64(WORD_SLOTS)).astype(np.int64)
    present = np.unique(words.document() * WORD_SLOTS + slot[words.codes]) if len(words.codes) else np.zeros(0, np.int64)
    data, offsets = text_bytes(column)
    found, counts = shape_counts(data, offsets)
    size = KINDS**3
    totals = np.maximum(np.diff(offsets) - 2, 1)
    share = np.sqrt(counts / totals[found // size])
    keys = np.concatenate([present // WORD_SLOTS, found // size])
    slots = np.concatenate([present % WORD_SLOTS, WORD_SLOTS + found % size])
    values = np.concatenate([np.full(len(present), WORD_WEIGHT), share])
    order = np.argsort(keys, kind="stable")
    return Features(slots[order], values[order], np.searchsorted(keys[order], np.arange(rows + 1)))


def feature_columns(features: Features) -> list[pa.Array]:
    """The features as list columns, to be stored."""
    offsets = pa.array(features.bounds.astype(np.int32))
    return [
        pa.ListArray.from_arrays(offsets, pa.array(features.slots.astype(np.int32))),
        pa.ListArray.from_arrays(offsets, pa.array(features.values.astype(np.float32))),
    ]


def stored_features(batch: pa.RecordBatch) -> Features:
    slots = batch.column("slots")
    offsets = slots.offsets.to_numpy().astype(np.int64)
    return Features(
        slots.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
        batch.column("values").flatten().to_numpy(zero_copy_only=False).astype(np.float64),
        offsets - offsets[0],
    )


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


@dataclass
class LinearModel:
    weights: np.ndarray  # of each slot and class
    bias: np.ndarray

    def posteriors(self, features: Features) -> np.ndarray:
        return softmax(features.dot(self.weights) + self.bias)


#: Tasks that the bounded rows of a fit are dealt to; each sends one gradient a round.
FIT_TASKS = 8


def train_linear(rows: DataFrame, classes: int, rounds: int = ROUNDS, rate: float = 0.05, decay: float = 1e-5) -> LinearModel:
    """Fit class probabilities to soft targets; rows have slots, values and target (array of shares).

    Each round adds up the gradient over all partitions and takes a step whose
    length adapts to each weight. Without rows all classes stay equally likely.
    """
    context = rows.sparkSession.sparkContext
    size = (SLOTS + 1) * classes
    state = np.zeros((SLOTS + 1, classes))
    squares = np.full_like(state, 1e-8)
    for _ in range(rounds):
        shared = context.broadcast(state)

        def gradient(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            weights = shared.value
            total, seen = np.zeros((SLOTS + 1, classes)), False
            for batch in batches:
                if not batch.num_rows:
                    continue
                features = stored_features(batch)
                model = LinearModel(weights[:-1], weights[-1])
                target = batch.column("target").flatten().to_numpy(zero_copy_only=False).reshape(-1, classes)
                error = model.posteriors(features) - target
                owners = features.owners()
                for k in range(classes):
                    total[:-1, k] += np.bincount(features.slots, features.values * error[owners, k], SLOTS)
                total[-1] += error.sum(axis=0)
                seen = True
            if seen:
                yield task_array(total)

        step = tree_sum(rows.select("slots", "values", "target").mapInArrow(gradient, SCHEMA), size).reshape(SLOTS + 1, classes)
        step += decay * state
        squares += step**2
        state = state - rate * step / np.sqrt(squares)
        shared.destroy()
    return LinearModel(state[:-1], state[-1])
