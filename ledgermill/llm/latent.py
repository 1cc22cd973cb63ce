"""Benchmark passages in documents, found in a latent space and confirmed in full.

Words are weighted by how few documents hold them (counted over all documents). A
randomised singular value decomposition of weighted passages, documents' and
benchmark items together, gives a latent space; its products are summed over all
partitions of all documents. Every window of every document is then
compared with every item by cosine there. Candidates are confirmed by the longest
common subsequence of words: an item found nearly whole counts, and one found in
good part counts as a paraphrase if its answer, the last sentence, is there too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.ragged import Words, split_words, text_slices
from ledgermill.llm.vectors import SCHEMA, task_array, tree_sum
from ledgermill.sources.paths import stored

DIMENSIONS, SPARE = 128, 8
#: Items of one latent space, and words of them; a space serves one block of the benchmark.
BLOCK_ITEMS, BLOCK_WORDS = 192, 20_000
#: Blocks that are looked for in one pass over the documents.
BLOCKS_AT_ONCE = 16
SCALES = (8, 16, 32, 64)
FEWEST_WORDS = 5
#: Text bytes whose distinct words are looked up together.
READ_BYTES = 4 << 20
COSINE = 0.65
#: Least share of a candidate window's places with words of the item.
FEWEST_SHARED = 0.35
#: Words whose vectors are added first; windows start on such a grid.
GRID = 4
WHOLE, PART, ANSWER = 0.8, 0.6, 0.8
#: Words worked on at once, and what stretches of one text share.
STRETCH, OVERLAP = 1 << 11, 128
#: Sentences end between words only.
SENTENCE_END = re.compile(r"[.!?]+(?=\s|$)|\n+")


def plain(words: pa.Array) -> pa.Array:
    """Letters and digits of words in small letters."""
    return pc.replace_substring_regex(pc.utf8_lower(words), r"[^\pL\pN]+", "")


def plain_words(text: str | None) -> list[str]:
    return [w for w in plain(pa.array((text or "").split(), pa.string())).to_pylist() if w]


@dataclass
class Item:
    key: object
    words: list[str]
    answer: list[str]


def as_item(key: object, text: str | None) -> Item:
    """An item with its answer: the words of its last sentence, or the last quarter of a single sentence."""
    words = plain_words(text)
    sentences = [w for w in map(plain_words, SENTENCE_END.split(text or "")) if w]
    answer = words[-(len(sentences[-1]) if len(sentences) > 1 else max(3, len(words) // 4)) :]
    return Item(key, words, answer)


@dataclass
class Block:
    """Items with their vocabulary; ``ids`` are the items' words as numbers in it."""

    items: list[Item]
    vocabulary: dict[str, int]
    ids: list[np.ndarray]


def blocks_of(benchmark: DataFrame, key: str, text: str) -> Iterator[Block]:
    """The benchmark a block at a time; items of fewer than ``FEWEST_WORDS`` words are left out."""
    held: list[Item] = []
    size = 0

    def made(items: list[Item]) -> Block:
        vocabulary: dict[str, int] = {}
        ids = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in item.words], np.int64) for item in items]
        return Block(items, vocabulary, ids)

    for row in benchmark.select(key, text).toLocalIterator():
        item = as_item(row[0], row[1])
        if len(item.words) < FEWEST_WORDS:
            continue
        held.append(item)
        size += len(item.words)
        if len(held) >= BLOCK_ITEMS or size >= BLOCK_WORDS:
            yield made(held)
            held, size = [], 0
    if held:
        yield made(held)


@dataclass
class Sequence:
    """Numbered words of texts; words outside the vocabulary have its size as number."""

    ids: np.ndarray
    bounds: np.ndarray


class Numbering:
    """Finds the words of texts in the vocabularies of some blocks."""

    def __init__(self, vocabularies: list[list[str]]) -> None:
        self.tables = [pa.array(v, pa.string()) for v in vocabularies]

    def read(self, column: pa.Array) -> tuple[Words, pa.Array, np.ndarray]:
        """The words, their plain spellings, and which are words at all."""
        words = split_words(column)
        spelled = plain(words.vocabulary.cast(pa.binary()).cast(pa.string()))
        return words, spelled, pc.binary_length(spelled).to_numpy(zero_copy_only=False) > 0

    def sequence(self, k: int, words: Words, spelled: pa.Array, real: np.ndarray) -> Sequence:
        size = len(self.tables[k])
        number = pc.fill_null(pc.index_in(spelled, value_set=self.tables[k]), size).to_numpy(zero_copy_only=False).astype(np.int64)
        kept = real[words.codes] if len(words.codes) else np.zeros(0, bool)
        running = np.concatenate([[0], np.cumsum(kept)])
        return Sequence(number[words.codes[kept]], running[words.bounds])


def document_counts(docs: DataFrame, blocks: list[Block]) -> tuple[int, list[np.ndarray]]:
    """How many documents there are, and how many hold each word of each vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast([list(b.vocabulary) for b in blocks])
    sizes = [len(b.vocabulary) for b in blocks]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering = Numbering(shared.value)
        total = np.zeros(1 + sum(sizes))
        for part in text_slices(batches, limit=READ_BYTES):
            total[0] += part.num_rows
            words, spelled, real = numbering.read(part.column("text"))
            at = 1
            for k, size in enumerate(sizes):
                found = numbering.sequence(k, words, spelled, real)
                owner = np.repeat(np.arange(part.num_rows), np.diff(found.bounds))
                pairs = np.unique(owner * (size + 1) + found.ids)
                total[at : at + size] += np.bincount(pairs % (size + 1), minlength=size + 1)[:size]
                at += size
        yield task_array(total)

    total = tree_sum(docs.select("text").mapInArrow(counted, SCHEMA), 1 + sum(sizes))
    return int(total[0]), [x for x in np.split(total[1:], np.cumsum(sizes)[:-1])]


def windows(bounds: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of windows of ``scale`` words, half overlapping; the last of a stretch reaches its end."""
    length = np.diff(bounds)
    step = max(1, scale // 2)
    count = np.where(length > 0, np.maximum(0, -(-(length - scale) // step)) + 1, 0)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    first = np.repeat(bounds[:-1], count)
    end = np.repeat(bounds[1:], count)
    start = np.maximum(first, np.minimum(first + number * step, end - scale))
    return start, np.minimum(start + scale, end)


def running_sums(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Sums of the vectors of the words before each place; a window's sum is the difference of two."""
    running = np.zeros((len(ids) + 1, vectors.shape[1]))
    np.cumsum(vectors[ids], axis=0, out=running[1:])
    return running


def stretches(found: Sequence) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Some texts' words at a time: their numbers, the bounds of stretches, and each stretch's text and place."""
    owners, starts, ends = [], [], []
    for k, (a, b) in enumerate(zip(found.bounds.tolist(), found.bounds[1:].tolist(), strict=False)):
        while a < b:
            owners.append(k)
            starts.append(a)
            ends.append(min(b, a + STRETCH))
            a = ends[-1] if ends[-1] == b else ends[-1] - OVERLAP
    at = 0
    while at < len(owners):
        stop, size = at, 0
        while stop < len(owners) and (stop == at or size + ends[stop] - starts[stop] <= STRETCH):
            size += ends[stop] - starts[stop]
            stop += 1
        parts = [found.ids[a:b] for a, b in zip(starts[at:stop], ends[at:stop], strict=True)]
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        yield np.concatenate(parts), bounds, np.array([owners[at:stop], starts[at:stop]])
        at = stop


@dataclass
class LatentSpace:
    """Weights of the words of a block, and the directions that its words are turned into."""

    weights: np.ndarray
    directions: np.ndarray

    def word_vectors(self) -> np.ndarray:
        """Latent vector of each word; zero for words outside."""
        inside = (self.weights[:, None] * self.directions).astype(np.float32)
        return np.concatenate([inside, np.zeros((1, self.directions.shape[1]), np.float32)])


def item_rows(block: Block, weights: np.ndarray) -> np.ndarray:
    """Weighted items, each of length one."""
    rows = np.zeros((len(block.items), len(weights)))
    for row, ids in zip(rows, block.ids, strict=True):
        np.add.at(row, ids, weights[ids])
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_spaces(sample: DataFrame, blocks: list[Block], documents: int, counts: list[np.ndarray]) -> list[LatentSpace]:
    """A latent space for each block by randomised decomposition.

    Random directions are sent once through the product of the passages with
    their transpose and made orthogonal; a second product gives the singular
    values. Items weigh as much together as all passages of the texts.
    """
    context = sample.sparkSession.sparkContext
    weights = [np.log((documents + 1) / (c + 1)) + 1 for c in counts]
    rank = [min(DIMENSIONS + SPARE, len(b.vocabulary)) for b in blocks]
    draw = np.random.default_rng(11)
    bases = [draw.standard_normal((len(b.vocabulary), r)) for b, r in zip(blocks, rank, strict=True)]
    sizes = [x.size + 1 for x in bases]
    vocabularies = [list(b.vocabulary) for b in blocks]
    values: list[np.ndarray] = []
    for turn in range(2):
        shared = context.broadcast((vocabularies, weights, bases))

        def product(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocabularies, weights, bases = shared.value
            numbering = Numbering(vocabularies)
            totals = [np.zeros((len(v) + 1, x.shape[1])) for v, x in zip(vocabularies, bases, strict=True)]
            energy = np.zeros(len(bases))
            for part in text_slices(batches, limit=1 << 20):
                words, spelled, real = numbering.read(part.column("text"))
                for k, (weight, base) in enumerate(zip(weights, bases, strict=True)):
                    found = numbering.sequence(k, words, spelled, real)
                    padded = np.append(weight, 0.0)
                    vectors = np.append(weight[:, None] * base, np.zeros((1, base.shape[1])), axis=0)
                    for ids, bounds, _ in stretches(found):
                        start, end = windows(bounds, 32)
                        running = running_sums(ids, vectors)
                        sums = running[end] - running[start]
                        lengths = running_sums(ids, padded[:, None] ** 2)[:, 0]
                        size = np.sqrt(lengths[end] - lengths[start]) + 1e-9
                        sums /= (size**2)[:, None]
                        energy[k] += len(start)
                        place = np.concatenate([np.arange(a, b) for a, b in zip(start, end, strict=True)]) if len(start) else start
                        owner = np.repeat(np.arange(len(start)), end - start)
                        word = ids[place]
                        # The transpose: each word gets its window's product.
                        order = np.argsort(word, kind="stable")
                        first = np.flatnonzero(np.append(True, np.diff(word[order]) != 0)) if len(word) else word
                        if len(word):
                            totals[k][word[order][first]] += np.add.reduceat(sums[owner[order]], first, axis=0)
            out = [np.append((w[:, None] * t[:-1]).ravel(), e) for w, t, e in zip(weights, totals, energy, strict=True)]
            yield task_array(np.concatenate(out))

        total = tree_sum(sample.select("text").mapInArrow(product, SCHEMA), sum(sizes))
        shared.unpersist()
        after = []
        for k, flat in enumerate(np.split(total, np.cumsum(sizes)[:-1])):
            rows = item_rows(blocks[k], weights[k])
            again = flat[:-1].reshape(bases[k].shape) + max(1.0, flat[-1]) / len(rows) * (rows.T @ (rows @ bases[k]))
            if turn == 0:
                after.append(np.linalg.qr(again)[0])
            else:
                small = bases[k].T @ again
                value, turned = np.linalg.eigh((small + small.T) / 2)
                order = np.argsort(-value)[:DIMENSIONS]
                values.append(value[order])
                after.append(bases[k] @ turned[:, order])
        bases = after
    return [LatentSpace(w, b) for w, b in zip(weights, bases, strict=True)]


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, one bit per word of ``a``."""
    places: dict[int, int] = {}
    for k, word in enumerate(a.tolist()):
        places[word] = places.get(word, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for word in b.tolist():
        here = row & places.get(word, 0)
        row = (row + here | row - here) & full
    return len(a) - row.bit_count()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``id_column``, item_id, cosine, found_share, answer_share and first_word of each item found in a document.

    Of several places the one with the largest share of the item's words is
    given. Documents without an item have no row. Words are compared by their
    letters and digits in small letters. NULL and empty texts hold nothing; items
    that are NULL or have fewer than ``FEWEST_WORDS`` words are not looked for.
    Rows of equal or NULL id and repeated items keep their results. The benchmark
    is the set of queries: it goes through the driver in blocks of bounded size.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kinds = docs.schema[id_column].dataType.simpleString(), benchmark.schema[item_column].dataType.simpleString()
    schema = f"`{id_column}` {kinds[0]}, item_id {kinds[1]}, cosine double, found_share double, answer_share double, first_word bigint"
    results: list[DataFrame] = []
    group: list[Block] = []
    sample: DataFrame | None = None

    def search(blocks: list[Block]) -> DataFrame:
        nonlocal sample
        documents, counts = document_counts(source, blocks)
        if sample is None:
            # The space is fitted on every text, stored once for the two passes of each block group.
            sample = stored(source.where(F.col("text").isNotNull()).select("text"), "fit-texts")
        spaces = fit_spaces(sample, blocks, documents, counts)
        plans = []
        for block, space in zip(blocks, spaces, strict=True):
            vectors = space.word_vectors()
            queries = np.stack([vectors[ids].sum(axis=0) for ids in block.ids])
            queries = (queries / (np.linalg.norm(queries, axis=1, keepdims=True) + 1e-12)).astype(np.float32)
            # Each item is looked for with the window nearest to it in length, by ratio.
            scale = [min(SCALES, key=lambda s: abs(np.log(s / len(ids)))) for ids in block.ids]
            answers = [np.array([block.vocabulary[w] for w in item.answer], np.int64) for item in block.items]
            plans.append((list(block.vocabulary), vectors, queries, np.array(scale), block.ids, answers, [i.key for i in block.items]))
        shared = spark.sparkContext.broadcast(plans)

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            plans = shared.value
            numbering = Numbering([p[0] for p in plans])
            types = None
            for part in text_slices(batches, limit=READ_BYTES):
                types = part.schema.field("id").type
                keys = part.column("id").to_pylist()
                words, spelled, real = numbering.read(part.column("text"))
                best: dict[tuple[int, object, int], tuple] = {}
                for k, (_, vectors, queries, scales, items, answers, names) in enumerate(plans):
                    sequence = numbering.sequence(k, words, spelled, real)
                    holds = np.zeros((len(items), len(vectors)), bool)
                    for i, query in enumerate(items):
                        holds[i, query] = True
                    for ids, owners, first, size, places in laid_out(sequence, len(vectors) - 1):
                        for piece, start, item, cosine in candidates(ids, size, places, vectors, queries, scales, holds):
                            text = int(owners[piece])
                            place = int(sequence.bounds[text] + first[piece]) + start
                            query = items[item]
                            reach = len(query)
                            low = max(int(sequence.bounds[text]), place - reach)
                            high = min(int(sequence.bounds[text + 1]), place + 2 * reach)
                            region = sequence.ids[low:high]
                            share = common_words(query, region) / reach
                            if share < PART:
                                continue
                            told = common_words(answers[item], region) / len(answers[item])
                            if share < WHOLE and told < ANSWER:
                                continue
                            row = (share, told, cosine, low - int(sequence.bounds[text]))
                            key = (text, k, item)
                            if key not in best or row > best[key]:
                                best[key] = row
                rows = [(keys[t], plans[k][6][i], c, s, a, w) for (t, k, i), (s, a, c, w) in best.items()]
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(columns[0], types),
                            pa.array(columns[1], pa.int64() if kinds[1] == "bigint" else None),
                            pa.array(columns[2], pa.float64()),
                            pa.array(columns[3], pa.float64()),
                            pa.array(columns[4], pa.float64()),
                            pa.array(columns[5], pa.int64()),
                        ],
                        names=[id_column, "item_id", "cosine", "found_share", "answer_share", "first_word"],
                    )

        return source.mapInArrow(found, schema)

    for block in blocks_of(benchmark, item_column, item_text):
        group.append(block)
        if len(group) == BLOCKS_AT_ONCE:
            results.append(search(group))
            group = []
    if group:
        results.append(search(group))
    out = results[0] if results else spark.createDataFrame([], schema)
    for more in results[1:]:
        out = out.union(more)
    return out


def laid_out(found: Sequence, outside: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Some texts' words at a time, on a grid of ``GRID`` words.

    Gives numbers of words, and of each piece its text, its first word there, its
    size and its place. Behind each piece there is room for the largest window,
    filled with a word outside the vocabulary.
    """
    length = np.diff(found.bounds)
    step = STRETCH - OVERLAP
    pieces = np.where(length > 0, np.maximum(0, -(-(length - STRETCH) // step)) + 1, 0)
    owner = np.repeat(np.arange(len(length)), pieces)
    first = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * step
    size = np.minimum(length[owner] - first, STRETCH)
    room = -(-size // GRID) * GRID + SCALES[-1]
    ends = np.cumsum(room)
    at = 0
    while at < len(owner):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + STRETCH + SCALES[-1], side="right")))
        place = ends[at:stop] - room[at:stop] - base
        ids = np.full(ends[stop - 1] - base, outside, np.int64)
        some = size[at:stop]
        inner = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        begin = found.bounds[owner[at:stop]] + first[at:stop]
        ids[np.repeat(place, some) + inner] = found.ids[np.repeat(begin, some) + inner]
        yield ids, owner[at:stop], first[at:stop], some, place
        at = stop


def candidates(
    ids: np.ndarray,
    size: np.ndarray,
    place: np.ndarray,
    vectors: np.ndarray,
    queries: np.ndarray,
    scales: np.ndarray,
    holds: np.ndarray,
) -> list[tuple[int, int, int, float]]:
    """Windows near an item by cosine: piece, start in it, item and cosine.

    Windows overlap by half and their sums are put together from those of half
    the width. A candidate must also have words of the item (``holds``) in a share
    of ``FEWEST_SHARED`` of its places.
    """
    sums = vectors[ids].reshape(-1, GRID, vectors.shape[1]).sum(axis=1)
    width, out = GRID, []
    for scale in SCALES:
        while width < scale:
            half = width // GRID
            sums = sums[:-half] + sums[half:]
            width *= 2
        asked = np.flatnonzero(scales == scale)
        if not len(asked):
            continue
        count = np.maximum(0, -(-(size - scale) // (scale // 2))) + 1
        piece = np.repeat(np.arange(len(size)), count)
        start = (np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)) * (scale // 2)
        rows = sums[(place[piece] + start) // GRID]
        near = (rows @ queries[asked].T) / (np.sqrt((rows * rows).sum(axis=1)) + 1e-9)[:, None]
        w, q = np.nonzero(near >= COSINE)
        if not len(w):
            continue
        words = ids[(place[piece[w]] + start[w])[:, None] + np.arange(scale)]
        shared = holds[asked[q][:, None], words].sum(axis=1)
        enough = shared >= FEWEST_SHARED * scale
        w, q = w[enough], q[enough]
        out += zip(piece[w].tolist(), start[w].tolist(), asked[q].tolist(), near[w, q].tolist(), strict=True)
    return out
