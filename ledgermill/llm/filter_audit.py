"""What filters of documents do to each other in every order, with exact copies found by radix tries.

Each task computes the failed filters of its texts as a bit mask and leaves out the
copies it has already seen with a smaller id. The other texts are dealt into ranges
of the text order, whose bounds are prefixes of sampled texts that grow where many
texts share one.
Each range inserts its whole texts into a compressed trie that holds the least id at
its terminals: a row with a greater id fails filter E. Masks are then counted by
part and label, and the figures of all orders follow from the counts of 32 masks.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.ordered import RANGES_PER_TASK, shuffle_tasks
from ledgermill.llm.ragged import split_words, text_bytes, text_slices
from ledgermill.sources.paths import stored

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
MASKS = 1 << len(FILTERS)
FEWEST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 200, 50, 2
SIGNS = b"#$%&*|"
#: Distinct texts sampled for each range, and the bytes of each that bounds are made of.
SAMPLED, REACH = 4, 2048
ROWS_AT_ONCE = 1 << 16


def content_masks(column: pa.Array) -> np.ndarray:
    """Filters A to D that each text fails, as bits."""
    words = split_words(column)
    rows = len(column)
    count = np.diff(words.bounds)
    size = max(len(words.vocabulary), 1)
    distinct = np.bincount(np.unique(words.document() * size + words.codes) // size, minlength=rows) if len(words.codes) else np.zeros(rows, np.int64)
    data, offsets = text_bytes(column)

    def each(kind: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(kind, dtype=np.int64)])[offsets])

    sign = np.zeros(256, bool)
    sign[list(SIGNS)] = True
    capitals, points = each((data >= 65) & (data <= 90)), each((data & 0xC0) != 0x80)
    failed = [
        count < FEWEST_WORDS,
        100 * distinct < LEAST_DISTINCT_PERCENT * count,
        100 * capitals > MOST_CAPITALS_PERCENT * points,
        each(sign[data]) > 0,
    ]
    return sum(f.astype(np.int32) << k for k, f in enumerate(failed))


@dataclass
class Node:
    label: bytes
    children: dict[int, Node] = field(default_factory=dict)
    least: object = None
    rows: Counter | None = None


def agreeing(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    if a == b[: len(a)]:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """A compressed trie of whole texts; a terminal holds the least id of its text and the rows that have it."""

    def __init__(self) -> None:
        self.root = Node(b"")

    def terminal(self, text: bytes) -> Node:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
            elif not text.startswith(child.label, at):
                cut = agreeing(child.label, text[at : at + len(child.label)])
                upper = Node(child.label[:cut], {child.label[cut]: child})
                child.label = child.label[cut:]
                node.children[text[at]] = child = upper
            node = child
            at += len(child.label)
        return node

    def insert(self, text: bytes, key: object, part: str, mask: int, count: int) -> list[tuple]:
        """Add rows of a text; gives those (id, part, mask, rows) that are now known to have a smaller id beside them."""
        node = self.terminal(text)
        if node.rows is None or key < node.least:
            gone = [(node.least, p, m, n) for (p, m), n in node.rows.items()] if node.rows else []
            node.least, node.rows = key, Counter({(part, mask): count})
            return gone
        if key > node.least:
            return [(key, part, mask, count)]
        node.rows[part, mask] += count
        return []

    def firsts(self) -> Iterator[tuple]:
        """The rows with the least id of each text, by walking all terminals."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.rows is not None:
                for (part, mask), n in node.rows.items():
                    yield node.least, part, mask, n
            stack.extend(node.children.values())


@dataclass
class TextRanges:
    """Ranges of the text order between ascending prefixes; a range that holds many texts with one
    beginning is dealt into several parts by the digest of the whole text, so copies stay together."""

    bounds: list[bytes]
    parts: list[int]

    def __post_init__(self) -> None:
        self.first = np.concatenate([[0], np.cumsum(self.parts)]).tolist()

    def number(self, text: bytes, digest: bytes) -> int:
        at = bisect_right(self.bounds, text)
        return self.first[at] + (int.from_bytes(digest[:8], "big") % self.parts[at] if self.parts[at] > 1 else 0)

    @property
    def count(self) -> int:
        return self.first[-1]


def ranges_between(heads: list[bytes], count: int) -> TextRanges:
    """About ``count`` ranges from the beginnings of sampled texts.

    A bound is the shortest prefix that tells its text from the one before in the
    order, so prefixes grow where many texts share one.
    """
    heads = sorted(heads)
    parts = {b"": 1}

    def bound(at: int) -> bytes:
        return heads[at][: agreeing(heads[at - 1], heads[at]) + 1] if at else b""

    for head, times in Counter(heads[i * len(heads) // count] for i in range(1, count) if heads).items():
        start, behind = bisect_left(heads, head), bisect_right(heads, head)
        parts[bound(start)] = times
        if times > 1 and behind < len(heads):
            parts.setdefault(bound(behind), 1)
    bounds = sorted(parts)
    return TextRanges(bounds[1:], [parts[b] for b in bounds])


def text_ranges(docs: DataFrame) -> TextRanges:
    """Ranges of the texts of a frame (``text``), about ``RANGES_PER_TASK`` for each shuffle task.

    They follow the beginnings of a sample of the distinct texts, chosen by hash, so
    copies weigh once: at most about ``SAMPLED`` beginnings of ``REACH`` bytes for each range.
    """
    count = shuffle_tasks(docs) * RANGES_PER_TASK
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    share = min(1.0, count * SAMPLED / max(docs.count(), 1))
    chosen = docs.select(F.xxhash64(data).alias("h"), data.alias("data")).where(F.col("h") < min(-(2**63) + int(share * 2**64), 2**63 - 1))
    heads = chosen.groupBy("h").agg(F.min(F.substring("data", 1, REACH)).alias("head")).collect()
    return ranges_between([bytes(r["head"]) for r in heads], count)


def failed_filters(docs: DataFrame, id_column: str = "doc_id", part_column: str = "source", text_column: str = "text") -> DataFrame:
    """Rows of a table counted by ``id``, ``part`` and ``mask`` (bits of the filters A to E they fail).

    A text is a copy if a smaller id has the same text. A row without an id neither
    is a copy nor makes one; rows of the least id are all first. NULL texts are
    empty texts, a NULL part is an empty string. Other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    ranges = text_ranges(rows)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, object] = {}
        turn = 0
        for part in text_slices(batches):
            key_type = part.column("id").type
            masks = content_masks(part.column("text")).tolist()
            texts = pc.fill_null(part.column("text"), "").cast(pa.binary()).to_pylist()
            digests = list(map(xxhash.xxh3_128_digest, texts))
            keys = part.column("id").to_pylist()
            for key, digest in zip(keys, digests, strict=True):
                if key is not None and (digest not in seen or key < seen[digest]):
                    seen[digest] = key
            counted: Counter = Counter()
            place: dict[bytes, int] = {}
            for at, (key, name, mask, digest) in enumerate(zip(keys, part.column("part").to_pylist(), masks, digests, strict=True)):
                if key is None:
                    counted[key, name, mask, None] += 1
                elif seen[digest] < key:
                    counted[key, name, mask | DUPLICATE, None] += 1
                else:
                    place[digest] = at
                    counted[key, name, mask, digest] += 1
            out = list(counted)
            # Rows that are settled go to any range.
            numbers = [ranges.number(texts[place[d]], d) if d else (turn + i) % ranges.count for i, (_, _, _, d) in enumerate(out)]
            turn += len(out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers, pa.int32()),
                    pa.array([o[0] for o in out], key_type),
                    pa.array([o[1] for o in out], pa.string()),
                    pa.array([o[2] for o in out], pa.int32()),
                    pa.array(list(counted.values()), pa.int64()),
                    pa.array([texts[place[o[3]]] if o[3] else None for o in out], pa.binary()),
                ],
                names=["range", "id", "part", "mask", "n", "body"],
            )

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, current, ready = RadixTrie(), None, []
        key_type = None

        def batch() -> pa.RecordBatch:
            columns = list(zip(*ready, strict=True)) or [[], [], [], []]
            ready.clear()
            kinds = (key_type, pa.string(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["id", "part", "mask", "n"])

        for part in batches:
            key_type = part.column("id").type
            for number, key, name, mask, n, body in zip(*(part.column(c).to_pylist() for c in ("range", "id", "part", "mask", "n", "body")), strict=True):
                if number != current:
                    ready.extend(trie.firsts())
                    trie, current = RadixTrie(), number
                if body is None:
                    ready.append((key, name, mask, n))
                else:
                    ready.extend((k, p, m | DUPLICATE, c) for k, p, m, c in trie.insert(body, key, name, mask, n))
                if len(ready) >= ROWS_AT_ONCE:
                    yield batch()
        ready.extend(trie.firsts())
        if ready:
            yield batch()

    dealt = (
        rows.mapInArrow(described, f"range int, id {kind}, part string, mask int, n bigint, body binary")
        .repartition(shuffle_tasks(docs), "range")
        .sortWithinPartitions("range")
    )
    return dealt.mapInArrow(marked, f"id {kind}, part string, mask int, n bigint")


@dataclass
class Orders:
    """For each order and step (rows) the masks (columns) that are kept, removed, and so on."""

    names: list[str]
    steps: list[int]
    kept: np.ndarray
    removed: np.ndarray
    redundant: np.ndarray
    unique: np.ndarray
    shapley: np.ndarray


def all_orders() -> Orders:
    masks = np.arange(MASKS)
    names, steps, letters = [], [], []
    kept, removed, redundant, unique = [], [], [], []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letter
            fails, gone = (masks & bit) > 0, (masks & before) > 0
            names.append("".join(FILTERS[k] for k in order))
            steps.append(step)
            letters.append(letter)
            kept.append((masks & (before | bit)) == 0)
            removed.append(fails & ~gone)
            redundant.append(fails & gone)
            unique.append(masks == bit)
            before |= bit
    matrix = np.array(removed, np.int64)
    by_filter = np.stack([matrix[np.array(letters) == k].sum(axis=0) for k in range(len(FILTERS))])
    return Orders(names, steps, np.array(kept, np.int64), matrix, np.array(redundant, np.int64), np.array(unique, np.int64), by_filter[letters])


def audit_filters(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", part_column: str = "source", text_column: str = "text") -> DataFrame:
    """What each filter does at each step of every order, by part.

    A document counts as good or toxic if any row of ``labels`` says so; a part has
    600 rows, also where nothing is removed. A table without rows gives none.
    """
    rows = stored(failed_filters(docs, id_column, part_column, text_column), "masks")
    said = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    )
    said = stored(said.where(F.col("good") | F.col("toxic")), "said")
    # Rows that share an id are one row of the join.
    each = rows.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    labelled = each.join(said, "id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"),
    )
    parts = labelled.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))

    def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = all_orders()
        for batch in batches:
            for name, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                n, good, toxic = (np.zeros(MASKS, np.int64) for _ in range(3))
                for c in counts:
                    n[c["mask"]], good[c["mask"]], toxic[c["mask"]] = c["n"], c["good"], c["toxic"]
                figures = [orders.kept @ n, orders.removed @ n, orders.redundant @ n, orders.unique @ n, orders.removed @ good, orders.removed @ toxic, orders.shapley @ n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(orders.names), pa.string()), pa.array(orders.names, pa.string()), pa.array(orders.steps, pa.int32()), *map(pa.array, figures)],
                    names=["part", "filter_order", "step", *FIGURES],
                )

    return parts.mapInArrow(expanded, "part string, filter_order string, step int, " + ", ".join(f"{f} bigint" for f in FIGURES))


FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
