"""Maximal periodic runs of words in whole texts, found with suffix trees.

A run is a stretch of words with smallest period q, of at least ``LEAST_WORDS`` and
``LEAST_TIMES`` * q words, that no neighbouring word extends. Where the words of a
text can hold one is settled first over a whole slice of texts: every three words
of a run stand again within a quarter of its length. Each such stretch gets the
suffix trees of its words and of their reversal. Leaves in the order of a tour of
the tree, and the shallowest node passed between two of them, answer how far two
places agree in constant time; the longest Lyndon word at each place, under an order
of words and the opposite one, is the only root that a run can have there, and it is
extended in both directions.

A stretch takes about 1 kB a word while it is worked on; other texts only their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgermill.llm.ragged import mixed, split_words, text_slices

LEAST_WORDS = 6
LEAST_TIMES = 4
#: Words compared to see whether a place can lie in a run; three is right for the two limits above.
GRAM = 3
#: The end of a stretch, smaller than every word in either order.
END = -1
RUN = "struct<start: bigint, length: bigint, period: bigint>"


class SuffixTree:
    """Ukkonen's tree of a sequence of word numbers that ends in ``END``; node 0 is the root."""

    def __init__(self, text: list[int]) -> None:
        self.size = len(text)
        begin, stop, link = [0], [0], [0]
        children: list[dict[int, int]] = [{}]
        self.begin, self.stop, self.children = begin, stop, children
        size = self.size
        node = edge = length = waiting = 0
        for i, word in enumerate(text):
            waiting += 1
            last = 0
            while waiting:
                if not length:
                    edge = i
                child = children[node].get(text[edge])
                if child is None:
                    children[node][text[edge]] = len(begin)
                    begin.append(i)
                    stop.append(size)
                    link.append(0)
                    children.append({})
                    if last:
                        link[last] = node
                        last = 0
                else:
                    span = stop[child] - begin[child]
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if text[begin[child] + length] == word:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    inner, leaf = len(begin), len(begin) + 1
                    begin += [begin[child], i]
                    stop += [begin[child] + length, size]
                    link += [0, 0]
                    begin[child] += length
                    children += [{word: leaf, text[begin[child]]: child}, {}]
                    children[node][text[edge]] = inner
                    if last:
                        link[last] = inner
                    last = inner
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1

    def tour(self, opposite: bool = False) -> tuple[list[int], list[int]]:
        """Suffixes in order, and the depth of the shallowest node between each and the one before."""
        suffixes, depths = [], []
        stack = [(0, 0, 0)]
        while stack:
            node, depth, low = stack.pop()
            depth += self.stop[node] - self.begin[node]
            below = self.children[node]
            if not below:
                suffixes.append(self.size - depth)
                depths.append(low)
                continue
            words = sorted(below, reverse=not opposite)
            if opposite and words[0] == END:
                words = [*words[1:], END]
            # The stack gives the last word first; only the first child keeps what was passed on the way.
            stack.extend((below[w], depth, depth) for w in words[:-1])
            stack.append((below[words[-1]], depth, low))
        return suffixes, depths


class Agreement:
    """How many words two places of a sequence agree on, by the lowest common ancestor of their leaves."""

    def __init__(self, suffixes: list[int], depths: list[int]) -> None:
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.least = [np.array(depths, np.int32)]
        width = 1
        while 2 * width <= len(suffixes):
            level = self.least[-1]
            self.least.append(np.minimum(level[:-width], level[width:]))
            width *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words from ``a`` and from ``b`` on that agree; the places of a pair must differ."""
        left, right = self.rank[a], self.rank[b]
        low, high = np.minimum(left, right) + 1, np.maximum(left, right)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(low), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.least[k][low[at]], self.least[k][high[at] - (1 << k) + 1])
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """The next place of a smaller suffix, which ends the longest Lyndon word at each place."""
    out, stack = [0] * len(rank), []
    for i in range(len(rank) - 1, -1, -1):
        while stack and rank[stack[-1]] > rank[i]:
            stack.pop()
        out[i] = stack[-1] if stack else len(rank)
        stack.append(i)
    return out


def runs_of(codes: list[int]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of word numbers, by start and period."""
    size = len(codes)
    tree = SuffixTree([*codes, END])
    upward = tree.tour()
    agree = Agreement(*upward)
    downward, _ = tree.tour(opposite=True)
    backward = Agreement(*SuffixTree([*reversed(codes), END]).tour())
    found: set[tuple[int, int, int]] = set()
    for order in (upward[0], downward):
        rank = [0] * (size + 1)
        for r, suffix in enumerate(order):
            rank[suffix] = r
        at = np.arange(size)
        period = np.array(next_smaller(rank)[:size], np.int64) - at
        possible = period * LEAST_TIMES <= size
        at, period = at[possible], period[possible]
        before = backward(size - at, size - at - period)
        length = before + period + agree(at, at + period)
        kept = length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
        found.update(zip((at - before)[kept].tolist(), length[kept].tolist(), period[kept].tolist(), strict=True))
    return sorted(found, key=lambda r: (r[0], r[2]))


def possible_stretches(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and sizes of the stretches that can hold runs; each run lies in one of them.

    Any three words of a run of period q and length n stand again q words away
    inside it, and q is at most n / 4. So places whose three words do not come again
    so near, for the length of the stretch they are in, are left out, until no more go.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    count = len(codes) - GRAM + 1
    if count < 1:
        return none
    key = np.zeros(count, np.uint64)
    for k in range(GRAM):
        key = mixed(key * np.uint64(3) + codes[k : k + count].astype(np.uint64) + np.uint64(1))
    inside = np.zeros(len(codes) + 1, bool)
    for k in range(1, GRAM):
        inside[np.maximum(bounds[1:] - k, 0)] = True
    inside = ~inside[:count]
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:count]
    order = np.argsort(key, kind="stable")
    same = (key[order[1:]] == key[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    far = np.iinfo(np.int64).max
    gap = np.where(same, order[1:] - order[:-1], far)
    near = np.full(count, far)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    alive = inside & (near < far)
    while True:
        edges = np.diff(np.concatenate([[0], alive.astype(np.int8), [0]]))
        starts, sizes = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - np.flatnonzero(edges == 1) + GRAM - 1
        if not len(starts):
            return none
        allowed = np.where(sizes >= LEAST_WORDS, sizes // LEAST_TIMES, 0)
        places = np.flatnonzero(alive)
        good = near[places] <= np.repeat(allowed, sizes - GRAM + 1)
        if good.all():
            return starts, sizes
        alive[places[~good]] = False


def text_runs(column: pa.Array) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of the texts that have any, by row."""
    words = split_words(column)
    out: dict[int, list[tuple[int, int, int]]] = {}
    starts, sizes = possible_stretches(words.codes, words.bounds)
    rows = np.searchsorted(words.bounds, starts, side="right") - 1
    for row, start, size in zip(rows.tolist(), starts.tolist(), sizes.tolist(), strict=True):
        first = start - int(words.bounds[row])
        found = [(first + s, n, q) for s, n, q in runs_of(words.codes[start : start + size].tolist())]
        if found:
            out.setdefault(row, []).extend(found)
    # Stretches may share words at their ends, never a run.
    return {row: sorted(set(found), key=lambda r: (r[0], r[2])) for row, found in out.items()}


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest length / period; of equal ones the first, then the one of the smaller period."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """Words joined by one blank, without those that a run contains after its first period."""
    words = text.split()
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    return b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``runs`` (by start, then period), ``strongest`` and ``collapsed`` text of each row.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, numbered from 0. NULL,
    empty and blank texts have no run, no strongest run and an empty collapsed text.
    Repeated rows give repeated rows; other columns are not read. Nothing is
    shuffled; a text is worked on whole.
    """
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            column = part.column("text")
            found = text_runs(column)
            texts = pc.fill_null(column, "").cast(pa.large_binary()).to_pylist()
            lists = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found.get(i, [])] for i in range(len(texts))]
            best = [dict(zip(("start", "length", "period"), strongest(found[i]), strict=True)) if i in found else None for i in range(len(texts))]
            short = [collapsed(t, found.get(i, [])) for i, t in enumerate(texts)]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(lists, pa.list_(run)), pa.array(best, run), pa.array(short, pa.binary()).cast(pa.string())],
                names=["id", "runs", "strongest", "collapsed"],
            )

    return rows.mapInArrow(searched, f"id {kind}, runs array<{RUN}>, strongest {RUN}, collapsed string").withColumnRenamed("id", id_column)
