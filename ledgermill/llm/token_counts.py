"""Exact token counts of byte-level BPE by rank-synchronous merging of arrays.

Texts are cut into pre-tokens with array operations over code points. The
distinct pre-tokens of a slice are laid out as one ragged array of symbols; in
each round every sequence merges all places of its lowest-ranked pair at once,
until no sequence has a pair left. A pre-token's count is the number of its
surviving symbols.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.ragged import numbered, pieces, text_bytes, text_slices

NO_RANK = np.int64(1 << 40)
SLOT_BITS = 19
LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3


@dataclass
class Merges:
    """Pairs in ascending key order with the rank and the result of each.

    ``slots`` finds a pair by a hash of its key; pairs whose slot is taken are
    marked in ``shared`` and found by binary search.
    """

    byte_ids: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    slots: np.ndarray
    shared: np.ndarray
    specials: list[bytes]


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others follow from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_merges(path: str) -> Merges:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocabulary = spec["model"]["vocab"]
    byte_ids = np.zeros(256, np.int64)
    for character, byte in printable_bytes().items():
        byte_ids[byte] = vocabulary[character]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    keys = np.array([vocabulary[a] << 20 | vocabulary[b] for a, b in pairs], np.int64)
    results = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    slots, shared = np.zeros(1 << SLOT_BITS, np.int64), np.zeros(1 << SLOT_BITS, bool)
    place = slot_of(keys)
    slots[place] = np.arange(len(keys))
    shared[place[slots[place] != np.arange(len(keys))]] = True
    specials = [t["content"].encode() for t in spec["added_tokens"]]
    return Merges(byte_ids, keys, order.astype(np.int64), results[order], slots, shared, specials)


def slot_of(keys: np.ndarray) -> np.ndarray:
    return (keys * np.int64(0x1E3779B97F4A7C15) >> 40) & ((1 << SLOT_BITS) - 1)


def pair_ranks(left: np.ndarray, right: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Rank and result of each pair; ``NO_RANK`` where the vocabulary has no such pair."""
    key = left << 20 | right
    place = slot_of(key)
    at = merges.slots[place]
    known = merges.keys[at] == key
    again = np.flatnonzero(~known & merges.shared[place])
    at[again] = np.minimum(np.searchsorted(merges.keys, key[again]), len(merges.keys) - 1)
    known[again] = merges.keys[at[again]] == key[again]
    return np.where(known, merges.ranks[at], NO_RANK), merges.results[at]


def surviving_symbols(words: pa.Array, merges: Merges) -> np.ndarray:
    """Tokens of each byte string after all merges."""
    counts = np.zeros(len(words), np.int64)
    data, offsets = words.buffers()[2], np.frombuffer(words.buffers()[1], np.int64)
    offsets = offsets[words.offset : words.offset + len(words) + 1]
    if data is None or not len(words):
        return counts
    symbols = merges.byte_ids[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]]
    owner = np.repeat(np.arange(len(words)), np.diff(offsets))
    while len(symbols):
        inner = owner[1:] == owner[:-1]
        ranks, results = pair_ranks(symbols[:-1], symbols[1:], merges)
        ranks = np.where(inner, ranks, NO_RANK)
        first = np.flatnonzero(np.concatenate([[True], ~inner]))
        lowest = np.minimum.reduceat(np.append(ranks, NO_RANK), first)
        # A sequence without a pair is done: count it and take it out.
        number = np.cumsum(np.concatenate([[True], ~inner])) - 1
        done = (lowest == NO_RANK)[number]
        counts += np.bincount(owner[done], minlength=len(words))
        here = np.append((ranks == lowest[number[:-1]]) & (ranks < NO_RANK), False)
        # In a run of overlapping places the leftmost is taken, then every second one.
        run = here & ~np.concatenate([[False], here[:-1]])
        start = np.maximum.accumulate(np.where(run, np.arange(len(here)), 0))
        here &= (np.arange(len(here)) - start) % 2 == 0
        symbols = np.where(here, np.append(results, 0), symbols)
        keep = ~done
        keep[1:] &= ~here[:-1]
        symbols, owner = symbols[keep], owner[keep]
    return counts


#: The white space of Unicode.
BLANKS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
UNSEEN = 255


def character_classes() -> np.ndarray:
    """Class of every code point; ``classified`` fills those that texts have."""
    kinds = np.full(0x110000, UNSEEN, np.uint8)
    kinds[BLANKS] = SPACE
    return kinds


def classified(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The class of each code point: letter, number, white space or other."""
    kind = kinds[points]
    for code in np.unique(points[kind == UNSEEN]).tolist():
        kinds[code] = {"L": LETTER, "N": DIGIT}.get(unicodedata.category(chr(code))[0], OTHER)
    return kinds[points] if (kind == UNSEEN).any() else kind


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8 and the byte each starts at."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[starts].astype(np.int32)
    if len(starts) == len(data):
        return lead, starts
    padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int32) & 0x3F
    points = lead.copy()
    two, three, four = (lead >= 0xC0) & (lead < 0xE0), (lead >= 0xE0) & (lead < 0xF0), lead >= 0xF0
    at = starts[two]
    points[two] = (lead[two] & 0x1F) << 6 | padded[at + 1]
    at = starts[three]
    points[three] = (lead[three] & 0x0F) << 12 | padded[at + 1] << 6 | padded[at + 2]
    at = starts[four]
    points[four] = (lead[four] & 0x07) << 18 | padded[at + 1] << 12 | padded[at + 2] << 6 | padded[at + 3]
    return points, starts


def special_spans(data: np.ndarray, offsets: np.ndarray, specials: list[bytes]) -> list[tuple[int, int]]:
    """Places of special strings that lie within one text, leftmost first."""
    raw, found = data.tobytes(), []
    for special in specials:
        at = raw.find(special)
        while at >= 0:
            owner = int(np.searchsorted(offsets, at, side="right"))
            inside = at + len(special) <= offsets[owner]
            if inside:
                found.append((at, at + len(special)))
            at = raw.find(special, at + (len(special) if inside else 1))
    return sorted(found)


def pre_tokens(data: np.ndarray, edges: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the pre-tokens of a byte-level vocabulary.

    A pre-token is a contraction, a run of letters, of numbers or of other signs
    with the blank before it, or white space. Of white space before a word the
    last character stands alone, or joins the word if it is a blank. ``edges``
    are bytes at which a pre-token must start.
    """
    points, at = code_points(data)
    total = len(points)
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(data) + 1, bool)
    cut[edges] = True
    cut = cut[at]
    cut[0] = True
    kind = classified(points, kinds)
    run = cut.copy()
    run[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last = np.append(run[1:], True)
    # The last white space of a run before a word starts a pre-token of its own.
    alone = space & last & ~np.append(cut[1:], True)
    begin = run | alone
    joined = np.zeros(total, bool)
    joined[1:] = alone[:-1] & (points[:-1] == 0x20)
    begin &= ~joined
    # Contractions: only where a pre-token starts at the apostrophe itself.
    quote = np.flatnonzero(begin & (points == 0x27))
    ahead = np.append(points, [0, 0])
    stop = np.append(cut, [True, True])
    one, two = ahead[quote + 1], ahead[quote + 2]
    free = ~stop[quote + 1]
    single = free & np.isin(one, [ord(c) for c in "stmd"])
    both = free & ~stop[quote + 2]
    double = np.zeros(len(quote), bool)
    for a, b in ("re", "ve", "ll"):
        double |= both & (one == ord(a)) & (two == ord(b))
    for which, size in ((single, 2), (double & ~single, 3)):
        places = quote[which]
        begin[places + 1] = False
        after = places + size
        begin[after[after < total]] = True
    starts = at[np.flatnonzero(begin)]
    return starts, np.append(starts[1:], len(data))


def batch_counts(column: pa.Array, merges: Merges, kinds: np.ndarray) -> np.ndarray:
    """Tokens of each text of a column."""
    data, offsets = text_bytes(column)
    spans = special_spans(data, offsets, merges.specials)
    flat = np.array(spans, np.int64).ravel()
    starts, ends = pre_tokens(data, np.concatenate([offsets, flat]), kinds)
    if spans:
        # A special string is one token: leave its pre-tokens out and count it by itself.
        first = flat[::2]
        where = np.searchsorted(first, starts, side="right") - 1
        inside = (where >= 0) & (starts < flat[1::2][np.maximum(where, 0)])
    else:
        first, inside = flat, np.zeros(len(starts), bool)
    codes, vocabulary = numbered(pieces(data, starts, ends))
    each = surviving_symbols(vocabulary, merges)[codes] if len(codes) else np.zeros(0, np.int64)
    each[inside] = 0
    running = np.concatenate([[0], np.cumsum(each)])
    bounds = np.searchsorted(starts, offsets)
    special = np.searchsorted(first, offsets)
    return np.diff(running[bounds]) + np.diff(special)


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 1024
) -> DataFrame:
    """``id_column``, n_bytes, n_tokens and over_limit (more than ``limit``) of each row.

    NULL texts count as empty: 0 bytes, 0 tokens. Rows with a NULL or repeated id
    keep one result each; an empty table gives no row. The tokenizer file is read
    by each task, so its path must exist on all machines.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, kinds = load_merges(tokenizer_path), character_classes()
        for part in text_slices(batches):
            tokens = batch_counts(part.column("text"), merges, kinds)
            size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), size, pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
                names=[id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    return source.mapInArrow(
        counted, f"`{id_column}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
