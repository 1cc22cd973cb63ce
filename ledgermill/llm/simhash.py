"""SimHash fingerprints and the search for fingerprints within a Hamming radius.

The terms of a text are its runs of five words, one ending at each word; at the
start the run is filled with blanks, so short texts have terms too. Every
occurrence of a term votes on each bit of the fingerprint with the sign that the
term's hash has there; a term's weight is therefore its count.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.ordered import AT, range_bounds, ranges_of, shuffle_tasks, with_range
from ledgermill.llm.ragged import mixed, split_words, text_slices, word_hashes
from ledgermill.sources.paths import stored

BITS = 256
TERM_WORDS = 5
#: Terms whose bits are spread out at once in a task.
CHUNK = 1 << 15
#: Queries that are looked for in one pass over the fingerprints.
QUERIES = 1 << 17


def term_hashes(column: pa.Array, words_per_term: int = TERM_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the term ending at each word, and the bounds of each text's words."""
    words = split_words(column, lower=True)
    total = len(words.codes)
    hashes = word_hashes(words.vocabulary)[words.codes] if total else np.zeros(0, np.uint64)
    place = np.arange(total)
    first = np.repeat(words.bounds[:-1], np.diff(words.bounds))
    out = np.zeros(total, np.uint64)
    for back in range(words_per_term - 1, -1, -1):
        step = hashes if not back else np.concatenate([hashes[:1].repeat(min(back, total)), hashes[:-back]])
        out = mixed(out * np.uint64(3) + np.where(place - back >= first, step, np.uint64(0)) + np.uint64(back + 1))
    return out, words.bounds


def fingerprints(column: pa.Array) -> np.ndarray:
    """The fingerprint of each text as ``BITS / 8`` bytes; a text without words has only zero bits."""
    hashes, bounds = term_hashes(column)
    owner = np.repeat(np.arange(len(column)), np.diff(bounds))
    votes = np.zeros((len(column), BITS), np.int64)
    for at in range(0, len(hashes), CHUNK):
        part, whose = hashes[at : at + CHUNK], owner[at : at + CHUNK]
        lanes = [mixed(part + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)) for k in range(BITS // 64)]
        bits = np.unpackbits(np.stack(lanes, axis=1).view(np.uint8), axis=1)
        change = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]]))
        # Each text stands once in ``change``, so this adds every part once.
        votes[whose[change]] += np.add.reduceat(bits, change, axis=0, dtype=np.int32)
    return np.packbits(2 * votes > np.diff(bounds)[:, None], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def as_hex(prints: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in prints]


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the next text's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[str]]]:
    """Ids, texts and next texts of sorted rows; the last row of each range only serves as a next one."""
    held: tuple[int, object, str] | None = None
    for part in text_slices(batches):
        rows = list(
            zip(part.column("copy").to_pylist(), part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True)
        )
        rows = ([held] if held else []) + [(copy, key, text or "") for copy, key, text in rows]
        held = rows[-1]
        pairs = [(a[1], a[2], b[2]) for a, b in zip(rows, rows[1:], strict=False) if not a[0]]
        if pairs:
            ids, texts, following = zip(*pairs, strict=True)
            yield list(ids), list(texts), list(following)


def edit_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likenesses.

    The edited form has the last ``floor(n_chars / 2)`` code points replaced by
    the first as many of the next text in ascending id order; after the last
    comes the first. NULL texts are empty. Rows of equal id are ordered by a hash
    of their text; a NULL id comes first. One row is its own successor.

    Texts are shuffled once, by ranges of the id; the first row of each range is
    also sent to the range before, so no task waits for another.
    """
    bounds = range_bounds(docs, id_column)
    rows = with_range(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), "id", bounds)
    known = ranges_of(rows.drop("text"), "id")
    # One row per range: the broadcast is bounded by the number of ranges.
    firsts = docs.sparkSession.createDataFrame(
        [(first, known.before(n)) for n, first in zip(known.numbers, known.firsts, strict=True)],
        f"first {docs.schema[id_column].dataType.simpleString()}, also int",
    )
    dealt = (
        rows.join(F.broadcast(firsts), F.col("id").eqNullSafe(F.col("first")), "left")
        .withColumn(
            "to",
            F.explode(
                F.array_compact(
                    F.array(
                        F.struct(F.col(AT).alias("range"), F.lit(False).alias("copy")),
                        F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("range"), F.lit(True).alias("copy"))),
                    )
                )
            ),
        )
        .select("id", "text", "to.range", "to.copy")
        .repartition(shuffle_tasks(docs), "range")
        .sortWithinPartitions("range", "copy", F.col("id").asc_nulls_first(), F.xxhash64("text"))
        .select("id", "text", "copy")
    )

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, following in with_next(batches):
            changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
            # The next text of most rows is the row after.
            own = fingerprints(pa.array(texts, pa.large_string()))
            after = np.concatenate([own[1:], own[:1]])
            other = [i for i in range(len(texts)) if i + 1 == len(texts) or texts[i + 1] is not following[i]]
            after[other] = fingerprints(pa.array([following[i] for i in other], pa.large_string()))
            new = fingerprints(pa.array(changed, pa.large_string()))
            yield pa.RecordBatch.from_pydict(
                {
                    id_column: pa.array(ids, id_type),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                    "fingerprint": as_hex(own),
                    "edited_fingerprint": as_hex(new),
                    "near_edited": likeness(own, new),
                    "near_next": likeness(own, after),
                }
            )

    kind = docs.schema[id_column].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    return dealt.mapInArrow(
        printed,
        f"`{id_column}` {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def radius_for(similarity: float, recall: float) -> int:
    """The least radius that holds a pair of this similarity with probability ``recall`` at least.

    A term set's fingerprint bits are signs of sums of random signs, so with J the
    similarity as shared over all terms, each bit differs with probability
    ``acos(2 J / (1 + J)) / pi``, and the bits are independent of each other.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    within = 0.0
    for radius in range(BITS + 1):
        within += math.comb(BITS, radius) * p**radius * (1 - p) ** (BITS - radius)
        if within >= recall:
            return radius
    return BITS


def as_lanes(column: pa.Array) -> list[np.ndarray]:
    """The 64-bit lanes of fingerprints in hexadecimal digits."""
    lanes = BITS // 64
    flat = np.frombuffer(bytes.fromhex("".join(column.to_pylist())), np.uint64).reshape(-1, lanes)
    return [np.ascontiguousarray(flat[:, i]) for i in range(lanes)]


def near_lists(queries: DataFrame, prints: DataFrame, radius: int) -> DataFrame:
    """``query``, ``found`` and ``distance``: for each query the keys of the other fingerprints at most ``radius`` bits apart.

    ``queries`` has a column ``fingerprint``, ``prints`` also a ``key``; both hold
    each fingerprint once, and none is NULL. Every query is compared with every
    fingerprint, so none is missed at any radius. A query has a row for each batch
    of fingerprints that holds a near one. Queries go through the driver in blocks
    of ``QUERIES``; fingerprints are not shuffled.
    """
    kind = prints.schema["key"].dataType.simpleString()
    schema = f"query string, found array<{kind}>, distance array<int>"
    context = prints.sparkSession.sparkContext

    def search(block: list[str]) -> DataFrame:
        shared = context.broadcast(block)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = shared.value
            asked = as_lanes(pa.array(names))
            for batch in batches:
                if not batch.num_rows:
                    continue
                lanes, keys = as_lanes(batch.column("fingerprint")), batch.column("key")
                query, found, distance = [], [], []
                for i in range(len(names)):
                    # Most fingerprints are too far already on half of the bits.
                    half = np.bitwise_count(lanes[0] ^ asked[0][i]) + np.bitwise_count(lanes[1] ^ asked[1][i])
                    at = np.flatnonzero(half <= radius)
                    apart = half[at].astype(np.int32)
                    for k in range(2, len(lanes)):
                        apart += np.bitwise_count(lanes[k][at] ^ asked[k][i])
                    near = np.flatnonzero((apart > 0) & (apart <= radius))
                    if len(near):
                        query.append(names[i])
                        found.append(at[near])
                        distance.append(apart[near])
                if query:
                    offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(query),
                            pa.ListArray.from_arrays(offsets, keys.take(pa.array(np.concatenate(found)))),
                            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(distance))),
                        ],
                        names=["query", "found", "distance"],
                    )

        return prints.select("fingerprint", "key").mapInArrow(work, schema)

    out: DataFrame | None = None
    rows = queries.select("fingerprint").toLocalIterator()
    while block := [r[0] for r in islice(rows, QUERIES)]:
        more = search(block)
        out = more if out is None else out.union(more)
    return prints.sparkSession.createDataFrame([], schema) if out is None else out


def within_radius(queries: DataFrame, prints: DataFrame, radius: int) -> DataFrame:
    """All pairs (query, found, distance) of different fingerprints at most ``radius`` bits apart.

    Both frames have a column ``fingerprint``; equal ones count once, and NULL
    ones are left out.
    """
    q, p = (df.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct() for df in (queries, prints))
    near = near_lists(q, p.withColumn("key", F.col("fingerprint")), radius)
    pairs = near.select("query", F.explode(F.arrays_zip("found", "distance")).alias("_p"))
    return pairs.select("query", "_p.found", "_p.distance")


def with_near(prints: DataFrame, asked: Column, radius: int, id_column: str = "doc_id") -> DataFrame:
    """``prints`` with class_id, near_count and near_ids.

    Rows of equal fingerprints are a class; ``class_id`` is its least id. For the
    rows that are ``asked``, ``near_count`` is the number of other classes at most
    ``radius`` bits apart and ``near_ids`` their class ids in ascending order (a class
    without any id is only counted); both are NULL for other rows.
    """
    classes = stored(
        prints.groupBy("fingerprint").agg(
            F.min(id_column).alias("key"), F.count("*").alias("n"), F.coalesce(F.max(asked), F.lit(False)).alias("asked")
        ),
        "classes",
    )
    near = (
        near_lists(classes.where("asked"), classes, radius)
        .groupBy(F.col("query").alias("fingerprint"))
        .agg(F.sum(F.size("found")).alias("n_near"), F.flatten(F.collect_list("found")).alias("near"))
    )
    # Other classes are one row that has all there is to know.
    facts = classes.where("asked OR n > 1").select("fingerprint", "key").join(near, "fingerprint", "left")
    known = stored(facts.withColumn("near", F.array_sort(F.array_compact("near"))), "near")
    wanted = F.coalesce(asked, F.lit(False))
    return prints.join(known, "fingerprint", "left").select(
        *prints.columns,
        F.coalesce("key", id_column).alias("class_id"),
        F.when(wanted, F.coalesce("n_near", F.lit(0))).alias("near_count"),
        F.when(wanted, F.coalesce("near", F.array().cast(f"array<{prints.schema[id_column].dataType.simpleString()}>"))).alias("near_ids"),
    )
