"""A hidden Markov language model over whole texts, trained by Baum-Welch.

Every token has a base probability from its count in the training texts. The
hidden states do not repeat the vocabulary: tokens fall into classes, one for
each frequent word and ``BUCKETS`` for the hashes of all others, and a state
gives each class a probability that its words share in proportion to their base
probabilities. So the probability of a text is its base probability times a ratio
from the forward recursion over classes, and the model stays small however large
the vocabulary gets. Counts of all words take part: frequent words are looked up
in a table of bounded size, the rest is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.ragged import Words, split_words, text_slices
from ledgermill.llm.vectors import SCHEMA, task_array, tree_sum
from ledgermill.sources.paths import stored

#: Words whose counts are looked up instead of joined, and those of them with a class of their own.
FREQUENT, OWN_CLASS = 1 << 16, 1 << 13
BUCKETS = 1 << 12
END = OWN_CLASS + BUCKETS
CLASSES = END + 1
STATES = 8
#: Rounds over one eighth of the training texts each, then rounds over all of them.
WARM_ROUNDS, FULL_ROUNDS = 8, 2
#: Weight of the base distribution in the counts of each state.
PRIOR = 2500.0
#: Seed of the hash that Spark's ``xxhash64`` uses; both sides must agree on buckets.
HASH_SEED = 42
TOKENS_AT_ONCE = 1 << 20


@dataclass
class BaseCounts:
    """Word counts of the training texts: all of them as a frame, the frequent ones at hand."""

    counts: DataFrame  # word, n
    frequent: list[str]
    frequent_counts: np.ndarray
    texts: int
    tokens: int
    distinct: int

    @property
    def mass(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)


def count_words(docs: DataFrame, training: Column, text_column: str = "text") -> BaseCounts:
    """Counts of the words of the training texts; each text also has one end token."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            words = split_words(part.column("text"), lower=True)
            times = np.bincount(words.codes, minlength=len(words.vocabulary))
            yield pa.RecordBatch.from_arrays(
                [words.vocabulary.cast(pa.binary()).cast(pa.string()), pa.array(times.astype(np.int64))], names=["word", "n"]
            )

    used = docs.where(training).select(F.col(text_column).alias("text"))
    counts = stored(used.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    texts = used.count()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    return BaseCounts(
        counts,
        [r["word"] for r in top],
        np.array([r["n"] for r in top], np.int64),
        texts,
        total[0] + texts,
        total[1] + (1 if texts else 0),
    )


def class_masses(base: BaseCounts) -> np.ndarray:
    """Base probability of each class; a bucket also holds one word not seen in training."""
    out = np.full(CLASSES, 0.5)
    own = base.frequent_counts[:OWN_CLASS]
    out[:OWN_CLASS] = 0.5  # classes without a word are never met
    out[: len(own)] = own + 0.5
    rest = base.counts.join(
        F.broadcast(base.counts.sparkSession.createDataFrame([(w,) for w in base.frequent[:OWN_CLASS]], "word string")),
        "word",
        "left_anti",
    )
    bucket = F.xxhash64("word").bitwiseAND(BUCKETS - 1)
    for row in rest.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        out[OWN_CLASS + row["bucket"]] += row["n"] + 0.5 * row["words"]
    out[END] = base.texts + 0.5
    return out / base.mass


def prepare(docs: DataFrame, base: BaseCounts, training: Column, id_column: str, text_column: str) -> DataFrame:
    """Each text as classes, with the base score of its frequent words and its other words with their counts."""
    session = docs.sparkSession
    shared = session.sparkContext.broadcast((base.frequent, base.frequent_counts, base.texts, base.mass))
    kind = docs.schema[id_column].dataType.simpleString()

    def prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts, texts, mass = shared.value
        table = pa.array([w.encode() for w in frequent], pa.large_binary())
        logs = np.log10((counts + 0.5) / mass) if len(counts) else np.zeros(0)
        end_log = np.log10((texts + 0.5) / mass)
        for part in text_slices(batches):
            words: Words = split_words(part.column("text"), lower=True)
            size, rows = len(words.vocabulary), part.num_rows
            rank = pc.fill_null(pc.index_in(words.vocabulary, value_set=table), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            klass = rank.copy()
            for k in np.flatnonzero((rank < 0) | (rank >= OWN_CLASS)).tolist():
                klass[k] = OWN_CLASS + (xxhash.xxh64_intdigest(words.vocabulary[k].as_py(), HASH_SEED) & (BUCKETS - 1))
            known = rank >= 0
            score = np.zeros(size)
            score[known] = logs[rank[known]]
            document = words.document()
            base_part = np.bincount(document, score[words.codes], rows) + end_log
            n_known = np.bincount(document, known[words.codes], rows).astype(np.int64) + (texts > 0)
            # Other words, once per text with their count there.
            other = ~known[words.codes]
            pairs, times = np.unique(document[other] * max(1, size) + words.codes[other], return_counts=True)
            whose = pairs // max(1, size)
            rare = pa.StructArray.from_arrays(
                [words.vocabulary.take(pa.array(pairs % max(1, size))).cast(pa.binary()).cast(pa.string()), pa.array(times.astype(np.int64))],
                names=["word", "n"],
            )
            classes = np.insert(klass[words.codes], words.bounds[1:], END).astype(np.int32)
            class_bounds = words.bounds + np.arange(rows + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    part.column("id"),
                    part.column("training"),
                    pa.array(np.diff(class_bounds).astype(np.int64)),
                    pa.array(n_known),
                    pa.array(base_part),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(whose, np.arange(rows + 1)).astype(np.int32)), rare),
                    pa.ListArray.from_arrays(pa.array(class_bounds.astype(np.int32)), pa.array(classes)),
                ],
                names=["row", "id", "training", "n_tokens", "n_known", "base", "rare", "classes"],
            )

    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("id"),
        training.alias("training"),
        F.col(text_column).alias("text"),
    )
    frame = source.mapInArrow(
        prepared,
        f"row bigint, id {kind}, training boolean, n_tokens bigint, n_known bigint, base double, "
        "rare array<struct<word: string, n: bigint>>, classes array<int>",
    )
    return stored(frame, "prepared-texts")


@dataclass
class HiddenModel:
    start: np.ndarray
    moves: np.ndarray
    emissions: np.ndarray  # of each state and class

    def ratios(self, masses: np.ndarray) -> np.ndarray:
        """Emission over base probability, classes first."""
        return np.ascontiguousarray((self.emissions / masses).T)


def first_model(masses: np.ndarray, states: int, seed: int = 7) -> HiddenModel:
    """States that stay put and differ by chance."""
    draw = np.random.default_rng(seed)
    emissions = masses * np.exp(0.5 * draw.standard_normal((states, len(masses))))
    moves = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(moves, 0.9 if states > 1 else 1.0)
    return HiddenModel(np.full(states, 1 / states), moves, emissions / emissions.sum(axis=1, keepdims=True))


@dataclass
class Lattice:
    """Texts walked in step, longest first: where each text starts and how many are alive at each step."""

    first: np.ndarray
    alive: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, bounds: np.ndarray) -> Lattice:
        counts = np.diff(bounds)
        order = np.argsort(-counts, kind="stable")
        length = counts[order]
        steps = int(length[0]) if len(length) else 0
        return cls(bounds[:-1][order], np.searchsorted(-length, -np.arange(steps), side="left"), order)


def forward(classes: np.ndarray, lattice: Lattice, model: HiddenModel, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward values of every token and its scale; the logs of a text's scales add up to its ratio."""
    states = len(model.start)
    alpha = np.zeros((len(classes), states))
    scale = np.ones(len(classes))
    now = np.zeros((0, states))
    for t, count in enumerate(lattice.alive.tolist()):
        at = lattice.first[:count] + t
        ahead = np.broadcast_to(model.start, (count, states)) if t == 0 else now[:count] @ model.moves
        now = ahead * ratios[classes[at]]
        total = now.sum(axis=1)
        now /= total[:, None]
        alpha[at], scale[at] = now, total
    return alpha, scale


def expected_counts(classes: np.ndarray, bounds: np.ndarray, model: HiddenModel, ratios: np.ndarray) -> np.ndarray:
    """Expected starts, moves and emissions of these texts, laid out in a row."""
    states = len(model.start)
    lattice = Lattice.of(bounds)
    alpha, scale = forward(classes, lattice, model, ratios)
    moves = np.zeros((states, states))
    later = np.ones((len(bounds) - 1, states))
    counts = lattice.alive.tolist()
    for t in range(len(counts) - 1, 0, -1):
        at = lattice.first[: counts[t]] + t
        back = later[: counts[t]] * ratios[classes[at]] / scale[at][:, None]
        before = alpha[at - 1].copy()
        # ``later`` holds what follows a token; texts that end here still hold ones.
        alpha[at] *= later[: counts[t]]
        moves += before.T @ back
        later[: counts[t]] = back @ model.moves.T
    if counts:
        at = lattice.first[: counts[0]]
        alpha[at] *= later[: counts[0]]
    emissions = np.stack([np.bincount(classes, alpha[:, s], CLASSES) for s in range(states)])
    begin = alpha[bounds[:-1][np.diff(bounds) > 0]].sum(axis=0)
    return np.concatenate([begin, (moves * model.moves).ravel(), emissions.ravel()])


def class_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with their classes and bounds, about ``TOKENS_AT_ONCE`` tokens at a time."""
    for batch in batches:
        lists = batch.column("classes")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + TOKENS_AT_ONCE, side="right")) - 1)
            yield batch.slice(at, stop - at), values[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
            at = stop


def re_estimated(counts: np.ndarray, masses: np.ndarray, states: int) -> HiddenModel:
    """The model of these expected counts, with the base distribution as prior."""
    start = counts[:states] + 1.0
    moves = counts[states : states + states * states].reshape(states, states) + 0.1
    emissions = counts[states + states * states :].reshape(states, -1) + PRIOR * masses
    return HiddenModel(
        start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emissions / emissions.sum(axis=1, keepdims=True)
    )


def train(prepared: DataFrame, masses: np.ndarray, states: int = STATES) -> HiddenModel:
    """Baum-Welch over the training rows: each round's counts are added up across all partitions.

    The first rounds see one eighth of the texts each, all different, which
    together are one pass; the last rounds see all of them.
    """
    context = prepared.sparkSession.sparkContext
    rows = prepared.where("training").select("row", "classes")
    model = first_model(masses, states)
    size = states + states * states + states * len(masses)
    for turn in range(WARM_ROUNDS + FULL_ROUNDS):
        part = rows if turn >= WARM_ROUNDS else rows.where(F.pmod(F.xxhash64("row"), F.lit(WARM_ROUNDS)) == turn)
        shared = context.broadcast((model.start, model.moves, model.emissions, masses))

        def counted(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start, moves, emissions, masses = shared.value
            model = HiddenModel(start, moves, emissions)
            ratios = model.ratios(masses)
            total = np.zeros(size)
            for _, classes, bounds in class_slices(batches):
                total += expected_counts(classes, bounds, model, ratios)
            if total.any():
                yield task_array(total)

        counts = tree_sum(part.select("classes").mapInArrow(counted, SCHEMA), size)
        model = re_estimated(counts, masses, states)
        shared.unpersist()
    return model


def score_texts(
    docs: DataFrame,
    training: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    states: int = STATES,
) -> DataFrame:
    """Base-10 log-probability of each text under the base counts and under the hidden model.

    Gives ``id_column``, training, n_tokens, n_known, train_tokens, base_score
    and score for each row. Words are lower-cased (A-Z) runs without white space,
    then comes one end token. A NULL text is empty and has only the end token; a
    NULL or repeated id keeps a row each. Without training texts every token has
    the same base probability.
    """
    base = count_words(docs, training, text_column)
    masses = class_masses(base)
    prepared = prepare(docs, base, training, id_column, text_column)
    model = train(prepared, masses, states)
    mass, tokens = base.mass, base.tokens
    shared = docs.sparkSession.sparkContext.broadcast((model.start, model.moves, model.emissions, masses))
    kind = docs.schema[id_column].dataType.simpleString()

    def gained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, moves, emissions, masses = shared.value
        model = HiddenModel(start, moves, emissions)
        ratios = model.ratios(masses)
        for part, classes, bounds in class_slices(batches):
            lattice = Lattice.of(bounds)
            scale = forward(classes, lattice, model, ratios)[1]
            gain = np.add.reduceat(np.log10(scale), bounds[:-1]) if part.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("row", "id", "training", "n_tokens", "n_known", "base")), pa.array(gain)],
                names=["row", "id", "training", "n_tokens", "n_known", "base", "gain"],
            )

    scored = prepared.drop("rare").mapInArrow(
        gained,
        f"row bigint, id {kind}, training boolean, n_tokens bigint, n_known bigint, base double, gain double",
    )
    rare = prepared.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    seen = F.coalesce(F.col("n"), F.lit(0))
    sums = (
        rare.join(base.counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10((seen + 0.5) / F.lit(mass))).alias("rest"),
            F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("rest_known"),
        )
    )
    base_score = F.col("base") + F.coalesce("rest", F.lit(0.0))
    return scored.join(sums, "row", "left").select(
        F.col("id").alias(id_column),
        "training",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        base_score.alias("base_score"),
        (base_score + F.col("gain")).alias("score"),
    )
