"""Quality of texts from rules of thumb that disagree, without any hand-made label.

Each labeller votes for good or poor text, or not at all. Expectation-
maximisation over the counts of vote patterns estimates how often each labeller
votes what on good and on poor texts. The posterior of a text's pattern is then
the label on which a hashed linear scorer is trained, which scores every text from
its own words and shapes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.hashed import FIT_TASKS, LinearModel, feature_columns, text_features, train_linear
from ledgermill.llm.ragged import split_words, text_bytes, text_slices
from ledgermill.sources.paths import stored

NO_VOTE, POOR, GOOD = 0, 1, 2
ITERATIONS = 200
#: Share of good texts taken for granted before any vote.
GOOD_SHARE = 0.8
#: The bounds of each labeller, below or above which it votes.
SIGN_SHARE, CAPITAL_SHARE, BAR_SHARE, SAME_WORD_SHARE = 0.12, 0.5, 0.1, 0.25
TWIN_SHARE, SAME_LINE_SHARE, WORD_LETTERS, DIGIT_SHARE = 0.1, 0.5, (2.0, 14.0), 0.3
ENOUGH_WORDS = 8


def shares_by_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean of the marks of each text; 0 for a text without any."""
    running = np.concatenate([[0], np.cumsum(marks, dtype=np.float64)])
    return np.diff(running[bounds]) / np.maximum(np.diff(bounds), 1)


def votes(column: pa.Array) -> np.ndarray:
    """One row of votes per text.

    Nine labellers vote for poor: on signs, capitals, bars between words, the
    commonest word, neighbouring words that are the same, repeated lines, the
    length of words, ends of sentences and digits. One votes for good: on prose.
    They vote from eight words on.
    """
    data, offsets = text_bytes(column)
    words = split_words(column)
    rows, total = len(column), np.diff(words.bounds)
    letters = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | (data >= 128)
    digits = (data >= 48) & (data <= 57)
    blank = np.isin(data, [0x20, *range(0x09, 0x0E)])
    signs = shares_by_text(~letters & ~digits & ~blank, offsets)
    n_letters = np.maximum(shares_by_text(letters, offsets), 1e-9)
    capitals = shares_by_text((data >= 65) & (data <= 90), offsets) / n_letters
    figures = shares_by_text(digits, offsets)
    document = words.document()
    size = max(1, len(words.vocabulary))
    pairs, times = np.unique(document * size + words.codes, return_counts=True)
    most = np.zeros(rows)
    np.maximum.at(most, pairs // size, times)
    common = most / np.maximum(total, 1)
    twin = np.zeros(len(words.codes), bool)
    twin[1:] = (words.codes[1:] == words.codes[:-1]) & (document[1:] == document[:-1])
    twins = shares_by_text(twin, words.bounds)
    spelled = words.vocabulary.to_pylist()
    bar = np.array([w in (b"|", b"/", b"-", b"*") for w in spelled], bool)
    ending = np.array([w[-1:] in b".?!" for w in spelled], bool)
    length = np.array([len(w) for w in spelled], np.float64)
    bars = shares_by_text(bar[words.codes], words.bounds)
    ends = shares_by_text(ending[words.codes], words.bounds)
    mean = shares_by_text(length[words.codes], words.bounds)
    lines = np.zeros(rows)
    for i, text in enumerate(column.to_pylist()):
        kept = [x for x in (text or "").split("\n") if x.strip()]
        lines[i] = 1 - len(set(kept)) / len(kept) if len(kept) >= 3 else 0.0
    enough = total >= ENOUGH_WORDS
    calm = (signs < SIGN_SHARE / 2) & (capitals < CAPITAL_SHARE / 2) & (figures < DIGIT_SHARE / 3)

    def poor(found: np.ndarray, asked: np.ndarray) -> np.ndarray:
        return np.where(asked & found, POOR, NO_VOTE)

    def good(found: np.ndarray, asked: np.ndarray) -> np.ndarray:
        return np.where(asked & found, GOOD, NO_VOTE)

    return np.stack(
        [
            poor(signs > SIGN_SHARE, enough),
            poor(capitals > CAPITAL_SHARE, enough),
            poor(bars > BAR_SHARE, enough),
            poor(common > SAME_WORD_SHARE, enough),
            poor(twins > TWIN_SHARE, enough),
            poor(lines > SAME_LINE_SHARE, enough),
            poor((mean < WORD_LETTERS[0]) | (mean > WORD_LETTERS[1]), enough),
            poor((ends < 0.005) | (ends > 0.6), enough),
            poor(figures > DIGIT_SHARE, enough),
            good(calm & (ends > 0.02) & (ends < 0.4) & (mean > 3) & (mean < 10), enough),
        ],
        axis=1,
    )


LABELLERS = 10


@dataclass
class LabelModel:
    rates: np.ndarray  # of each labeller, class (poor, good) and vote

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes is good; ``GOOD_SHARE`` without any vote."""
        log = np.tile(np.log([1 - GOOD_SHARE, GOOD_SHARE]), (len(patterns), 1))
        for k in range(patterns.shape[1]):
            told = patterns[:, k]
            log += np.where((told == NO_VOTE)[:, None], 0.0, np.log(self.rates[k, :, told]))
        log -= log.max(axis=1, keepdims=True)
        both = np.exp(log)
        return both[:, 1] / both.sum(axis=1)


def fit_label_model(patterns: np.ndarray, counts: np.ndarray) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns and how many texts have each.

    It starts from texts without a vote for poor being good, so the classes keep
    their meaning. The share of good texts is given: were it free, a labeller that
    is never contradicted could not be told from one that is always wrong. To vote not at all tells nothing about a text.
    """
    labellers = patterns.shape[1]
    poor, good = (patterns == POOR).sum(axis=1), (patterns == GOOD).sum(axis=1)
    belief = np.where(poor > 0, 0.02, np.where(good > 0, 0.98, 0.5))
    model = LabelModel(np.full((labellers, 2, 3), 0.5))
    for _ in range(ITERATIONS):
        weight = np.stack([counts * (1 - belief), counts * belief], axis=1)
        # Of each class, the share of texts that get each vote; a little more than none.
        rates = np.ones((labellers, 2, 3))
        for k in range(labellers):
            for told in (POOR, GOOD):
                rates[k, :, told] = (weight[patterns[:, k] == told].sum(axis=0) + 0.5) / (weight.sum(axis=0) + 1.5)
        model = LabelModel(rates)
        after = model.posterior(patterns)
        if len(after) == 0 or np.abs(after - belief).max() < 1e-9:
            break
        belief = after
    return model


def score_quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, votes, posterior, score and keep of each row.

    ``posterior`` is what the label model makes of the votes, ``score`` the linear
    scorer's probability that the text is good, ``keep`` whether that is 0.5 or
    more. A NULL or empty text has no votes, posterior and score 0, and is not
    kept. Vote patterns are counted over all rows (at most ``3 ** LABELLERS`` come
    to the driver); the scorer is trained on all rows with a text.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            given = votes(part.column("text"))
            code = given @ (3 ** np.arange(LABELLERS))
            yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int32))], names=["pattern"])

    counted = source.mapInArrow(voted, "pattern int").groupBy("pattern").count().collect()
    counted.sort(key=lambda r: r["pattern"])
    codes = np.array([r["pattern"] for r in counted], np.int64)
    counts = np.array([r["count"] for r in counted], np.float64)
    patterns = codes[:, None] // 3 ** np.arange(LABELLERS) % 3
    model = fit_label_model(patterns, counts)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            belief = model.posterior(votes(part.column("text")))
            target = np.stack([1 - belief, belief], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *feature_columns(text_features(part.column("text"))),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(belief) + 1, dtype=np.int32) * 2), pa.array(target.ravel())),
                ],
                names=["slots", "values", "target"],
            )

    chosen = source.where(F.length("text") > 0)
    features = chosen.mapInArrow(labelled, "slots array<int>, values array<float>, target array<double>")
    rows = stored(features.repartition(FIT_TASKS), "labelled")
    scorer = train_linear(rows, 2)
    shared = docs.sparkSession.sparkContext.broadcast((scorer.weights, scorer.bias))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = LinearModel(*shared.value)
        for part in text_slices(batches):
            text = part.column("text")
            given = votes(text)
            some = np.diff(text_bytes(text)[1]) > 0
            belief = np.where(some, model.posterior(given), 0.0)
            score = np.where(some, scorer.posteriors(text_features(text))[:, 1], 0.0)
            names = ["-", "p", "g"]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(["".join(names[v] for v in row) for row in given.tolist()]),
                    pa.array(belief),
                    pa.array(score),
                    pa.array(score >= 0.5),
                ],
                names=[id_column, "votes", "posterior", "score", "keep"],
            )

    return source.mapInArrow(scored, f"`{id_column}` {kind}, votes string, posterior double, score double, keep boolean")
