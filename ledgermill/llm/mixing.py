"""Document rates that bring soft domain memberships to target weights.

A scorer learned from the labelled table gives each document a probability for
each domain. Non-negative rates are then fitted by accelerated projected-gradient
least squares: the expected tokens of each domain, summed over all documents with
their rates, shall meet the targets, and rates shall stay near one otherwise. A
step needs only the domain totals, so each round is one sum over the table of
memberships, and a task finds a document's rate by going through the totals of
the rounds before.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.hashed import FIT_TASKS, LinearModel, feature_columns, text_features, train_linear
from ledgermill.llm.ragged import split_words, text_slices
from ledgermill.llm.vectors import SCHEMA, task_array, tree_sum
from ledgermill.sources.paths import stored

#: The domain scorer learns from all labelled rows; up to twice so many go to the texts by broadcast.
LABELLED_ROWS = 20_000
ROUNDS = 60
#: Weight of staying near a rate of one, against the squared miss of the targets.
NEARNESS = 1e-3
CLOSE_ENOUGH = 1e-7
DOMAINS = ("clean", "poor", "toxic")


def domain_targets(labels: DataFrame) -> DataFrame:
    """One row per labelled document: id and shares of the domains.

    Toxic is toxic, the rest is clean or poor by its quality. A label that is NULL
    does not count against a document; one without any label is left out, and
    repeated labels of a document are averaged.
    """
    known = labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) == 1
    poor = ~toxic & (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    shares = [F.avg(c.cast("double")) for c in (~toxic & ~poor, poor, toxic)]
    return known.groupBy(F.col("doc_id").alias("label_id")).agg(F.array(*shares).alias("target"))


def memberships(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, tokens (words) and posterior of each row, from a scorer learned on labelled rows."""
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    targets = domain_targets(labels)
    # Stored first, so that their number is known: they go to the texts, not the texts to them.
    chosen = stored(targets, "chosen-labels")
    if chosen.count() <= 2 * LABELLED_ROWS:
        chosen = F.broadcast(chosen)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found = feature_columns(text_features(part.column("text")))
            yield pa.RecordBatch.from_arrays([*found, part.column("target")], names=["slots", "values", "target"])

    rows = source.join(chosen, source["id"] == F.col("label_id")).select("text", "target")
    labelled = rows.mapInArrow(features, "slots array<int>, values array<float>, target array<double>")
    scorer = train_linear(stored(labelled.repartition(FIT_TASKS), "labelled"), len(DOMAINS), rate=0.2)
    shared = docs.sparkSession.sparkContext.broadcast((scorer.weights, scorer.bias))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = LinearModel(*shared.value)
        for part in text_slices(batches):
            posterior = scorer.posteriors(text_features(part.column("text")))
            tokens = np.diff(split_words(part.column("text")).bounds)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(tokens.astype(np.int64)), *(pa.array(posterior[:, k]) for k in range(len(DOMAINS)))],
                names=["id", "tokens", *(f"p_{d}" for d in DOMAINS)],
            )

    columns = ", ".join(f"p_{d} double" for d in DOMAINS)
    return source.mapInArrow(placed, f"id {kind}, tokens bigint, {columns}")


@dataclass
class Fit:
    """What the rounds so far have found out: how far each missed the targets, and with what momentum."""

    misses: list[np.ndarray]
    momentum: list[float]
    most: float

    def rates(self, posterior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rates of documents, and the point from which the next step is taken."""
        rate = np.ones(len(posterior))
        ahead = rate
        step = 1 / (1 + NEARNESS)
        for miss, weight in zip(self.misses, self.momentum, strict=True):
            slope = posterior @ miss + NEARNESS * (ahead - 1)
            after = np.clip(ahead - step * slope, 0.0, self.most)
            ahead = after + weight * (after - rate)
            rate = after
        return rate, ahead


def fit_rates(members: DataFrame, weights: Mapping[str, float], most: float = float("inf")) -> tuple[DataFrame, dict[str, dict[str, float]]]:
    """Members with their rate, and a report of tokens available, wanted and expected by domain.

    The targets are the weights times the amount of tokens for which the domain
    of the largest weight is used just once: others are thinned out or, unless
    ``most`` forbids it, repeated. A document without words has no part in the
    totals and rate 1.
    """
    names = [f"p_{d}" for d in DOMAINS]
    count = len(DOMAINS)

    def totals(fit: Fit, ahead: bool) -> np.ndarray:
        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(count)
            for batch in batches:
                posterior = np.stack([batch.column(n).to_numpy() for n in names], axis=1)
                rate = fit.rates(posterior)[int(ahead)]
                total += (rate * batch.column("tokens").to_numpy()) @ posterior
            yield task_array(total)

        return tree_sum(members.select("tokens", *names).mapInArrow(summed, SCHEMA), count)

    fit = Fit([], [], most)
    available = totals(fit, False)
    wanted_share = np.array([weights.get(d, 0.0) for d in DOMAINS])
    wanted_share = wanted_share / wanted_share.sum()
    main = int(wanted_share.argmax())
    targets = wanted_share * float(available[main] / wanted_share[main])
    scale = max(1.0, float(available.sum()))
    speed = 1.0
    for _ in range(ROUNDS):
        miss = (totals(fit, True) - targets) / scale
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        fit = Fit([*fit.misses, miss], [*fit.momentum, (speed - 1) / faster], most)
        speed = faster
        if len(fit.misses) > 1 and np.abs(fit.misses[-1] - fit.misses[-2]).max() < CLOSE_ENOUGH:
            break
    reached = totals(fit, False)
    kinds = ", ".join(f"{c} {t}" for c, t in members.dtypes)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            posterior = np.stack([batch.column(n).to_numpy() for n in names], axis=1)
            rate = np.where(batch.column("tokens").to_numpy() > 0, fit.rates(posterior)[0], 1.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], names=[*batch.schema.names, "rate"])

    report = {
        d: {"available": float(a), "wanted": float(t), "expected": float(r)}
        for d, a, t, r in zip(DOMAINS, available, targets, reached, strict=True)
    }
    return members.mapInArrow(rated, f"{kinds}, rate double"), report


def mix_documents(
    docs: DataFrame,
    labels: DataFrame,
    weights: Mapping[str, float],
    id_column: str = "doc_id",
    text_column: str = "text",
    most: float = float("inf"),
) -> tuple[DataFrame, dict[str, dict[str, float]]]:
    """``id_column``, tokens, the posterior of each domain and rate of each row, and the report of the fit.

    A NULL or empty text has 0 tokens, the posterior of the scorer's bias and rate
    1. Without labelled rows all domains are equally likely. ``most`` bounds the
    rates from above.
    """
    members = stored(memberships(docs, labels, id_column, text_column), "memberships")
    rated, report = fit_rates(members, weights, most)
    return rated.withColumnRenamed("id", id_column), report


def copies(rate: str = "rate", key: str = "doc_id") -> Column:
    """Whole copies of a row: the rate rounded up or down by a draw from the key, so the mean is the rate."""
    draw = F.pmod(F.xxhash64(F.lit(11), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(F.col(rate) + draw).cast("int")
