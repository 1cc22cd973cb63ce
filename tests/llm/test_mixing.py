"""Rates against a direct solution, totals against targets, and the odd cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm.mixing import DOMAINS, NEARNESS, copies, fit_rates, mix_documents


def test_rates_solve_the_least_squares(spark):
    draw = np.random.default_rng(2)
    posterior = draw.dirichlet([0.4, 0.3, 0.2], 300)
    tokens = draw.integers(1, 500, 300)
    rows = [(i, int(t), *map(float, p)) for i, (t, p) in enumerate(zip(tokens, posterior, strict=True))]
    members = spark.createDataFrame(rows, "id bigint, tokens bigint, " + ", ".join(f"p_{d} double" for d in DOMAINS))
    weights = {"clean": 0.7, "poor": 0.25, "toxic": 0.05}
    rated, report = fit_rates(members, weights)
    rate = np.array([r.rate for r in rated.orderBy("id").collect()])
    available = tokens @ posterior
    target = np.array([0.7, 0.25, 0.05]) * available[0] / 0.7
    assert (rate >= 0).all()
    total = (rate * tokens) @ posterior
    assert np.allclose([report[d]["expected"] for d in DOMAINS], total)
    assert np.abs(total - target).max() < 0.02 * tokens.sum()
    # At the solution no free rate can lower the sum of squares any further.
    slope = posterior @ (total - target) / available.sum() + NEARNESS * (rate - 1)
    assert np.abs(slope[rate > 1e-6]).max() < 1e-3 and slope[rate <= 1e-6].min(initial=0) > -1e-3


def test_registered_query_meets_its_targets(spark):
    from ledgermill.llm.queries import TARGET_WEIGHTS, op8_soft_mixing

    folder = "/root/testdata/sf0.01"
    rows = op8_soft_mixing(spark, folder)
    sums = rows.agg(*(F.sum(F.col("rate") * F.col("tokens") * F.col(f"p_{d}")).alias(d) for d in DOMAINS)).first()
    total = sum(sums)
    for domain in DOMAINS:
        assert sums[domain] / total == pytest.approx(TARGET_WEIGHTS[domain], abs=0.02)
    joined = rows.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    mean = {(r.quality, r.toxic): r.rate for r in joined.groupBy("quality", "toxic").agg(F.avg("rate").alias("rate")).collect()}
    assert mean[1, 0] > 0.95 and mean[1, 1] < 0.2


def test_copies_keep_the_mean(spark):
    drawn = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(1.3).alias("rate")).agg(F.avg(copies())).first()[0]
    assert drawn == pytest.approx(1.3, abs=0.02)


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(3, 1, 0, 9), (4, 0, 0, 9), (5, 1, 1, 9), (5, 1, 0, 9), (None, 1, 1, 9), (6, None, None, 9), (7, None, 1, 9), (99, 1, 0, 9)],
        "doc_id bigint, quality int, toxic int, id int",
    )
    weights = {"clean": 0.9, "poor": 0.1}
    mixed, _ = mix_documents(odd_docs, labels, weights, most=1.0)
    rows = mixed.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.rate <= 1 for r in rows)
    assert all((r.tokens, r.rate) == (0, 1.0) for r in rows if r.doc_id in (0, 1, 2))
    unlabelled, _ = mix_documents(odd_docs, labels.limit(0), weights)
    assert all(r.p_clean == pytest.approx(1 / 3) for r in unlabelled.collect())
    assert mix_documents(no_docs, labels, weights)[0].count() == 0


def test_scorer_learns_from_every_labelled_row(spark, monkeypatch):
    from ledgermill.llm import mixing

    folder = "/root/testdata/sf0.001"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    seen = []
    train = mixing.train_linear
    monkeypatch.setattr(mixing, "LABELLED_ROWS", 5)
    monkeypatch.setattr(mixing, "train_linear", lambda rows, *a, **k: seen.append(rows.count()) or train(rows, *a, **k))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    mixing.memberships(docs, labels).count()
    expected = docs.join(mixing.domain_targets(labels), docs["doc_id"] == F.col("label_id")).count()
    assert seen == [expected] and expected > 50
