"""The label model on made votes, the query against labels it never saw, and the odd cases."""

import numpy as np

from ledgermill.llm.weak_labels import GOOD, NO_VOTE, POOR, fit_label_model, score_quality


def test_label_model_tells_good_from_bad_labellers():
    """One labeller votes poor on poor texts, one votes for good on good texts, one by chance."""
    draw = np.random.default_rng(1)
    truth = draw.random(4000) < 0.8
    first = np.where(~truth & (draw.random(4000) < 0.9), POOR, NO_VOTE)
    second = np.where(truth & (draw.random(4000) < 0.9), GOOD, NO_VOTE)
    third = np.where(draw.random(4000) < 0.5, GOOD, NO_VOTE)
    patterns, counts = np.unique(np.stack([first, second, third], axis=1), axis=0, return_counts=True)
    model = fit_label_model(patterns, counts.astype(float))
    belief = model.posterior(np.stack([first, second, third], axis=1))
    assert ((belief >= 0.5) == truth).mean() > 0.95
    assert model.rates[0, 0, POOR] > 5 * model.rates[0, 1, POOR]
    assert fit_label_model(np.zeros((0, 3), int), np.zeros(0)).posterior(np.array([[POOR, 0, 0]])).shape == (1,)


def test_registered_query_agrees_with_labels(spark):
    from ledgermill.llm.queries import op6_weak_labels

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op6_weak_labels(spark, folder).join(labels, "doc_id").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.keep for r in good) > 0.97 * len(good)
    assert sum(not r.keep for r in bad) > 0.9 * len(bad)


def test_odd_documents(odd_docs, no_docs):
    rows = score_quality(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id in (0, 1):
            assert (r.posterior, r.score, r.keep) == (0.0, 0.0, False)
        assert 0 <= r.score <= 1 and r.keep == (r.score >= 0.5)
    assert score_quality(no_docs).count() == 0


def test_scorer_learns_from_every_text(spark, monkeypatch):
    from ledgermill.llm import weak_labels

    seen = []
    train = weak_labels.train_linear
    monkeypatch.setattr(weak_labels, "TRAINING_ROWS", 5, raising=False)
    monkeypatch.setattr(weak_labels, "train_linear", lambda rows, *a, **k: seen.append(rows.count()) or train(rows, *a, **k))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    score_quality(docs).count()
    assert seen == [docs.where("length(text) > 0").count()]
