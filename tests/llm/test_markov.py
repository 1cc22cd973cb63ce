"""Base scores against a plain count, the forward recursion against all paths, training against its own likelihood."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np

from ledgermill.llm import markov
from ledgermill.llm.language import held_out

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def tokens(text):
    return [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().translate(LOWER)) if w] + [None]


def test_registered_query_against_plain_counts(spark, small_dir):
    from ledgermill.llm.queries import op7_markov_model

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    training = [k for k in texts if zlib.crc32(str(k).encode()) % 5 != 1]
    count = Counter(w for k in training for w in tokens(texts[k]))
    total, mass = sum(count.values()), sum(count.values()) + 0.5 * (len(count) + 1)
    rows = op7_markov_model(spark, small_dir).collect()
    assert len(rows) == len(texts)
    better = 0
    for r in rows:
        words = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(count[w] > 0 for w in words), total)
        assert r.held_out == (r.doc_id not in set(training))
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 0.5) / mass) for w in words), abs_tol=1e-6)
        better += r.held_out and r.score > r.base_score
    assert better > 0.8 * sum(r.held_out for r in rows)


def test_forward_adds_up_all_paths():
    draw = np.random.default_rng(1)
    masses = draw.random(markov.CLASSES)
    model = markov.first_model(masses / masses.sum(), 3)
    ratios = model.ratios(masses / masses.sum())
    classes, bounds = draw.integers(0, markov.CLASSES, 7), np.array([0, 4, 4, 7])
    scale = markov.forward(classes, markov.Lattice.of(bounds), model, ratios)[1]
    for a, b in ((0, 4), (4, 7)):
        paths = itertools.product(range(3), repeat=b - a)
        total = sum(
            model.start[p[0]]
            * math.prod(model.moves[x, y] for x, y in itertools.pairwise(p))
            * math.prod(ratios[classes[a + i], s] for i, s in enumerate(p))
            for p in paths
        )
        assert math.isclose(math.prod(scale[a:b]), total, rel_tol=1e-9)


def test_a_round_of_training_raises_the_likelihood():
    draw = np.random.default_rng(2)
    masses = np.full(markov.CLASSES, 1 / markov.CLASSES)
    classes = np.concatenate([draw.integers(0, 50, 400), draw.integers(5000, 5050, 400)])
    bounds = np.arange(0, 801, 40)
    model = markov.first_model(masses, 2)
    before = -np.inf
    for _ in range(6):
        ratios = model.ratios(masses)
        after = np.log(markov.forward(classes, markov.Lattice.of(bounds), model, ratios)[1]).sum()
        assert after > before
        before = after
        counts = markov.expected_counts(classes, bounds, model, ratios)
        assert math.isclose(counts[2 + 4 :].sum(), len(classes)) and math.isclose(counts[:2].sum(), len(bounds) - 1)
        model = markov.re_estimated(counts, masses, 2)


def test_odd_documents(odd_docs, no_docs):
    rows = markov.score_texts(odd_docs, ~held_out("doc_id", 5, 1)).collect()
    assert len(rows) == odd_docs.count()
    empty = [r for r in rows if r.doc_id in (0, 1, 2)]
    assert {r.n_tokens for r in empty} == {1} and all(r.n_known == 1 and r.score < 0 for r in empty)
    assert len({round(r.score, 9) for r in empty}) == 1
    assert markov.score_texts(no_docs, ~held_out("doc_id", 5, 1)).count() == 0
    untrained = markov.score_texts(odd_docs, held_out("doc_id", 5, 1) & odd_docs.text.isNull() & odd_docs.text.isNotNull())
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in untrained.collect())
