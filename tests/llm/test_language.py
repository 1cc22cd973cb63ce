"""Languages on held-out texts, spans of mixed ones, and the odd cases."""

import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm.language import best_paths, held_out, keep_languages, label_languages, train_language_model

WORDS = {
    "en": "the cat sat there with thing other when what house mother water reading".split(),
    "de": "der hund schlief nicht auch eine wasser zwischen straße mutter schön über".split(),
    "ru": "кот спал там где дом вода мать очень хорошо".split(),
}


@pytest.fixture(scope="module")
def taught(spark):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices(WORDS[lang], k=30)), lang) for i, lang in enumerate(sorted(WORDS) * 20)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_held_out_texts(taught):
    model = train_language_model(taught.where(~held_out("doc_id", 4, 2)))
    asked = taught.where(held_out("doc_id", 4, 2))
    assert asked.count() > 5
    rows = label_languages(asked, model).join(taught.drop("text"), "doc_id").collect()
    assert all(r.lang_pred == r.lang and 0.9 <= r.score <= 1 for r in rows)


def test_spans_of_mixed_text(spark, taught):
    model = train_language_model(taught)
    text = " ".join(WORDS["en"] * 2 + WORDS["de"] + ["кот", "спал"])
    row = label_languages(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).first()
    assert [s.lang for s in row.spans] == ["en", "de", "ru"]
    assert row.spans[1].first_word == 2 * len(WORDS["en"]) and row.spans[1].n_words == len(WORDS["de"])
    assert row.lang_pred == "en" and 0.5 < row.score < 1


def test_odd_documents(taught, odd_docs, no_docs):
    model = train_language_model(taught)
    rows = {r.doc_id: r for r in label_languages(odd_docs, model).collect()}
    for i in (0, 1, 2):
        assert (rows[i].lang_pred, rows[i].score, rows[i].spans) == ("und", 0.0, [])
    assert all(r.lang_pred in WORDS and 0 < r.score <= 1 for i, r in rows.items() if i not in (0, 1, 2))
    assert label_languages(no_docs, model).count() == 0
    kept = keep_languages(odd_docs, model, 0.4)
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.count() - 3


def test_without_labelled_texts(odd_docs, no_docs):
    model = train_language_model(no_docs)
    assert model.languages == []
    assert {r.lang_pred for r in label_languages(odd_docs, model).collect()} == {"und"}
    assert keep_languages(odd_docs, model, 0.1).count() == 0


def test_registered_query_on_held_out_documents(spark, small_dir):
    from ledgermill.llm.queries import op4_language

    rows = op4_language(spark, small_dir).join(spark.read.parquet(f"{small_dir}/documents.parquet"), "doc_id")
    right = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.95


def test_texts_of_no_learned_language(spark, small_dir):
    """Other languages of a learned script, other scripts and letter junk are unknown and go."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    model = train_language_model(docs)
    junk = random.Random(1)
    foreign = {
        1: "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        2: "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        3: "人人生而自由 在尊严和权利上一律平等",
        4: " ".join("".join(junk.choices("bcdfghjkmpqvwxyz", k=8)) for _ in range(30)),
    }
    known = docs.where("lang IS NOT NULL AND length(text) > 500").limit(1).first()
    texts = foreign | {10: known.text, 11: known.text[:200] + " " + foreign[2]}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in label_languages(frame, model).collect()}
    # A text with a letter gets a learned language; that it is in none shows in the share of the unknown.
    assert all(rows[i].lang_pred in model.languages and rows[i].unknown > rows[i].score for i in foreign)
    assert rows[10].unknown < 0.1
    assert rows[10].lang_pred == known.lang and rows[10].score > 0.9
    assert rows[11].lang_pred == known.lang and 0.5 < rows[11].score < 0.9
    assert [r.doc_id for r in keep_languages(frame, model, 0.4).orderBy("doc_id").collect()] == [10, 11]


def test_best_paths_against_all_paths():
    draw = np.random.default_rng(3)
    for _ in range(60):
        sizes = draw.integers(0, 5, 3)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        scores = draw.normal(size=(bounds[-1], 3)).astype(np.float32)
        path = best_paths(scores, bounds, 0.7)

        def value(labels, rows):
            changes = sum(a != b for a, b in zip(labels, labels[1:], strict=False))
            # The last language is the unknown; to begin in it costs the penalty.
            return sum(rows[i, k] for i, k in enumerate(labels)) - 0.7 * changes - 0.7 * (labels[0] == 2)

        for low, high in zip(bounds, bounds[1:], strict=False):
            if high > low:
                rows = scores[low:high]
                best = max(value(labels, rows) for labels in product(range(3), repeat=high - low))
                assert abs(value(tuple(path[low:high]), rows) - best) < 1e-4
