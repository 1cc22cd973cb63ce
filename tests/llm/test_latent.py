"""Benchmark items found against a search by shared word runs, paraphrases, and the odd cases."""

import random
from collections import Counter, defaultdict

import numpy as np

from ledgermill.llm.latent import as_item, common_words, contaminated, plain_words, windows


def test_registered_query_finds_all_passages(spark, small_dir):
    from ledgermill.llm.queries import op3_latent_retrieval

    items = {r.item_id: plain_words(r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()}
    runs = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} for i, w in items.items()}
    holders = defaultdict(set)
    for i, found in runs.items():
        for run in found:
            holders[run].add(i)
    expected = set()
    for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect():
        words = plain_words(r.text)
        shared = Counter(i for run in {tuple(words[k : k + 4]) for k in range(len(words) - 3)} for i in holders[run])
        expected |= {(r.doc_id, i) for i, n in shared.items() if n >= 0.8 * len(runs[i])}
    got = {(r.doc_id, r.item_id) for r in op3_latent_retrieval(spark, small_dir).collect()}
    assert expected and got == expected


def test_longest_common_subsequence():
    draw = random.Random(1)
    for _ in range(200):
        a = np.array([draw.randrange(5) for _ in range(draw.randrange(1, 12))])
        b = np.array([draw.randrange(6) for _ in range(draw.randrange(12))], np.int64)
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert common_words(a, b) == table[-1, -1]


def test_windows_cover_every_word():
    start, end = windows(np.array([0, 0, 3, 40]), 8)
    covered = set()
    for a, b in zip(start, end, strict=True):
        covered |= set(range(a, b))
    assert covered == set(range(40)) and (end - start <= 8).all() and start.min() == 0


def test_answers():
    item = as_item(1, "What is the colour of the sky? The sky is blue.")
    assert item.answer == ["the", "sky", "is", "blue"] and len(item.words) == 11
    assert as_item(1, None).words == []


def paraphrase(draw, words, share):
    out = list(words)
    for k in draw.sample(range(len(out) - 6), int(share * len(out))):
        out[k] = f"zz{draw.randrange(99)}"
    return out


def test_paraphrases_and_odd_cases(spark, odd_docs, no_docs):
    draw = random.Random(5)
    vocabulary = [f"{a}{b}" for a in ("ba", "co", "di", "fu", "ge") for b in ("lar", "men", "nor", "pil", "quo", "rat", "sim")]
    item = [draw.choice(vocabulary) for _ in range(30)]
    text = " ".join(item[:20]).capitalize() + ". " + " ".join(item[20:]) + "."
    around = " ".join(draw.choices(SYLLABIC, k=300))
    docs = [
        (1, f"{around} {text} {around}", None),
        (2, f"{around} {text.upper().replace(' ', ' ** ')} {around}", None),
        (3, " ".join(paraphrase(draw, item, 0.3)), None),
        (4, around, None),
        (5, " ".join(draw.sample(item, len(item))), None),
        (6, None, "x"),
        (None, text, "x"),
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, cosine string")
    bench = spark.createDataFrame([(7, text, 1.0), (8, None, 1.0), (9, "too short", 1.0), (7, text, 1.0)], "item_id bigint, text string, score double")
    rows = contaminated(frame, bench).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, None} and {r.item_id for r in rows} == {7}
    share = {r.doc_id: r.found_share for r in rows}
    assert share[1] == share[2] == 1.0 and 0.6 <= share[3] < 0.8
    assert contaminated(frame, bench.limit(0)).count() == 0
    assert contaminated(no_docs, bench).count() == 0
    assert contaminated(odd_docs, bench).count() == 0


SYLLABIC = [f"{a}{b}{c}" for a in "pkt" for b in "aiou" for c in ("rel", "van", "dos")]


def test_items_that_end_in_a_decimal_or_an_abbreviation(spark):
    items = {
        1: "The bank raised what it asks of house buyers again last month. The new yearly rate is 3.5 percent.",
        2: "Most of these old wooden bridges were built by farmers. The longest one still stands in the U.S.",
    }
    assert as_item(1, items[1]).answer == ["the", "new", "yearly", "rate", "is", "35", "percent"]
    assert as_item(2, items[2]).answer[-1] == "us"
    benchmark = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    texts = {10: "Before it some words. " + items[1] + " And after it.", 20: "So: " + items[2], 30: "Nothing of the kind."}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(10, 1), (20, 2)}


def test_space_is_fitted_on_every_text(spark, small_dir, monkeypatch):
    from ledgermill.llm import latent

    seen = []
    fit = latent.fit_spaces
    monkeypatch.setattr(latent, "FIT_DOCUMENTS", 5, raising=False)
    monkeypatch.setattr(latent, "fit_spaces", lambda sample, *a: seen.append(sample.count()) or fit(sample, *a))
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    contaminated(docs, spark.read.parquet(f"{small_dir}/benchmark.parquet")).count()
    assert seen and set(seen) == {docs.where("text IS NOT NULL").count()}
