"""Groups against all pairs, also where nodes stay large, and the odd cases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from ledgermill.llm import chosen_path
from ledgermill.llm.chosen_path import near_duplicate_groups

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingles(text, size):
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().translate(LOWER)) if w]
    runs = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    return frozenset(runs or ([tuple(words)] if words else []))


def groups(texts, size, percent):
    """Least reachable id by comparing all texts that share a shingle."""
    sets = {k: shingles(t, size) for k, t in texts.items()}
    parent = {k: k for k in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, found in sets.items():
        for j, both in Counter(j for x in found for j in holders[x]).items():
            if 100 * both >= percent * (len(found) + len(sets[j]) - both):
                a, b = top(j), top(k)
                parent[max(a, b)] = min(a, b)
        for x in found:
            holders[x].append(k)
    return {k: len(s) for k, s in sets.items()}, {k: top(k) for k in sets}


def check(rows, texts, size, percent):
    sizes, expected = groups(texts, size, percent)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_shingles, r.component_id) == (sizes[r.doc_id], expected[r.doc_id])
        assert r.kept == (r.doc_id == expected[r.doc_id])


def test_registered_query_against_all_pairs(spark, small_dir):
    from ledgermill.llm.queries import op9_chosen_path

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    check(op9_chosen_path(spark, small_dir).collect(), texts, 3, 85)


@pytest.mark.parametrize("leaf", [64, 4])
def test_large_groups_of_near_copies(spark, monkeypatch, leaf):
    """Copies drift from two bases; with small leaves most nodes stay large at the last depth."""
    monkeypatch.setattr(chosen_path, "LEAF", leaf)
    draw = random.Random(leaf)
    texts = {}
    for base in range(2):
        words = [f"w{draw.randrange(400)}" for _ in range(120)]
        for _ in range(40):
            copy = list(words)
            for _ in range(draw.randrange(5)):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(1000)}"
            texts[len(texts)] = " ".join(copy)
    chain = [f"c{i}" for i in range(100)]
    for step in range(12):
        texts[len(texts)] = " ".join(chain[3 * step :] + [f"d{i}" for i in range(3 * step)])
    order = list(texts)
    draw.shuffle(order)
    texts = {k: texts[order[k]] for k in range(len(order))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    check(near_duplicate_groups(docs, 3, 0.85).collect(), texts, 3, 85)


def test_odd_documents(odd_docs, odd_texts, no_docs):
    rows = near_duplicate_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    _, expected = groups(dict(enumerate(odd_texts)), 5, 80)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert expected[6] == expected[7] == 5
    assert near_duplicate_groups(no_docs).count() == 0


def test_deep_nodes_get_the_trees_that_the_threshold_needs(spark, monkeypatch):
    """Isolated pairs of about the threshold whose nodes all get as deep as can be: hardly any may be missed."""
    for threshold in (0.8, 0.85):
        for depth in (2, 4, 6):
            trees = chosen_path.trees_needed(threshold, depth)
            assert chosen_path.missed(threshold, depth, trees) <= 1 - chosen_path.RECALL
    assert chosen_path.missed(0.8, 6, 12) > 0.03
    monkeypatch.setattr(chosen_path, "LEAF", 1)
    texts = {}
    for pair in range(300):
        words = [f"p{pair}-{k}" for k in range(100)]
        for words in (words, words[:89] + [f"q{pair}-{k}" for k in range(11)]):
            texts[len(texts)] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = near_duplicate_groups(docs, 1, 0.8).collect()
    assert sum(not r.kept for r in rows) >= 299
