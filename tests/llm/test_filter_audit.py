"""The audit against applying every order of filters to every document."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from ledgermill.llm.filter_audit import FIGURES, RadixTrie, audit_filters, ranges_between

SCHEMA = "doc_id bigint, text string, source string, n int, part string, id string"


def failed(docs):
    least = {}
    for key, text, *_ in docs:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    for key, text, part, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        tests = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": key is not None and least[text] < key,
        }
        yield key, part or "", {k for k, v in tests.items() if v}


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = list(failed(docs))
    out, shapley = Counter(), Counter()
    for part in {p for _, p, _ in rows}:
        for order in permutations("ABCDE"):
            left = [(k, f) for k, p, f in rows if p == part]
            all_rows = left
            for step, letter in enumerate(order, 1):
                gone = [(k, f) for k, f in left if letter in f]
                left = [(k, f) for k, f in left if letter not in f]
                key = part, "".join(order), step
                shapley[part, letter] += len(gone)
                out[key, "kept"] = len(left)
                out[key, "removed"] = len(gone)
                out[key, "redundant"] = sum(letter in f for _, f in all_rows) - len(gone)
                out[key, "unique_fails"] = sum(f == {letter} for _, f in all_rows)
                out[key, "good_lost"] = sum(k in good for k, _ in gone)
                out[key, "toxic_lost"] = sum(k in toxic for k, _ in gone)
                out[key, "shapley"] = 0
    for (key, name) in list(out):
        if name == "shapley":
            out[key, name] = shapley[key[0], key[1][key[2] - 1]]
    return dict(out)


def audited(spark, docs, labels):
    frame = spark.createDataFrame([(k, t, p, 1, "x", "y") for k, t, p in docs], SCHEMA)
    said = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = audit_filters(frame, said).collect()
    return {((r.part, r.filter_order, r.step), f): r[f] for r in rows for f in FIGURES}


@pytest.mark.parametrize("seed", [1, 2])
def test_every_order(spark, seed):
    draw = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "DELTA", "e#", "ü", "zeta"] + [f"w{i}" for i in range(300)]
    texts = [None, "", " ", "same start " * 300, "same start " * 300 + "x", "same start " * 299]
    texts += [" ".join(draw.choices(words, k=draw.choice([3, 150, 250]))) for _ in range(20)]
    docs = [(i, draw.choice(texts), draw.choice(["a", "b", None, ""])) for i in draw.sample(range(1000), 150)]
    docs += [docs[0], docs[0], (None, texts[3], "a"), (None, None, None)]
    labels = [(k, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for k, _, _ in docs[:80]] + [(docs[0][0], 1, 1), (None, 1, 1)]
    assert audited(spark, docs, labels) == plain_audit(docs, labels)


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = audit_filters(odd_docs, labels).where("filter_order = 'ABCDE' AND step = 1").collect()
    assert sum(r.kept + r.removed for r in rows) == odd_docs.count()
    assert audit_filters(no_docs, labels).count() == 0
    assert audit_filters(odd_docs, labels.limit(0)).count() == 600 * len(rows)


def test_trie_holds_whole_texts():
    trie = RadixTrie()
    texts = [b"", b"a", b"ab", b"abc", b"abd", b"b" * 9000, b"b" * 9000 + b"c", b"ab"]
    later = [trie.insert(t, k, "p", 0, 1) for k, t in enumerate(texts)]
    assert later[-1] == [(7, "p", 0, 1)] and not any(later[:-1])
    assert trie.insert(b"ab", 1, "q", 3, 2) == [(2, "p", 0, 1)]
    assert sorted(k for k, *_ in trie.firsts()) == [0, 1, 1, 3, 4, 5, 6]


def test_ranges_part_texts_that_share_a_beginning():
    draw = random.Random(3)
    same = b"one beginning " * 40
    heads = [same + bytes(draw.choices(range(65, 91), k=20)) for _ in range(400)] + [bytes(draw.choices(range(65, 91), k=9)) for _ in range(200)]
    ranges = ranges_between(heads, 60)
    counts = Counter(ranges.number(h, b"") for h in heads)
    assert max(counts.values()) <= 12 and ranges.count >= 55
    assert [ranges.number(h, b"") for h in sorted(heads)] == sorted(ranges.number(h, b"") for h in heads)


def test_ranges_of_one_beginning_are_dealt_by_digest():
    heads = [b"a" * 2048] * 300 + [b"b", b"c"]
    ranges = ranges_between(heads, 40)
    numbers = Counter(ranges.number(b"a" * 3000, bytes([i]) * 8) for i in range(256))
    assert len(numbers) > 30 and max(numbers.values()) < 20
    assert ranges.number(b"b", b"") not in numbers
    assert ranges_between([], 8).count == 1
