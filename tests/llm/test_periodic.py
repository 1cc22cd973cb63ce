"""Periodic runs against every stretch of small word sequences."""

import hashlib
import random
import zlib

import pyarrow as pa

from ledgermill.llm.periodic import SuffixTree, periodic_runs, runs_of, text_runs
from ledgermill.llm.queries import op12_periodic_runs


def plain_runs(words):
    out = set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            smaller = any(all(words[k] == words[k + d] for k in range(i, i + size - d)) for d in range(1, q))
            if size >= max(6, 4 * q) and not smaller:
                out.add((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(count):
    draw = random.Random(8)
    for _ in range(count):
        words = [draw.randrange(draw.choice([1, 2, 2, 3, 5])) for _ in range(draw.randint(1, 60))]
        if draw.random() < 0.6:
            a, p = draw.randrange(len(words)), draw.randint(1, 6)
            words = words[:a] + [words[min(a + (i - a) % p, len(words) - 1)] for i in range(a, len(words))]
        yield words


def test_suffixes_come_in_order():
    for words in sequences(100):
        text = [*words, -1]
        suffixes, depths = SuffixTree(text).tour()
        assert suffixes == sorted(range(len(text)), key=lambda i: text[i:])
        for (a, b), depth in zip(zip(suffixes, suffixes[1:], strict=False), depths[1:], strict=True):
            assert text[a : a + depth] == text[b : b + depth] and text[a + depth] != text[b + depth]


def test_all_runs_are_found():
    for words in sequences(1500):
        wanted = plain_runs(words)
        assert runs_of(words) == wanted
        text = " ".join(map(str, words))
        found = text_runs(pa.array(["x y", text, None, text]))
        assert found.get(1, []) == found.get(3, []) == wanted and set(found) <= {1, 3}


def test_odd_documents(odd_docs, no_docs, odd_texts):
    rows = {r.doc_id: r for r in periodic_runs(odd_docs).collect()}
    assert periodic_runs(odd_docs).count() == odd_docs.count() and periodic_runs(no_docs).count() == 0
    for i, text in enumerate(odd_texts):
        words = " ".join((text or "").encode().split(None) and [w.decode() for w in (text or "").encode().split(None)])
        if i != 8:
            assert rows[i].runs == [] and rows[i].strongest is None and rows[i].collapsed == words


def test_registered_query(spark, small_dir):
    got = {r.doc_id: r for r in op12_periodic_runs(spark, small_dir).collect()}
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    repeated = 0
    for doc in docs:
        words = [w.decode() for w in (doc.text or "").encode().split(None)]
        h, n = zlib.crc32(str(doc.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 700:
            continue
        runs = plain_runs(words)
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        row = got[doc.doc_id]
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()
        if runs:
            repeated += 1
            best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (*best, 1000 * best[1] // best[2])
        else:
            assert row.start is row.length is row.period is row.exponent_milli is None
    assert repeated
