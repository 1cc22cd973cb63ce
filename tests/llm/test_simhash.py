"""Edited texts and fingerprints against a plain walk, the radius search against all pairs."""

import hashlib
import random

import pyarrow as pa

from ledgermill.llm.simhash import BITS, edit_fingerprints, fingerprints, radius_for, with_near, within_radius


def test_edited_texts_and_likeness(spark, odd_docs, odd_texts):
    known = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = {r.doc_id: r for r in edit_fingerprints(known).collect()}
    texts = [t or "" for t in odd_texts]
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        prints = fingerprints(pa.array([text, edited, following]))
        assert rows[i].fingerprint == prints[0].tobytes().hex()
        assert rows[i].edited_fingerprint == prints[1].tobytes().hex()
        same = BITS - sum(bin(a ^ b).count("1") for a, b in zip(prints[0].tolist(), prints[2].tolist(), strict=True))
        assert rows[i].near_next == same / BITS
    assert rows[5].fingerprint == rows[6].fingerprint
    assert rows[8].near_edited > 0.55


def test_repeated_and_missing_ids_keep_their_rows(odd_docs, no_docs):
    assert edit_fingerprints(odd_docs).count() == odd_docs.count()
    assert edit_fingerprints(no_docs).count() == 0
    one = edit_fingerprints(odd_docs.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_radius_search_finds_all_pairs(spark):
    draw = random.Random(3)
    prints = set()
    for _ in range(30):
        base = draw.getrandbits(BITS)
        for flips in range(12):
            other = base
            for _ in range(flips):
                other ^= 1 << draw.randrange(BITS)
            prints.add(other)
    frame = spark.createDataFrame([(f"{p:0{BITS // 4}x}",) for p in prints] + [(None,)] * 2, "fingerprint string")
    asked = sorted(prints)[::5]
    for radius in (3, 7, 10):
        expected = {(a, b, (a ^ b).bit_count()) for a in asked for b in prints if 0 < (a ^ b).bit_count() <= radius}
        queries = frame.where(frame.fingerprint.isin([f"{a:0{BITS // 4}x}" for a in asked]))
        found = [(int(r["query"], 16), int(r["found"], 16), r["distance"]) for r in within_radius(queries, frame, radius).collect()]
        assert len(found) == len(set(found)) and set(found) == expected


def test_near_copies_and_equal_ones_are_named(spark):
    """Copies of similarity 0.8 to 0.99, far beyond a few bits, and equal texts come with their ids."""
    draw = random.Random(8)
    base = [f"w{draw.randrange(5000)}" for _ in range(1000)]
    texts = {0: " ".join(base), 7: " ".join(base)}
    for i, edits in enumerate((1, 4, 10, 18), start=1):
        copy = list(base)
        for k in range(edits):
            copy[(k * 1000) // edits] = f"x{i}-{k}"
        texts[i] = " ".join(copy)
    for i in range(20, 30):
        texts[i] = " ".join(f"y{draw.randrange(5000)}" for _ in range(300))
    prints = fingerprints(pa.array(list(texts.values())))
    rows = [(k, p.tobytes().hex()) for k, p in zip(texts, prints, strict=True)]
    frame = spark.createDataFrame(rows + [(None, rows[0][1])], "doc_id bigint, fingerprint string")
    found = with_near(frame, frame.doc_id == 7, radius_for(0.8, 0.99)).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        assert r.class_id == (0 if r.doc_id in (0, 7, None) else r.doc_id)
        assert (r.near_count, r.near_ids) == ((4, [1, 2, 3, 4]) if r.doc_id == 7 else (None, None))
    assert radius_for(1.0, 0.99) == 0 and 26 < radius_for(0.9, 0.99) < radius_for(0.8, 0.99) < 60


def test_registered_query_against_brute_force(spark, small_dir):
    from ledgermill.llm.queries import op2_simhash

    rows = op2_simhash(spark, small_dir).collect()
    radius = radius_for(0.8, 0.99)
    classes = {}
    for r in rows:
        classes[r.fingerprint] = min(r.doc_id, classes.get(r.fingerprint, r.doc_id))
    for r in rows:
        assert r.class_id == classes[r.fingerprint]
        near = [k for f, k in classes.items() if 0 < (int(f, 16) ^ int(r.fingerprint, 16)).bit_count() <= radius]
        assert (r.near_count, r.near_ids) == ((len(near), sorted(near)) if r.doc_id % 50 == 0 else (None, None))
