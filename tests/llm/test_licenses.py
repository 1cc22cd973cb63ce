"""License rules against plain regular expressions and hand-made texts."""

import re

from ledgermill.llm.licenses import BASE_PHRASES, Rule, license_matches, license_rules, license_summary
from ledgermill.llm.queries import op13_license_signatures


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def labels(spark, texts, rules=None):
    rows = license_summary(license_matches(frame(spark, texts), rules)).collect()
    return [r.labels for r in sorted(rows, key=lambda r: r.doc_id)]


def test_rules_are_ordered_signatures():
    rules = license_rules()
    assert len(rules) > 300 and len(set(rules)) == len(rules)


def test_signatures(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0 (the license)",
        "GNU General Public License v3 or any later version",
        "the GNU Lesser General Public License 2.1 only",
        "SPDX-License-Identifier: MIT",
        "this is BSD-3-Clause and that is the MIT License",
        "under Creative Commons Attribution-NonCommercial 4.0 International License",
        "permission is hereby granted, free of charge, to any person obtaining a copy",
        "mit der Bahn, all is general and open",
    ]
    assert labels(spark, texts) == [
        "apache,apache-2.0", "gpl,gpl-3.0-or-later", "gpl,lgpl-2.1-only", "mit", "bsd-3-clause,mit", "cc-by-nc-4.0", "mit", "",
    ]


def test_containment_and_priority(spark):
    rules = [Rule("long", "a b c", "a", 50), Rule("inner", "b c", "b", 1), Rule("late", "c d", "c", 50), Rule("first", "x y", "x", 1), Rule("second", "x y", "x", 2)]
    rows = license_matches(frame(spark, ["a b c d x y", "b c"]), rules).orderBy("doc_id").collect()
    assert [(d.first_word, d.last_word, d.label) for d in rows[0].detections] == [(0, 2, "long"), (2, 3, "late"), (4, 5, "first")]
    assert [d.label for d in rows[1].detections] == ["inner"]


def test_many_places_in_one_text(spark):
    row = license_summary(license_matches(frame(spark, ["MIT License " * 3000]))).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.labels) == (6000, 3000, 0, 5998, "mit")


def test_odd_documents(odd_docs, no_docs):
    rows = {r.doc_id: r for r in license_summary(license_matches(odd_docs)).collect()}
    assert license_matches(odd_docs).count() == odd_docs.count() and license_matches(no_docs).count() == 0
    for i in (0, 1, 2):
        assert tuple(rows[i])[1:] == (0, 0, None, None, "", "", 0.0)


def test_registered_query(spark, small_dir):
    found = op13_license_signatures(spark, small_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Exchange" not in plan
    got = {r.doc_id: r for r in found.collect()}
    based = 0
    for doc in spark.read.parquet(f"{small_dir}/documents.parquet").collect():
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), doc.text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places, names = [], set()
        for phrase, label in BASE_PHRASES.items():
            parts = phrase.split()
            here = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            places += here
            names |= {label} if here else set()
        row = got[doc.doc_id]
        assert (row.n_words, row.n_base, row.base_labels) == (len(words), len(places), ",".join(sorted(names)))
        assert (row.first_word, row.last_word) == ((min(places), max(places)) if places else (None, None))
        assert names <= set(row.labels.split(",")) and 0 <= row.score <= 1
        based += bool(places)
    assert based
