"""License signatures in whole texts by ordered rules, with DataFrame functions only.

A rule is a pattern over words, a label, a priority and a keyword. Texts are reduced
to their words; a text without any keyword is done with that. In the others each
word gets its number (``12:mit 13:license``), a rule is tried only where its own
keyword is among the words, and every match gives the numbers of its first and last
word. A match within a longer one, or on the same words as one of higher priority,
is suppressed; overlaps that neither contains stay both. Nothing is shuffled: the
rules are literals of a few hundred rows, tried one after the other on a row.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What parts words: all of ASCII but letters and digits.
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Score of a text by the words of its longest match.
WORDS_TO_TRUST = 2.0


@dataclass(frozen=True)
class Rule:
    """``pattern``: regexes of words parted by blanks, ``(x)?`` for a word that may be missing."""

    label: str
    pattern: str
    keyword: str
    priority: int


#: Fixed phrases and labels of the base.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def versions(*numbers: str) -> list[tuple[str, str]]:
    """Pairs of the label's form and the word pattern of a version ("2.0" is two words); a final zero may be missing."""
    out = []
    for number in numbers:
        whole, _, part = number.partition(".")
        tail = f" {part}" if part and part != "0" else " (0)?" if part else ""
        out.append((number, f"(v|version|ver)? v?{whole}{tail}"))
    return out


def license_rules() -> list[Rule]:
    """Signatures by family: names with each version and form, titles, notices and identifiers."""
    rules: list[Rule] = []

    def add(label: str, keyword: str, *patterns: str, priority: int = 50) -> None:
        rules.extend(Rule(label, p, keyword, priority) for p in patterns)

    # Titles of the base come last; every longer signature contains them.
    for phrase, label in BASE_PHRASES.items():
        add(label, "license", phrase, priority=90)

    # The share-alike family: kind x version x form.
    kinds = {"gpl": "(gnu)? general public licen[sc]e", "lgpl": "(gnu)? (?:lesser|library) general public licen[sc]e", "agpl": "(gnu)? affero general public licen[sc]e"}
    for kind, title in kinds.items():
        for number, version in versions(*{"gpl": ("1.0", "2.0", "3.0"), "lgpl": ("2.0", "2.1", "3.0"), "agpl": ("1.0", "3.0")}[kind]):
            add(f"{kind}-{number}-or-later", "general", f"{title} (as)? (published)? (by)? (the)? (free)? (software)? (foundation)? (either)? {version} (of)? (the)? (license)? or (at)? (your)? (option)? any later version", priority=10)
            add(f"{kind}-{number}-only", "general", f"{title} {version} only", priority=15)
            add(f"{kind}-{number}", "general", f"{title} {version}", priority=20)
            add(f"{kind}-{number}", kind, f"{kind} {version}", f"{kind}v{number.partition('.')[0]}", f"licensed under (the)? (gnu)? {kind} {version}", priority=30)
            add(f"{kind}-{number}-or-later", kind, f"{kind} {version} or later", f"{kind} {version} plus", priority=20)
            add(f"{kind}-{number}-only", kind, f"{kind} {version} only", priority=20)
        add(kind, "public", title, priority=60)
        add(kind, kind, f"{kind} licen[sc]e", f"licensed under (the)? (gnu)? {kind}", priority=70)

    # Creative commons: six uses x four versions, by name and by identifier.
    spelled = {"by": "attribution", "sa": "(share)? (?:alike|sharealike)", "nc": "(non)? (?:commercial|noncommercial)", "nd": "(no)? (?:derivatives|noderivatives|derivs|noderivs) (works)?"}
    for use in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
        pattern = " ".join(spelled[part] for part in use.split("-"))
        for number, version in versions("2.0", "2.5", "3.0", "4.0"):
            add(f"cc-{use}-{number}", "creative", f"creative commons {pattern} {version}", f"creative commons {pattern} {version} (international|unported|generic)? licen[sc]e", priority=20)
            add(f"cc-{use}-{number}", "cc", f"cc {use.replace('-', ' ')} {version}", priority=30)
        add(f"cc-{use}", "creative", f"creative commons {pattern}", f"creative commons {pattern} licen[sc]e", priority=40)
        add(f"cc-{use}", "cc", f"cc {use.replace('-', ' ')}", priority=45)
    add("cc0", "cc0", "cc0", "cc0 1 0", "cc0 1 0 universal", priority=40)
    add("cc", "creative", "creative commons licen[sc]e", "creative commons", priority=70)

    # Families by name and version.
    named = {
        "apache": ("apache", ("1.0", "1.1", "2.0"), "apache (software)? licen[sc]e"),
        "mpl": ("mozilla", ("1.0", "1.1", "2.0"), "mozilla public licen[sc]e"),
        "epl": ("eclipse", ("1.0", "2.0"), "eclipse public licen[sc]e"),
        "eupl": ("union", ("1.0", "1.1", "1.2"), "european union public licen[sc]e"),
        "cddl": ("distribution", ("1.0", "1.1"), "common development and distribution licen[sc]e"),
        "cpl": ("common", ("1.0",), "common public licen[sc]e"),
        "artistic": ("artistic", ("1.0", "2.0"), "artistic licen[sc]e"),
        "boost": ("boost", ("1.0",), "boost software licen[sc]e"),
        "osl": ("open", ("1.0", "2.0", "2.1", "3.0"), "open software licen[sc]e"),
        "afl": ("academic", ("1.1", "1.2", "2.0", "2.1", "3.0"), "academic free licen[sc]e"),
        "ofl": ("font", ("1.0", "1.1"), "(sil)? open font licen[sc]e"),
        "odbl": ("database", ("1.0",), "open database licen[sc]e"),
        "gfdl": ("documentation", ("1.1", "1.2", "1.3"), "(gnu)? free documentation licen[sc]e"),
        "zpl": ("zope", ("1.1", "2.0", "2.1"), "zope public licen[sc]e"),
        "php": ("php", ("3.0", "3.1"), "php licen[sc]e"),
        "python": ("python", ("2.0",), "python (software)? (foundation)? licen[sc]e"),
        "qpl": ("q", ("1.0",), "q public licen[sc]e"),
        "lppl": ("latex", ("1.0", "1.1", "1.2", "1.3"), "latex project public licen[sc]e"),
        "mulan": ("mulan", ("1.0", "2.0"), "mulan (permissive)? (software)? licen[sc]e"),
        "ms-pl": ("microsoft", (), "microsoft public licen[sc]e"),
        "ms-rl": ("microsoft", (), "microsoft reciprocal licen[sc]e"),
        "zlib": ("zlib", (), "zlib (libpng)? licen[sc]e"),
        "isc": ("isc", (), "isc licen[sc]e"),
        "wtfpl": ("want", (), "do what the f[a-z]* you want to public licen[sc]e"),
        "unlicense": ("unlicense", (), "(the)? unlicense"),
        "x11": ("x11", (), "(mit)? x11 licen[sc]e"),
        "0bsd": ("zero", (), "zero clause bsd"),
    }
    for label, (keyword, numbers, title) in named.items():
        add(label, keyword, title, f"licensed under (the)? (terms)? (of)? (the)? {title}", priority=60)
        for number, version in versions(*numbers):
            add(f"{label}-{number}", keyword, f"{title} {version}", f"licensed under (the)? {title} {version}", priority=20)
    for short in ("mpl", "epl", "eupl", "cddl", "apache", "ofl", "odbl", "gfdl"):
        for number, version in versions(*named[short][1]):
            add(f"{short}-{number}", short, f"{short} {version}", priority=40)

    # Short permissive forms, by clause count.
    for count, word in (("2", "two"), ("3", "three"), ("4", "four")):
        add(f"bsd-{count}-clause", "bsd", f"bsd {count} clause", f"(?:{count}|{word}) clause bsd", f"bsd {count} clause licen[sc]e", f"(?:{count}|{word}) clause bsd licen[sc]e", priority=20)
    add("bsd-2-clause", "bsd", "(?:simplified|freebsd) bsd licen[sc]e", priority=20)
    add("bsd-3-clause", "bsd", "(?:new|revised|modified) bsd licen[sc]e", priority=20)
    add("bsd-4-clause", "bsd", "(?:original|old) bsd licen[sc]e", priority=20)
    add("bsd", "bsd", "bsd (style)? licen[sc]e", "licensed under (the)? bsd", priority=60)
    for verb in ("licensed", "released", "distributed"):
        add("mit", verb, f"{verb} under (the)? mit (license)?", priority=40)

    # Sentences of license texts.
    add("mit", "charge", "permission is hereby granted free of charge to any person obtaining a copy", priority=5)
    add("isc", "fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", priority=5)
    add("bsd", "binary", "redistribution and use in source and binary forms with or without modification are permitted", priority=5)
    add("apache-2.0", "compliance", "you may not use this file except in compliance with the license", priority=5)
    add("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0", priority=5)
    add("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the (gnu)? general public license", priority=5)
    add("public-domain", "domain", "(?:released|dedicated|placed) (in|into|to)? the public domain", "public domain dedication", priority=50)
    add("proprietary", "reserved", "all rights reserved", priority=95)
    for identifier in ("mit", "isc", "zlib", "unlicense", "0bsd", "cc0 1 0"):
        add(identifier.split()[0], "spdx", f"spdx license identifier {identifier}", priority=10)
    return rules


def numbered_pattern(pattern: str) -> str:
    """The regex of a word pattern over ``12:word`` words; a match begins with the first word's number."""
    out, began = [], False
    for word in pattern.split():
        optional = word.startswith("(") and word.endswith(")?") and not word.startswith("(?:")
        body = word[1:-2] if optional else word
        if optional:
            out.append(f"(?:[0-9]+:(?:{body}) )?")
        else:
            out.append(f"[0-9]+:(?:{body}) ")
            began = True
    if not began:
        raise ValueError(f"a pattern needs a word that may not be missing: {pattern}")
    return f"(?<= ){''.join(out)}"


def any_of(keywords: set[str]) -> str:
    """A regex that finds any of the keywords as a word, tried by first letter."""
    letters = sorted({k[0] for k in keywords})
    groups = [f"{a}(?:{'|'.join(sorted(k[1:] for k in keywords if k[0] == a))})" for a in letters]
    return f"(?:^| )(?:{'|'.join(groups)})(?: |$)"


def license_matches(
    docs: DataFrame, rules: Sequence[Rule] | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: ``id_column``, ``n_words``, base figures, and ``detections`` that stand.

    ``detections`` are structs of first and last word, priority and label by first
    word. ``base_starts`` holds the first words of the base phrases, which
    are never suppressed. NULL, empty and wordless texts have no words, no detection
    and score 0. Repeated rows give repeated rows; other columns are not read.
    """
    rules = license_rules() if rules is None else list(rules)
    table = sorted({(r.priority, f" {r.keyword} ", numbered_pattern(r.pattern), r.label) for r in rules})
    listed = json.dumps([dict(zip(("priority", "keyword", "regex", "label"), row, strict=True)) for row in table])
    literals = F.from_json(F.lit(listed), "array<struct<priority: int, keyword: string, regex: string, label: string>>")
    rows = docs.select(docs[id_column].alias("id"), F.coalesce(docs[text_column], F.lit("")).alias("text")).select(
        "id", F.trim(F.regexp_replace("text", NO_WORD, " ")).alias("words")
    )
    blanks = F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit("")))
    rows = rows.select(
        "id",
        F.when(F.col("words") == "", 0).otherwise(blanks + 1).cast("long").alias("n_words"),
        # Lower case of all letters finds some texts too many; the rules see A-Z in lower case only.
        F.when(F.lower("words").rlike(any_of({r.keyword for r in rules})), F.concat(F.lit(" "), F.translate("words", CAPITALS, SMALL), F.lit(" "))).alias("plain"),
    )
    words = F.split(F.trim("plain"), " ")
    numbered = F.array_join(F.transform(words, lambda w, i: F.concat(i.cast("string"), F.lit(":"), w)), " ")
    rows = rows.select("*", F.when(F.col("plain").isNotNull(), F.concat(F.lit(" "), numbered, F.lit(" "))).alias("numbered"))

    def number(match: Column) -> Column:
        return F.substring_index(match, ":", 1).cast("long")

    def found(rule: Column) -> Column:
        matches = F.regexp_extract_all(F.col("numbered"), rule["regex"], F.lit(0))
        return F.transform(
            matches,
            lambda m: F.struct(
                number(m).alias("first"),
                (-number(F.substring_index(F.rtrim(m), " ", -1))).alias("before"),
                rule["priority"].alias("priority"),
                rule["label"].alias("label"),
            ),
        )

    # By first word, then the longest, then the priority: a match is contained if one before it ends no sooner.
    tried = F.filter(literals, lambda r: F.contains(F.col("plain"), r["keyword"]))
    all_found = F.array_sort(F.flatten(F.transform(tried, found)))
    kind = "array<struct<first: bigint, before: bigint, priority: int, label: string>>"
    start = F.struct(F.lit(-1).cast("long").alias("reach"), F.array().cast(kind).alias("kept"))

    def standing(state: Column, match: Column) -> Column:
        last = -match["before"]
        return F.when(
            last > state["reach"],
            F.struct(last.alias("reach"), F.concat(state["kept"], F.array(match)).alias("kept")),
        ).otherwise(state)

    kept = F.aggregate(F.coalesce("all_found", F.array().cast(kind)), start, standing, lambda s: s["kept"])
    base = "|".join(BASE_PHRASES)
    base_numbered = "|".join(" ".join(f"[0-9]+:{w}" for w in phrase.split()) for phrase in BASE_PHRASES)
    matched = rows.select(
        "id",
        "n_words",
        F.when(F.col("plain").rlike(f" (?:{base}) "), F.regexp_extract_all("numbered", F.lit(f"(?<= )(?:{base_numbered})(?= )"), F.lit(0))).alias("base"),
        all_found.alias("all_found"),
    )
    phrase = F.array_distinct(F.transform(F.coalesce("base", F.array().cast("array<string>")), lambda m: F.regexp_replace(m, "[0-9]+:", "")))
    return matched.select(
        F.col("id").alias(id_column),
        "n_words",
        F.transform(F.coalesce("base", F.array().cast("array<string>")), number).alias("base_starts"),
        F.transform(phrase, base_label).alias("base_labels"),
        F.transform(
            kept,
            lambda m: F.struct(m["first"].alias("first_word"), (-m["before"]).alias("last_word"), m["priority"].alias("priority"), m["label"].alias("label")),
        ).alias("detections"),
    )


def base_label(phrase: Column) -> Column:
    pairs = list(BASE_PHRASES.items())
    out = F.when(phrase == pairs[0][0], pairs[0][1])
    for name, label in pairs[1:]:
        out = out.when(phrase == name, label)
    return out


def license_summary(matches: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts, places, labels and a score between 0 and 1 that grows with the longest match."""
    starts = F.col("base_starts")
    longest = F.coalesce(F.array_max(F.transform("detections", lambda d: d["last_word"] - d["first_word"] + 1)), F.lit(0))
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("detections", lambda d: d["label"]))))
    return matches.select(
        id_column,
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        (longest / (longest + WORDS_TO_TRUST)).cast("double").alias("score"),
    )
