import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sondar.llm import licenses
from sondar.llm.license_rules import BASE, RULES, TIERS

RULES_NOW = licenses.rules()
NOTICES = [
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
    "licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: BSD-3-Clause", "all rights reserved",
    "Neither the name of the Foo Corp nor the names of its contributors may be used to endorse or promote products derived from this software.",
    "Unter der MIT-Lizenz", "mit freundlichen Grüßen", "creative commons attribution non-commercial share alike",
]


def plain(text):
    """(words, matches) by trying every rule and comparing all matches with each other."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    line, found = "".join(f" {w}" for w in words) + " ", []
    for i, rule in enumerate(RULES_NOW):
        if rule.base:
            phrase = rule.label, next(p for p, label in BASE.items() if label == rule.label).split()
            found += [(k, k + len(phrase[1]) - 1, i) for k in range(len(words)) if words[k : k + len(phrase[1])] == phrase[1]]
        else:
            for m in re.finditer(f"(?<= )(?:{rule.expression})(?= )", line):
                found.append((line[: m.start()].count(" ") - 1, line[: m.end()].count(" ") - 1, i))

    def inside(a, b):
        if a == b or not (b[0] <= a[0] and a[1] <= b[1]):
            return False
        ta, tb = RULES_NOW[a[2]].tier, RULES_NOW[b[2]].tier
        longer = b[1] - b[0] > a[1] - a[0]
        return tb <= ta if longer else (tb, b[2]) < (ta, a[2])

    return len(words), sorted(a for a in found if RULES_NOW[a[2]].base or not any(inside(a, b) for b in found))


def test_rules_are_many_and_gated_by_their_own_words():
    assert len(RULES_NOW) > 200 and list(RULES) == list(TIERS)
    assert all(r.keywords for r in RULES_NOW)
    assert licenses.necessary("under (?:the )?mit(?: x)? license") == {b"under", b"mit", b"license"}
    assert licenses.necessary("non ?commercial (?:v|version )?2 (?:a|b) licen[cs]e(?: [^ ]+){0,3} end") == {b"end"}


@pytest.mark.parametrize("text", [
    *NOTICES, " ".join(NOTICES), "", "x", "under the mit license under the MIT license", "APACHE LICENSE VERSION 2",
    "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice", "İ K Å under the mit license", "\x00under\x1cthe mit\nlicense\x7f",
])
def test_matches_equal_a_plain_scan(text):
    n, found = licenses.Scanner().matches(text.encode())
    assert (n, sorted(found)) == plain(text)


def test_long_texts_are_scanned_in_blocks(monkeypatch):
    text = " ".join(NOTICES[i % len(NOTICES)] + " filler" * (i % 7) for i in range(300))
    monkeypatch.setattr(licenses, "BLOCK", 64)
    n, found = licenses.Scanner().matches(text.encode())
    assert (n, sorted(found)) == plain(text)


def test_gaps_and_priorities():
    scanner = licenses.Scanner()

    def labels(text):
        return [RULES_NOW[i].label for _, _, i in scanner.matches(text.encode())[1]]

    assert labels(NOTICES[6]) == ["bsd-3-clause"]
    assert labels("licensed under the GNU Lesser General Public License, version 2.1") == ["lgpl-2.1"]
    assert labels("mit freundlichen Grüßen") == []
    assert sorted(labels("Licensed under CC BY-NC-SA 4.0")) == ["cc-by-nc", "cc-by-nc-sa"]


def test_rows_of_every_kind(spark, texts, nothing):
    clashing = texts.withColumns({c: F.lit("z") for c in ("t", "found", "c0", "label")}).unionByName(
        texts.limit(1).withColumns({c: F.lit(None).cast("string") for c in ("t", "found", "c0", "label")}).withColumn("text", F.lit(NOTICES[0])))
    rows = licenses.scan(clashing).collect()
    assert len(rows) == clashing.count()
    for r in rows:
        n, found = plain(r.text)
        assert r.n_words == n and r.t in ("z", None)
        assert sorted((m.first_word, m.last_word, m.rule) for m in r.licenses) == found
    assert licenses.scan(nothing).count() == licenses.summary(nothing).count() == 0
    clash = licenses.scan(texts.withColumn("Licenses", F.lit(1)))
    assert clash.columns[-2:] == ["n_words", "_licenses"] and clash.columns[-3] == "Licenses"


def test_query_matches_a_plain_scan(spark, sf):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = entry.queries()["op13_licenses"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        n, found = plain(text[r.doc_id])
        base = [f for f in found if RULES_NOW[f[2]].base]
        assert (r.n_words, r.n_base) == (n, len(base))
        assert (r.first_word, r.last_word) == ((min(base)[0], max(base)[0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({RULES_NOW[i].label for _, _, i in base}))
        assert r.labels == ",".join(sorted({RULES_NOW[i].label for _, _, i in found}))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(found)
