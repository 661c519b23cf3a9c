import math
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sondar.llm import rules
from sondar.llm.labelled import fit_logistic


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(500):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(20, 90))]
        good = i % 4 != 0
        text = " ".join(words) if good else [" ".join(w.upper() + "!!" for w in words), " ".join([words[0]] * len(words))][i % 8 // 4]
        docs.append((i, text))
        labels.append((i, int(good)))
    docs += [(None, "one"), (900, None), (901, ""), (902, "x" * 200_000)]
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_learns_from_the_other_folds_only(spark, made):
    docs, labels = made
    rows = rules.scored(docs, labels).collect()
    assert len(rows) == docs.count()
    right = [r.predicted == int(r.doc_id % 4 != 0) for r in rows if r.held_out and r.doc_id < 500]
    assert sum(right) >= 0.95 * len(right) and len(right) > 60
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    known = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    assert rules.learn(docs, labels) == rules.learn(docs, known)


def test_the_column_agrees_with_the_rules(spark, made):
    docs, labels = made
    model = rules.learn(docs, labels)
    stats = rules.statistics(F.col("text"))
    rows = docs.select(model.score(stats).alias("s"), *[c.alias(n) for n, c in stats.items()]).collect()
    for r in rows[:100]:
        x = np.array([[r[n] for n in model.names]])
        total = model.intercept + sum(w for p, w in zip(model.paths, model.weights) if rules.fires(x, p)[0])
        assert math.isclose(r.s, 1 / (1 + math.exp(-total)), rel_tol=1e-9)
    assert all(len(p) <= rules.DEPTH for p in model.paths)


def test_the_lasso_is_sparse():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (600, 30)).astype(float)
    y = (x[:, 3] + rng.random(600) > 0.9).astype(float)
    w, _ = fit_logistic(x, y, l1=0.02)
    assert abs(w[3]) == np.abs(w).max() and (np.abs(w) < 1e-6).sum() >= 25


def test_rows_of_all_kinds(spark, made, texts, nothing):
    _, labels = made
    assert rules.scored(texts, labels).count() == 8
    assert rules.scored(nothing, labels).count() == 0
    assert rules.good(texts, labels).columns == texts.columns
    assert rules.scored(texts, labels.limit(0)).where("score between 0 and 1").count() == 8


def plainly(text):
    """The statistics of a text in plain Python."""
    t = text or ""
    n = max(len(t), 1)
    words = re.sub(r"[ \t\n\x0b\f\r]+", " ", t).strip(" ").split(" ")
    lines = t.split("\n")
    kinds = [unicodedata.category(c) for c in t]
    plain = [k[0] in "LN" or c in " \t\n\x0b\f\r.," for c, k in zip(t, kinds)]
    return {
        "chars": math.log1p(len(t)), "upper": kinds.count("Lu") / n, "digits": sum(c in "0123456789" for c in t) / n,
        "signs": plain.count(False) / n, "stops": sum(c in ".," for c in t) / n, "wide": (len(t.encode()) - len(t)) / n,
        "word_length": n / len(words), "distinct_words": len(set(words)) / len(words) ** 0.8,
        "line_length": math.log1p(n / len(lines)), "distinct_lines": len(set(lines)) / len(lines),
    }


def test_statistics_equal_plain_python(spark, texts, sf):
    odd = spark.createDataFrame([("a\n\nb\n",), ("  x  ",), ("Ünïcode ÄÖ, 12. ½ ٣\t\r\n",), ("\U0001f98a!!",), ("\n",)], "text string")
    rows = texts.select("text").unionByName(odd).unionByName(spark.read.parquet(f"{sf}/documents.parquet").select("text"))
    for r in rows.select("text", *[c.alias(n) for n, c in rules.statistics(F.col("text")).items()]).collect():
        for name, value in plainly(r.text).items():
            assert math.isclose(r[name], value, rel_tol=1e-9, abs_tol=1e-12), (name, r.text)


def test_statistics_stand_once_in_the_plan(spark, texts, monkeypatch):
    names = list(rules.statistics(F.col("text")))

    def plans(paths):
        model = rules.Rules(names, paths, [0.01] * len(paths), 0.0)
        monkeypatch.setattr(rules, "learn", lambda *_, **__: model)
        return [f(texts, None)._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") for f in (rules.good, rules.scored)]

    few = [((f, True, 0.5),) for f in range(len(names))]
    many = [((f, True, k / 50), (g, False, 0.9)) for f in range(10) for g in range(10) for k in range(3)]
    assert plans(few) == plans(many) == [7, 7]


def test_query_matches_the_rules(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = rules.learn(docs, labels)
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = entry.queries()["op4_quality"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        stats = plainly(text[r.doc_id])
        x = np.array([[stats[n] for n in model.names]])
        total = model.intercept + sum(w for p, w in zip(model.paths, model.weights) if rules.fires(x, p)[0])
        assert math.isclose(r.score, 1 / (1 + math.exp(-total)), rel_tol=1e-6)
