import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sondar.llm import toxicity
from sondar.llm.toxicity import Lexicon, folded


@pytest.fixture(scope="module")
def made(spark):
    docs, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        word = ["grunzel", "Grunzelmann", "idi0t"][i % 3] if toxic else "harmless"
        docs.append((i, f"some words number{i} and {word} follow here again " * (1 + i % 4)))
        labels.append((i, int(toxic)))
    docs += [(None, "grunzel"), (1000, None), (1001, ""), (1002, "so harmless " * 9000 + "grunzeltier"), (1002, "clean")]
    labels += [(5000, 1), (None, 1), (3, None), (0, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_folding():
    assert folded("Yоu 1d10t, p4thetic​ L­OSER ｆｕｌｌ") == " you idiot pathetic loser full "
    assert folded("call 2024 or A4") == " call or aa "
    assert folded(None) == folded("") == " "


def test_exceptions_and_beginnings():
    lexicon = Lexicon({" trash ": 2.0, " grunz": 3.0}, ("trash can",))
    assert lexicon.total(folded("a trash can")) == 0
    assert lexicon.total(folded("trash in a trash can")) == 2
    assert lexicon.total(folded("grunzwort, ungrunz")) == 3
    assert Lexicon({}, ()).total(folded("anything")) == 0


def test_learns_and_keeps_folds_apart(spark, made):
    docs, labels = made
    rows = toxicity.scored(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        if r.doc_id is not None and r.doc_id < 400:
            assert r.predicted == (r.doc_id % 5 == 0)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.predicted)
    assert by[None] == [1] and by[1000] == by[1001] == [0] and sorted(by[1002]) == [0, 1]


def test_much_copied_document_leaves_room_for_other_words(spark):
    draw = random.Random(7)
    copied = " ".join("".join(draw.choices("bcdfghklmnprstvz", k=12)) for _ in range(900))
    docs = [(i, copied if i % 4 == 0 else "nothing but words here") for i in range(300)]
    docs += [(i, f"here are words and grunzel number{i}") for i in range(300, 312)]
    labels = [(i, int(i % 4 == 0 or i >= 300)) for i, _ in docs]
    lexicon = toxicity.learn(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    learnt = set(lexicon.weights) - {folded(w) for w in toxicity.BASE}
    assert " grunzel " in learnt and len(learnt) == 2


def test_held_out_labels_change_nothing(spark, made):
    docs, labels = made
    held = [r for r in labels.collect() if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    other = labels.join(spark.createDataFrame(held, labels.schema).select("doc_id").distinct(), "doc_id", "left_anti")
    assert toxicity.learn(docs, labels) == toxicity.learn(docs, other)


def test_clean_rows_keep_their_columns(spark, made, texts, nothing):
    docs, labels = made
    assert toxicity.clean(docs, labels).columns == docs.columns
    assert toxicity.clean(texts, labels).columns == texts.columns
    assert toxicity.clean(texts, labels).count() == 8
    assert toxicity.clean(nothing, labels).count() == 0
    assert toxicity.scored(texts, labels.limit(0)).where("score between 0 and 1").count() == 8


def plain(lexicon, text):
    """The sum of weights by looking for every entry at every place."""
    words = folded(text)

    def places(entry):
        return [i for i in range(len(words)) if words.startswith(entry, i)]

    harmless = {i + k for phrase in lexicon.exceptions for i in places(folded(phrase)) for k in range(len(folded(phrase)) - 1)}
    single = {}
    for entry, weight in lexicon.weights.items():
        for i in places(entry) if entry[0] != "2" else ():
            single[i] = max(single.get(i, weight), weight)
    again = sum(
        w * max(0, len([i for i in places(e[1:]) if i not in harmless]) - 1) for e, w in lexicon.weights.items() if e[0] == "2")
    return sum(w for i, w in single.items() if i not in harmless) + again


def test_totals_equal_a_plain_matcher():
    lexicon = Lexicon({" trash ": 2.0, " tra": 1.5, " grunz": 3.0, " grunzel ": 4.0, "2 grunz": 2.5, "2 bome": 1.0, " bomente": 0.5}, ("trash can", "can"))
    draw = random.Random(5)
    words = ["trash", "can", "tr4sh", "grunzel", "grunzelig", "bomente", "bomen", "Grunz", "xgrunz", "other", "trashcan"]
    for _ in range(400):
        text = " ".join(draw.choices(words, k=draw.randrange(12)))
        assert math.isclose(lexicon.total(folded(text)), plain(lexicon, text)), text


def test_repeated_beginnings_are_learnt(spark):
    draw = random.Random(9)
    filler = ["".join(draw.choices("bcdfghklmn", k=6)) for _ in range(300)]
    docs, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        odd = [f"zorb{draw.choice(filler)}" for _ in range(3 if bad else int(i % 9 == 1))]
        words = draw.choices(filler, k=40) + odd
        draw.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows = toxicity.scored(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 6 == 0) for r in held) >= 0.98 * len(held)


def test_repeated_ids_learn_from_one_text(spark, made):
    docs, labels = made
    copies = docs.unionByName(docs).unionByName(docs.where("doc_id < 40").withColumn("text", F.lit("zzz last")))
    assert toxicity.learn(copies, labels) == toxicity.learn(copies.repartition(7, "text"), labels)


def test_query_matches_the_plain_matcher(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    lexicon = toxicity.learn(docs, labels)
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = entry.queries()["op10_toxicity"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        total, n = plain(lexicon, text[r.doc_id]), folded(text[r.doc_id]).count(" ")
        a = math.log1p(total)
        z = sum(w * x for w, x in zip(lexicon.scale, (a, math.log1p(toxicity.DILUTION * total / min(n, toxicity.DILUTION)) - a, 1)))
        assert math.isclose(r.score, 1 / (1 + math.exp(-z)), rel_tol=1e-9) and r.predicted == (r.score >= 0.3)
