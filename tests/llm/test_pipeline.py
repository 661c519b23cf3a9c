import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sondar.llm import rules, toxicity
from tests.llm.test_simhash import by_definition, linked


def test_stages_keep_columns_and_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held, columns = docs, docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, sf).cache()
        assert held.columns == columns, name
        counts.append(held.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > 0
    assert held.where("n_chars <> length(text)").isEmpty()
    assert held.select("doc_id").distinct().count() == counts[-1]
    # Nothing of 200 bytes is left that the stage before held twice.
    texts = [r.text for r in held.collect()]
    pieces = corpus_pipeline.STAGES[-1][1](spark, held, sf).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in held.collect()} and len(texts) == counts[-1]


@pytest.mark.parametrize("stage", range(5))
def test_empty_tables(spark, sf, stage):
    none = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[stage][1](spark, none, sf).count() == 0


def without_repeats(texts, width=200):
    """The texts without the characters that a window found twice touches."""
    data, seen = [t.encode() for t in texts], {}
    for d in data:
        for i in range(len(d) - width + 1):
            seen[d[i : i + width]] = seen.get(d[i : i + width], 0) + 1
    out = []
    for t, d in zip(texts, data):
        gone, end = bytearray(len(d)), 0
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[max(i, end) : i + width] = b"1" * (i + width - max(i, end))
                end = i + width
        kept, at = [], 0
        for c in t:
            n = len(c.encode())
            if not any(gone[at : at + n]):
                kept.append(c)
            at += n
        out.append("".join(kept))
    return out


def test_pieces_match_a_plain_chain(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    lexicon = toxicity.learn(docs, labels)
    text = {r.doc_id: r.text or "" for r in docs.collect() if lexicon.score(r.text) < toxicity.THRESHOLD}
    # The rules' features are columns, so here the model's own scores decide.
    marked = rules.scored(docs.where(docs.doc_id.isin(list(text))), labels).collect()
    ids = sorted(r.doc_id for r in marked if r.score >= rules.THRESHOLD)
    root = linked([by_definition(text[i]) for i in ids])
    ids = [i for k, i in enumerate(ids) if root[k] == k]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1]
            for i, t in zip(ids, without_repeats([text[i] for i in ids]))}
    pieces = corpus_pipeline.run(spark, sf).collect()
    covered = {}
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        part = want[r.doc_id][r.start : r.start + r.length]
        assert r.start == covered.get(r.doc_id, 0) and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<i4").tobytes())
        covered[r.doc_id] = r.start + r.length
    assert covered == {i: len(x) for i, x in want.items()}


@pytest.mark.parametrize("stage", range(5))
def test_clashing_names(spark, sf, stage, texts):
    name, function = corpus_pipeline.STAGES[stage]
    docs = texts.withColumn("n_chars", F.length("text").cast("long"))
    out = function(spark, docs, sf)
    if name != "packing":
        assert out.columns == docs.columns
    assert out.count() > 0


def test_given_columns_come_back(spark, sf, texts):
    docs = texts.withColumn("n_chars", F.length("text").cast("long"))
    cut = corpus_pipeline.cut_repeats(spark, docs, sf).where("doc_id = 1").first()
    assert cut.kept == "kept" and cut.spans == "spans"
