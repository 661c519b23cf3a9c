"""The registered queries that have no SQL, on the smallest given tables, against plain Python."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry
from sondar.llm import editwalk
from tests.llm.test_simhash import by_definition, linked


@pytest.fixture(scope="module")
def given(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def rows(spark, sf, name):
    return entry.queries()[name](spark, sf).collect()


def test_op1(spark, sf, given):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in given.items()}
    covered, filled = {}, {}
    for r in sorted(rows(spark, sf, "op1_packing"), key=lambda r: (r.doc_id, r.start)):
        part = want[r.doc_id][r.start : r.start + r.length]
        assert r.start == covered.get(r.doc_id, 0) and r.length == len(part) > 0 and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<i4").tobytes())
        covered[r.doc_id] = r.start + r.length
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert covered == {i: len(x) for i, x in want.items()}
    for pieces in filled.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    # Little is padded: all but a few sequences a task are full.
    assert sum(sum(n for _, n in p) == 2048 for p in filled.values()) >= 0.9 * len(filled) - 8


def test_op3(spark, sf, given, width=200):
    data = {i: t.encode() for i, t in given.items()}
    seen = {}
    for d in data.values():
        for k in range(len(d) - width + 1):
            seen[d[k : k + width]] = seen.get(d[k : k + width], 0) + 1
    got = {r.doc_id: r for r in rows(spark, sf, "op3_suffix_arrays")}
    assert set(got) == set(data)
    for i, d in data.items():
        gone = np.zeros(len(d) + 2, dtype=bool)
        for k in range(len(d) - width + 1):
            if seen[d[k : k + width]] > 1:
                gone[k + 1 : k + width + 1] = True
        kept = np.frombuffer(d, np.uint8)[~gone[1:-1]].tobytes()
        spans = int((gone[1:] & ~gone[:-1]).sum())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(d), len(d) - len(kept), spans)
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_op5(spark, sf, given):
    order = sorted(given, reverse=True)
    got = {r.doc_id: r for r in rows(spark, sf, "op5_edit_fingerprints")}
    assert set(got) == set(given)
    walks = editwalk.walker()
    prints = dict(zip(order, walks.fingerprints([given[i] for i in order])))
    for i, j in zip(order, order[1:] + order[:1]):
        half = len(given[i]) // 2
        changed = given[i][: len(given[i]) - half] + given[j][:half]
        after = walks.fingerprints([changed])[0]
        r = got[i]
        assert r.n_chars == len(given[i]) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (prints[i], after)
        assert (r.near_edited, r.near_next) == (walks.likeness(prints[i], after), walks.likeness(prints[i], prints[j]))


def test_op8(spark, sf, given):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in rows(spark, sf, "op8_bpe")}
    assert set(got) == set(given)
    for i, text in given.items():
        ids = plain.encode_ordinary(text)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_op9(spark, sf, given):
    ids = sorted(given)
    prints = [by_definition(given[i]) for i in ids]
    root = linked(prints)
    got = {r.doc_id: r for r in rows(spark, sf, "op9_simhash")}
    assert set(got) == set(given)
    for k, i in enumerate(ids):
        assert got[i].fingerprint == f"{prints[k]:016x}" and got[i].component_id == ids[root[k]]
