import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sondar.llm import suffixes


def removed(texts, width):
    """Covered bytes of each text by counting every window."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - width + 1):
            seen[d[i : i + width]] = seen.get(d[i : i + width], 0) + 1
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def corpus():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    line = "a line of thirty bytes or so, often"
    texts = []
    for n in range(90):
        parts = [rng.choice([rng.choice(passages), word(), line, " ".join(word() for _ in range(30))]) for _ in range(rng.randrange(1, 8))]
        texts.append(" ".join(parts))
    texts += [texts[3], texts[3], None, "", "x", "ab" * 400, "a" * 900, "\x00" * 300, passages[0][:50]]
    return texts


@pytest.mark.parametrize("width, anchor, shard", [(40, 10, 1 << 20), (40, 16, 500), (100, 48, 2000)])
def test_matches_counting(spark, width, anchor, shard):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = suffixes.remove_repeats(docs, min_len=width, anchor=anchor, shard_bytes=shard).collect()
    got = {r.doc_id: (len(r.spans), bytes(r.kept)) for r in rows}
    assert [got[i] for i in range(len(texts))] == removed(texts, width)


def test_long_texts_cross_blocks(spark):
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh") for _ in range(3000))
    texts = [base, "zz" + base[500:2500] + "yy", base[:300]]
    data = [(k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    rows = suffixes.remove_repeats(docs, min_len=200, anchor=48, block_bytes=700).collect()
    got = {r.doc_id: (len(r.spans), bytes(r.kept)) for r in rows}
    assert [got[i] for i in range(3)] == removed(texts, 200)


def test_suffix_array_and_prefixes():
    rng = random.Random(4)
    segments = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    segments += [segments[0] + b"a", b"a" * 50, segments[1]]
    bounds = np.cumsum([0] + [len(s) for s in segments])
    buf = np.frombuffer(b"".join(segments), np.uint8)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    order = suffixes.suffix_array(buf, ends)
    raw = buf.tobytes()
    want = sorted(range(len(raw)), key=lambda i: (raw[i : ends[i]], i))
    assert order.tolist() == want
    shared = suffixes.common_prefixes(buf, ends, order, bounds[:-1])
    for k in range(1, len(want)):
        a, b = raw[want[k - 1] : ends[want[k - 1]]], raw[want[k] : ends[want[k]]]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert shared[k] == n


def test_rows_of_all_kinds(spark, texts, nothing):
    rows = suffixes.remove_repeats(texts, min_len=30, anchor=8).collect()
    assert len(rows) == 8
    by = {r.doc_id: bytes(r["_kept"]) for r in rows}
    assert by[1] == by[2] == b"" and by[3] == by[4] == b"" and by[6].endswith("՘".encode())
    assert suffixes.remove_repeats(nothing).count() == 0


def test_whole_characters(spark):
    same = "é" * 30
    docs = spark.createDataFrame([(1, "ab€" + same + "ß"), (2, "₭" + same + "à")], "doc_id long, text string")
    rows = suffixes.remove_repeats(docs, min_len=21, anchor=8, whole_characters=True).collect()
    for r in rows:
        bytes(r.kept).decode()
    assert {r.doc_id: bytes(r.kept).decode() for r in rows}[1] in ("ab€ß", "ab€", "ab")


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(120)
    rows = suffixes.remove_repeats(docs.select("doc_id", "text"), keep=["doc_id", "text"], min_len=200).orderBy("doc_id").collect()
    want = removed([r.text for r in rows], 200)
    assert [(len(r.spans), bytes(r.kept)) for r in rows] == want
    assert docs.select(F.lit(1)).count() == len(rows)
