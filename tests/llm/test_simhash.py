import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sondar.llm import simhash
from sondar.llm.common import components


def by_definition(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps, distance=3):
    root = list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def test_fingerprints_follow_the_definition(spark, texts):
    rows = simhash.fingerprints(texts, "text", ["doc_id", "text"]).collect()
    assert len(rows) == 8
    for row in rows:
        assert row.fp % (1 << 64) == by_definition(row.text)
    assert by_definition("ÄB Ä x y") == simhash.fingerprint("Äb Ä x y")


def test_components_match_all_pairs(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(150)]
    # A chain, a dense group and bits at the top and bottom.
    fps += [fps[0] ^ ((1 << k) - 1) for k in range(1, 14)]
    fps += [fps[1] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)]
    fps = sorted(set(fps) | {fps[2] ^ 1 << 63, fps[2] ^ 7})
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for group in (2048, 24):  # the smaller divides groups several times
        comps = components(simhash.links(frame, group=group)).collect()
        root = {r.node % (1 << 64): r.root % (1 << 64) for r in comps}
        got = {}
        for f in fps:
            got.setdefault(root.get(f, f), set()).add(f)
        want = {}
        for f, r in zip(fps, linked(fps)):
            want.setdefault(r, set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_references_lose_no_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fp = np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 40)])
    group = np.zeros(len(fp), dtype=np.int64)
    i, j = simhash.linked_pairs(group, fp, 3)
    want = {(a, b) for a in range(len(fp)) for b in range(a + 1, len(fp)) if int(fp[a] ^ fp[b]).bit_count() <= 3}
    assert set(zip(i.tolist(), j.tolist())) == want


def test_rows_of_all_kinds(spark, texts, nothing):
    rows = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(texts).collect()}
    assert simhash.near_duplicates(texts).count() == 8
    fox = simhash.fingerprint("The quick brown fox jumps over the lazy dog")
    fox = fox - (1 << 64) if fox >> 63 else fox
    assert rows[1, fox] == rows[2, fox] == 1
    assert rows[3, 0] == rows[4, 0] == 3
    assert [c for (i, _), c in rows.items() if i is None] == [None]
    assert simhash.near_duplicates(nothing).count() == 0


def test_one_of_each_keeps_columns(spark, texts, nothing):
    kept = simhash.one_of_each(texts)
    assert kept.columns == texts.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 5, 6]
    assert simhash.one_of_each(nothing).count() == 0
    same = texts.where("doc_id = 2")
    assert simhash.one_of_each(same).count() == 1


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.root for r in components(edges).collect()} == {0}
    assert components(edges.where("u < 0")).count() == 0


def test_text_ids(spark, texts):
    named = texts.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    rows = simhash.one_of_each(named).collect()
    assert rows[0].asDict().keys() == {c: 0 for c in texts.columns}.keys()
    assert {r.doc_id for r in rows} == {"d1", "d3", "d5", "d6", None}
