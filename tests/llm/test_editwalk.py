import random

import pytest

from sondar.llm import editwalk
from sondar.llm.editwalk import Walker, edited


def test_likeness_follows_edits():
    rng, walks = random.Random(1), Walker()
    text = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    few = list(text)
    for _ in range(6):
        few[rng.randrange(len(few))] = rng.choice(["", "x", "yz"])
    other = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    a, b, c, d = walks.fingerprints([text, "".join(few), other, text])
    assert a == d and walks.likeness(a, d) == 1
    assert walks.likeness(a, b) > 0.6 > 0.4 > walks.likeness(a, c)
    assert walks.likeness(a, b) == walks.likeness(b, a)


def test_one_by_one_and_side_by_side_agree():
    rng, walks = random.Random(2), Walker()
    texts = ["".join(rng.choice("abcé\U0001f98a") for _ in range(rng.choice([0, 1, 2, 17, 300, 5000]))) for _ in range(120)]
    assert walks.fingerprints(texts) == [walks.fingerprints([t])[0] for t in texts]


def test_the_walk_by_definition():
    walks = Walker()
    text = "some text of no meaning"
    embedding, j = [], 0
    for c in text:
        code = (ord(c) * 0x9E3779B1 & 0xFFFFFFFF) >> 24
        stay = int(walks.table[code, j % editwalk.PERIOD])
        embedding += [code % 255 + 1] * stay
        j += stay
    grid = next(g for g, n in enumerate(walks.grid) if n >= len(embedding))
    want = bytes(embedding[p] if p < len(embedding) else 0 for p in walks.sampled(grid))
    assert walks.fingerprints([text]) == [f"{grid:02x}{want.hex()}"]


def test_compared_with_the_next(spark, texts, nothing):
    import hashlib

    distinct = texts.dropDuplicates(["doc_id"]).where("doc_id is not null")
    rows = {r.doc_id: r for r in editwalk.compare_with_next(distinct).collect()}
    given = sorted(((r.doc_id, r.text or "") for r in distinct.collect()), reverse=True)
    assert len(rows) == len(given)
    for (i, text), (_, following) in zip(given, given[1:] + given[:1]):
        want = edited(text, following)
        assert rows[i].edited_sha256 == hashlib.sha256(want.encode()).hexdigest() and rows[i].n_chars == len(text)
        prints = editwalk.walker().fingerprints([text, want, following])
        assert [rows[i].fingerprint, rows[i].edited_fingerprint] == prints[:2]
        assert rows[i].near_next == editwalk.walker().likeness(prints[0], prints[2])
    assert editwalk.compare_with_next(texts).count() == 8
    assert editwalk.compare_with_next(nothing).count() == 0
    assert editwalk.compare_with_next(distinct.limit(1)).count() == 1


def test_parts_do_not_matter(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = sorted(map(tuple, editwalk.compare_with_next(docs).collect()))
    before = editwalk.PART_BYTES
    editwalk.PART_BYTES = 10_000
    try:
        got = sorted(map(tuple, editwalk.compare_with_next(docs.repartition(6)).collect()))
    finally:
        editwalk.PART_BYTES = before
    assert got == want


def test_near_copies_meet(spark, nothing):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(1500)) for _ in range(6)]
    rows = [(n, t) for n, t in enumerate(base)]
    rows += [(10 + n, t[:700] + "!" + t[701:] + "end") for n, t in enumerate(base)] + [(20, base[0]), (21, base[0]), (None, base[1]), (30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for tile in (512, 2):
        found = {}
        for r in editwalk.near_duplicates(docs, tile=tile).collect():
            found.setdefault(r.doc_id, r.component_id)
        assert [found[10 + n] for n in range(6)] == list(range(6)) and found[20] == found[21] == 0
        assert found[None] == 1 and found[30] == 30
    assert editwalk.near_duplicates(nothing).count() == 0


def test_other_ids_are_refused(spark):
    with pytest.raises(TypeError):
        editwalk.compare_with_next(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
