import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sondar.llm import packing
from sondar.llm.packing import Limits, Piece, packed

PATH = public_tokenizers.path("byte_bpe_50k.json")


TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 5, 64), Limits(64, 3, 20), Limits(1, 1, 1), Limits(48, 100, 7)])
def test_limits_hold_and_every_id_is_placed_once(limits):
    rng = random.Random(str(limits))
    pieces = []
    for n in range(300):
        size = rng.choice([1, 2, 3, rng.randrange(1, 40), rng.randrange(1, 300)])
        pieces.append(Piece(n, np.arange(size), 0, size, rng.choice([0, 0, size // 2, size])))
    placed, lengths = defaultdict(list), []
    for sequence in packed(iter(pieces), limits, window=16):
        tokens = sum(p.tokens for p in sequence)
        assert tokens == limits.tokens or tokens & (tokens - 1) == 0
        assert 0 < tokens <= limits.tokens and len(sequence) <= limits.segments
        assert sum(p.loss for p in sequence) <= limits.loss
        lengths.append(tokens)
        for p in sequence:
            assert p.tokens > 0
            placed[p.example].append((p.start, p.end))
    for p in pieces:
        spans = sorted(placed[p.example])
        assert spans[0][0] == 0 and spans[-1][1] == p.end
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    if limits == Limits():
        assert lengths.count(2048) == sum(p.end for p in pieces) // 2048


def test_limits_are_positive():
    with pytest.raises(ValueError):
        next(packed([], Limits(0)))


def check(df, rows):
    want = sorted((str(r.doc_id), ids_of(r.text)) for r in rows)
    got, sequences = defaultdict(list), defaultdict(list)
    for r in df.collect():
        sequences[r.sequence_id].append((r.offset, r.length))
        got[str(r.doc_id), r.doc_tokens].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and len(r.ids) == r.length
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
    total = sum(len(ids) for _, ids in want)
    assert total == sum(n for s in sequences.values() for _, n in s)
    for name, ids in want:
        parts = sorted((r.start, r.ids) for r in got[name, len(ids)])
        copies = sum(w == (name, ids) for w in want)
        flat = [i for start in sorted({s for s, _ in parts}) for i in next(p for s, p in parts if s == start)]
        assert copies > 1 or flat == ids


def test_texts_of_all_kinds(spark, texts, nothing):
    check(packing.pack_texts(texts, PATH), texts.collect())
    assert packing.pack_texts(nothing, PATH).count() == 0
    odd = spark.createDataFrame([(1, "<|endoftext|> a  b\r\n ՘x \x1c 's"), (2, "  x")], "doc_id long, text string")
    check(packing.pack_texts(odd, PATH), odd.collect())


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(packing.pack_texts(docs, PATH), docs.collect())


def test_prompts_bear_no_loss(spark):
    docs = spark.createDataFrame([(1, "one two three four five six", 3), (2, "seven", None)], "doc_id long, text string, p long")
    rows = packing.pack_texts(docs, PATH, prompt="p").collect()
    loss = defaultdict(int)
    for r in rows:
        loss[r.doc_id] += r.loss
    assert loss[1] == len(ids_of("one two three four five six")) - 3 and loss[2] == len(ids_of("seven"))
