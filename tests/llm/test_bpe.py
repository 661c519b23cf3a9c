import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from sondar.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
REFERENCE = tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_ids_and_round_trip(spark, texts, nothing):
    rows = bpe.encode(texts, PATH, public_tokenizers.PATTERN, text="text").collect()
    want = sorted((str(r.doc_id), REFERENCE.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in texts.collect())
    assert sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in rows) == want
    for r in rows:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(bytes(r.decoded)).hexdigest()
    assert bpe.encode(nothing, PATH, public_tokenizers.PATTERN).count() == 0


def test_any_characters():
    rng, codec = random.Random(1), bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for _ in range(3000):
        text = "".join(chr(rng.choice([
            rng.randrange(300), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000), rng.choice([32, 10, 39, 9, 0x85, 0x1C, 0x200B])
        ])) for _ in range(rng.randrange(1, 25)))
        ids = codec.encode(text)
        assert ids == REFERENCE.encode_ordinary(text), ascii(text)
        assert codec.decode(ids) == text.encode()


def test_ranks_with_gaps_are_refused():
    with pytest.raises(ValueError):
        bpe.model({b"a": 0, b"b": 2})
