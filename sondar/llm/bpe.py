"""Byte-level BPE through a sentencepiece model made from a rank file.

The vocabulary of a byte-level BPE file becomes a sentencepiece BPE model without
training: every byte is written as a visible character, every token is a piece, its
score is its negative rank, and normalisation is the identity.  Sentencepiece
merges the adjacent pair with the best score, which is the pair of lowest rank.
Text is cut into pre-tokens, each encoded by itself; ids are decoded by the
inverse mapping.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.llm.common import quoted, slices

#: Pre-tokens remembered by a Python worker; any number may pass through.
REMEMBERED = 300_000
# Characters on whose classes all libraries agree.
_UNUSUAL = re.compile("[^\\t\\n\\x20-\\x7e\\xa1-\\xac\\xae-\\u024f\\u2013\\u2014\\u2018-\\u201e\\u2022\\u2026\\u20ac]")
# Stand-ins of a known class: letter, number, white space, other.
_STAND_INS = {"L": "中", "N": "٠", "S": " ", "": "☃"}


def byte_characters() -> list[str]:
    """A visible character for every byte: itself where it has one, else one
    of those from 256 on, in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in visible else chr(spare))
        spare += b not in visible
    return out


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value % (1 << 64))


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def read_ranks(path: str) -> dict[bytes, int]:
    """Token to rank, from lines of a base64 token and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model whose piece ids are the ranks.

    Ranks have to run from 0 without a gap; the unknown piece follows them.
    """
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks are not 0 to n-1")
    names = byte_characters()

    def piece(text: str, score: float, kind: int) -> bytes:
        return _bytes(1, _bytes(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    pieces = [piece("".join(names[b] for b in t), -float(ranks[t]), 1) for t in tokens]
    unknown = piece("<unk>", 0.0, 2)
    # Trainer settings: BPE, the size, no white-space splitting, and the special ids.
    trainer = _number(3, 2) + _number(4, len(tokens) + 1) + _number(24, 0)
    trainer += _number(40, len(tokens)) + _number(41, -1) + _number(42, -1) + _number(43, -1)
    # Normaliser settings: identity, no dummy prefix, spaces kept as they are.
    normaliser = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + unknown + _bytes(2, trainer) + _bytes(3, normaliser)


class Codec:
    """Encodes texts to ids and decodes ids to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import sentencepiece

        self.pattern = pattern
        self.find = regex.compile(pattern).findall
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model(ranks))
        names = byte_characters()
        self.names = str.maketrans({chr(b): names[b] for b in range(256)})
        self.byte_of = {ord(name): b for b, name in enumerate(names)}
        self.known: dict[str, tuple[list[int], bytes, bytes]] = {}
        self._odd: dict[int, str] | None = None

    def _stand_ins(self) -> dict[int, str]:
        """Stand-ins for the characters that the library of reference puts into another
        class than the pattern engine here does."""
        if self._odd is None:
            import tiktoken

            every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
            single = {bytes([i]): i for i in range(256)}
            here, there = {}, {}
            for name, pattern in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s")):
                probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
                # Text that the pattern does not match is left out of the ids.
                there.update((ord(c), name) for c in bytes(probe.encode_ordinary(every)).decode())
                here.update((ord(c), name) for c in regex.findall(pattern, every))
            self._odd = {
                c: _STAND_INS[there.get(c, "")] for c in here.keys() | there.keys() if here.get(c) != there.get(c)
            }
        return self._odd

    def words(self, text: str) -> list[str]:
        """The text's pre-tokens."""
        if not _UNUSUAL.search(text):
            return self.find(text)
        plain = text.translate(self._stand_ins())
        if plain == text:
            return self.find(text)
        return [text[m.start() : m.end()] for m in regex.finditer(self.pattern, plain)]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids, by the inverse of the byte mapping."""
        pieces = self.processor.id_to_piece(ids)
        return bytes(self.byte_of[ord(c)] for p in pieces for c in p)

    def learn(self, words: set[str]) -> None:
        """Encodes the pre-tokens that are not yet known, and decodes their ids."""
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        mapped = [w.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.names) for w in new]
        for word, ids in zip(new, self.processor.encode(mapped, num_threads=1)):
            self.known[word] = (ids, " ".join(map(str, ids)).encode(), self.decode(ids))

    def encode(self, text: str) -> list[int]:
        words = self.words(text)
        self.learn(set(words))
        return [i for w in words for i in self.known[w][0]]


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, made once per Python worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text",
           full: bool = True) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) and, if ``full``, ``ids`` and
    ``decoded``, of every row.

    The digests are of the decimal ids joined by single spaces and of the decoded
    bytes, lower-case hexadecimal.  A null text is empty and has no ids.
    """
    kind = docs.schema[id_col].dataType
    frame = docs.select(quoted(id_col).alias("i"), quoted(text).alias("t"))
    schema = T.StructType([
        T.StructField("i", kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ] + ([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())] if full else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, "t", 1 << 21):
                split = [coder.words(t or "") for t in part.column("t").to_pylist()]
                coder.learn(set().union(*split))
                known, counts, sums, backs, ids, decoded = coder.known.__getitem__, [], [], [], [], []
                for words in split:
                    found = list(map(known, words))
                    counts.append(sum([len(f[0]) for f in found]))
                    sums.append(hashlib.sha256(b" ".join([f[1] for f in found])).hexdigest())
                    data = b"".join([f[2] for f in found])
                    backs.append(hashlib.sha256(data).hexdigest())
                    if full:
                        ids.append([i for f in found for i in f[0]])
                        decoded.append(data)
                columns = [part.column("i"), pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(backs, pa.string())]
                if full:
                    columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    out = frame.mapInArrow(run, schema)
    return out.select(F.col("i").alias(id_col), *[f.name for f in schema][1:])
