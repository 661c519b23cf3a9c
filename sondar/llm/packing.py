"""Vector bin packing of token sequences.

A piece of an example asks for tokens, one segment and loss-bearing tokens; a
sequence offers a limited amount of each.  The sequence being filled takes,
from a window of waiting pieces, the one whose demands have the largest dot product
with what is left of the limits.  Where none fits, a piece is cut to fill the
rest.  A sequence that its segments or loss tokens close early, and the last of
a partition, are cut into lengths that are powers of two, so none is padded.

Each partition packs its own rows and holds only the window: no shuffle, and a
hot source or repeated rows change nothing.  Sequence ids hold the partition
and a running number.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.llm.common import quoted, slices

WINDOW = 512
#: Bytes of text whose different parts are encoded together, and parts remembered by a
#: Python worker; any number may pass through.
TOGETHER, REMEMBERED = 32 << 20, 1_200_000
# Characters on whose classes every Unicode version agrees.
_UNUSUAL = re.compile("[^\\t\\n\\x20-\\x7e\\xa1-\\xac\\xae-\\u024f\\u2013\\u2014\\u2018-\\u201e\\u2022\\u2026\\u20ac]")


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


@dataclass
class Piece:
    """Ids ``start`` to ``end`` of an example whose first ``prompt`` ids bear no loss."""

    example: int
    ids: np.ndarray
    start: int
    end: int
    prompt: int

    @property
    def tokens(self) -> int:
        return self.end - self.start

    @property
    def loss(self) -> int:
        return max(0, self.end - max(self.start, self.prompt))

    def head(self, tokens: int, loss: int) -> int:
        """Ids that fit into so many tokens and loss-bearing tokens."""
        free = max(0, self.prompt - self.start)
        return min(self.tokens, tokens, free + loss)

    def cut(self, length: int) -> tuple[Piece, Piece]:
        middle = self.start + length
        return (Piece(self.example, self.ids, self.start, middle, self.prompt),
                Piece(self.example, self.ids, middle, self.end, self.prompt))


def _finished(pieces: list[Piece], limits: Limits) -> Iterator[list[Piece]]:
    """The pieces as one full sequence or as several whose lengths are powers of two."""
    left = sum(p.tokens for p in pieces)
    if left == limits.tokens:
        yield pieces
        return
    waiting = pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        sequence = []
        while room:
            piece = waiting.pop()
            if piece.tokens > room:
                piece, rest = piece.cut(room)
                waiting.append(rest)
            sequence.append(piece)
            room -= piece.tokens
        yield sequence


def packed(pieces: Iterable[Piece], limits: Limits = Limits(), window: int = WINDOW) -> Iterator[list[Piece]]:
    """Sequences of pieces.  Every id of every piece lies in exactly one."""
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("limits are positive")
    source = iter(pieces)
    pool: list[Piece | None] = [None] * window
    tokens, loss = np.zeros(window, np.int64), np.zeros(window, np.int64)
    free, ended = list(range(window)), False
    queue: list[Piece] = []
    caps = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)

    def put(piece: Piece) -> None:
        slot = free.pop()
        pool[slot], tokens[slot], loss[slot] = piece, piece.tokens, piece.loss

    def take(slot: int) -> Piece:
        piece = pool[slot]
        pool[slot], tokens[slot], loss[slot] = None, 0, 0
        free.append(slot)
        return piece

    def refill() -> Iterator[list[Piece]]:
        nonlocal ended
        # One slot stays free for the rest of a piece that is cut.
        while len(free) > 1 and not (ended and not queue):
            piece = queue.pop() if queue else next(source, None)
            if piece is None:
                ended = True
                break
            while piece.tokens >= limits.tokens and piece.head(limits.tokens, limits.loss) == limits.tokens:
                whole, piece = piece.cut(limits.tokens)
                yield [whole]
            if not piece.tokens:
                continue
            length = piece.head(limits.tokens, limits.loss)
            if length < piece.tokens:
                piece, rest = piece.cut(length)
                queue.append(rest)
            put(piece)

    while True:
        yield from refill()
        if len(free) == window:
            break
        sequence: list[Piece] = []
        left = [limits.tokens, limits.segments, limits.loss]
        while left[0] and left[1]:
            there = tokens > 0
            fits = np.flatnonzero(there & (tokens <= left[0]) & (loss <= left[2]))
            if len(fits):
                weights = np.array(left) / caps / caps
                value = tokens[fits] * weights[0] + weights[1] + loss[fits] * weights[2]
                piece = take(int(fits[value.argmax()]))
            else:
                # Cut the piece that fills most of the rest.
                best, length = -1, 0
                for slot in np.flatnonzero(there):
                    possible = pool[slot].head(left[0], left[2])
                    if possible > length:
                        best, length = int(slot), possible
                        if possible == left[0]:
                            break
                if best < 0:
                    break
                piece, rest = take(best).cut(length)
                put(rest)
            sequence.append(piece)
            left[0] -= piece.tokens
            left[1] -= 1
            left[2] -= piece.loss
            if left[0]:
                yield from refill()
        yield from _finished(sequence, limits)


_remembered: dict[str, dict[str, bytes]] = {}


def text_encoder(path: str, remembered: int = REMEMBERED) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    """Ids of texts by the tokenizer file at ``path``, without special tokens.

    The pre-tokens of a byte-level file never run from a visible character into a
    space, so a batch of such texts is cut there and each different part is encoded
    once, and remembered by the Python worker.  Texts with unusual characters, and other kinds of files, are encoded whole.
    """
    # Spark runs the tasks of an executor side by side; threads inside would be in the way.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    with open(path, encoding="utf-8") as file:
        form = json.load(file)
    before = form.get("pre_tokenizer") or {}
    by_part = (
        form.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
    )
    line_end = tokenizer.encode("\n", add_special_tokens=False).ids
    by_part = by_part and len(line_end) == 1

    def direct(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    ends = dict(zip(",.", direct([",", "."])))
    known = _remembered.setdefault(path, {})

    def after_space(parts: list[str]) -> list[bytes]:
        """The ids of each part with a space before it."""
        # A comma or full stop after a letter is a token of its own.
        ended = [len(p) > 1 and p[-1] in ",." and p[-2].isalpha() for p in parts]
        wanted = dict.fromkeys([p[:-1] if e else p for p, e in zip(parts, ended)])
        new = [p for p in wanted if p not in known]
        if len(known) + len(new) > remembered:
            known.clear()
            new = list(wanted)
        # Parts without white space are encoded many in one text; a line end before a
        # space is a token of its own, so it tells them apart.
        plain = [p for p in new if p and "\n" not in p and "\t" not in p]
        groups = [plain[i : i + 500] for i in range(0, len(plain), 500)]
        for group, raw in zip(groups, direct(["\n".join([" " + p for p in g]) for g in groups])):
            marks = np.flatnonzero(np.frombuffer(raw, dtype="<u4") == line_end[0])
            if len(marks) == len(group) - 1:
                cuts = [-1, *marks.tolist(), len(raw) // 4]
                known.update((p, raw[4 * a + 4 : 4 * b]) for p, a, b in zip(group, cuts, cuts[1:]))
        new = [p for p in new if p not in known]
        known.update(zip(new, direct([" " + p for p in new])))
        return [known[p[:-1]] + ends[p[-1]] if e else known[p] for p, e in zip(parts, ended)]

    def by_parts(texts: pa.Array) -> Iterator[np.ndarray]:
        cut = pc.split_pattern(texts, " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        which = coded.indices.to_numpy().astype(np.int64)
        # A text's first part has no space before it.
        start = coded.dictionary.take(pa.array(which[bounds[:-1] - bounds[0]])).to_pylist()
        different = list(dict.fromkeys(start))
        place = {p: i for i, p in enumerate(different, len(coded.dictionary))}
        which[bounds[:-1] - bounds[0]] = [place[p] for p in start]
        ids = after_space(coded.dictionary.to_pylist()) + direct(different)
        length = np.array([len(i) // 4 for i in ids], dtype=np.int64)
        begin = np.cumsum(length) - length
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        del ids, coded, cut
        for a, b in zip(bounds - bounds[0], bounds[1:] - bounds[0]):
            of = which[a:b]
            size = length[of]
            yield flat.take(np.repeat(begin[of] - (np.cumsum(size) - size), size) + np.arange(size.sum()))

    def encode(texts: pa.Array) -> Iterator[np.ndarray]:
        words = texts.fill_null("")
        whole = np.array([
            not by_part or "  " in t or "\n " in t or "\t " in t or _UNUSUAL.search(t) is not None for t in words.to_pylist()
        ], dtype=bool)
        parts = by_parts(words.filter(pa.array(~whole))) if not whole.all() else iter(())
        for i, alone in enumerate(whole.tolist()):
            yield np.frombuffer(direct([words[i].as_py()])[0], dtype="<u4") if alone else next(parts)

    return encode


def pack_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", prompt: str | None = None,
               end_id: int | None = 1, limits: Limits = Limits(), ids: bool = True,
               together: int = TOGETHER, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece of the packed texts.

    ``id_col``, ``start`` and ``length`` (the piece's place in its text's ids),
    ``doc_tokens`` (all its ids, ``end_id`` included), ``sequence_id``, ``offset``
    (place in the sequence), ``loss`` (loss-bearing ids), ``ids_crc32`` of the
    ids as little-endian 32-bit integers and, if asked, the ``ids``.  ``prompt``
    names a column with the number of leading ids that bear no loss.  A null text is empty: only its
    ``end_id`` is packed, and without one it has no piece.  Null and repeated ids
    are kept; every row is an example of its own.  ``together`` and ``remembered``
    trade a worker's memory for time and change nothing else.
    """
    kind = docs.schema[id_col].dataType
    frame = docs.select(quoted(id_col).alias("i"), quoted(text).alias("t"),
                        (F.coalesce(quoted(prompt), F.lit(0)) if prompt else F.lit(0)).cast("long").alias("p"))
    schema = T.StructType([T.StructField("i", kind)] + [
        T.StructField(n, T.LongType())
        for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss")
    ] + ([T.StructField("ids", T.ArrayType(T.LongType()))] if ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(path, remembered)
        names: dict[int, tuple[pa.Scalar, int]] = {}
        first = TaskContext.get().partitionId() << 36
        id_type: list[pa.DataType] = []

        def pieces() -> Iterator[Piece]:
            number = 0
            for batch in batches:
                id_type[:] = [batch.schema.field("i").type]
                for part in slices(batch, "t", together):
                    rows = zip(part.column("i").to_pylist(), encode(part.column("t")), part.column("p").to_pylist())
                    for name, found, free in rows:
                        if end_id is not None:
                            found = np.append(found, np.uint32(end_id)).astype("<u4")
                        number += 1
                        names[number] = (name, len(found))
                        yield Piece(number, found, 0, len(found), max(0, free))

        rows: list[tuple] = []
        owed: dict[int, int] = {}

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [id_type[0]] + [pa.int64()] * 7 + ([pa.list_(pa.int64())] if ids else [])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.name for f in schema])

        for sequence_id, sequence in enumerate(packed(pieces(), limits), first):
            offset = 0
            for piece in sequence:
                name, total = names[piece.example]
                part = piece.ids[piece.start : piece.end]
                row = (name, piece.start, piece.tokens, zlib.crc32(part.tobytes()), total, sequence_id, offset, piece.loss)
                rows.append((*row, part.tolist()) if ids else row)
                offset += piece.tokens
                # An example whose every id is placed is forgotten.
                owed[piece.example] = owed.get(piece.example, total) - piece.tokens
                if not owed[piece.example]:
                    del owed[piece.example], names[piece.example]
            if len(rows) >= 1000:
                yield batch()
                rows.clear()
        if rows:
            yield batch()

    out = frame.mapInArrow(run, schema)
    return out.select(F.col("i").alias(id_col), *[f.name for f in schema][1:])
