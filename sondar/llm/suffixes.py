"""Removal of byte strings that occur more than once, by suffix arrays.

Every window of ``min_len`` bytes belongs to its anchor, the window's smallest
hash of a shorter string.  Equal windows have equal anchors at equal
places, so a window whose anchor occurs once in the whole corpus is unique, and
equal windows meet wherever text is dealt by anchor.  The windows of one anchor
in one text form a run; the run's bytes are a segment.

* An anchor found once is dropped.
* Segments that occur several times as a whole are repeated throughout; they
  are counted, not compared, however many copies there are.
* What differs around a common anchor is compared exactly: different segments
  go to shards of bounded size, each shard gets a suffix array by
  Larsson-Sadakane refinement and common prefixes by Kasai's rule, and a window
  is repeated if a neighbour shares ``min_len`` bytes.  The segments of an anchor
  with more than a shard's fill are spread over several shards; the sorted
  window digests of these are merged by binary search.

Texts are identified by 88 bits of hashes and windows of different shards by 128
bits; everything else is compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.llm.common import fresh, quoted, slices, staged

MIN_LEN = 200
ANCHOR = 48
SHARD_BYTES = 1 << 20
BLOCK = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D
_POSITION = np.uint64((1 << 24) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _hashes(buf: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes from each position on."""
    n = len(buf)
    size = 1 << max(n, 1).bit_length()
    if size not in _tables:
        _tables.clear()
        _tables[size] = (_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size))
    up, down = _tables[size]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    value = (sums[length:] - sums[: n + 1 - length]) * down[: n + 1 - length]
    value ^= value >> np.uint64(31)
    value *= _MULTIPLIER
    value ^= value >> np.uint64(29)
    return value


def _smallest(key: np.ndarray, width: int) -> np.ndarray:
    """The smallest key of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        key = np.minimum(key[: len(key) - span], key[span:])
        span *= 2
    if span < width:
        key = np.minimum(key[: len(key) - (width - span)], key[width - span :])
    return key


def anchored(buf: bytes, bounds: np.ndarray, min_len: int, anchor: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows in texts laid end to end at ``bounds``: the text's
    number, the run's first window and number of windows in the buffer, and the
    anchor's hash.  The buffer is at most 16 MB."""
    none = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    if len(buf) < min_len:
        return none
    grams = _hashes(np.frombuffer(buf, np.uint8), anchor)
    key = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    at = (_smallest(key, min_len - anchor + 1) & _POSITION).astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(at)]
    inside = np.flatnonzero(np.arange(len(at)) + min_len <= bounds[text + 1])
    if not len(inside):
        return none
    a, t = at[inside], text[inside]
    start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (t[1:] != t[:-1])]))
    count = np.diff(np.append(start, len(inside)))
    return t[start], inside[start], count, grams[a[start]]


def _keys(text: Column) -> tuple[Column, Column]:
    """A text's 64-bit and 24-bit hash."""
    return F.xxhash64(text), F.xxhash64(F.lit("second"), text).bitwiseAND((1 << 24) - 1)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _place(second: Column, start: Column, windows: Column) -> Column:
    """Second hash, first window and number of windows of a run in one long."""
    return F.shiftleft(second, 39).bitwiseOR(F.shiftleft(start, 8)).bitwiseOR(windows - 1)


_START_MASK, _COUNT_MASK = (1 << 31) - 1, (1 << 8) - 1


def runs(texts: DataFrame, min_len: int, anchor: int, block_bytes: int = BLOCK) -> DataFrame:
    """(h, g1, g2, k, place) per run of every text of columns k, second, t."""
    most = min_len - anchor + 1
    if most > 256 or anchor < 8 or not min_len <= block_bytes <= 1 << 24:
        raise ValueError("an anchor has at least 8 bytes, at most 256 windows have it, and a block holds 16 MB")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(parts: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
            buf = b"".join(p[3] for p in parts)
            bounds = np.cumsum([0] + [len(p[3]) for p in parts])
            t, start, count, h = anchored(buf, bounds, min_len, anchor)
            digest, tail = xxhash.xxh3_128_digest, min_len - 1
            g = np.frombuffer(
                b"".join(digest(buf[s : s + c + tail]) for s, c in zip(start.tolist(), count.tolist())), dtype="<u8"
            ).reshape(-1, 2)
            k, second, base = (np.array([p[i] for p in parts], dtype=np.int64)[t] for i in range(3))
            place = (second << 39) | ((start - bounds[t] + base) << 8) | (count - 1)
            return pa.RecordBatch.from_arrays(
                [_signed(h), _signed(np.ascontiguousarray(g[:, 0])), _signed(np.ascontiguousarray(g[:, 1])),
                 pa.array(k), pa.array(place)], names=["h", "g1", "g2", "k", "place"])

        waiting: list[tuple[int, int, int, bytes]] = []
        size = 0
        for batch in batches:
            for part in slices(batch, "t"):
                for k, second, text in zip(*(part.column(c).to_pylist() for c in ("k", "second", "t"))):
                    data = text.encode("utf-8", "surrogatepass")
                    if len(data) < min_len:
                        continue
                    if len(data) >= 1 << 31:
                        raise ValueError("a text of 2 GB or more")
                    # Long texts go in blocks that share all but one byte of a window.
                    for base in range(0, len(data) - min_len + 1, block_bytes - min_len + 1):
                        piece = data[base : base + block_bytes]
                        if size + len(piece) > block_bytes and waiting:
                            yield block(waiting)
                            waiting, size = [], 0
                        waiting.append((k, second, base, piece))
                        size += len(piece)
        if waiting:
            yield block(waiting)

    return texts.select("k", "second", "t").mapInArrow(scan, "h long, g1 long, g2 long, k long, place long")


def suffix_array(buf: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All suffixes, each up to its end, in order; equal ones by position.

    ``ends`` has for every position the end of its segment.  Larsson and
    Sadakane's refinement: groups of suffixes equal in their first ``h`` bytes are
    divided by the group of what follows these, and only groups of several are touched again.
    """
    n = len(buf)
    left = ends - np.arange(n)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(7):
        key = (key << np.uint64(8)) | np.where(left > i, padded[i : i + n], np.uint64(0))
    key = (key << np.uint64(8)) | np.minimum(left, 7).astype(np.uint64)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, dtype=np.int64)
    start = np.flatnonzero(first)
    rank[order] = np.repeat(start, np.diff(np.append(start, n)))
    h, longest = 7, int(left.max()) if n else 0
    while True:
        size = np.diff(np.append(start, n))
        mixed = np.flatnonzero(np.repeat(size > 1, size))
        if not len(mixed):
            return order
        these = order[mixed]
        group = rank[these]
        if h >= longest:
            order[mixed] = these[np.argsort(group * np.int64(n) + these)]
            return order
        after = np.where(left[these] > h, rank[np.minimum(these + h, n - 1)] + 1, 0)
        both = group * np.int64(n + 1) + after
        by = np.argsort(both)
        these, both, group = these[by], both[by], group[by]
        order[mixed] = these
        new = np.concatenate([[True], both[1:] != both[:-1]])
        fresh_start = np.flatnonzero(new)
        rank[these] = np.repeat(mixed[fresh_start], np.diff(np.append(fresh_start, len(these))))
        is_first = np.zeros(n, dtype=bool)
        is_first[start] = True
        is_first[mixed[fresh_start]] = True
        start = np.flatnonzero(is_first)
        h *= 2


def common_prefixes(buf: np.ndarray, ends: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each place in the order, the bytes shared with the place before.

    Kasai's rule, that a suffix shares at most one byte less than the suffix
    one byte longer did, followed through all segments at once: step by step from their starts.
    """
    n = len(buf)
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    shared = np.zeros(n, dtype=np.int64)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    word = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        word = (word << np.uint64(8)) | padded[i : i + n].astype(np.uint64)
    at = starts.copy()
    known = np.zeros(len(at), dtype=np.int64)
    while len(at):
        before = place[at] - 1
        other = order[np.maximum(before, 0)]
        most = np.where(before >= 0, np.minimum(ends[at] - at, ends[other] - other), 0)
        length = np.minimum(known, most)
        going = np.flatnonzero(length < most)
        while len(going):
            a, b, l = at[going], other[going], length[going]
            differ = word[a + l] ^ word[b + l]
            same = np.zeros(len(going), dtype=np.int64)
            for bits in range(8, 65, 8):
                same += differ < np.uint64(1 << (64 - bits)) if bits < 64 else differ == 0
            length[going] = np.minimum(l + same, most[going])
            going = going[(same == 8) & (length[going] < most[going])]
        shared[place[at]] = length
        on = at + 1 < ends[at]
        at, known = at[on] + 1, np.maximum(length[on] - 1, 0)
    return shared


def repeated_windows(segments: list[bytes], min_len: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each segment the windows, as booleans, that start more than once in
    all of them; and where in the laid-out segments the first of each different window starts, in
    suffix order, with the segments' bounds."""
    bounds = np.cumsum([0] + [len(s) for s in segments])
    buf = np.frombuffer(b"".join(segments), np.uint8)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    order = suffix_array(buf, ends)
    shared = common_prefixes(buf, ends, order, bounds[:-1][np.diff(bounds) > 0])
    close = shared >= min_len
    again = close.copy()
    again[:-1] |= close[1:]
    twice = np.zeros(len(buf), dtype=bool)
    twice[order] = again
    whole = ends - np.arange(len(buf)) >= min_len
    distinct = order[whole[order] & ~close]
    windows = [twice[a : max(a, b - min_len + 1)] for a, b in zip(bounds[:-1], bounds[1:])]
    return windows, distinct, bounds


def _ranges(flags: np.ndarray) -> list[int]:
    """First and last index of each run of true flags, in one list."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    edge[1::2] -= 1
    return edge.tolist()


def _compare(min_len: int):
    def shard(table: pa.Table) -> pa.Table:
        """Repeated windows of a shard's segments; for segments of a spread anchor
        also the digest of each different window, kind 1."""
        rows = table.select(["h", "g1", "g2", "wide", "segment"]).to_pylist()
        windows, distinct, bounds = repeated_windows([r["segment"] for r in rows], min_len)
        out = [(0, r["h"], r["g1"], r["g2"], _ranges(w), 0, 0) for r, w in zip(rows, windows) if w.any()]
        wide = np.array([r["wide"] for r in rows], dtype=bool)
        if wide.any():
            owner = np.searchsorted(bounds, distinct, side="right") - 1
            for p, i in zip(distinct.tolist(), owner.tolist()):
                if wide[i]:
                    r, at = rows[i], p - int(bounds[i])
                    d = xxhash.xxh3_128_digest(r["segment"][at : at + min_len])
                    d1, d2 = np.frombuffer(d, dtype="<i8").tolist()
                    out.append((1, r["h"], r["g1"], r["g2"], [at, at], d1, d2))
        columns = list(zip(*out)) if out else [()] * 7
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.int64()]
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "h", "g1", "g2", "windows", "d1", "d2"])

    return shard


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted digests those found in several shards, by binary search for
    each digest's first and last place."""
    columns = ("d1", "d2", "h", "g1", "g2", "at")
    rows = {c: np.empty(0, np.int64) for c in columns}

    def answer(upto: int) -> pa.RecordBatch:
        keys = np.rec.fromarrays([rows["d1"][:upto], rows["d2"][:upto]])
        first = np.searchsorted(rows["d1"][:upto], rows["d1"][:upto], side="left")
        last = np.searchsorted(rows["d1"][:upto], rows["d1"][:upto], side="right")
        twice = last - first > 1
        same = np.zeros(upto, dtype=bool)
        same[1:] = keys[1:] == keys[:-1]
        same[:-1] |= same[1:].copy()
        found = np.flatnonzero(twice & same)
        return pa.RecordBatch.from_arrays([pa.array(rows[c][:upto][found]) for c in columns[2:]], names=list(columns[2:]))

    for batch in batches:
        for c in columns:
            rows[c] = np.concatenate([rows[c], batch.column(c).to_numpy()])
        if not len(rows["d1"]):
            continue
        upto = int(np.searchsorted(rows["d1"], rows["d1"][-1], side="left"))
        if upto:
            yield answer(upto)
            rows = {c: v[upto:] for c, v in rows.items()}
    if len(rows["d1"]):
        yield answer(len(rows["d1"]))


def repeated_spans(docs: DataFrame, text: str = "text", min_len: int = MIN_LEN, anchor: int = ANCHOR,
                   shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK) -> DataFrame:
    """(k, second, spans): for each different text, by its hashes, the byte
    ranges that repeated windows cover, unordered and overlapping."""
    k, second = _keys(F.col("t"))
    texts = docs.select(F.coalesce(quoted(text), F.lit("")).alias("t")).where(F.octet_length("t") >= min_len)
    texts = texts.select("t", k.alias("k"), second.alias("second"))
    every = staged(runs(texts, min_len, anchor, block_bytes), "runs")
    twice = staged(
        every.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("g1").alias("low"), F.max("g1").alias("high"))
        .where("n > 1").select("h", (F.col("low") != F.col("high")).alias("mixed"), "low"), "anchors")
    hits = staged(every.join(twice.drop("low"), "h"), "hits")
    start = F.shiftrightunsigned("place", 8).bitwiseAND(_START_MASK)
    last = F.col("place").bitwiseAND(_COUNT_MASK)
    of_text = [F.col("k"), F.shiftrightunsigned("place", 39).alias("second")]

    # One place to read each different segment of a mixed anchor.
    segments = staged(
        hits.where("mixed").groupBy("h", "g1", "g2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "place")).alias("r"))
        .select("h", "g1", "g2", "n", "r.k", "r.place"), "segments")
    total = segments.agg(F.sum(last + min_len)).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    wide = staged(
        segments.groupBy("h").agg(F.sum(last + min_len).alias("bytes")).where(F.col("bytes") > shard_bytes // 2)
        .select("h", F.ceil(2 * F.col("bytes") / shard_bytes).cast("long").alias("pieces")), "wide")
    wanted = segments.groupBy(*of_text).agg(F.collect_list(F.struct("h", "g1", "g2", start.alias("s"), last.alias("c"))).alias("wanted"))
    sources = staged(wanted, "wanted")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", 1 << 19):
                rows = []
                for t, wants in zip(part.column("t").to_pylist(), part.column("wanted").to_pylist()):
                    data = t.encode("utf-8", "surrogatepass")
                    rows.extend((w["h"], w["g1"], w["g2"], data[w["s"] : w["s"] + w["c"] + min_len]) for w in wants)
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=["h", "g1", "g2", "segment"])

    # Copies of a text give the same segments, of which each task keeps one.
    cut = texts.join(sources, ["k", "second"]).select("t", "wanted").mapInArrow(
        extract, "h long, g1 long, g2 long, segment binary")
    cut = cut.groupBy("h", "g1", "g2").agg(F.first("segment").alias("segment"))
    spread = wide.select("h", "pieces")
    dealt = cut.join(spread, "h", "left").select(
        "h", "g1", "g2", "segment", F.col("pieces").isNotNull().alias("wide"),
        F.pmod(F.when(F.col("pieces").isNull(), F.xxhash64("h")).otherwise(
            F.xxhash64("h", F.pmod(F.col("g1"), F.col("pieces")))), F.lit(shards)).alias("shard"))
    compared = staged(
        dealt.groupBy("shard").applyInArrow(
            _compare(min_len), "kind int, h long, g1 long, g2 long, windows array<int>, d1 long, d2 long"), "compared")
    found = compared.where("kind = 0").select("h", "g1", "g2", "windows")
    if not wide.isEmpty():
        digests = compared.where("kind = 1").select("d1", "d2", "h", "g1", "g2", F.col("windows")[0].cast("long").alias("at"))
        merged = digests.repartition("d1").sortWithinPartitions("d1", "d2").mapInArrow(
            _merge, "h long, g1 long, g2 long, at long")
        merged = merged.select("h", "g1", "g2", F.array(F.col("at").cast("int"), F.col("at").cast("int")).alias("windows"))
        found = found.unionByName(merged)
    # Per segment: everything if it occurs several times, else what was found.
    found = found.groupBy("h", "g1", "g2").agg(F.flatten(F.collect_list("windows")).alias("windows"))
    decided = staged(
        segments.where("n > 1").select("h", "g1", "g2", F.lit(None).cast("array<int>").alias("windows"))
        .unionByName(found.join(segments.where("n > 1"), ["h", "g1", "g2"], "left_anti")), "decided")
    # Every run gets the decision on its segment; all segments of an anchor that is not mixed are one.
    every_segment = decided.unionByName(twice.where("not mixed").select(
        "h", F.col("low").alias("g1"), F.lit(None).cast("long").alias("g2"), F.lit(None).cast("array<int>").alias("windows"))).alias("d")
    found = hits.alias("r").join(
        every_segment, (F.col("r.h") == F.col("d.h")) & (F.col("r.g1") == F.col("d.g1"))
        & (F.col("d.g2").isNull() | (F.col("r.g2") == F.col("d.g2")))).select("k", "place", "windows")
    span = F.when(F.col("windows").isNull(), F.array(start, start + last)).otherwise(
        F.transform("windows", lambda w: w + start))
    return found.groupBy(*of_text).agg(F.collect_set(span).alias("spans"))


def _cut(min_len: int, whole_characters: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                spans, kept = [], []
                for text, found in zip(part.column("t").to_pylist(), part.column("spans").to_pylist()):
                    data = (text or "").encode("utf-8", "surrogatepass")
                    if not found:
                        spans.append([])
                        kept.append(data)
                        continue
                    pairs = np.concatenate([np.array(f, dtype=np.int64).reshape(-1, 2) for f in found])
                    pairs = pairs[np.argsort(pairs[:, 0])]
                    stop = np.maximum.accumulate(pairs[:, 1] + min_len)
                    new = np.concatenate([[True], pairs[1:, 0] > stop[:-1]])
                    begin = pairs[new, 0]
                    end = stop[np.append(np.flatnonzero(new)[1:] - 1, len(stop) - 1)]
                    if whole_characters:
                        raw = np.frombuffer(data + b" ", np.uint8)
                        # Back to a character's first byte, on past its last.
                        heads = np.flatnonzero((raw & 0xC0) != 0x80)
                        begin = heads[np.searchsorted(heads, begin, side="right") - 1]
                        end = heads[np.searchsorted(heads, end, side="left")]
                        new = np.concatenate([[True], begin[1:] > end[:-1]])
                        begin, end = begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
                    spans.append([{"start": int(a), "end": int(b)} for a, b in zip(begin, end)])
                    edges = [0, *np.stack([begin, end], 1).ravel().tolist(), len(data)]
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                names = [n for n in part.schema.names if n not in ("t", "spans")]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(spans, kind), pa.array(kept, pa.binary())],
                    names=[*names, "spans", "kept"])

    return scan


def remove_repeats(docs: DataFrame, text: str = "text", keep: list[str] | None = None, min_len: int = MIN_LEN,
                   anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, whole_characters: bool = False,
                   block_bytes: int = BLOCK) -> DataFrame:
    """The kept columns (default: all but the text), ``spans`` and ``kept``; where the frame has
    columns of these names, the new ones have an underscore before theirs (``common.fresh``).

    ``spans`` are the maximal byte ranges covered by strings of ``min_len`` bytes
    that start anywhere else too, in this text or another; ``kept`` are the other bytes of
    the text in UTF-8.  Every row counts, so all copies of a long text lose it
    whole.  Null texts are empty.  With ``whole_characters`` the spans grow to the
    ends of the characters they touch, so that ``kept`` is text again.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    spans = staged(repeated_spans(docs, text, min_len, anchor, shard_bytes, block_bytes), "spans")
    names = [f"c{i}" for i in range(len(keep))]
    k, second = _keys(F.col("t"))
    rows = docs.select(
        *[quoted(c).alias(n) for c, n in zip(keep, names)], F.coalesce(quoted(text), F.lit("")).alias("t"))
    joined = rows.withColumns({"k": k, "second": second}).join(spans, ["k", "second"], "left").select(*names, "t", "spans")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = joined.select(*names).schema.add("spans", T.ArrayType(span)).add("kept", T.BinaryType())
    out = joined.mapInArrow(_cut(min_len, whole_characters), schema)
    added = [F.col(n).alias(fresh(docs, n)) for n in ("spans", "kept")]
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], *added)
