"""Document fingerprints by a randomised edit embedding.

A walk reads a text: at each step of the embedding it writes down the character it is at,
and a random bit that all texts share, drawn for the step and the character, decides whether it moves on.
Where two texts agree the walks fall back into step soon after an edit, so their
embeddings differ in about as many places as the texts have edits.  The fingerprint samples
the embedding at places of lowest random priority, so the samples of two
lengths agree on which places they share; likeness is the share of equal samples.

Bands of sampled bits bring texts together that may be alike; whole
fingerprints verify them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.llm.common import boundaries, components, quoted, slices, staged
from sondar.llm.simhash import forest

PERIOD = 4096
CLASSES = 256
SAMPLES = 64
SEED = 7
PART_BYTES = 16 << 20
MAX_PARTS = 20_000
BLOCK_CHARS = 1 << 21
BAND_SAMPLES, LIKENESS, TILE = 4, 0.8, 512


def _advances() -> np.ndarray:
    """Steps spent at a character of each class from each step on."""
    words = [xxhash.xxh64_intdigest(f"walk {i}".encode(), SEED) for i in range(CLASSES * PERIOD // 64)]
    bits = np.unpackbits(np.array(words, dtype="<u8").view(np.uint8)).reshape(CLASSES, PERIOD).astype(bool)
    bits[:, -1] |= ~bits.any(axis=1)
    twice = np.concatenate([bits, bits], axis=1)
    place = np.where(twice, np.arange(2 * PERIOD), 2 * PERIOD)
    following = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :PERIOD]
    return (following - np.arange(PERIOD) + 1).astype(np.int64)


def _grid() -> list[int]:
    """Lengths that embeddings are rounded up to, four in each octave."""
    out = [0, *range(1, 17)]
    while out[-1] < 1 << 44:
        out.append(max(out[-1] + 1, round(out[-1] * 2**0.25)))
    return out


class Walker:
    """The shared randomness, and what follows from it."""

    def __init__(self):
        self.table = _advances()
        self.rows = self.table.tolist()
        self.grid = _grid()
        self.places: dict[int, np.ndarray] = {}

    def sampled(self, grid: int) -> np.ndarray:
        """The places of lowest priority below the grid's length, by priority."""
        if grid not in self.places:
            length = self.grid[grid]
            best = np.empty(0, np.int64)
            for start in range(0, length, 1 << 20):
                place = np.concatenate([best, np.arange(start, min(length, start + (1 << 20)))])
                order = np.argsort(self.priority(place), kind="stable")[:SAMPLES]
                best = place[order]
            self.places[grid] = best
        return self.places[grid]

    @staticmethod
    def priority(place: np.ndarray) -> np.ndarray:
        x = place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def fingerprints(self, texts: list[str]) -> list[str]:
        """One fingerprint for each text; the walks of all texts go side by side."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        longest = lengths[order]
        code = np.frombuffer("".join([texts[i] for i in order]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        code = ((code * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
        bounds = np.concatenate([[0], np.cumsum(longest)])
        begins = np.empty(len(code), dtype=np.int64)
        at = np.zeros(len(texts), dtype=np.int64)
        step, active = 0, len(texts)
        flat = self.table.ravel()
        while True:
            active = int(np.searchsorted(-longest[:active], -step, side="left"))
            if active < 48:
                break
            where = bounds[:active] + step
            now = at[:active]
            begins[where] = now
            now += flat[code[where].astype(np.int64) * PERIOD + (now & (PERIOD - 1))]
            step += 1
        for i in range(active):  # the few longest texts go on by themselves
            j, places, rows, mask = int(at[i]), [], self.rows, PERIOD - 1
            for c in code[bounds[i] + step : bounds[i + 1]].tobytes():
                places.append(j)
                j += rows[c][j & mask]
            begins[bounds[i] + step : bounds[i + 1]] = places
            at[i] = j
        out = [""] * len(texts)
        for k, i in enumerate(order):
            end = int(at[k])
            grid = bisect_right(self.grid, end - 1) if end else 0
            place = self.sampled(grid)
            found = np.searchsorted(begins[bounds[k] : bounds[k + 1]], place, side="right") - 1
            # 0 is the space after the text's end, 1 to 255 are characters.
            symbol = code[bounds[k] + np.maximum(found, 0)] % 255 + 1 if end else np.empty(0, np.uint8)
            out[i] = f"{grid:02x}" + np.where(place < end, symbol, 0).astype(np.uint8).tobytes().hex()
        return out

    def likeness(self, a: str, b: str) -> float:
        """The share of equal samples among the places that either text reaches."""
        if a == b:
            return 1.0
        ga, gb = int(a[:2], 16), int(b[:2], 16)
        if ga < gb:
            a, b, ga, gb = b, a, gb, ga
        x = np.frombuffer(bytes.fromhex(a[2:]), np.uint8)
        y = np.frombuffer(bytes.fromhex(b[2:]), np.uint8)
        if not len(y):
            return 0.0
        if ga != gb:
            # The shorter's samples at the longer's places; the rest lies past its end.
            place, there = self.sampled(ga), self.sampled(gb)
            full = np.zeros(len(x), dtype=np.uint8)
            by = np.argsort(there)
            spot = np.minimum(np.searchsorted(there[by], place), len(there) - 1)
            hit = there[by][spot] == place
            full[hit] = y[by[spot[hit]]]
            y = full
        either = (x > 0) | (y > 0)
        return float((x[either] == y[either]).mean()) if either.any() else 1.0


_walker: list[Walker] = []


def walker() -> Walker:
    """The walker of this process."""
    if not _walker:
        _walker.append(Walker())
    return _walker[0]


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns and ``fingerprint``; a null text is empty."""
    keep = keep or []
    names = [f"k{i}" for i in range(len(keep))]
    frame = docs.select(*[quoted(c).alias(n) for c, n in zip(keep, names)], quoted(text).alias("t"))
    schema = T.StructType([*frame.select(*names).schema, T.StructField("fingerprint", T.StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", BLOCK_CHARS):
                prints = walker().fingerprints([t or "" for t in part.column("t").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(prints, pa.string())], names=[*names, "fingerprint"])

    out = frame.mapInArrow(scan, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "fingerprint")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text against its edited form and against the next text.

    The next text is that of the next smaller id, the largest after the
    smallest; the edited form has its last half replaced by the next text's
    beginning.  Ids are whole numbers.  Equal ids are ordered by a hash of their texts, and a null id comes after all
    others.  A null text is empty; one row alone is its own next.

    Rows move once, compressed, to parts of the ids' range; the first row of a part also goes to the part before.
    """
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{id_col} is no whole number")
    rows = docs.select(
        quoted(id_col).alias("i"), quoted(id_col).isNull().alias("absent"),
        F.coalesce(F.bitwise_not(quoted(id_col).cast("long")), F.lit((1 << 63) - 1)).alias("r"),
        F.xxhash64(F.coalesce(quoted(text), F.lit(""))).alias("h"), F.coalesce(quoted(text), F.lit("")).alias("t"))
    slim = staged(rows.select("absent", "r", "h", F.octet_length("t").alias("size")), "order")
    count, size = slim.agg(F.count(F.lit(1)), F.sum("size")).first()
    starts = boundaries(slim, "r", min(MAX_PARTS, max(1, int(size or 0) // PART_BYTES)), count)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.searchsorted(np.array(starts, dtype=np.int64), batch.column("r").to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), *(batch.column(c) for c in ("absent", "r", "h"))],
                names=["part", "absent", "r", "h"])

    firsts = slim.select("absent", "r", "h").mapInArrow(number, "part int, absent boolean, r long, h long")
    firsts = sorted(
        (row["part"], (row["f"]["absent"], row["f"]["r"], row["f"]["h"]))
        for row in firsts.groupBy("part").agg(F.min(F.struct("absent", "r", "h")).alias("f")).collect()
    )
    # The first row of each part also ends the part before, the very first row the last part.
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece in slices(batch, "t", BLOCK_CHARS):
                part = np.searchsorted(np.array(starts, dtype=np.int64), piece.column("r").to_numpy(), side="right").tolist()
                keys = list(zip(*(piece.column(c).to_pylist() for c in ("absent", "r", "h"))))
                texts = [packer.compress(t.encode("utf-8", "surrogatepass")) for t in piece.column("t").to_pylist()]
                copies = [k for k, key in enumerate(keys) if key in before]
                take = pa.array([*range(len(keys)), *copies], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part + [before[keys[k]] for k in copies], pa.int32()),
                     pa.array([False] * len(keys) + [True] * len(copies), pa.bool_()),
                     *(piece.column(c).take(take) for c in ("i", "absent", "r", "h")),
                     pa.array(texts + [texts[k] for k in copies], pa.binary())],
                    names=["part", "ghost", "i", "absent", "r", "h", "z"])

    moved = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("ghost", T.BooleanType()), T.StructField("i", kind),
        T.StructField("absent", T.BooleanType()), T.StructField("r", T.LongType()), T.StructField("h", T.LongType()),
        T.StructField("z", T.BinaryType())])
    out = T.StructType([
        T.StructField("i", kind), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, walks = zstandard.ZstdDecompressor(), walker()
        held: list[tuple] = []

        def answer(rows: list[tuple]) -> pa.RecordBatch:
            """All rows but the last, which is only the next of the one before."""
            texts = [r[1] for r in rows]
            changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
            prints = walks.fingerprints(texts)
            after = walks.fingerprints(changed)
            shas = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]
            near = [walks.likeness(a, b) for a, b in zip(prints, after)]
            following = [walks.likeness(a, b) for a, b in zip(prints, prints[1:])]
            columns = [[r[0] for r in rows[:-1]], [len(t) for t in texts[:-1]], shas, prints[:-1], after, near, following]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (id_type[0], pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))],
                names=[f.name for f in out])

        id_type: list[pa.DataType] = []
        size, ended = 0, False
        for batch in batches:
            id_type[:] = [batch.schema.field("i").type]
            for ghost, i, z in zip(*(batch.column(c) for c in ("ghost", "i", "z"))):
                if ended:
                    continue  # repeated rows may end a part more than once
                data = unpacker.decompress(z.as_py()).decode("utf-8", "surrogatepass")
                held.append((i.as_py(), data))
                size += len(data)
                ended = ghost.as_py()
                if ended or size >= BLOCK_CHARS and len(held) > 1:
                    yield answer(held)
                    held, size = held[-1:], len(data)

    done = (
        rows.mapInArrow(deal, moved).repartitionById(len(starts) + 1, F.col("part"))
        .sortWithinPartitions("ghost", "absent", "r", "h").mapInArrow(walk, out)
    )
    return done.withColumnRenamed("i", id_col)


def _bands(prints: DataFrame) -> DataFrame:
    """(band, fp) of each fingerprint, as seen from its own grid length and
    from the next two, so that texts of nearly equal length share one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = walker()
        for batch in batches:
            bands, owners = [], []
            for fp in batch.column("fp").to_pylist():
                own = int(fp[:2], 16)
                values = dict(zip(walks.sampled(own).tolist(), bytes.fromhex(fp[2:])))
                for grid in range(own, min(own + 3, len(walks.grid))) if own else (0,):
                    place = walks.sampled(grid).tolist()
                    sample = [values.get(p, 0) for p in place]
                    for start in range(0, max(1, len(sample) - BAND_SAMPLES + 1), BAND_SAMPLES):
                        part = sample[start : start + BAND_SAMPLES]
                        bands.append(xxhash.xxh64_intdigest(bytes([grid, start, *part]), SEED) - (1 << 63))
                        owners.append(fp)
            yield pa.RecordBatch.from_arrays([pa.array(bands, pa.int64()), pa.array(owners, pa.string())], names=["band", "fp"])

    return prints.select("fp").mapInArrow(cut, "band long, fp string").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", likeness: float = LIKENESS,
                    tile: int = TILE) -> DataFrame:
    """(id_col, fingerprint, component_id): the smallest id reachable over pairs that share a
    band and whose fingerprints are at least ``likeness`` alike.

    Equal fingerprints are one from the start.  A band of more than ``tile``
    different fingerprints is compared in tiles, each pair of tiles by itself.
    """
    marked = staged(fingerprints(docs, text, [id_col]).select(quoted(id_col).alias("id"), "fingerprint"), "prints")
    classes = staged(marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("low")), "classes")
    bands = staged(_bands(classes), "bands")
    sizes = staged(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select("band", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "bands")
    dealt = bands.join(sizes, "band").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    dealt = dealt.select("band", "fp", "tile", other.alias("other")).select(
        "band", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "fp").distinct()

    def compare(table: pa.Table) -> pa.Table:
        walks = walker()
        prints = sorted(table.column("fp").to_pylist())
        pairs = [(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints))
                 if walks.likeness(prints[i], prints[j]) >= likeness]
        i, j = (np.array([p[k] for p in pairs], dtype=np.int64) for k in (0, 1))
        label = forest(i, j, len(prints))
        moved = np.flatnonzero(label != np.arange(len(prints))).tolist()
        return pa.table({"u": pa.array([prints[k] for k in moved], pa.string()),
                         "v": pa.array([prints[label[k]] for k in moved], pa.string())})

    found = dealt.groupBy("band", "a", "b").applyInArrow(compare, "u string, v string")
    comps = staged(components(found), "components")
    joined = classes.join(comps, classes["fp"] == comps["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    moved = staged(joined.join(least, "root").select(F.col("fp").alias("fingerprint"), "component_id"), "classes")
    return marked.join(moved, "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "component_id")
