"""SimHash near-duplicates, filtered by distances to reference fingerprints.

A fingerprint has a bit set where more than half of the text's shingle hashes
have it.  Equal fingerprints are one class from the start.  Different ones are
compared only where they agree on some block of bits, as any two within the
allowed distance must on at least one block of ``distance + 1``; a block value that
too many share is divided again by the bits it has left.  Inside a group, a
table holds every fingerprint's Hamming distance to many reference
fingerprints.  Two of them whose distances to any reference differ by more
than the limit cannot be near each other; the others are verified bit by bit.
A group answers with a spanning forest of its links, never with all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.llm.common import components, fresh, quoted, slices, staged

SHINGLE = 3
DISTANCE = 3
SEED = 42
REFERENCES = 16
GROUP = 2048
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text; null and wordless texts have 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    digest, seed = xxhash.xxh64_intdigest, SEED
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    columns = [words[i:] for i in range(shingle)]
    hashes = np.array([digest(b" ".join(w), seed) for w in zip(*columns)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                 shingle: int = SHINGLE) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed long."""
    keep = keep or []
    frame = docs.select(*[quoted(c).alias(f"k{i}") for i, c in enumerate(keep)], quoted(text).alias("t"))
    names = [f"k{i}" for i in range(len(keep))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                fps = np.array([fingerprint(t, shingle) for t in part.column("t").to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(fps.view(np.int64))], names=[*names, "fp"]
                )

    kept = frame.select(*names)
    schema = kept.schema.add("fp", "long")
    out = frame.mapInArrow(scan, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "fp")


def _blocks(used: int, parts: int) -> list[int]:
    """Masks that add one block of the unused bits to those used."""
    left = [b for b in range(64) if not used >> b & 1]
    cuts = [round(i * len(left) / parts) for i in range(parts + 1)]
    blocks = [left[a:b] for a, b in zip(cuts, cuts[1:])]
    return [used | sum(1 << b for b in block) for block in blocks if block]


def _divide(parts: int):
    """Each row once for every block that its mask (bits known to agree) can
    be widened by, with the wider mask and its bits as the key."""

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            mask = batch.column("mask").to_numpy().view(np.uint64)
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for used in np.unique(mask).tolist():
                if used not in known:
                    known[used] = np.array(_blocks(used, parts), dtype=np.uint64)
                wide, part = known[used], fp[mask == used]
                masks, fps = np.tile(wide, len(part)), np.repeat(part, len(wide))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(masks.view(np.int64)), pa.array((masks & fps).view(np.int64)), pa.array(fps.view(np.int64))],
                    names=["mask", "key", "fp"])

    return divide


def _reference_points(count: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"reference {i}".encode(), SEED) for i in range(count)], dtype=np.uint64)


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest index each of 0..n-1 reaches over the links i-j."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
        if not len(i) and np.array_equal(before, label):
            break
    return label


def linked_pairs(group: np.ndarray, fp: np.ndarray, distance: int, references: int = REFERENCES
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``distance`` among rows of equal group, sorted by group."""
    table = np.bitwise_count(fp[:, None] ^ _reference_points(references)[None, :]).astype(np.int8)
    last = np.searchsorted(group, group, side="right")
    found: list[tuple[np.ndarray, np.ndarray]] = []
    at, step = np.arange(len(fp)), 1
    while True:
        at = at[at + step < last[at]]
        if not len(at):
            break
        i, j = at, at + step
        for column in range(0, references, 4):
            near = np.abs(table[i, column : column + 4] - table[j, column : column + 4]).max(axis=1) <= distance
            i, j = i[near], j[near]
        near = np.bitwise_count(fp[i] ^ fp[j]) <= distance
        if near.any():
            found.append((i[near], j[near]))
        step += 1
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _compare(distance: int, references: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask, key, fp = (np.empty(0, np.int64) for _ in range(3))

        def answer(upto: int) -> pa.RecordBatch:
            change = np.flatnonzero((mask[1:upto] != mask[: upto - 1]) | (key[1:upto] != key[: upto - 1])) + 1
            group = np.zeros(upto, np.int64)
            group[change] = 1
            group = np.cumsum(group)
            part = fp[:upto].view(np.uint64)
            i, j = linked_pairs(group, part, distance, references)
            label = forest(i, j, upto)
            moved = np.flatnonzero(label != np.arange(upto))
            return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[label[moved]])], names=["u", "v"])

        for batch in batches:
            mask, key, fp = (
                np.concatenate([old, batch.column(n).to_numpy()])
                for old, n in ((mask, "mask"), (key, "key"), (fp, "fp"))
            )
            if not len(fp):
                continue
            whole = np.flatnonzero((mask != mask[-1]) | (key != key[-1]))
            upto = int(whole[-1]) + 1 if len(whole) else 0
            if upto:
                yield answer(upto)
                mask, key, fp = mask[upto:], key[upto:], fp[upto:]
        if len(fp):
            yield answer(len(fp))

    return links


def links(fps: DataFrame, distance: int = DISTANCE, group: int = GROUP, references: int = REFERENCES) -> DataFrame:
    """(u, v): links that join the distinct fingerprints of column ``fp`` as all
    pairs within ``distance`` bits would.

    Groups of more than ``group`` fingerprints are divided by further blocks, so
    no group is compared whole unless it is small, and none is cut short.
    """
    rows, out = fps.select(F.lit(0).cast("long").alias("mask"), "fp"), []
    while True:
        rows = rows.mapInArrow(_divide(distance + 1), "mask long, key long, fp long")
        big = staged(
            rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group)
            .select("mask", "key"), "groups")
        if big.isEmpty():
            big = None
        small = rows if big is None else rows.join(big, ["mask", "key"], "left_anti")
        small = small.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
        out.append(small.mapInArrow(_compare(distance, references), "u long, v long"))
        if big is None:
            break
        rows = staged(rows.join(big, ["mask", "key"], "left_semi").select("mask", "fp"), "groups")
    edges = out[0]
    for more in out[1:]:
        edges = edges.unionByName(more)
    return edges


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """(id_col, fp, component_id) for every row.

    ``component_id`` is the smallest id reachable over links of at most
    ``distance`` differing bits, the row itself included.  Null and wordless texts
    have fingerprint 0 and link like any other.  Null ids never win; a component
    of nulls alone has a null.  Repeated rows and ids stay, each with its row.
    """
    marked = staged(fingerprints(docs, text, [id_col], shingle).withColumnRenamed(id_col, "id"), "fingerprints")
    classes = staged(marked.groupBy("fp").agg(F.min("id").alias("low")), "classes")
    comps = staged(components(links(classes, distance)), "components")
    member = comps.join(classes, comps["node"] == classes["fp"]).select("fp", "root", "low")
    lowest = member.groupBy("root").agg(F.min("low").alias("least"))
    moved = staged(member.join(lowest, "root").select("fp", F.col("least").alias("c")).unionByName(
        classes.join(comps, classes["fp"] == comps["node"], "left_anti").select("fp", F.col("low").alias("c"))
    ), "classes")
    return marked.join(moved, "fp").select(F.col("id").alias(id_col), "fp", F.col("c").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` with one of each near-duplicate group: the smallest
    id, then the smallest hash of the text; one of rows equal in both.  Null ids
    come last.  Whole numbers are in their order, other ids in that of their texts."""
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    number, digest, low = (fresh(docs, n) for n in ("_id", "_hash", "_null"))
    key = [quoted(id_col).isNull().alias(low), F.coalesce(quoted(id_col).cast("long" if whole else "string"), F.lit(0 if whole else "")).alias(number),
           F.xxhash64(quoted(text)).alias(digest)]
    keyed = docs.select("*", *key)
    slim = keyed.select(low, number, digest, quoted(text).alias("t"))
    marked = staged(fingerprints(slim, "t", [low, number, digest], shingle), "fingerprints")
    classes = staged(marked.groupBy("fp").agg(F.min(F.struct(low, number, digest)).alias("best")), "classes")
    comps = staged(components(links(classes, distance)), "components")
    joined = classes.join(comps, classes["fp"] == comps["node"], "left")
    best = joined.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best"))
    best = staged(best.select("best.*").distinct(), "kept")
    rank = fresh(docs, "_rank")
    from pyspark.sql import Window

    once = Window.partitionBy(low, number, digest).orderBy(low)
    return (
        keyed.join(best, [low, number, digest])
        .withColumn(rank, F.row_number().over(once))
        .where(F.col(rank) == 1)
        .select(*[quoted(c) for c in docs.columns])
    )
