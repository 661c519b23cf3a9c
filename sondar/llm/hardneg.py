"""Hard negatives by exact inner products of quantised vectors, Kronecker-packed.

Components become whole numbers.  In a block of candidates, the biased components of one
dimension are packed into the fields of one wide integer; an anchor multiplies each
such integer once by its own biased component, and the sum of these products holds the
inner products of all candidates, one in each field.  Fields are wide enough for the
largest sum in the block, so scores are exact.

Anchors meet all rows in blocks of bounded size: first the rows of their label, for
their positives, then the others, for the negatives.  A block hands on a few rows an anchor.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondar.llm.common import quoted, staged

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES, NEGATIVES = 5, 3
#: A negative scores from ``LOW`` to ``HIGH`` hundredths of the positive's score.
LOW, HIGH = 50, 95
ANCHOR_BLOCK, CANDIDATE_BLOCK = 4096, 4096
_LONG = np.iinfo(np.int64)


class Packed:
    """The components of a block of vectors in wide integers, one for each dimension."""

    def __init__(self, vectors: np.ndarray, largest: int):
        """``vectors`` are whole numbers, a row each; no anchor's component exceeds ``largest`` in size."""
        self.rows, self.dim = vectors.shape
        self.bias = max(-int(vectors.min(initial=0)), 0)
        self.largest = largest
        biased = vectors.astype(object) + self.bias if self.bias + int(vectors.max(initial=0)) > _LONG.max else vectors + self.bias
        top = int(biased.max(initial=0)) * 2 * largest * max(self.dim, 1)
        self.width = max(1, (top.bit_length() + 7) // 8)
        # What the anchors' bias adds to each field, and the candidates' to the whole.
        exact = biased.astype(object) if self.width > 7 else biased
        self.sums = exact.sum(axis=1) * largest if self.dim else np.zeros(self.rows, dtype=np.int64)
        self.wide = [int.from_bytes(self._fields(biased[:, k]), "little") for k in range(self.dim)]

    def _fields(self, column: np.ndarray) -> bytes:
        if column.dtype == object or self.width < 8:
            if column.dtype == object:
                return b"".join(int(x).to_bytes(self.width, "little") for x in column)
            return np.ascontiguousarray(column.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : self.width]).tobytes()
        spread = np.zeros((len(column), self.width), dtype=np.uint8)
        spread[:, :8] = column.astype("<u8").view(np.uint8).reshape(-1, 8)
        return spread.tobytes()

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner product of the anchor with every row; a score beyond 64 bits
        counts as the largest or smallest long."""
        total = 0
        for a, wide in zip(anchor, self.wide):
            total += (a + self.largest) * wide
        raw = total.to_bytes(self.rows * self.width, "little")
        less = self.bias * sum(anchor)
        if self.width > 7:
            fields = [int.from_bytes(raw[i : i + self.width], "little") for i in range(0, len(raw), self.width)]
            exact = [int(f) - int(s) - less for f, s in zip(fields, self.sums)]
            return np.array([min(max(x, int(_LONG.min) + 1), int(_LONG.max)) for x in exact], dtype=np.int64)
        spread = np.zeros((self.rows, 8), dtype=np.uint8)
        spread[:, : self.width] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, self.width)
        return spread.view("<i8").ravel() - self.sums - less


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` highest scores, highest first; of equal ones the earlier."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        places = np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((places, -scores[places]))]


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, len(flat) // table.num_rows).astype(np.int64)


def _blocks(table: pa.Table) -> tuple[pa.Table, pa.Table, Packed, np.ndarray] | None:
    """Anchors, candidates by id, the candidates packed, and the anchors' components."""
    role = table.column("role").to_numpy()
    anchors, candidates = (table.filter(pa.array(role == r)) for r in (0, 1))
    if not anchors.num_rows or not candidates.num_rows:
        return None
    candidates = candidates.sort_by("id")
    own = _matrix(anchors)
    largest = max(int(own.max(initial=0)), -int(own.min(initial=0)))
    return anchors, candidates, Packed(_matrix(candidates), largest), own


def _result(names: list[str], columns: list[list[np.ndarray]]) -> pa.Table:
    return pa.table({n: pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for n, c in zip(names, columns)})


def _positives(k: int) -> Callable[[pa.Table], pa.Table]:
    def nearest(table: pa.Table) -> pa.Table:
        """The best rows of a block for each anchor of the same label."""
        names, out = ["anchor", "id", "score"], [[], [], []]
        if (blocks := _blocks(table)) is not None:
            anchors, candidates, packed, own = blocks
            ids, keys, number = candidates.column("id").to_numpy(), candidates.column("key").to_numpy(), anchors.column("key").to_numpy()
            its = anchors.column("id").to_numpy()
            for key, vec_id, vector in zip(number.tolist(), its.tolist(), own.tolist()):
                others = np.flatnonzero((keys != key) & (ids != vec_id))
                scores = packed.scores(vector)[others]
                places = best(scores, k)
                for column, values in zip(out, (np.full(len(places), key), ids[others][places], scores[places])):
                    column.append(values)
        return _result(names, out)

    return nearest


def _negatives(k: int, low: int, high: int) -> Callable[[pa.Table], pa.Table]:
    def hardest(table: pa.Table) -> pa.Table:
        """For each anchor and each of its positives' scores, the best rows of a
        block that have another label and score within the bounds."""
        names, out = ["anchor", "positive_score", "id", "score"], [[], [], [], []]
        if (blocks := _blocks(table)) is not None:
            anchors, candidates, packed, own = blocks
            ids, number = candidates.column("id").to_numpy(), anchors.column("key").to_numpy()
            labels = pa.concat_tables([anchors.select(["label"]), candidates.select(["label"])]).column("label").combine_chunks()
            codes = labels.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            mine, theirs = codes[: len(number)], codes[len(number) :]
            wanted = anchors.column("wanted").to_pylist()
            for key, label, targets, vector in zip(number.tolist(), mine, wanted, own.tolist()):
                scores = packed.scores(vector)
                others = np.flatnonzero(theirs != label)
                scores = scores[others]
                for target in sorted(set(targets)):
                    # Whole numbers of any size, so that the bounds are exact.
                    least, most = -(-low * target // 100), high * target // 100
                    inside = np.flatnonzero((scores >= least) & (scores <= most))
                    places = inside[best(scores[inside], k)]
                    for column, values in zip(out, (np.full(len(places), key), np.full(len(places), target), ids[others][places], scores[places])):
                        column.append(values)
        return _result(names, out)

    return hardest


def _ranked(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * component) for every component, as longs."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))).cast("long"))


def sound(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def mine(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
         anchors: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, scale: int = SCALE,
         anchor_block: int = ANCHOR_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` says which rows ask (by default those whose id is divisible by 50).
    An anchor's positives are the first ``positives`` other rows of its label, by
    score and then by smaller id; for each of them its first ``negatives`` rows of another
    label with ``low * positive_score <= 100 * score <= high * positive_score`` are returned.

    Rows with a null id or label, a null vector, or a null or non-finite component take no
    part.  Vectors are compared only with vectors as long; an empty one scores 0.
    Equal rows count once; of different rows with one id each is a row, but none meets
    its own id as a positive.  Components beyond 64 bits after scaling count as the largest or smallest
    long, and so do such scores.  An empty table gives no rows; other columns are left out.

    Every anchor meets every row once, in blocks of ``anchor_block`` by
    ``candidate_block`` rows; a label of any size is spread over blocks.
    """
    e = quoted(vector)
    rows = vectors.select(
        quoted(id_col).cast("long").alias("id"), (quoted(label) if isinstance(label, str) else label).alias("label"),
        e.alias("e"), (anchors if anchors is not None else quoted(id_col) % ANCHOR_EVERY == 0).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & sound(F.col("e")))
    rows = rows.select("id", "label", F.coalesce("asks", F.lit(False)).alias("asks"), quantised(F.col("e"), scale).alias("q"))
    rows = rows.dropDuplicates(["id", "label", "q"]).select(
        F.xxhash64("id", "label", "q").alias("key"), "id", "label", F.size("q").alias("dim"), "asks", "q")
    rows = staged(rows, "quantised")
    sizes = staged(
        rows.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asking")), "sizes")

    def parts(n: Column, block: int) -> Column:
        return F.greatest(F.ceil(n / block), F.lit(1)).cast("int")

    def place(n: Column, salt: str) -> Column:
        return F.pmod(F.xxhash64("key", F.lit(salt)), n).cast("int")

    def met(left: DataFrame, right: DataFrame, by: list[str], extra: list[str]) -> DataFrame:
        """Every block of anchors beside every block of candidates, under ``by``."""
        own = [*dict.fromkeys([*by, "label", "key", "id", "q"])]
        a = left.select(*own, *extra, place(F.col("na"), "a").alias("a"),
                        F.explode(F.sequence(F.lit(0), F.col("nc") - 1)).alias("c"), F.lit(0).alias("role"))
        c = right.select(*own, *[F.lit(None).cast(left.schema[x].dataType).alias(x) for x in extra],
                         F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("a"), place(F.col("nc"), "c").alias("c"), F.lit(1).alias("role"))
        # The groups' key has names of its own, so that the label stays a column.
        return a.unionByName(c).groupBy(*[F.col(b).alias(f"g{i}") for i, b in enumerate([*by, "a", "c"])])

    asked = sizes.where("asking > 0").select(
        "label", "dim", parts(F.col("asking"), anchor_block).alias("na"), parts(F.col("n"), candidate_block).alias("nc"))
    same = rows.join(asked, ["label", "dim"])
    near = met(same.where("asks"), same, ["label", "dim"], []).applyInArrow(
        _positives(positives), "anchor long, id long, score long")
    near = staged(_ranked(near, ["anchor"], positives).select(
        "anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    wanted = near.groupBy("anchor").agg(F.collect_set("positive_score").alias("wanted"))
    total = sizes.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("asking").alias("asking")).where("asking > 0").select(
        "dim", parts(F.col("asking"), anchor_block).alias("na"), parts(F.col("n"), candidate_block).alias("nc"))
    every = rows.join(total, "dim")
    asking = every.where("asks").join(wanted, F.col("key") == F.col("anchor"))
    hard = met(asking, every, ["dim"], ["wanted"]).applyInArrow(
        _negatives(negatives, low, high), "anchor long, positive_score long, id long, score long")
    hard = _ranked(hard, ["anchor", "positive_score"], negatives)
    names = rows.where("asks").select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))
    return near.join(hard, ["anchor", "positive_score"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def relabelled(label: str = "label", id_col: str = "vec_id", every: int = 7, labels: int = 10) -> Column:
    """The label, made wrong where the id is divisible by ``every``."""
    return F.when(quoted(id_col) % every == 0, (quoted(label) + 1) % labels).otherwise(quoted(label))
