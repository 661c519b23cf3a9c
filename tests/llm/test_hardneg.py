import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sondar.llm import hardneg


@pytest.mark.parametrize("most", [0, 1, 150, 10**6, 10**15, 2**62])
def test_packed_products_are_exact(most):
    rng = np.random.default_rng(most % 1000)
    rows, anchor = rng.integers(-most, most + 1, (40, 7)), rng.integers(-most, most + 1, 7)
    got = hardneg.Packed(rows, int(np.abs(anchor).max())).scores(anchor.tolist())
    want = [sum(a * b for a, b in zip(anchor.tolist(), row)) for row in rows.tolist()]
    assert got.tolist() == [min(max(x, -(2**63) + 1), 2**63 - 1) for x in want]


def test_best_takes_the_earlier_of_ties():
    scores = np.array([3, 5, 5, 1, 5, 3])
    assert hardneg.best(scores, 2).tolist() == [1, 2]
    assert hardneg.best(scores, 4).tolist() == [1, 2, 4, 0]
    assert hardneg.best(scores, 9).tolist() == [1, 2, 4, 0, 5, 3] and not len(hardneg.best(scores[:0], 3))


def brute(rows, positives=5, negatives=3):
    good = []
    for i, l, v in dict.fromkeys((i, l, None if v is None else tuple(v)) for i, l, v in rows):
        if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, l, [math.floor(256 * x) for x in v]))
    out = []
    for i, l, v in good:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in good if len(w) == len(v))
        for p, j in [(-s, j) for s, j, m in scored if m == l and j != i][:positives]:
            hits = [(-s, k) for s, k, m in scored if m != l and 50 * p <= -100 * s <= 95 * p][:negatives]
            out += [(i, j, n, k, p, s) for n, (s, k) in enumerate(hits, 1)]
    return sorted(out)


def made():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=8)
    rows = [(i, int(i % 3), (centre + rng.normal(size=8)).tolist()) for i in range(300)]
    # One vector many times, equal rows, and rows that take no part.
    rows += [(1000 + i, 1, centre.tolist()) for i in range(120)] + rows[100:103]
    rows += [(2000, None, centre.tolist()), (2050, 0, None), (2100, 0, [float("nan")] * 8), (2150, 0, [None] * 8), (2200, 1, []),
             (2250, 2, centre[:4].tolist()), (2251, 2, centre[:4].tolist()), (2252, 1, (centre[:4] * 0.8).tolist()), (None, 1, centre.tolist())]
    return rows


@pytest.mark.parametrize("blocks", [(4096, 4096), (2, 37)])
def test_matches_brute_force(spark, blocks):
    rows = made()
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    frame = frame.withColumns({c: F.lit("x") for c in ("q", "key", "anchor", "score", "a", "c", "role")})
    got = hardneg.mine(frame, anchor_block=blocks[0], candidate_block=blocks[1]).collect()
    assert sorted(map(tuple, got)) == brute(rows) and len(got) > 40


def test_edges(spark):
    schema = "vec_id long, label int, embedding array<double>"
    assert hardneg.mine(spark.createDataFrame([], schema)).count() == 0
    assert hardneg.mine(spark.createDataFrame([(50, 1, [1.0])], schema)).count() == 0
    huge = [(50, 1, [1e300, 1.0]), (1, 1, [1e300, 1.0]), (2, 2, [1.0, 1.0])]
    assert hardneg.mine(spark.createDataFrame(huge, schema)).count() == 0
    own = hardneg.mine(spark.createDataFrame(made(), schema), anchors=F.col("vec_id") < 3, low=0, high=100).collect()
    assert {r.anchor_id for r in own} == {0, 1, 2} and all(r.negative_score <= r.positive_score for r in own)
