import random

import pytest
from pyspark.sql import functions as F

from sondar.operators import profile as p
from sondar.operators import toplists


def brute(values, n=20):
    counts = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    ordered = sorted(counts.items(), key=lambda x: (-x[1], ("None" if x[0] is None else x[0]).encode(), x[0] is None))
    return [(v or "", n_, v is None) for v, n_ in ordered[:n]]


def listed(spark, values, modes, n=20):
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(4)
    (found,) = p.table_profile(df, modes, top_n=n).collect()
    if "distinct_count" in modes:
        assert found.distinct_count == len({v for v in values if v is not None})
    return [(x.value, x["count"], x.is_null) for x in found.top_values]


def made(kind):
    rng = random.Random(kind)
    long = "ä shared beginning of some length "
    if kind == "short":
        return [rng.choice(["", "a", "b", None, "None", "Ö" * 11]) for _ in range(300)]
    if kind == "long":
        return [long * 3 + str(rng.randrange(40)) for _ in range(400)] + [None] * 30
    if kind == "mixed":
        start = "0123456789abcdef"
        texts = [start, start + "xyz", start + "A" * 40, start + "z" * 90, start + "z" * 91, start[:-1], "short"]
        return [rng.choice(texts) for _ in range(200)]
    if kind == "unique":
        return [f"{rng.random():.12f} and more than that" for _ in range(500)]
    # Hundreds of texts that occur once and begin alike for longer than any first look.
    return [long * 20 + f"{i:04d}" for i in range(300)] + ["common one, long enough for a digest"] * 5 + [long * 20]


@pytest.mark.parametrize("kind", ["short", "long", "mixed", "unique", "alike"])
@pytest.mark.parametrize("modes", [["top_values"], ["top_values", "distinct_count"]])
def test_lists_equal_brute_force(spark, kind, modes):
    values = made(kind)
    assert listed(spark, values, modes) == brute(values)
    assert listed(spark, values, modes, n=3) == brute(values, 3)


def test_heavy_hitters_only_where_they_stand_apart(spark):
    # A thousand values a hundred times, and a tail too long for a summary of few keys.
    df = spark.range(40_000).select(
        F.when(F.col("id") % 4 == 0, F.col("id") % 5).otherwise(F.col("id") + 100).cast("string").alias("far"),
        (F.col("id") % 20_000).cast("string").alias("flat"),
        F.when(F.col("id") % 3 > 0, F.lit("x")).alias("few"))
    found = toplists.heavy_hitters(df, {c: c for c in df.columns}, 5, tracked=200)
    assert set(found) == {"far", "few"}
    assert sorted(found["far"].keys) == [(str(i), 2000) for i in range(5)]
    assert found["few"].keys == [(None, 13334), ("x", 26666)] and found["few"].nulls == 13334


def test_documents_are_not_shuffled_whole(spark, monkeypatch):
    text = F.concat(F.repeat(F.lit("long text "), 400), (F.col("id") % 50).cast("string"))
    df = spark.range(3000).select(text.alias("t"))
    seen = []
    original = toplists.unpivoted_counts
    monkeypatch.setattr(toplists, "unpivoted_counts", lambda df, keys: seen.append(df.selectExpr(*[
        f"max(octet_length({k})) as k" for k in keys.values()]).first().k) or original(df, keys))
    (found,) = p.table_profile(df).collect()
    assert found.distinct_count == 50 and len(found.top_values[0].value) > 4000
    # Of 4000 bytes and more a row, a key of at most 48 goes through the shuffle.
    assert seen and max(seen) <= 48
