import datetime as dt

from pyspark.sql import functions as F

from sondar.operators.profile import light_profile
from sondar.sources import footers

KIND = "n bigint, small smallint, day date, flag boolean, x double, name string, at timestamp, list array<int>"
ROWS = [
    (i, i % 5 if i % 3 else None, dt.date(2024, 1, 1) + dt.timedelta(days=i), i % 2 == 0, float("nan") if i == 3 else -i / 2,
     f"name {i}" if i % 4 else None, dt.datetime(2024, 1, 1, i % 24), [i])
    for i in range(50)
]


def test_what_types_allow_is_answered_from_footers(spark, tmp_path):
    spark.createDataFrame(ROWS, KIND).repartition(3).write.parquet(f"{tmp_path}/t/part=x")
    other = footers.beside(spark)
    other.conf.set("spark.sql.maxMetadataStringLength", "10000")
    ranged, counted = ["n", "small", "day", "flag"], ["n", "small", "day", "flag", "x", "name", "at"]
    plan = footers.footer_frame(other, f"{tmp_path}/t", ranged, counted)._jdf.queryExecution().toString()
    pushed = plan.partition("PushedAggregation: [")[2].partition("]")[0]
    assert "COUNT(*)" in pushed and "MIN(n)" in pushed and "MAX(day)" in pushed and "COUNT(name)" in pushed
    # The caller's session reads as before.
    assert spark.conf.get("spark.sql.sources.useV1SourceList") and "x" not in pushed.replace("MAX", "").replace("COUNT(x)", "")

    df = spark.read.parquet(f"{tmp_path}/t")
    want = {r.column_name: r for r in light_profile(df, df.columns, df.columns).collect()}
    got = {r.column_name: r for r in footers.footer_profile(spark, f"{tmp_path}/t").collect()}
    assert set(got) == {*want} and got["part"].min_value == "x"
    for name, r in got.items():
        assert (r.ordinal, r.null_ratio, r.min_value, r.max_value) == (
            want[name].ordinal, want[name].null_ratio, want[name].min_value, want[name].max_value), name
        assert r.from_footers == (name in ranged)
    (count,) = footers.footer_counts(spark, {"t": f"{tmp_path}/t"}).collect()
    assert tuple(count) == ("t", 50)


def test_empty_and_without_statistics(spark, tmp_path):
    df = spark.createDataFrame(ROWS, KIND)
    df.limit(0).write.parquet(f"{tmp_path}/empty")
    found = footers.footer_profile(spark, f"{tmp_path}/empty").where(F.col("column_name") == "n").first()
    assert found.null_ratio is None and found.min_value is None
    df.write.option("parquet.column.statistics.enabled", "false").parquet(f"{tmp_path}/bare")
    bare = {r.column_name: r for r in footers.footer_profile(spark, f"{tmp_path}/bare").collect()}
    assert (bare["n"].min_value, bare["n"].max_value, bare["small"].null_ratio) == ("0", "49", 17 / 50)
