import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sondar.operators.profile import table_profile
from sondar.plans import folders


def rows(n, start=0):
    return [
        (i, float("nan") if i % 11 == 0 else -0.0 if i % 7 == 0 else i / 3, Decimal(i) / 4, f"name {i % 9}" if i % 5 else None,
         dt.date(2024, 1, 1) + dt.timedelta(days=i % 40), i % 2 == 0, [i])
        for i in range(start, start + n)
    ]


KIND = "id bigint, x double, d decimal(12,2), name string, day date, even boolean, list array<int>"


def written(spark, path, n, start=0):
    spark.createDataFrame(rows(n, start), KIND).write.mode("overwrite").parquet(path)


def same(refreshed, dataset, spark):
    df = spark.read.parquet(dataset)
    want = {r.column_name: r for r in table_profile(df, ["null_ratio", "min_max"]).collect()}
    exact = {r.column_name: r.distinct_count for r in table_profile(df, ["distinct_count"]).collect()}
    got = {r.column_name: r for r in refreshed.profile.collect()}
    assert set(got) == set(want)
    for name, r in got.items():
        assert r.null_ratio == want[name].null_ratio and r.ordinal == want[name].ordinal, name
        if name != "list":
            assert (r.min_value, r.max_value) == (want[name].min_value, want[name].max_value), name
            assert abs(r.distinct_count - exact[name]) <= 0.03 * exact[name], name
        assert r.approximate


def test_only_new_and_changed_folders_are_read(spark, tmp_path):
    dataset, store = f"{tmp_path}/lake", folders.FolderStatistics(spark, f"{tmp_path}/kept")
    written(spark, f"{dataset}/day=1", 50)
    written(spark, f"{dataset}/day=2", 70, 40)
    first = store.refresh(dataset)
    assert (first.read, first.kept, first.dropped) == (2, 0, 0)
    same(first, dataset, spark)
    written(spark, f"{dataset}/day=a b", 30, 500)
    second = store.refresh(dataset)
    assert (second.read, second.kept) == (1, 2)
    same(second, dataset, spark)
    version = store.latest()
    assert store.refresh(dataset).read == 0 and store.latest() == version
    # A rewritten folder is read again, one that is gone is forgotten.
    written(spark, f"{dataset}/day=1", 20, 900)
    (tmp_path / "lake" / "day=2").rename(tmp_path / "elsewhere")
    third = store.refresh(dataset)
    assert (third.read, third.kept, third.dropped) == (1, 1, 1)
    same(third, dataset, spark)


def test_another_schema_reads_everything_again(spark, tmp_path):
    dataset, store = f"{tmp_path}/lake", folders.FolderStatistics(spark, f"{tmp_path}/kept")
    written(spark, f"{dataset}/day=1", 5)
    written(spark, f"{dataset}/day=2", 5)
    store.refresh(dataset)
    chosen = store.refresh(dataset, columns=["id", "name"])
    assert chosen.read == 2 and [r.column_name for r in chosen.profile.collect()] == ["id", "name"]


def test_an_empty_folder_says_nothing(spark, tmp_path):
    dataset, store = f"{tmp_path}/lake", folders.FolderStatistics(spark, f"{tmp_path}/kept")
    spark.createDataFrame([], KIND).write.parquet(f"{dataset}/day=1")
    found = store.refresh(dataset).profile.where(F.col("column_name") == "id").first()
    assert found.null_ratio is None and found.min_value is None and found.distinct_count == 0
