import random

import pytest
from pyspark.sql import functions as F

from sondar.model import COLUMNS, CONTAINERS, ddl
from sondar.operators.browse import search
from sondar.operators.search_index import SearchIndex, write_index


@pytest.fixture(scope="module")
def catalog(spark):
    rng = random.Random(2)
    parts = ["tide", "buoy", "log", "%_x", "Mast", "ÖL", "a.b", "gauge", "e-mail", "reef"]
    name = lambda: "_".join(rng.choices(parts, k=rng.randrange(1, 4)))
    text = lambda: rng.choice([None, "", " ".join(rng.choices(parts, k=6))])
    boxes = {("shop", rng.choice("xy"), f"{name()}{i}") for i in range(60)}
    containers = [(*k, text(), text()) for k in sorted(boxes)]
    columns = [(*k, f"{name()}{i}", "int", text(), text()) for k in sorted(boxes) for i in range(3)]
    key = "database string, schema_name string, container_name string"
    frames = (
        spark.createDataFrame(containers, f"{key}, description string, native_description string"),
        spark.createDataFrame(columns, f"{key}, column_name string, native_type string, description string, native_description string"))
    return [
        f.select(*[F.col(c) if c in f.columns else F.lit(None).cast(t).alias(c) for c, t in kind.items()])
        for f, kind in zip(frames, (CONTAINERS, COLUMNS))]


@pytest.fixture(scope="module")
def index(catalog, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    write_index(*catalog, path)
    return SearchIndex(spark, path)


@pytest.mark.parametrize("word", ["tide", " BUOY ", "%_x", "a.b", "öl", "e", "y_log", "gauge reef", "nowhere", "", "mast1", "tide_tide"])
def test_hits_equal_those_of_a_scan(catalog, index, word):
    for options in ({}, {"kind": "column", "limit": None}, {"kind": "container", "limit": 3}):
        assert index.search(word, **options).collect() == search(*catalog, word, **options).collect()


def test_postings_are_read_and_pruned(index):
    assert index.candidates("gauge").count() < index.candidates("").count()
    plan = index.candidates("gauge")._jdf.queryExecution().toString()
    assert "postings" in plan and "In(gram, [" in plan
    assert "postings" not in index.candidates("ga")._jdf.queryExecution().toString()


def test_empty_inventory(spark, tmp_path):
    write_index(spark.createDataFrame([], ddl(CONTAINERS)), spark.createDataFrame([], ddl(COLUMNS)), f"{tmp_path}/none")
    assert SearchIndex(spark, f"{tmp_path}/none").search("tide").count() == 0
