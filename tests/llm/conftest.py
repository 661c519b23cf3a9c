import pytest
from pyspark.sql import functions as F

from sondar.llm.ship import ship


CLASHING = ["id", "i", "p", "k", "h", "kept", "spans", "score", "y", "n", "_score", "component_id"]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def texts(spark):
    """Documents with nulls, empty and long texts, repeated rows and ids, and extra columns."""
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog", "x", 1.0),
        (2, "The quick brown fox jumps over the lazy dog", "y", None),
        (2, "The quick brown fox jumps over the lazy dog", "y", None),
        (3, None, None, 2.0),
        (4, "", "z", 3.0),
        (None, "a text without an id", "z", 4.0),
        (5, long, "z", 5.0),
        (6, "Zwölf Boxkämpfer jagen Viktor \U0001f98a quer über den Sylter Deich\x00\x1c՘", "z", 6.0),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, T string, fp double").repartition(3)
    # Names that operators use inside or add.
    return frame.withColumns({name: F.lit(name) for name in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, T string, fp double")
    return frame.withColumns({name: F.lit(name) for name in CLASHING})
