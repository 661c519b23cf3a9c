import fnmatch

import pytest
from pyspark.sql import functions as F

from sondar.functions.globs import matches_any

NAMES = ["a", "b", "]", "!", "-", "^", "[", "\\\\", "ab", "a]b", "[]a]b", "z", "&", "x-y", ".", "é"]


@pytest.mark.parametrize(
    "pattern",
    ["[!]a]b", "[]]", "[!]]", "[]a]b", "[a", "[", "[]", "[!]", "[z-a]", "[!z-a]", "[a-]", "[-a]", "[a-c]", "[!a-c]",
     "[^a]", "[&&b]", "[\\\\]", "[[]", "?", "*", "a*", "[.]", "x[-]y"],
)
def test_as_the_shell_reads_them(spark, pattern):
    frame = spark.createDataFrame([(n,) for n in NAMES], "n string")
    got = {r.n for r in frame.where(matches_any(F.col("n"), [pattern])).collect()}
    assert got == {n for n in NAMES if fnmatch.fnmatchcase(n, pattern)}
