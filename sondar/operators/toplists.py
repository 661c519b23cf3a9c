"""The commonest values of columns, without moving long values.

A value of up to ``SHORT`` bytes is counted as itself, a longer one by its first
characters and a 128-bit digest; whole texts are fetched for the winners only.

Where nothing but the list is wanted, heavy hitters come first: one aggregation keeps a
bounded summary of frequent keys for each column (``approx_top_k``), whose error is known.  If it
separates the wanted values from all others, they are counted exactly in one more pass and
no other value is shuffled at all.  Columns that it does not separate are counted by
their keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondar.functions.sql import literal

#: Bytes up to which a value is its own key, and characters that a longer one's key begins with.
SHORT, START = 24, 16
#: Keys that the summary of a column follows, and that are looked at for each value wanted.
TRACKED, ROOM = 10_000, 4


def key_sql(text: str) -> str:
    """What a text is counted by; longer than ``SHORT`` bytes only if it holds a digest."""
    return f"if(octet_length({text}) <= {SHORT}, {text}, concat(left({text}, {START}), md5({text})))"


def unpivoted_counts(df: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """(column_name, value, n) of the named expressions, one per column.

    The shuffle carries a column's position; its name is put back after.
    """
    pairs = ", ".join(f"{slot}, {text}" for slot, text in enumerate(keys.values()))
    names = ", ".join(literal(name) for name in keys)
    return (
        df.selectExpr(f"stack({len(keys)}, {pairs}) as (slot, value)")
        .groupBy("slot", "value")
        .agg(F.expr("count(1) as n"))
        .selectExpr(f"element_at(array({names}), slot + 1) as column_name", "value", "n")
    )


@dataclass
class Listed:
    """What is known of a column: its keys with their counts, best first, the
    number of rows and nulls, and (if counted) of distinct values."""

    keys: list[tuple[str | None, int]] = field(default_factory=list)
    rows: int = 0
    nulls: int = 0
    distinct: int | None = None


def _order(item: tuple[str | None, int]) -> tuple[int, bytes]:
    """Keys by count and by what is known of their text's order."""
    key, n = item
    return -n, ("None" if key is None else key)[:START].encode()


def heavy_hitters(df: DataFrame, texts: Mapping[str, str], n: int, tracked: int = TRACKED) -> dict[str, Listed]:
    """The columns (``texts``: name to text expression) whose ``n`` commonest values a
    bounded summary separates from all others, with exact counts.

    Of a value that is not in the summary at most twice its error can occur, so if the n-th
    value is estimated at over four times the error, none is missed.
    """
    names = list(texts)
    found = df.selectExpr(
        "count(1) as rows",
        *[f"count({text}) as n{i}" for i, text in enumerate(texts.values())],
        *[f"approx_top_k({key_sql(text)}, {tracked}, {tracked}) as k{i}" for i, text in enumerate(texts.values())],
    ).first()
    # The summary's table is the power of two that holds the tracked keys three quarters full.
    size = 1 << (-(-4 * tracked // 3) - 1).bit_length()
    wanted, out = [], {}
    for i, name in enumerate(names):
        rows, known = found["rows"], found[f"n{i}"]
        # The summary counts NULL too, whose number is known anyway.
        error = 3.5 * rows / size
        guesses = sorted(((x["count"], x["item"]) for x in found[f"k{i}"] or () if x["item"] is not None), reverse=True)
        few = sum(count for count, _ in guesses) == known and len(guesses) < tracked // 2
        if not few and (len(guesses) < n or guesses[n - 1][0] <= 4 * error):
            continue
        least = 0 if len(guesses) <= n else guesses[n - 1][0] - 2 * error
        chosen = [key for count, key in guesses if count >= least]
        if len(chosen) > n * ROOM:
            continue
        wanted += [(i, key) for key in chosen]
        out[name] = Listed([(None, rows - known)] if rows > known else [], rows, rows - known)
    if wanted:
        # At most ``n * ROOM`` short keys a column.
        asked = F.broadcast(df.sparkSession.createDataFrame(wanted, "slot int, value string"))
        pairs = ", ".join(f"{i}, {key_sql(text)}" for i, text in enumerate(texts.values()) if names[i] in out)
        met = df.selectExpr(f"stack({len(out)}, {pairs}) as (slot, value)").join(asked, ["slot", "value"])
        for row in met.groupBy("slot", "value").agg(F.expr("count(1) as n")).collect():
            out[names[row["slot"]]].keys.append((row["value"], row["n"]))
    return out


def counted_keys(df: DataFrame, texts: Mapping[str, str], n: int) -> dict[str, Listed]:
    """Every column by the counts of all its keys: exact, one shuffle of short keys."""
    counts = unpivoted_counts(df, {name: key_sql(text) for name, text in texts.items()})
    first = f"left(coalesce(value, 'None'), {START})"
    best = counts.selectExpr(
        "column_name", "value", "n",
        f"row_number() over (partition by column_name order by n desc, {first}, value) as place",
    ).where(f"place <= {n * ROOM}")
    totals = counts.groupBy("column_name").agg(
        F.expr("count(value) as distinct"), F.expr("sum(n) as rows"),
        F.expr("coalesce(sum(if(value is null, n, null)), 0) as nulls"))
    # One job: the counts are shuffled once and read by both.
    both = best.selectExpr("column_name", "value", "n", "place", "cast(null as bigint) as rows", "cast(null as bigint) as nulls").unionAll(
        totals.selectExpr("column_name", "null", "distinct", "0", "rows", "nulls"))
    out = {name: Listed(distinct=0) for name in texts}
    for row in both.collect():
        listed = out[row["column_name"]]
        if row["place"]:
            listed.keys.append((row["value"], row["n"]))
        else:
            listed.distinct, listed.rows, listed.nulls = row["n"], row["rows"], row["nulls"]
    return out


def _first_of_ties(df: DataFrame, text: str, n: int, start: str, wanted: int) -> list[str]:
    """Keys that hold the ``wanted`` smallest of the texts that occur ``n`` times and begin with ``start``.

    Compares longer and longer beginnings until they tell enough texts apart.
    """
    width = START
    while True:
        width *= 16
        rows = (
            df.where(f"startswith({text}, {literal(start)})")
            .selectExpr(f"{key_sql(text)} as key", f"left({text}, {width}) as begins", f"char_length({text}) > {width} as longer")
            .groupBy("key").agg(F.min("begins").alias("begins"), F.expr("count(1) as n"), F.max("longer").alias("longer"))
            .where(F.col("n") == n).orderBy("begins", "key").limit(wanted * ROOM + 1).collect()
        )
        last = rows[min(wanted, len(rows)) - 1]
        if len(rows) <= wanted * ROOM or rows[-1]["begins"] != last["begins"] or not last["longer"]:
            return [r["key"] for r in rows if r["begins"].encode() <= last["begins"].encode()]


def _candidates(df: DataFrame, text: str, listed: Listed, n: int) -> list[tuple[str | None, int]]:
    """The keys among which the first ``n`` values are, few more than ``n``."""
    keys = sorted(listed.keys, key=_order)
    if len(keys) <= n:
        return keys
    border = _order(keys[n - 1])
    if len(keys) >= n * ROOM and _order(keys[-1]) == border:
        # More texts than were looked at share their count and beginning.
        above = [k for k in keys if _order(k) < border]
        tied = _first_of_ties(df, text, -border[0], border[1].decode(), n - len(above))
        return above + [(key, -border[0]) for key in tied]
    return [k for k in keys if _order(k) <= border]


def top_values(df: DataFrame, texts: Mapping[str, str], listed: Mapping[str, Listed], n: int, shown: Mapping[str, str]) -> DataFrame:
    """(column_name, rank, value, count, is_null): commonest values first, ties by value.
    NULL is shown as '' and sorts as the word ``None``.

    ``shown`` renders the counted text, ``value``, of the columns it names.  Only
    here whole long texts are read: those of at most a few keys a column.
    """
    spark = df.sparkSession
    names = list(texts)
    rows = [
        (slot, name, key, count)
        for slot, name in enumerate(names)
        for key, count in _candidates(df, texts[name], listed[name], n)
    ]
    found = spark.createDataFrame(rows, "slot int, column_name string, key string, n bigint")
    long = sorted({slot for slot, _, key, _ in rows if key is not None and len(key.encode()) > SHORT})
    value = F.col("key")
    if long:
        pairs = ", ".join(f"{slot}, {texts[names[slot]]}" for slot in long)
        asked = F.broadcast(found.where(f"octet_length(key) > {SHORT}").select("slot", "key"))
        whole = (
            df.selectExpr(f"stack({len(long)}, {pairs}) as (slot, text)").where(f"octet_length(text) > {SHORT}")
            .selectExpr("slot", "text", f"{key_sql('text')} as key").join(asked, ["slot", "key"])
            .groupBy("slot", "key").agg(F.min("text").alias("text"))
        )
        found = found.join(whole, ["slot", "key"], "left")
        value = F.coalesce("text", "key")
    found = found.select("column_name", value.alias("value"), "n")
    cases = " ".join(f"when {literal(name)} then {text}" for name, text in shown.items())
    if cases:
        found = found.selectExpr("column_name", f"case column_name {cases} else value end as value", "n")
    return found.selectExpr(
        "column_name",
        "row_number() over (partition by column_name order by n desc, coalesce(value, 'None'), value is null) as rank",
        "coalesce(value, '') as value", "n as count", "value is null as is_null",
    ).where(f"rank <= {int(n)}")


def summaries(df: DataFrame, listed: Mapping[str, Listed]) -> DataFrame:
    """(column_name, distinct_count, rows, nulls) of the columns looked at."""
    rows: Sequence[tuple] = [(name, x.distinct, x.rows, x.nulls) for name, x in listed.items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, distinct_count bigint, rows bigint, nulls bigint")
