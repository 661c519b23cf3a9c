"""Statistics about the columns of a table.

A table is profiled in passes over disjoint sets of columns, whatever its width:

* ranges and null ratios: one aggregation over all such columns, map-side
  combined to one row per task;
* value counts: the categorical columns unpivoted to (column, key) and
  counted, map-side combined before the one shuffle, so a value that fills a
  third of the table costs one row per task; long values are digests there, and
  whole texts are read again for the few that are shown (``toplists``);
* columns whose values are only told apart are counted the same way and are not ranked.

Exact distinct counts come out of the value counts. Several ``count_distinct``
in one aggregation would multiply every row by the number of columns instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.functions.sql import ident, literal
from sondar.functions.text import value_sql
from sondar.functions.types import modes_for
from sondar.model import (
    ALL_MODES,
    DISTINCT_COUNT,
    MIN_MAX,
    NULL_RATIO,
    TOP_N,
    TOP_VALUE,
    TOP_VALUES,
    UnknownColumn,
)
from sondar.operators import toplists
from sondar.operators.toplists import unpivoted_counts

#: Columns that are profiled in one plan; a wider table is cut into blocks of as many.
BLOCK = 150

_RANKS = "array<struct<rank:int,value:string,count:bigint,is_null:boolean>>"


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise UnknownColumn(", ".join(missing))


def has_range(dtype: T.DataType) -> bool:
    """Whether min and max apply; a map, inside another type too, has no order."""
    if isinstance(dtype, T.ArrayType):
        return has_range(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(has_range(field.dataType) for field in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType, T.BinaryType))


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in df.schema.fields}


# Types counted under Spark's own text and rendered after, once per distinct
# value instead of once per row.
_RENDER_LATER = (
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
    T.DateType,
    T.TimestampNTZType,
)
# At most eight bytes, and hashed as such.
_EIGHT_BYTES = (
    T.IntegralType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def _counting_sql(name: str, dtype: T.DataType) -> str:
    """The text a value is counted under; -0.0 counts as 0.0."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"cast(cast({ident(name)} as double) + 0.0d as string)"
    if isinstance(dtype, _RENDER_LATER):
        return f"cast({ident(name)} as string)"
    return value_sql(ident(name), dtype)


def _rendered_sql(dtype: T.DataType) -> str:
    """``value``, counted as above, as it is shown."""
    if isinstance(dtype, T.FloatType):
        dtype = T.DoubleType()
    return value_sql(f"try_cast(value as {dtype.simpleString()})", dtype)


# ---- null ratio and range ----


def light_profile(
    df: DataFrame,
    ranged: Sequence[str],
    counted: Sequence[str],
    approximate: Sequence[str] = (),
    rsd: float = 0.05,
) -> DataFrame:
    """One row per column with its null ratio (if in ``counted``), min and max
    (``ranged``) and approximate distinct count (``approximate``).

    Min and max are taken on the column's own type and rendered after, so
    numbers do not compare as text. An empty table gives NULL throughout.
    """
    aggregates, rows = ["count(1) as rows"], []
    for index, field in enumerate(df.schema.fields):
        name, dtype, ref = field.name, field.dataType, ident(field.name)
        ratio = distinct = low = high = low_float = high_float = "null"
        if name in counted:
            aggregates.append(f"count({ref}) as n{index}")
            ratio = f"(rows - n{index}) / nullif(rows, 0)"
        if name in ranged and has_range(dtype):
            aggregates += [f"min({ref}) as lo{index}", f"max({ref}) as hi{index}"]
            if isinstance(dtype, (T.FloatType, T.DoubleType)):
                # Adding zero turns -0.0 into 0.0, whichever of them was met.
                low_float, high_float = f"lo{index} + 0.0d", f"hi{index} + 0.0d"
            else:
                low = value_sql(f"lo{index}", dtype)
                high = value_sql(f"hi{index}", dtype)
        if name in approximate:
            aggregates.append(f"approx_count_distinct({ref}, {rsd}) as d{index}")
            distinct = f"d{index}"
        rows.append(
            f"named_struct('column_name', {literal(name)}, 'ordinal', {index + 1}, "
            f"'native_type', {literal(dtype.simpleString())}, "
            f"'null_ratio', cast({ratio} as double), "
            f"'low', cast({low} as string), 'high', cast({high} as string), "
            f"'low_float', cast({low_float} as double), "
            f"'high_float', cast({high_float} as double), "
            f"'approx_distinct', cast({distinct} as bigint))"
        )
    if len(aggregates) > 1:
        totals = df.selectExpr(*aggregates)
    else:  # nothing asked of the data, so nothing is read
        totals = df.sparkSession.range(1)
    # Floats are rendered once, after the columns have become rows.
    double = T.DoubleType()
    return totals.selectExpr(f"inline(array({', '.join(rows)}))").selectExpr(
        "column_name",
        "ordinal",
        "native_type",
        "null_ratio",
        f"coalesce(low, {value_sql('low_float', double)}) as min_value",
        f"coalesce(high, {value_sql('high_float', double)}) as max_value",
        "approx_distinct",
    )


# ---- value counts ----


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n): how often each value occurs; NULL is a value."""
    require_columns(df, columns)
    types = _types(df)
    shown: dict[str, list[str]] = {}
    for name in columns:
        if isinstance(types[name], _RENDER_LATER):
            shown.setdefault(_rendered_sql(types[name]), []).append(literal(name))
    counts = unpivoted_counts(df, {c: _counting_sql(c, types[c]) for c in columns})
    if not shown:
        return counts
    cases = " ".join(
        f"when column_name in ({', '.join(names)}) then {text}"
        for text, names in shown.items()
    )
    return counts.selectExpr("column_name", f"case {cases} else value end as value", "n")


def count_summary(counts: DataFrame) -> DataFrame:
    """Rows, nulls and distinct non-null values per column of a value count."""
    return counts.groupBy("column_name").agg(
        F.expr("count(value) as distinct_count"),
        F.expr("sum(n) as rows"),
        F.expr("coalesce(sum(if(value is null, n, null)), 0) as nulls"),
    )


def _number_sql(name: str, dtype: T.DataType) -> str | None:
    """The value as a whole number, one to one, where its type allows."""
    if isinstance(dtype, T.DateType):
        return f"cast(unix_date({ident(name)}) as bigint)"
    return f"cast({ident(name)} as bigint)" if isinstance(dtype, T.IntegralType) else None


#: Bytes of a bitmap of one bucket, and of a value in a shuffle.
_BITMAP, _VALUE = 4096, 24


def dense_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those whose bitmaps are smaller than their values, task by task: few of a
    task's buckets of 32 768 neighbouring numbers hold few values.

    Both are estimated in one aggregation, so that keys scattered over a wide range, or
    over all tasks, are not given a bitmap for every few values.
    """
    types = _types(df)
    numbers = {c: n for c in columns if (n := _number_sql(c, types[c])) is not None}
    if not numbers:
        return []
    found = df.selectExpr("spark_partition_id() as task", *[f"{n} as x{i}" for i, n in enumerate(numbers.values())]).selectExpr(
        *[f"approx_count_distinct(if(x{i} is null, null, struct(task, x{i}))) as n{i}" for i in range(len(numbers))],
        *[f"approx_count_distinct(if(x{i} is null, null, struct(task, bitmap_bucket_number(x{i})))) as b{i}" for i in range(len(numbers))],
    ).first()
    return [c for i, c in enumerate(numbers) if found[f"b{i}"] * _BITMAP <= found[f"n{i}"] * _VALUE]


def bitmap_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct counts (with rows and nulls) of whole numbers and dates by bitmaps: a task
    sends a row for each occupied bucket of 32 768 numbers instead of one for each value."""
    require_columns(df, columns)
    types = _types(df)
    numbers = [_number_sql(c, types[c]) for c in columns]
    if None in numbers:
        raise TypeError(f"not a whole number or date: {columns[numbers.index(None)]}")
    pairs = ", ".join(f"{slot}, {number}" for slot, number in enumerate(numbers))
    names = ", ".join(literal(name) for name in columns)
    buckets = (
        df.selectExpr(f"stack({len(columns)}, {pairs}) as (slot, value)")
        .groupBy("slot", F.expr("bitmap_bucket_number(value) as bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(value)) as bits"), F.expr("count(1) as n"))
    )
    return buckets.groupBy("slot").agg(
        F.expr("coalesce(sum(if(bucket is null, 0, bitmap_count(bits))), 0) as distinct_count"),
        F.expr("sum(n) as rows"),
        F.expr("coalesce(sum(if(bucket is null, n, 0)), 0) as nulls"),
    ).selectExpr(f"element_at(array({names}), slot + 1) as column_name", "distinct_count", "rows", "nulls")


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct counts (with rows and nulls) where no value is shown.

    Whole numbers and dates that lie close together are counted by bitmaps, which a
    first look at the call decides.  Other values that fit eight bytes are told apart by their xxhash64, which maps
    eight bytes one to one; decimals by themselves; all others by the SHA-256 of
    their text, so that documents are not moved just to be told apart.
    """
    require_columns(df, columns)
    types = _types(df)
    dense = dense_columns(df, columns)
    fixed, texts = {}, {}
    for name in columns:
        dtype, ref = types[name], ident(name)
        if name in dense:
            continue
        if isinstance(dtype, _EIGHT_BYTES):
            if isinstance(dtype, (T.FloatType, T.DoubleType)):
                ref = f"cast({ref} as double) + 0.0d"
            fixed[name] = f"if({ref} is null, null, xxhash64({ref}))"
            continue
        text = _counting_sql(name, dtype)
        if not isinstance(dtype, T.DecimalType):
            text = f"sha2({text}, 256)"
        texts[name] = text
    parts = [
        count_summary(unpivoted_counts(df, keys)) for keys in (fixed, texts) if keys
    ]
    if dense:
        parts.append(bitmap_counts(df, dense))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


# ---- whole table ----


def choose_modes(
    df: DataFrame, modes: Sequence[str] | Mapping[str, Sequence[str]] | None
) -> dict[str, tuple[str, ...]]:
    """Modes per column: by type where None, the same for all where a list, and
    by name where a mapping. An empty list gathers nothing."""
    if modes is None:
        return {f.name: modes_for(f.dataType) for f in df.schema.fields}
    if isinstance(modes, Mapping):
        require_columns(df, modes)
        chosen = {name: tuple(modes.get(name, ())) for name in df.columns}
    else:
        chosen = {name: tuple(modes) for name in df.columns}
    unknown = {mode for picked in chosen.values() for mode in picked} - set(ALL_MODES)
    if unknown:
        raise ValueError(f"unknown profile modes: {sorted(unknown)}")
    return chosen


def _by_blocks(df: DataFrame, chosen: Mapping[str, Sequence[str]], **options: object) -> DataFrame:
    """The profile of a wide table, put together from blocks of its columns.

    Each block is a plan of its own over its own columns, so that none is too large to be
    compiled; a columnar source is still read once.
    """
    blocks = [df.columns[i : i + BLOCK] for i in range(0, len(df.columns), BLOCK)]

    def one(names: list[str]) -> DataFrame:
        return table_profile(df.selectExpr(*map(ident, names)), {c: chosen[c] for c in names}, **options)

    # What runs at the call runs side by side.
    with ThreadPoolExecutor(max_workers=4) as pool:
        parts = list(pool.map(one, blocks))
    out = None
    for i, part in enumerate(parts):
        part = part.withColumn("ordinal", F.col("ordinal") + i * BLOCK)
        out = part if out is None else out.unionAll(part)
    return out


def table_profile(
    df: DataFrame,
    modes: Sequence[str] | Mapping[str, Sequence[str]] | None = None,
    *,
    top_n: int = TOP_N,
    max_distinct: int | None = None,
    approximate: bool = False,
    rsd: float = 0.05,
) -> DataFrame:
    """One row per column: null ratio, range, distinct count, commonest values.

    With ``modes=None`` every column gets what its type warrants. ``max_distinct``
    leaves the list of commonest values out where a column has more values than
    that. ``approximate=True`` replaces the exact distinct count by a sketch and
    flags it. ``modes`` names what was gathered for each column.

    Listing values runs its counting at the call; the rest waits for an action.
    """
    chosen = choose_modes(df, modes)
    if len(df.columns) > BLOCK:
        return _by_blocks(df, chosen, top_n=top_n, max_distinct=max_distinct, approximate=approximate, rsd=rsd)

    def having(mode: str) -> list[str]:
        return [name for name in df.columns if mode in chosen[name]]

    ranged, listed, distinct = having(MIN_MAX), having(TOP_VALUES), having(DISTINCT_COUNT)
    nulls = having(NULL_RATIO)
    sketched = distinct if approximate else []
    exact = [] if approximate else distinct
    # Columns whose values are listed, and columns only told apart. Both give
    # their null ratio as well, so a text column is read once.
    ranked = listed
    apart = [c for c in exact if c not in ranked]
    counted = {*ranked, *apart}

    out = light_profile(
        df, ranged, [c for c in nulls if c not in counted], sketched, rsd
    )
    # What is joined has at most one row per column of the table.
    summaries = []
    if ranked:
        types = _types(df)
        texts = {c: _counting_sql(c, types[c]) for c in ranked}
        listed = {}
        if max_distinct is None:
            alone = {c: t for c, t in texts.items() if c not in exact}
            listed = toplists.heavy_hitters(df, alone, top_n) if alone else {}
        rest = {c: t for c, t in texts.items() if c not in listed}
        if rest:
            listed |= toplists.counted_keys(df, rest, top_n)
        summaries.append(toplists.summaries(df, listed))
        shown = {c: _rendered_sql(types[c]) for c in ranked if isinstance(types[c], _RENDER_LATER)}
        tops = toplists.top_values(df, texts, listed, top_n, shown).groupBy("column_name").agg(
            F.expr(
                "array_sort(collect_list(named_struct("
                "'rank', rank, 'value', value, 'count', count, 'is_null', is_null))) "
                "as ranks"
            )
        )
        out = out.join(tops, "column_name", "left")
    else:
        out = out.selectExpr("*", f"cast(null as {_RANKS}) as ranks")
    if apart:
        summaries.append(distinct_counts(df, apart))
    if summaries:
        summary = summaries[0]
        for more in summaries[1:]:
            summary = summary.unionByName(more)
        out = out.join(summary, "column_name", "left")
    else:
        out = out.selectExpr(
            "*",
            *[
                f"cast(null as bigint) as {name}"
                for name in ("distinct_count", "rows", "nulls")
            ],
        )

    def among(names: Iterable[str]) -> str:
        listing = ", ".join(literal(name) for name in names)
        return f"column_name in ({listing})" if listing else "false"

    few = "true" if max_distinct is None else f"coalesce(distinct_count, 0) <= {int(max_distinct)}"
    ran = ", ".join(
        f"{literal(name)}, array({', '.join(map(literal, picked))})"
        for name, picked in chosen.items()
        if picked
    )
    return out.selectExpr(
        "column_name",
        "ordinal",
        "native_type",
        f"if({among(nulls)}, coalesce(null_ratio, nulls / nullif(rows, 0)), null) "
        "as null_ratio",
        f"case when {among(sketched)} then approx_distinct "
        f"when {among(exact)} then coalesce(distinct_count, 0) end as distinct_count",
        "min_value",
        "max_value",
        f"if({among(ranked)} and {few}, coalesce(transform(ranks, r -> "
        "named_struct('value', r.value, 'count', r.count, 'is_null', r.is_null)), "
        f"cast(array() as array<{TOP_VALUE}>)), null) as top_values",
        f"{among(sketched)} as approximate",
        "cast(coalesce("
        + (f"element_at(map({ran}), column_name), " if ran else "")
        + "array()) as array<string>) as modes",
    )


def profile_column(df: DataFrame, column: str, mode: str, **options: object) -> DataFrame:
    """One statistic of one column, reading that column only."""
    require_columns(df, [column])
    narrow = df.selectExpr(ident(column))
    return table_profile(narrow, {column: [mode]}, **options)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(container_name, estimated_count); Parquet answers from file footers."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("estimated_count")).select(
            F.lit(name).alias("container_name"), "estimated_count"
        )
        counts = one if counts is None else counts.unionAll(one)
    if counts is None:
        raise ValueError("no tables to count")
    return counts


def as_mode_map(profile: DataFrame) -> DataFrame:
    """(column_name, profile): the flat profile keyed by mode, as stored.

    Every mode that ran has an entry, with NULL fields where the table had
    nothing to say, so that merging it replaces what an earlier run found.
    """

    fields = {
        "distinct_count": "bigint",
        "null_ratio": "double",
        "top_values": f"array<{TOP_VALUE}>",
        "min_value": "string",
        "max_value": "string",
        "approximate": "boolean",
    }

    def entry(mode: str, *gathered: str) -> str:
        approximate = "approximate" if mode == DISTINCT_COUNT else "false"
        values = ", ".join(
            f"{literal(name)}, cast("
            + (
                approximate
                if name == "approximate"
                else name if name in gathered else "null"
            )
            + f" as {kind})"
            for name, kind in fields.items()
        )
        return (
            f"if(array_contains(modes, {literal(mode)}), named_struct('key', {literal(mode)}, "
            f"'value', named_struct({values})), null)"
        )

    entries = ", ".join(
        [
            entry(NULL_RATIO, "null_ratio"),
            entry(MIN_MAX, "min_value", "max_value"),
            entry(DISTINCT_COUNT, "distinct_count"),
            entry(TOP_VALUES, "top_values"),
        ]
    )
    return profile.selectExpr(
        "column_name", f"map_from_entries(array_compact(array({entries}))) as profile"
    )
