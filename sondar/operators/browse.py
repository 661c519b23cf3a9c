"""Reading an inventory: filters, pages, search, references, changes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondar.functions.globs import matches_any
from sondar.functions.text import shortened
from sondar.model import (
    AmbiguousContainer,
    CONTAINER_KEY,
    DEFAULT_CHANGE_LIMIT,
    DEFAULT_PAGE,
    DEFAULT_SEARCH_LIMIT,
    InvalidCursor,
    SOURCE_AI,
    SOURCE_HUMAN,
    UnknownContainer,
)

# ---- access


@dataclass(frozen=True)
class Access:
    """What a caller may read: shell-style patterns on container names, deny
    before allow, and a list of databases. Empty lists restrict nothing.
    ``raw_samples`` allows rows without masking; ``writes_as_human`` says that what
    the caller writes counts as a person's, not as a machine's guess."""

    allow: tuple[str, ...] = ()
    deny: tuple[str, ...] = ()
    databases: tuple[str, ...] = ()
    raw_samples: bool = False
    writes_as_human: bool = False

    @property
    def source(self) -> str:
        """Who a description written with this access comes from; never the caller's say."""
        return SOURCE_HUMAN if self.writes_as_human else SOURCE_AI

    @classmethod
    def from_claims(cls, claims: dict[str, Any], scopes: Sequence[str] = ()) -> Access:
        """From a decoded token and its scopes. A malformed container rule denies everything;
        what is no list of strings grants nothing."""

        def strings(value: Any) -> tuple[str, ...]:
            items = value if isinstance(value, list) else []
            return tuple(item for item in items if isinstance(item, str))

        rule = claims.get("containers")
        granted = {
            "databases": strings(claims.get("databases")),
            "raw_samples": claims.get("allow_raw_sample") is True,
            "writes_as_human": claims.get("annotate_as_human") is True or "annotate:human" in scopes,
        }
        if rule is not None and not isinstance(rule, dict):
            return cls(deny=("*",), **granted)
        rule = rule or {}
        return cls(
            allow=strings(rule.get("allow")),
            deny=strings(rule.get("deny")),
            **granted,
        )

    def condition(self) -> Column:
        """True for rows (``database``, ``container_name``) that may be read."""
        name = F.col("container_name")
        allowed = ~matches_any(name, self.deny)
        if self.allow:
            allowed &= matches_any(name, self.allow)
        if self.databases:
            allowed &= F.col("database").isin(list(self.databases))
        return allowed


def permitted(df: DataFrame, access: Access) -> DataFrame:
    """Only the containers (or columns of containers) the caller may read."""
    return df.where(access.condition())


# ---- scope and pages


def in_scope(
    df: DataFrame, database: str | None = None, schema: str | None = None
) -> DataFrame:
    if database:
        df = df.where(F.col("database") == database)
    if schema is not None:
        df = df.where(F.col("schema_name") == schema)
    return df


def _page_size(limit: int | None) -> int:
    return DEFAULT_PAGE if limit is None else max(1, limit)


_CONTAINER_ORDER = ["container_name", "database", "schema_name"]


def containers_after(
    containers: DataFrame,
    *,
    database: str | None = None,
    schema: str | None = None,
    limit: int | None = None,
    cursor: Sequence[str] | None = None,
) -> DataFrame:
    """The next containers by name, of one schema if it is given; one more than
    the page holds.

    The cursor is (container_name, database, schema_name) of the last row
    seen, so equal names in two databases are not lost at a page's edge. Only
    a page's worth of rows leaves each task.
    """
    rows = in_scope(containers, database, schema)
    if cursor is not None:
        if len(cursor) != 3:
            raise InvalidCursor(str(cursor))
        name, base, schema = (F.lit(part) for part in cursor)
        rows = rows.where(
            (F.col("container_name") > name)
            | (
                (F.col("container_name") == name)
                & (
                    (F.col("database") > base)
                    | ((F.col("database") == base) & (F.col("schema_name") > schema))
                )
            )
        )
    return rows.orderBy(*_CONTAINER_ORDER).limit(_page_size(limit) + 1)


def container_page(
    containers: DataFrame, **options: Any
) -> tuple[DataFrame, tuple[str, str, str] | None]:
    """A page and the cursor of the next one, None on the last."""
    size = _page_size(options.get("limit"))
    found = containers_after(containers, **options)
    last = found.select(*_CONTAINER_ORDER).collect()
    page = found.limit(size)
    return page, (tuple(last[size - 1]) if len(last) > size else None)


def columns_after(
    columns: DataFrame,
    database: str,
    container: str,
    schema: str = "",
    *,
    limit: int | None = None,
    cursor: str | int | None = None,
    include_profile: bool = True,
) -> DataFrame:
    """The next columns of a container by ordinal, one more than the page
    holds; without profiles on request, which are most of a page's size."""
    rows = columns.where(
        (F.col("database") == database)
        & (F.col("schema_name") == schema)
        & (F.col("container_name") == container)
    )
    if cursor is not None:
        try:
            after = int(cursor)
        except ValueError as error:
            raise InvalidCursor(str(cursor)) from error
        rows = rows.where(F.col("ordinal") > after)
    if not include_profile:
        rows = rows.drop("profile")
    return rows.orderBy("ordinal").limit(_page_size(limit) + 1)


def column_page(
    columns: DataFrame, database: str, container: str, schema: str = "", **options: Any
) -> tuple[DataFrame, str | None]:
    """A page of columns and the cursor of the next one, None on the last."""
    size = _page_size(options.get("limit"))
    found = columns_after(columns, database, container, schema, **options)
    last = found.select("ordinal").collect()
    return found.limit(size), (str(last[size - 1][0]) if len(last) > size else None)


# ---- names


def name_candidates(requested: DataFrame, containers: DataFrame) -> DataFrame:
    """(container, candidate, exact): the catalog's names each requested one may
    mean, NULL where there is none.

    A name the catalog holds means itself (``exact``); a bare one may be the
    last part of qualified names.
    """
    known = containers.select(F.col("container_name").alias("candidate")).distinct()
    names = known.selectExpr(
        "candidate",
        "inline(if(contains(candidate, '.'), "
        "array(named_struct('name', candidate, 'exact', true), "
        "named_struct('name', substring_index(candidate, '.', -1), 'exact', false)), "
        "array(named_struct('name', candidate, 'exact', true))))",
    )
    wanted = requested.select("container").distinct()
    return wanted.join(names, wanted["container"] == names["name"], "left").select(
        "container", "candidate", "exact"
    )


def resolve_names(requested: DataFrame, containers: DataFrame) -> DataFrame:
    """(container, resolved, matches) for every requested name; ``resolved`` is
    NULL where the catalog has no such name or several."""
    return (
        name_candidates(requested, containers)
        .groupBy("container")
        .agg(
            F.coalesce(F.max("exact"), F.lit(False)).alias("exact"),
            F.count("candidate").alias("found"),
            F.min("candidate").alias("candidate"),
        )
        .selectExpr(
            "container",
            "if(exact, container, if(found = 1, candidate, null)) as resolved",
            "if(exact, 1L, found) as matches",
        )
    )


def require_container(containers: DataFrame, name: str) -> str:
    """The catalog's name for one container, or an error that says why not."""
    wanted = containers.sparkSession.sql(
        "select :name as container", args={"name": name}
    )
    found = resolve_names(wanted, containers).first()
    if found is None or found.matches == 0:
        raise UnknownContainer(name)
    if found.resolved is None:
        # As many names as schemas hold this one table.
        shown = [
            row.candidate
            for row in name_candidates(wanted, containers).orderBy("candidate").collect()
        ]
        raise AmbiguousContainer(
            f"{name!r} is in {found.matches} schemas: {', '.join(shown)}"
        )
    return found.resolved


def known_only(requested: DataFrame, containers: DataFrame) -> DataFrame:
    """Requested names (``container_name``) the catalog holds."""
    return requested.join(containers, "container_name", "left_semi")


# ---- search


def search(
    containers: DataFrame,
    columns: DataFrame,
    keyword: str,
    *,
    database: str | None = None,
    kind: str = "all",
    limit: int | None = DEFAULT_SEARCH_LIMIT,
) -> DataFrame:
    """Containers and columns whose name or description holds the keyword.

    Case does not matter and no character is special. Name hits come before
    description hits, containers before columns, then by name; everything is
    ranked before the limit, which each task applies to its own rows first.
    ``limit=None`` gives every hit, sorted over as many tasks as it takes.
    """
    if kind not in ("all", "container", "column"):
        raise ValueError(f"unknown kind: {kind!r}")
    word = keyword.strip().lower()

    def hits(df: DataFrame, name: str, *extra: Column) -> DataFrame:
        by_name = F.contains(F.lower(name), F.lit(word))
        in_text = F.coalesce(
            F.contains(F.lower("description"), F.lit(word)), F.lit(False)
        ) | F.coalesce(
            F.contains(F.lower("native_description"), F.lit(word)), F.lit(False)
        )
        found = in_scope(df, database).where(
            (by_name | in_text) if word else F.lit(False)
        )
        return found.select(
            *CONTAINER_KEY,
            *extra,
            shortened(
                F.coalesce(F.nullif("description", F.lit("")), "native_description")
            ).alias("description"),
            F.when(by_name, F.lit("name")).otherwise(F.lit("description")).alias(
                "match_in"
            ),
        )

    nothing = F.lit(None).cast("string")
    parts = []
    if kind != "column":
        parts.append(
            hits(
                containers,
                "container_name",
                nothing.alias("column_name"),
                nothing.alias("native_type"),
            )
        )
    if kind != "container":
        parts.append(
            hits(columns, "column_name", F.col("column_name"), F.col("native_type"))
        )
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    ranked = found.orderBy(
        F.col("match_in") != "name",
        F.col("column_name").isNotNull(),
        "container_name",
        F.coalesce("column_name", F.lit("")),
        "database",
        "schema_name",
    )
    return ranked if limit is None else ranked.limit(limit)


# ---- references and changes


def relationships(columns: DataFrame, database: str | None = None) -> DataFrame:
    """Every declared reference as an edge, by container, then ordinal."""
    return (
        in_scope(columns, database)
        .where(F.col("references_container").isNotNull())
        .orderBy("container_name", "ordinal", "database", "schema_name")
        .select(
            "database",
            "schema_name",
            F.col("container_name").alias("from_container"),
            F.col("column_name").alias("from_column"),
            F.col("references_container").alias("to_container"),
            F.col("references_column").alias("to_column"),
        )
    )


def recent_changes(
    changes: DataFrame,
    *,
    database: str | None = None,
    since: Any = None,
    limit: int = DEFAULT_CHANGE_LIMIT,
) -> DataFrame:
    """What moved, newest first."""
    rows = in_scope(changes, database)
    if since is not None:
        rows = rows.where(F.col("detected_at") >= F.lit(since).cast("timestamp"))
    return rows.orderBy(F.desc("detected_at"), F.desc("id")).limit(limit)


def summary(
    containers: DataFrame, columns: DataFrame, database: str | None = None
) -> DataFrame:
    """Counts over the inventory, one row; counts only, whatever its size."""
    listed = in_scope(containers, database).select(
        F.lit(1).alias("container"),
        F.col("error").isNotNull().cast("int").alias("failed"),
        "estimated_count",
        F.lit(0).alias("column"),
        F.lit(0).alias("profiled"),
    )
    detailed = in_scope(columns, database).select(
        F.lit(0).alias("container"),
        F.lit(0).alias("failed"),
        F.lit(None).cast("bigint").alias("estimated_count"),
        F.lit(1).alias("column"),
        F.col("profile").isNotNull().cast("int").alias("profiled"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return listed.unionAll(detailed).agg(
        total("container").alias("containers"),
        total("failed").alias("containers_failed"),
        F.sum("estimated_count").alias("estimated_rows"),
        total("column").alias("columns"),
        total("profiled").alias("columns_profiled"),
    )
