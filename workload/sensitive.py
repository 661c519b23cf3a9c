"""Detection and masking over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.functions.fixed import NAME_PATTERNS, VALUE_PATTERNS
from sondar.operators import sensitivity as s
from workload import plain, registry, run_sql, table
from workload.profiles import union

# Customers as a contact list; some have no address.
CONTACTS = """
select c_custkey,
       case when c_mktsegment <> 'MACHINERY'
            then concat('u', c_custkey, '@x', c_nationkey, '.com') end as contact,
       concat('+886-9', lpad(cast(c_custkey as varchar(10)), 8, '0')) as reach,
       c_name as full_name, c_mktsegment as segment, c_acctbal as balance,
       concat('tok_', c_custkey) as api_key,
       case when c_nationkey < 12 then concat('user', c_custkey, '@internal')
            else concat('u', c_nationkey) end as login
from {customer}
"""
CONTACT_COLUMNS = [
    "c_custkey", "contact", "reach", "full_name", "segment", "balance", "api_key", "login",
]


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, CONTACTS)


def _judged(source: str, column: str, name: str | None = None) -> str:
    text = f"{column}::varchar"
    hits = " or ".join(
        f"2 * count(*) filter (where regexp_matches(trim({text}, ' \t\n\r'), '{p}')) "
        f"> count(*) filter (where {text} <> '')"
        for p in VALUE_PATTERNS
    )
    return (
        f"select '{name or column}' as column_name, case when "
        f"count(*) filter (where {text} <> '') >= 3 and ({hits}) then 'pii' end "
        f"as sensitivity from {source}"
    )


@registry.add(
    "detect_by_values",
    f"with c as ({plain(CONTACTS)})\n"
    + union([_judged("c", column) for column in CONTACT_COLUMNS]),
)
def detect_by_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.by_values(contacts(spark, sf_dir))


@registry.add(
    "detect_by_values_texts",
    union(
        [
            _judged("documents", "text"),
            _judged("documents", "lang"),
            _judged("documents", "source"),
        ]
    ),
)
def detect_by_values_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, every one of them."""
    return s.by_values(table(spark, sf_dir, "documents"), ["text", "lang", "source"])


@registry.add(
    "detect_names_then_values",
    f"with c as ({plain(CONTACTS)})\n"
    + "select * from ("
    + union(
        ["select 'full_name' as column_name, 'pii' as sensitivity",
         "select 'api_key', 'secret'"]
        + [
            _judged("c", column)
            for column in ["c_custkey", "contact", "reach", "segment", "balance", "login"]
        ]
    )
    + ") where sensitivity is not null",
)
def detect_names_then_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.detect(contacts(spark, sf_dir), full=True)


def masked_sql(column: str, level: str) -> str:
    text = f"{column}::varchar"
    domain = f"substr({text}, instr({text}, '@') + 1)"
    suffix = f"regexp_extract({domain}, '[^.]*$')"
    return (
        f"case when {text} is null then null when '{level}' = 'secret' then '***' "
        f"when contains({text}, '@') then "
        f"case when instr({text}, '@') > 1 then substr({text}, 1, 1) else '' end "
        f"|| '***@***' || case when regexp_matches({domain}, '.[.][^.]*$') "
        f"then '.' || {suffix} else '' end "
        f"when length({text}) <= 4 then '***' "
        f"else substr({text}, 1, 2) || '***' || right({text}, 2) end as {column}"
    )


_LEVELS = {
    "contact": "pii", "reach": "pii", "full_name": "pii", "balance": "pii",
    "api_key": "secret", "login": "pii", "segment": "none",
}


@registry.add(
    "mask_table",
    f"with c as ({plain(CONTACTS)})\nselect c_custkey, segment, "
    + ", ".join(masked_sql(c, l) for c, l in _LEVELS.items() if l != "none")
    + " from c",
)
def mask_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.mask_table(contacts(spark, sf_dir), _LEVELS)


@registry.add(
    "masked_sample",
    f"with c as ({plain(CONTACTS)})\nselect c_custkey, segment, balance, login, "
    + ", ".join(
        masked_sql(c, l)
        for c, l in {"contact": "pii", "reach": "pii", "api_key": "secret"}.items()
    )
    + ", full_name from c order by c_custkey limit 50",
)
def masked_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty rows as shown to a caller; one verdict was corrected by hand."""
    rows, _ = s.masked_sample(
        contacts(spark, sf_dir),
        50,
        {"full_name": "none", "login": "none"},
        order_by=["c_custkey"],
    )
    return rows


@registry.add(
    "sample",
    "select * from orders order by o_totalprice desc, o_orderkey limit 100",
)
def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return s.sample(
        orders, 100, order_by=[F.desc("o_totalprice"), F.col("o_orderkey")]
    )


# Column names as customers might have chosen them: every pattern and some others.
_NAMES = """
select distinct concat(case c_custkey % 12 when 0 then 'user_Passwd_' when 1 then 'Contact E-Mail '
  when 2 then 'msisdn' when 3 then 'tax-id_' when 4 then 'card_NO' when 5 then 'ZipCode' when 6 then 'birth_day'
  when 7 then 'geo_location' when 8 then 'Given_Name' when 9 then 'Street Address ' when 10 then 'total'
  else 'api_KEY' end, c_nationkey) as column_name
from {customer}
"""


@registry.add(
    "detect_every_name_pattern",
    "select column_name, case "
    + " ".join(
        f"when regexp_matches(flat, '{pattern}') then '{level}'"
        for pattern, level in NAME_PATTERNS
    )
    + " end as sensitivity from (select *, regexp_replace(lower(column_name), '[^a-z0-9]', '', 'g') "
    f"as flat from ({plain(_NAMES)}))",
)
def detect_every_name_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.by_name(run_sql(spark, sf_dir, _NAMES))
