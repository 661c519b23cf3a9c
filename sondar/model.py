"""Frame schemas and closed vocabularies shared by every module."""

from __future__ import annotations


class SondarError(Exception):
    """Base of the errors a caller is expected to handle."""


class UnknownContainer(SondarError):
    """No such table, view or dataset."""


class UnknownColumn(SondarError):
    """The container has no such column."""


class AmbiguousContainer(SondarError):
    """A bare name that several schemas hold."""


class NotPermitted(SondarError):
    """The caller's access does not cover this."""


class RepeatedKey(SondarError):
    """A listing that names a container or column more than once."""


class InvalidCursor(SondarError):
    """A page cursor that no page handed out."""


# Profile modes.
NULL_RATIO = "null_ratio"
MIN_MAX = "min_max"
DISTINCT_COUNT = "distinct_count"
TOP_VALUES = "top_values"
ALL_MODES = (DISTINCT_COUNT, TOP_VALUES, NULL_RATIO, MIN_MAX)

# Sensitivity levels.
NONE = "none"
PII = "pii"
SECRET = "secret"

# Who wrote a verdict or a description.
SOURCE_DETECTED = "detected"
SOURCE_NATIVE = "native"
SOURCE_AI = "ai"
SOURCE_HUMAN = "human"

# Change types.
CONTAINER_ADDED = "container_added"
CONTAINER_REMOVED = "container_removed"
SCHEMA_CHANGED = "schema_changed"

# Scan outcomes.
DONE = "done"
SKIPPED = "skipped"
FAILED = "failed"

# Limits.
TOP_N = 20
TOP_VALUES_MAX_DISTINCT = 200
DEFAULT_SAMPLE_ROWS = 3
SENSITIVITY_SAMPLE_ROWS = 20
SCHEMA_SAMPLE_DOCUMENTS = 100
DEFAULT_PAGE = 100
DEFAULT_SEARCH_LIMIT = 50
DEFAULT_CHANGE_LIMIT = 100
SEARCH_DESCRIPTION_CHARS = 120

CONTAINER_KEY = ["database", "schema_name", "container_name"]
COLUMN_KEY = [*CONTAINER_KEY, "column_name"]

TOP_VALUE = "struct<value:string,count:bigint,is_null:boolean>"
PROFILE_VALUE = (
    "struct<distinct_count:bigint,null_ratio:double,"
    f"top_values:array<{TOP_VALUE}>,"
    "min_value:string,max_value:string,approximate:boolean>"
)
# mode -> result of the last run of that mode
PROFILE = f"map<string,{PROFILE_VALUE}>"


Fields = dict[str, str]


def ddl(fields: Fields) -> str:
    """The fields of a frame as a schema string."""
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())


def _fields(text: str) -> Fields:
    """``name type`` pairs, one to a line."""
    return dict(line.split(maxsplit=1) for line in text.strip().splitlines())


# One row per table, view or collection, as a source lists it.
LISTED_CONTAINERS = _fields("""
    database string
    schema_name string
    container_name string
    container_type string
    estimated_count bigint
    native_description string
    last_modified_at string
""")

# One row per column, as a source lists it.
LISTED_COLUMNS = _fields("""
    database string
    schema_name string
    container_name string
    column_name string
    ordinal int
    native_type string
    nullable boolean
    is_pk boolean
    is_fk boolean
    native_description string
    references_container string
    references_column string
""")

CONTAINERS = _fields("""
    database string
    schema_name string
    container_name string
    container_type string
    estimated_count bigint
    schema_hash string
    native_description string
    description string
    description_source string
    description_updated_at timestamp
    last_modified_at string
    error string
    scanned_at timestamp
""")

COLUMNS = _fields(f"""
    database string
    schema_name string
    container_name string
    column_name string
    ordinal int
    native_type string
    nullable boolean
    is_pk boolean
    is_fk boolean
    native_description string
    description string
    description_source string
    description_updated_at timestamp
    references_container string
    references_column string
    sensitivity string
    sensitivity_source string
    profile {PROFILE}
    scanned_at timestamp
""")

CHANGES = _fields("""
    id bigint
    job_id string
    database string
    schema_name string
    container_name string
    change_type string
    old_hash string
    new_hash string
    detail struct<added:array<string>,removed:array<string>,retyped:array<string>>
    detected_at timestamp
""")

SCAN_RUNS = _fields("""
    job_id string
    database string
    state string
    containers_done int
    containers_failed int
    containers_skipped int
    error string
    started_at timestamp
    finished_at timestamp
""")

AUDIT = _fields("""
    ts timestamp
    key_id string
    tool string
    params map<string,string>
    outcome string
    duration_ms double
    rendered_sql string
    rows_returned bigint
    unmasked boolean
    masked_columns array<string>
    error string
""")
