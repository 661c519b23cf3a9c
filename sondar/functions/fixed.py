"""Fixed values that results depend on, listed plainly.

Nothing here is computed: changing an entry changes what the library reports.
"""

from __future__ import annotations

# ---- fixed values: column-name patterns, tried in this order on the
# flattened name (lower case, separators removed); the first match decides.
NAME_PATTERNS = [
    ("password|passwd|secret|apikey|accesstoken|privatekey|credential", "secret"),
    ("email|mail(address)?", "pii"),
    ("phone|mobile|telephone|msisdn", "pii"),
    ("ssn|socialsecurity|nationalid|idcard|passport|taxid", "pii"),
    ("creditcard|cardnumber|cardno|iban|bankaccount", "pii"),
    ("(home|postal|street|mailing)?address|postcode|zipcode", "pii"),
    ("birth(date|day)|dateofbirth|dob$", "pii"),
    ("latitude|longitude|geolocation", "pii"),
    ("firstname|lastname|surname|givenname|fullname|realname", "pii"),
]

# ---- fixed values: what the values of a personal column look like, after
# surrounding white space is dropped: e-mail, phone, social security number,
# payment card.
VALUE_PATTERNS = [
    r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$",
    r"^\+?\d[\d\s().-]{7,}\d$",
    r"^\d{3}-\d{2}-\d{4}$",
    r"^(?:\d[ -]?){13,19}$",
]
# ---- fixed values: what a text needs before its pattern can match, pattern by pattern.
VALUE_NEEDS = [
    "contains({0}, '@')", "length({0}) >= 9", "length({0}) >= 11", "length({0}) >= 13",
]

# ---- fixed values: fragments of a declared type name, tried group by group.
OPAQUE_TYPES = [
    "blob", "binary", "bytea", "geometry", "geography", "point", "polygon",
    "linestring",
]
TEMPORAL_TYPES = ["date", "time", "year", "interval"]
NUMERIC_TYPES = ["int", "serial", "dec", "num", "float", "double", "real", "money"]
CATEGORICAL_TYPES = ["char", "text", "string", "clob", "enum", "bool", "uuid"]

# ---- fixed values: document value types by the statistics they allow.
DOCUMENT_NUMERIC = ["int", "long", "double", "decimal"]
DOCUMENT_TEMPORAL = ["date", "timestamp"]
DOCUMENT_CATEGORICAL = ["string", "bool"]

# ---- fixed values: what a masked value shows.
MASK = "***"

# ---- fixed values: data files by extension.
FILE_FORMATS = {
    "parquet": "parquet",
    "csv": "csv",
    "json": "json",
    "jsonl": "json",
    "ndjson": "json",
}
