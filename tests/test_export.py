import csv
import glob

import pytest

from sondar.model import COLUMNS, CONTAINERS
from sondar.operators.browse import Access
from sondar.operators.export import export
from tests.test_browse import column, container, frame


@pytest.fixture
def port(spark):
    containers = frame(spark, CONTAINERS, [
        container("moorings", estimated_count=1234567, description="berths | all"),
        container("arrivals", estimated_count=2),
        container("blank"),
        container("broken", error="OSError: gone", schema_hash=""),
    ])
    columns = frame(spark, COLUMNS, [
        column("keeper", "moorings", 2, description='say "hi", | ok\nthere ', description_source="human", sensitivity="pii"),
        column("code", "moorings", 1, is_pk=True, nullable=False, native_description="key"),
        column("code", "arrivals", 1, is_pk=True, nullable=False),
        column("mooring_id", "arrivals", 2, is_fk=True, references_container="moorings", references_column="code"),
        column("pilot", "arrivals", 3, is_pk=True, is_fk=True, references_container="moorings"),
    ])
    return containers, columns


def text(path):
    return "".join(open(p, encoding="utf-8", newline="").read() for p in sorted(glob.glob(f"{path}/part-*")))


def test_csv(port, tmp_path):
    path = f"{tmp_path}/out"
    result = export(*port, path, "csv", files=1).first()
    assert (result.containers, result.columns) == (4, 5)
    assert result.bytes_written == len(text(path).encode())
    rows = list(csv.DictReader(text(path).splitlines(keepends=True)))
    assert list(rows[0]) == [
        "database", "schema", "container", "column", "ordinal", "native_type", "nullable", "is_pk", "is_fk",
        "references", "description", "description_source", "sensitivity",
    ]
    assert [(r["container"], r["column"]) for r in rows] == [
        ("arrivals", "code"), ("arrivals", "mooring_id"), ("arrivals", "pilot"), ("moorings", "code"), ("moorings", "keeper"),
    ]
    assert rows[1]["references"] == "moorings.code" and rows[2]["references"] == "moorings"
    assert rows[4]["description"] == 'say "hi", | ok\nthere ' and rows[4]["sensitivity"] == "pii"
    assert (rows[3]["nullable"], rows[3]["is_pk"], rows[3]["schema"]) == ("0", "1", "")


MARKDOWN = """\
# Data dictionary — shop

From the inventory. Descriptions marked *written* were added to the inventory; the rest are the source's own comments.

## arrivals

table · ~2 rows

| column | type | null | key | description |
|---|---|---|---|---|
| `code` | text | no | PK |  |
| `mooring_id` | text | yes | FK → moorings.code |  |
| `pilot` | text | yes | PK FK → moorings |  |

## blank

table

| column | type | null | key | description |
|---|---|---|---|---|

## broken

table

> Not readable at the last scan: OSError: gone

## moorings

table · ~1,234,567 rows

berths | all

| column | type | null | key | description |
|---|---|---|---|---|
| `code` | text | no | PK | key |
| `keeper` | text | yes |  | say "hi", \\| ok there  *(written)* |
"""


def test_markdown(port, tmp_path):
    path = f"{tmp_path}/out"
    result = export(*port, path, database="shop").first()
    assert text(path) == MARKDOWN
    assert (result.containers, result.columns) == (4, 5)
    assert result.bytes_written == len(MARKDOWN.encode())


DBT = """\
version: 2

models:
  - name: "arrivals"
    columns:
      - name: "code"
      - name: "mooring_id"
      - name: "pilot"
  - name: "moorings"
    description: "berths | all"
    columns:
      - name: "code"
        description: "key"
      - name: "keeper"
        description: "say \\"hi\\", | ok\\nthere "
"""


def test_dbt(port, tmp_path):
    path = f"{tmp_path}/out"
    result = export(*port, path, "dbt_yaml", files=2).first()
    assert text(path) == DBT
    assert (result.containers, result.columns) == (2, 5)


def test_only_what_may_be_read(port, tmp_path):
    path = f"{tmp_path}/out"
    access = Access(deny=("moor*",))
    for form in ("csv", "markdown", "dbt_yaml"):
        result = export(*port, path, form, access=access, files=1).first()
        assert "keeper" not in text(path)
        assert result.columns == 3


def test_unknown_format(port, tmp_path):
    with pytest.raises(ValueError):
        export(*port, str(tmp_path), "xml")
