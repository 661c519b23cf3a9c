import hashlib

import pytest
from pyspark.sql import functions as F

from sondar.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "same words " * 200
    rows = [(i, f"http://host/{i}", f"<html>{'page ' * (i % 300)}{i}</html>" if i % 3 else big, "x") for i in range(60)]
    rows += [(100, None, None, None), (101, "u\r\nv", "", "x"), (102, "v", "é" * 600, "x"), (103, "w", "é" * 600, "x"), (None, "n", big, "x"),
             (59, "again", big, "x"), (104, "a", "s" * 999, "x"), (105, "b", "s" * 999, "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, Payload string")


def files_of(folder):
    files, base = warc.open_path(folder)
    found = {}
    for info in files.get_file_info(warc.pafs.FileSelector(base, recursive=True)):
        if info.base_name.endswith(".warc.gz"):
            found[info.base_name] = open(info.path, "rb").read()
    return found


def test_round_trip_and_revisits(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/a"
    manifest = warc.write(pages, folder, shard_bytes=20_000, file_bytes=1500).collect()
    held = files_of(folder)
    assert {m.name for m in manifest} == set(held) and len({m.shard for m in manifest}) > 1
    assert any(m.file > 0 for m in manifest)
    for m in manifest:
        assert hashlib.sha1(held[m.name]).hexdigest() == m.sha1 and len(held[m.name]) == m.bytes
    rows = warc.read(spark, folder).collect()
    given = pages.collect()
    last = {}
    for p in given:
        if p.html is not None and len(p.html.encode()) >= 1000 and p.page_id is not None:
            last[p.html] = max(last.get(p.html, -1), p.page_id)
    want = sorted(
        (str(p.page_id), len((p.html or "").encode()), hashlib.sha1((p.html or "").encode()).hexdigest(),
         "revisit" if last.get(p.html, p.page_id) != p.page_id else "response",
         str(last[p.html] if last.get(p.html, p.page_id) != p.page_id else None)) for p in given)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in rows) == want
    for r in rows:
        assert (r.payload is None) == (r.record_type == "revisit")


def test_the_same_rows_give_the_same_bytes(spark, pages, tmp_path):
    one, two = f"file://{tmp_path}/one", f"file://{tmp_path}/two"
    warc.write(pages.coalesce(1), one, shard_bytes=20_000, file_bytes=1500)
    warc.write(pages.orderBy(F.rand(3)).repartition(7), two, shard_bytes=20_000, file_bytes=1500)
    assert files_of(one) == files_of(two)


def test_unfinished_and_existing_archives_are_refused(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/b"
    with pytest.raises(FileNotFoundError):
        warc.read(spark, folder)
    warc.write(pages.limit(0), folder)
    assert warc.read(spark, folder).count() == 0
    with pytest.raises(FileExistsError):
        warc.write(pages, folder)


def test_damage_is_noticed(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/c"
    warc.write(pages, folder)
    name = next(iter(files_of(folder)))
    path = tmp_path / "c" / name
    path.write_bytes(path.read_bytes()[:-20])
    with pytest.raises(Exception, match="cut short|records"):
        warc.read(spark, folder).count()
