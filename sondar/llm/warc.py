"""Web archives: a deterministic sharded writer and its reader.

Records are sorted by id and dealt to shards at boundaries that depend on the
rows alone; a shard's records go, one gzip member each, to files that are rolled
by compressed size.  Headers, record ids and digests are computed anew.  Of
records with equal payloads one is a response and the others refer to it.

A task writes under a temporary name of its own.  Its manifest rows are committed
by Spark, for one attempt of each task only; then the files that
manifests name get their final names, and a last manifest file marks the archive as whole.  Readers
open what committed manifests name and nothing else.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.llm.common import boundaries, quoted, staged

FILE_BYTES = 16 << 20
SHARD_BYTES = 64 << 20
MAX_SHARDS = 20_000
REVISIT_BYTES = 1000
LEVEL = 5
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of addresses
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = "shard int, file int, temporary string, name string, records long, bytes long, sha1 string"
_RECORD = "page long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an address or plain path, and the path in it."""
    if urlsplit(path).scheme:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _clean(value: str | None) -> str:
    """A header value on one line."""
    return " ".join((value or "").split())


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page}:{digest}')}>"


def record(row: dict, payload: bytes, date: str) -> bytes:
    """One record: headers, the HTTP head and, for a response, the payload."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()
    head = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n"
    ).encode()
    block = head if row["revisit"] else head + payload
    page = None if row["page_null"] else row["page"]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if row['revisit'] else 'response'}",
        f"WARC-Record-ID: {record_id(page, row['digest'])}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(row['url'])}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Payload-Digest: {digest}",
        "WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
    ]
    if page is not None:
        lines.append(f"Page-ID: {page}")
    if row["revisit"]:
        lines += [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To: {record_id(row['response'], row['digest'])}",
            f"WARC-Refers-To-Target-URI: {_clean(row['response_url'])}",
            f"Refers-To-Page-ID: {row['response']}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page, page_null, digest, response, response_url) of the ids whose payload,
    of at least ``least`` bytes, a larger id has too.

    The rows of a payload are counted in parts before they meet, and answers go
    back to the parts, so a payload of a third of all rows is no hot key.
    """
    rows = pages.where(F.col("size") >= least).withColumn("part", F.pmod(F.xxhash64("page"), F.lit(64)))
    part = rows.groupBy("digest", "size", "part").agg(
        F.max(F.struct("page", "url")).alias("last"), F.count(F.lit(1)).alias("n"))
    whole = part.groupBy("digest", "size").agg(
        F.max("last").alias("last"), F.sum("n").alias("n"), F.collect_list("part").alias("held"))
    shared = staged(whole.where("n > 1").select(
        "digest", "size", F.explode("held").alias("part"), F.col("last.page").alias("response"),
        F.col("last.url").alias("response_url")), "shared")
    return (
        rows.join(shared, ["digest", "size", "part"]).where("response <> page")
        .select("page", "page_null", "digest", "response", "response_url").distinct()
    )


def _writer(folder: str, file_bytes: int, level: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_path(folder)
        attempt = uuid.uuid4().hex
        state: dict = {"shard": None}
        done: list[tuple] = []

        def close() -> None:
            if state.get("out"):
                state["out"].close()
                done.append((state["shard"], state["file"], state["temporary"],
                             f"shard-{state['shard']:06d}-{state['file']:05d}.warc.gz", state["records"], state["bytes"],
                             state["sha1"].hexdigest()))
                state["out"] = None

        def start(shard: int, number: int) -> None:
            name = f"_temporary/{attempt}-{shard:06d}-{number:05d}"
            files.create_dir(f"{base}/_temporary", recursive=True)
            state.update(shard=shard, file=number, temporary=name, records=0, bytes=0, sha1=hashlib.sha1(),
                         out=files.open_output_stream(f"{base}/{name}", compression=None))
            add(_member(
                "\r\n".join(["WARC/1.1", "WARC-Type: warcinfo",
                             f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_SPACE, f'info:{shard}:{number}')}>",
                             f"WARC-Date: {date}", "Content-Type: application/warc-fields", "Content-Length: 21", "", "format: WARC File 1.1", "", ""]
                            ).encode(), level))

        def add(member: bytes) -> None:
            state["out"].write(member)
            state["sha1"].update(member)
            state["bytes"] += len(member)

        refers: dict = {}
        for batch in batches:
            columns = [n for n in batch.schema.names if n != "payload"]
            payloads = batch.column("payload")
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                for i, row in enumerate(part.select(columns).to_pylist()):
                    if not row["kind"]:
                        refers = row
                        continue
                    same = all(refers.get(c) == row[c] for c in ("page", "page_null", "digest"))
                    row["revisit"] = same
                    row["response"], row["response_url"] = (refers["response"], refers["response_url"]) if same else (None, None)
                    if row["shard"] != state["shard"]:
                        close()
                        start(row["shard"], 0)
                    elif state["records"] and state["bytes"] >= file_bytes:
                        close()
                        start(row["shard"], state["file"] + 1)
                    add(_member(record(row, payloads[begin + i].as_py(), date), level))
                    state["records"] += 1
        close()
        names = ["shard", "file", "temporary", "name", "records", "bytes", "sha1"]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(list(zip(*done)) or [()] * 7, kinds)], names=names)

    return write


def _settle(folder: str):
    """Gives the files of committed manifest rows their final names.  A task that is
    run again finds its work done."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_path(folder)
        for batch in batches:
            for row in batch.to_pylist():
                old, new = f"{base}/{row['temporary']}", f"{base}/{row['name']}"
                if files.get_file_info(old).type == pafs.FileType.File:
                    files.move(old, new)
                there = files.get_file_info(new)
                if there.type != pafs.FileType.File or there.size != row["bytes"]:
                    raise OSError(f"{row['name']} is missing or has another size")
            yield batch

    return rename


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html",
          shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, least: int = REVISIT_BYTES, level: int = LEVEL,
          date: datetime = datetime(2020, 1, 1, tzinfo=timezone.utc)) -> DataFrame:
    """Writes one record per row to ``folder`` and returns the committed manifest.

    Of rows with equal payloads of at least ``least`` bytes those with the largest
    id are responses and the others revisit it; a null id counts as smallest, ids are whole numbers.
    A null payload or address is empty.  The same rows give the same bytes,
    whatever order or partitions they come in; only rows equal in everything may change places.
    ``date`` is every record's date.  The folder must be new and shared by all executors.
    """
    if not isinstance(pages.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} is no whole number")
    spark = pages.sparkSession
    files, base = open_path(folder)
    if files.get_file_info(f"{base}/MANIFEST.json").type != pafs.FileType.NotFound:
        raise FileExistsError(f"{folder} holds an archive")
    body = quoted(html) if dict(pages.dtypes)[html] == "binary" else F.encode(quoted(html), "UTF-8")
    body = F.coalesce(body, F.lit("").cast("binary"))
    rows = pages.select(
        F.coalesce(quoted(id_col).cast("long"), F.lit(-(1 << 63))).alias("page"), quoted(id_col).isNull().alias("page_null"),
        F.coalesce(quoted(url).cast("string"), F.lit("")).alias("url"), F.sha1(body).alias("digest"),
        F.octet_length(body).cast("long").alias("size"), body.alias("payload"))
    slim = staged(rows.drop("payload"), "pages")
    count, size = slim.agg(F.count(F.lit(1)), F.sum("size")).first()
    shards = min(MAX_SHARDS, max(1, -(-int(size or 0) // shard_bytes)))
    starts = boundaries(slim, "page", shards, count)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = [bisect_right(starts, p) for p in batch.column("page").to_pylist()]
            yield batch.append_column("shard", pa.array(shard, pa.int32()))

    # What a row refers to travels as a row before it, so that payloads move once.
    none = [F.lit(None).cast("long").alias("response"), F.lit(None).cast("string").alias("response_url")]
    records = rows.select("page", "page_null", "digest", F.lit(1).alias("kind"), "url", "size", *none, "payload")
    refers = revisits(slim, least).select(
        "page", "page_null", "digest", F.lit(0).alias("kind"), F.lit("").alias("url"), F.lit(0).cast("long").alias("size"),
        "response", "response_url", F.lit(None).cast("binary").alias("payload"))
    both = records.unionByName(refers)
    made = (
        both.mapInArrow(deal, T.StructType([*both.schema, T.StructField("shard", T.IntegerType())]))
        .repartitionById(len(starts) + 1, F.col("shard"))
        .sortWithinPartitions("shard", "page", "page_null", "digest", "kind", "url")
        .mapInArrow(_writer(folder, file_bytes, level, date.strftime("%Y-%m-%dT%H:%M:%SZ")), _MANIFEST)
    )
    manifest = staged(made, "manifest")
    named = staged(manifest.mapInArrow(_settle(folder), _MANIFEST).select(
        "shard", "file", "name", "records", "bytes", "sha1"), "manifest")
    totals = named.agg(F.count(F.lit(1)), F.sum("records"), F.sum("bytes")).first()
    named.write.parquet(f"{folder}/manifest")
    left = files.get_file_info(pafs.FileSelector(f"{base}/_temporary", allow_not_found=True))
    for info in left:  # of attempts that were lost
        files.delete_file(info.path)
    text = json.dumps({"files": totals[0], "records": int(totals[1] or 0), "bytes": int(totals[2] or 0)})
    with files.open_output_stream(f"{base}/_MANIFEST.json") as out:
        out.write(text.encode())
    files.move(f"{base}/_MANIFEST.json", f"{base}/MANIFEST.json")
    return spark.read.parquet(f"{folder}/manifest")


def _members(stream: pa.NativeFile) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    data, ended = b"", False
    while True:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not data:
                data = stream.read(1 << 20)
                if not data:
                    if parts:
                        raise ValueError("a record is cut short")
                    ended = True
                    break
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data
        if ended:
            return
        yield b"".join(parts)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers, in lower case, and its block, of the declared length."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a record")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    length = int(headers["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return headers, rest[:length]


def _reader(folder: str, with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_path(folder)
        names = [c.split()[0] for c in _RECORD.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for name, records in zip(batch.column("name").to_pylist(), batch.column("records").to_pylist()):
                rows, seen, held = [], 0, 0
                with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for member in _members(stream):
                        headers, block = parse(member)
                        if headers["warc-type"] == "warcinfo":
                            continue
                        seen += 1
                        http, _, payload = block.partition(b"\r\n\r\n")
                        fields = dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])
                        size = int(fields[b"Content-Length"])
                        digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                        response = headers["warc-type"] == "response"
                        if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"{name}: a payload differs from its digest")
                        page, refers = headers.get("page-id"), headers.get("refers-to-page-id")
                        rows.append((int(page) if page else None, size, digest, headers["warc-type"],
                                     int(refers) if refers else None, headers["warc-target-uri"],
                                     payload if with_payload and response else None))
                        held += len(payload) if with_payload else 0
                        if len(rows) >= 2000 or held > 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if seen != records:
                    raise ValueError(f"{name} holds {seen} records, its manifest says {records}")
                if rows:
                    yield batch_of(rows)

    return read


def read(spark: SparkSession, folder: str, id_col: str = "page_id", payload: bool = True) -> DataFrame:
    """The records of a whole archive, with checked digests: ``id_col``,
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``url``
    and, if asked, the ``payload`` of responses.  An archive whose last
    manifest is missing is refused."""
    files, base = open_path(folder)
    if files.get_file_info(f"{base}/MANIFEST.json").type != pafs.FileType.File:
        raise FileNotFoundError(f"{folder} holds no finished archive")
    listed = spark.read.parquet(f"{folder}/manifest").select("name", "records")
    with files.open_input_stream(f"{base}/MANIFEST.json") as stream:
        total = json.loads(stream.read())["files"]
    dealt = listed.repartition(max(1, min(total, 4 * spark.sparkContext.defaultParallelism)))
    rows = dealt.mapInArrow(_reader(folder, payload), _RECORD).withColumnRenamed("page", id_col)
    return rows if payload else rows.drop("payload")
