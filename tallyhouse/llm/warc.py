"""WARC archives as a Spark data source, and pages written to them with revisit records.

``register(spark)`` makes the format ``warc`` known. Writing takes rows (page_id, uri, record_type,
payload, payload_digest, refers_to); every task writes files of bounded size, and a manifest of the
files of successful tasks is written last, so a repeated or lost task leaves nothing that a reader
sees. Reading plans one partition for each file of the manifest (or each ``*.warc`` and ``*.warc.gz``
file of a folder without one; compressed ones are read as a stream, member after member). Equality
and membership filters on header columns are pushed down: a record's headers are parsed first, and
where a filter fails, or the payload is not wanted, its block is skipped without being read or
decoded. ``payload`` is wanted unless the option ``payload`` is ``false``, which leaves that column
out.

A response record holds an HTTP response whose body is the payload; a revisit record holds HTTP
headers only, and names the response by ``WARC-Refers-To``. Its payload is not stored again, but its
digest and length are (``WARC-Payload-Digest``, ``X-Payload-Length``).

Files are reached through ``pyarrow.fs``, by any URI it knows; a path without scheme is local.

Skew: equal payloads are found by digest; the digests with copies are joined back to the pages, and
a payload on a third of all pages is one row on the other side of that join.

Defined results: null html is the empty payload; payloads shorter than ``least_bytes`` are never
revisited; a page without id is written with an empty id, never named by a revisit unless all pages
of its payload lack one, and read back as null; repeated ids are written as often as they come, the
first of them by order of id is the response and so are its repeats; an empty table gives an archive
without records. Records of other writers have no ``page_id``: it is null unless the id is one of this
writer's, and so is ``refers_to``; their payload is what follows the HTTP headers, as it is stored, and
null if they are no responses. A text of any length is held once by the task that writes or reads it.
Other columns of the input are neither read nor required.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any, BinaryIO

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tallyhouse.storage import fresh_path, stage

# A new file is begun when one has reached this size.
FILE_BYTES = 64 << 20
MANIFEST = "_manifest.json"

HEADER_COLUMNS = "page_id BIGINT, uri STRING, record_type STRING, refers_to BIGINT, header_digest STRING, payload_length BIGINT"
WITH_PAYLOAD = HEADER_COLUMNS + ", payload BINARY"
_ID = "urn:page:"
_DATE = "2000-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(path: str) -> tuple[Any, str]:
    """The store of a path and the path within it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        scheme, _, rest = path.partition(":")
        return fs.FileSystem.from_uri(f"{scheme}://{rest.lstrip('/') if scheme != 'file' else '/' + rest.lstrip('/')}")
    return fs.LocalFileSystem(), path


# Records -----------------------------------------------------------------------------------------


def _id_of(page_id: int | None) -> str:
    return f"<{_ID}{'' if page_id is None else page_id}>"


def _page_of(record_id: str | None) -> int | None:
    """The page that an id of this writer names; null for ids of others."""
    scheme, _, number = (record_id or "").strip("<>").rpartition(":")
    is_own = f"{scheme}:" == _ID and number.removeprefix("-").isdecimal() and number.isascii()
    return int(number) if is_own and -(1 << 63) <= int(number) < 1 << 63 else None


def record(
    page_id: int | None, uri: str | None, kind: str, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """The bytes of one record."""
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload)]
    block = b"\r\n".join(http) + b"\r\n\r\n" + (payload if kind == "response" else b"")
    clean_uri = " ".join((uri or "").split())
    headers = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_id_of(page_id)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {clean_uri}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        headers += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_id_of(refers_to)}",
        ]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_headers(stream: BinaryIO) -> dict[str, str] | None:
    """Headers of the next record by lower-case name; None at the end. Raises on anything else."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record where one must begin: {line[:60]!r}")
    headers, last = {}, None
    while (line := stream.readline().rstrip(b"\r\n")):
        text = line.decode("utf-8", "replace")
        if text[0] in " \t" and last:
            headers[last] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        last = name.strip().lower()
        headers[last] = value.strip()
    if "content-length" not in headers:
        raise ValueError("a WARC record without Content-Length")
    return headers


def read_records(stream: BinaryIO, wanted: dict[str, set], with_payload: bool) -> Iterator[tuple]:
    """Rows of the records whose header columns are among the wanted values. A block is read only
    for a row that is returned with its payload; others are passed over by their length."""
    while (headers := read_headers(stream)) is not None:
        length = int(headers["content-length"])
        row = {
            "page_id": _page_of(headers.get("warc-record-id")),
            "uri": headers.get("warc-target-uri") or None,
            "record_type": headers.get("warc-type"),
            "refers_to": _page_of(headers.get("warc-refers-to")),
            "header_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "payload_length": int(headers["x-payload-length"]) if "x-payload-length" in headers else None,
        }
        if any(row[name] not in values for name, values in wanted.items()):
            stream.seek(length, 1)
        elif with_payload:
            block = stream.read(length)
            if len(block) != length:
                raise ValueError("a WARC record is cut off")
            is_response = row["record_type"] == "response"
            yield (*row.values(), block.partition(b"\r\n\r\n")[2] if is_response else None)
        else:
            stream.seek(length, 1)
            yield tuple(row.values())


# The data source ---------------------------------------------------------------------------------


@dataclass
class WarcFile(InputPartition):
    path: str

    def __init__(self, path: str) -> None:
        self.path = path


@dataclass
class WrittenFiles(WriterCommitMessage):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, with_payload: bool) -> None:
        self.path, self.with_payload = path, with_payload
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes equality and membership of header columns; returns what Spark has to do."""
        columns = {c.split()[0] for c in HEADER_COLUMNS.split(", ")}
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name not in columns:
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            values.discard(None)
            self.wanted[name] = self.wanted[name] & values if name in self.wanted else values

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, path = file_system(self.path)
        manifest = f"{path}/{MANIFEST}"
        if store.get_file_info(manifest).type != fs.FileType.NotFound:
            with store.open_input_stream(manifest) as f:
                names = json.loads(f.read())
        else:
            found = store.get_file_info(fs.FileSelector(path))
            names = sorted(x.base_name for x in found if x.base_name.endswith((".warc", ".warc.gz")))
        return [WarcFile(f"{self.path}/{name}") for name in names]

    def read(self, partition: WarcFile) -> Iterator[tuple]:
        if partition is None:
            return
        store, path = file_system(partition.path)
        with io.BufferedReader(store.open_input_file(path), 1 << 17) as stream:
            plain = gzip.GzipFile(fileobj=stream) if path.endswith(".gz") else stream
            yield from read_records(plain, self.wanted, self.with_payload)


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, rows: Iterator[Any]) -> WriterCommitMessage:
        store, path = file_system(self.path)
        store.create_dir(path, recursive=True)
        names: list[str] = []
        out, size = None, 0
        for row in rows:
            if out is None or size >= FILE_BYTES:
                if out is not None:
                    out.close()
                names.append(f"{uuid.uuid4().hex}.warc")
                out, size = store.open_output_stream(f"{path}/{names[-1]}"), 0
            size += out.write(
                record(
                    row["page_id"], row["uri"], row["record_type"], bytes(row["payload"] or b""),
                    row["payload_digest"], row["refers_to"],
                )
            )
        if out is not None:
            out.close()
        return WrittenFiles(names)

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        store, path = file_system(self.path)
        store.create_dir(path, recursive=True)
        names = sorted(n for m in messages if m is not None for n in m.names)
        with store.open_output_stream(f"{path}/{MANIFEST}") as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        store, path = file_system(self.path)
        for m in messages:
            for name in m.names if m is not None else ():
                store.delete_file(f"{path}/{name}")


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)`` and ``df.write.format("warc").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def _with_payload(self) -> bool:
        return str(self.options.get("payload", "true")).lower() != "false"

    def schema(self) -> str:
        return WITH_PAYLOAD if self._with_payload() else HEADER_COLUMNS

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], self._with_payload())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# Pages to archives and back ----------------------------------------------------------------------


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows for the writer: of pages with equal payloads of at least ``least_bytes`` bytes, the one
    with the smallest id is a response and the others revisit it."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    # SHA-1 is what the records carry; different payloads can be made to share it, so a second digest
    # decides with it.
    digests = [F.sha1(payload).alias("hex_digest"), F.sha2(payload, 256).alias("second_digest")]
    rows = pages.select("page_id", "url", payload.alias("payload"), *digests)
    hashed = pages.select("page_id", F.octet_length(payload).alias("bytes"), *digests)
    both = ["hex_digest", "second_digest"]
    groups = (
        hashed.where(F.col("bytes") >= least_bytes)
        .groupBy(*both)
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select(*both, "first_id")
    )
    groups = stage(groups, "equal-payloads")
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(groups, both, "left").select(
        F.col("page_id").cast("bigint"),
        F.col("url").alias("uri"),
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        "payload",
        base32_of_hex(F.col("hex_digest")).alias("payload_digest"),
        F.when(revisits, F.col("first_id")).cast("bigint").alias("refers_to"),
    )


def base32_of_hex(hex_digest: Column) -> Column:
    """Upper-case base32 of a 40-digit hexadecimal column: 15 digits are 12 letters, 10 are 8."""
    digits = [
        F.lpad(F.conv(F.substring(hex_digest, at, n), 16, 32), n * 4 // 5, "0")
        for at, n in ((1, 15), (16, 15), (31, 10))
    ]
    return F.translate(
        F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def write_pages(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    register(pages.sparkSession)
    with_revisits(pages, least_bytes).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(with_payload).lower()).load(path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record. Responses are
    read with their payloads, whose length and digest are taken from the bytes read; revisits are
    read by their headers alone."""
    responses = read_archive(spark, path).where("record_type = 'response'")
    revisits = read_archive(spark, path, with_payload=False).where("record_type = 'revisit'")
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    of_responses = responses.select(
        "page_id",
        F.octet_length("payload").cast("bigint"),
        base32_of_hex(F.sha1("payload")),
        "record_type",
        "refers_to",
    ).toDF(*names)
    of_revisits = revisits.select("page_id", "payload_length", "header_digest", "record_type", "refers_to")
    return of_responses.unionByName(of_revisits.toDF(*names))


def pages_through_archives(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the pages to archives below the shared folder and reads them back."""
    path = fresh_path(pages.sparkSession, "warc")
    write_pages(pages, path, least_bytes)
    return archived_pages(pages.sparkSession, path)
