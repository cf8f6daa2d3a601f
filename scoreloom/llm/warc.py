"""WARC archives: a Spark data source that writes them, and reads them record by record.

Writing: every task writes archives of its own, one gzip member per record, and starts a new archive
after ``archive_bytes``. Archives get their names when they are written; what counts is the list that the
commit on the driver writes once all tasks are done, so archives of lost or repeated tasks are never read.
A record with the same payload as one that is kept refers to it instead of holding it again.

Reading: one task per archive goes through it from the start. Compressed bytes are taken in blocks and
decompressed piece by piece, so that memory does not depend on how long a record is, unless its payload is
asked for; headers end at an empty line, Content-Length frames the block, and the digests of block and
payload are computed as the bytes pass and compared with those in the headers.

Defined results: a null payload is an empty one; a null url has no target header; characters that a
header cannot hold are percent-encoded in urls; of equal payloads of at least ``least_bytes`` bytes the one
with the largest id is kept, rows with the same id and payload are of one type, and a null id is smaller than
all others; smaller payloads are all kept; an empty table gives archives without such records; other
columns are ignored. A broken archive (cut short, wrong lengths or digests) stops the read and names the
archive and the place; with ``faults="keep"`` the rest of the archive, or the record, is one row that says so.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..shared_store import Workspace, ship_package
from .registry import query, read
from .sides import small_side

ARCHIVE_BYTES = 64 << 20
BLOCK = 1 << 18
COMMITTED = "archives.json"
BLANK_LINE = b"\r\n\r\n"
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN = "page_id bigint, url string, html binary, record_type string, refers_to bigint"
READ = (
    "archive string, place bigint, record_type string, record_id string, page_id bigint, refers_to bigint, url string, "
    "payload_bytes bigint, payload_digest string, payload binary, fault string"
)


def folder(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder and its path there; a plain path is one of the machine."""
    if "://" in path:
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.FileSystem.from_uri("file://" + path.removeprefix("file:"))


def digest(value: bytes) -> str:
    return base64.b32encode(value).decode()


def header_safe(text: str) -> str:
    return "".join([c if "!" <= c <= "~" else "".join([f"%{b:02X}" for b in c.encode("utf-8", "replace")]) for c in text])


def record(fields: dict[str, str | int | None], block: bytes) -> bytes:
    head = [VERSION, *[f"{k}: {v}".encode() for k, v in fields.items() if v is not None], f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(head) + BLANK_LINE + block + BLANK_LINE


def member(whole: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def page_record(page_id: int | None, url: str | None, html: bytes | None, kind: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit that keeps only the payload's HTTP header."""
    payload = html or b""
    mark = digest(hashlib.sha1(payload).digest())
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + BLANK_LINE
    block = http + (payload if kind == "response" else b"")
    own = {
        "WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": None if url is None else header_safe(url), "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{mark}", "WARC-Block-Digest": "sha1:" + digest(hashlib.sha1(block).digest()), "X-Page-Id": page_id,
    }
    if kind == "revisit":
        own |= {"WARC-Profile": SAME_PAYLOAD, "X-Refers-To-Page-Id": refers_to}
    return record(own, block)


@dataclass
class Written(WriterCommitMessage):
    archives: list[tuple[str, int]]


class ArchiveWriter(DataSourceArrowWriter):
    """Writes the archives of a task; the driver's commit lists those of all tasks."""

    def __init__(self, path: str, archive_bytes: int) -> None:
        self.path, self.archive_bytes = path, archive_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = folder(self.path)
        system.create_dir(root)
        done: list[tuple[str, int]] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for row in zip(*[batch.column(i) for i in range(batch.num_columns)], strict=True):
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, size = system.open_output_stream(f"{root}/{name}", compression=None), 0
                        info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": "1970-01-01T00:00:00Z",
                                "WARC-Filename": name, "Content-Type": "application/warc-fields"}
                        size += out.write(member(record(info, b"format: WARC File Format 1.1\r\n")))
                    size += out.write(member(page_record(*[v.as_py() for v in row])))
                    if size >= self.archive_bytes:
                        out.close()
                        out = done.append((name, size))
        finally:
            if out is not None:
                out.close()
                done.append((name, size))
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = folder(self.path)
        system.create_dir(root)
        listed = sorted(a for m in messages if m for a in m.archives)
        with system.open_output_stream(f"{root}/{COMMITTED}") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, root = folder(self.path)
        for m in messages:
            for name, _ in m.archives if m else ():
                system.delete_file(f"{root}/{name}")


class Broken(ValueError):
    pass


def members(source, block: int = BLOCK) -> Iterator[tuple[int, Iterator[bytes]]]:
    """Place of every gzip member in the stream, and its bytes piece by piece; take all of one before the next."""
    waiting, place = source.read(block), 0
    while waiting:
        state = {"used": 0, "left": waiting}

        def pieces(state: dict = state) -> Iterator[bytes]:
            unpack = zlib.decompressobj(31)
            data, state["left"] = state["left"], b""  # of a broken member nothing is left
            while not unpack.eof:
                if not data:
                    data = source.read(block)
                    if not data:
                        raise Broken("the archive ends inside a record")
                try:
                    piece = unpack.decompress(data, block)  # at most so much of what may be far longer
                except zlib.error as e:
                    raise Broken(f"not a gzip member: {e}") from e
                rest = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
                state["used"] += len(data) - len(rest)
                data = rest
                if piece:
                    yield piece
            state["left"] = data or source.read(block)

        yield place, pieces()
        place, waiting = place + state["used"], state["left"]


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if lines[0] not in (VERSION, b"WARC/1.0"):
        raise Broken(f"no record begins here: {lines[0][:40]!r}")
    pairs = [line.decode("utf-8", "replace").partition(":") for line in lines[1:]]
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def http_length(head: bytes) -> int | None:
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value)
    return None


class Framed:
    """The pieces of one member as header, block and end."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.left = pieces, b""

    def until_blank_line(self, most: int = 1 << 20) -> bytes:
        while BLANK_LINE not in self.left:
            piece = next(self.pieces, None)
            if piece is None or len(self.left) > most:
                raise Broken("a header without end")
            self.left += piece
        head, _, self.left = self.left.partition(BLANK_LINE)
        return head

    def exactly(self, size: int) -> Iterator[bytes]:
        while size:
            piece = self.left or next(self.pieces, None)
            if piece is None:
                raise Broken(f"{size} bytes are missing")
            self.left = piece[size:]
            yield piece[:size]
            size -= len(piece[:size])

    def ends(self) -> None:
        if self.left + b"".join(self.pieces) != BLANK_LINE:
            raise Broken("the record does not end where its length says")


def parsed(pieces: Iterator[bytes], keep_payload: bool) -> dict[str, object]:
    """One record; digests are checked as the bytes pass."""
    frame = Framed(pieces)
    head = fields_of(frame.until_blank_line())
    kind, length = head.get("warc-type", ""), int(head["content-length"])
    whole, own, kept, size = hashlib.sha1(), hashlib.sha1(), [], 0
    http: bytes | None = b"" if kind in ("response", "revisit") else None
    stated = None
    for piece in frame.exactly(length):
        whole.update(piece)
        if http is not None:  # still in the HTTP header
            http += piece
            if BLANK_LINE not in http:
                continue
            top, _, piece = http.partition(BLANK_LINE)
            stated, http = http_length(top), None
        own.update(piece)
        size += len(piece)
        if keep_payload:
            kept.append(piece)
    frame.ends()
    expected = {k: head.get(f"warc-{k}-digest", "").removeprefix("sha1:") for k in ("block", "payload")}
    if expected["block"] and expected["block"] != digest(whole.digest()):
        raise Broken("the block's digest differs")
    if kind == "response" and (expected["payload"] != digest(own.digest()) or stated != size):
        raise Broken("the payload's digest or length differs")
    number = lambda name: int(head[name]) if name in head else None
    return {
        "record_type": kind, "record_id": head.get("warc-record-id"), "page_id": number("x-page-id"), "refers_to": number("x-refers-to-page-id"),
        "url": head.get("warc-target-uri"), "payload_bytes": size if stated is None else stated, "payload_digest": expected["payload"] or None,
        "payload": b"".join(kept) if keep_payload and kind != "revisit" else None, "fault": None,
    }


def archive_rows(path: str, name: str, keep_payload: bool, keep_faults: bool) -> Iterator[dict[str, object]]:
    system, root = folder(path)
    with system.open_input_stream(f"{root}/{name}", compression=None) as source:
        place = 0
        try:
            for place, pieces in members(source):
                try:
                    row = parsed(pieces, keep_payload)
                except (Broken, ValueError, KeyError) as e:
                    if not keep_faults:
                        raise
                    for _ in pieces:  # to where the next one begins, if the member is whole
                        pass
                    row = {"fault": str(e)}
                yield {"archive": name, "place": place, **row}
        except (Broken, ValueError, KeyError) as e:
            if not keep_faults:
                raise Broken(f"{name}, from byte {place} on: {e}") from e
            yield {"archive": name, "place": place, "fault": str(e)}


@dataclass
class Archive(InputPartition):
    name: str


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, keep_payload: bool, keep_faults: bool) -> None:
        self.path, self.keep_payload, self.keep_faults = path, keep_payload, keep_faults

    def partitions(self) -> list[Archive]:
        system, root = folder(self.path)
        with system.open_input_stream(f"{root}/{COMMITTED}") as listed:
            return [Archive(name) for name, _ in json.loads(listed.read())] or [Archive("")]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        schema, rows, size = READ_ARROW, [], 0
        for row in archive_rows(self.path, partition.name, self.keep_payload, self.keep_faults) if partition.name else ():
            rows.append(row)
            size += len(row.get("payload") or b"")
            if len(rows) == 2000 or size > 1 << 24:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)


READ_ARROW = pa.schema([(part.split()[0], {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[part.split()[1]]) for part in READ.split(", ")])


class WarcSource(DataSource):
    """``spark.read.format("archive_records")``; options ``path``, ``payload`` ("keep"), ``faults`` ("keep"), ``archive_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "archive_records"

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"], self.options.get("payload") == "keep", self.options.get("faults") == "keep")

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"], int(self.options.get("archive_bytes", ARCHIVE_BYTES)))


def record_types(pages: DataFrame, work: Workspace, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The pages as records: which are kept as responses, and which refer to one."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("html"))
    mark: list[Column] = [F.sha1("html").alias("mark"), F.octet_length("html").alias("size")]
    copies = rows.where(F.octet_length("html") >= least_bytes).select("page_id", *mark).groupBy("mark", "size").agg(
        F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    several = small_side(work.save(copies.where("n > 1 and kept is not null").drop("n"), "copies"))
    joined = rows.select("*", *mark).join(several, ["mark", "size"], "left")
    refers = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return joined.select(
        "page_id", "url", "html", F.when(refers, "revisit").otherwise("response").alias("record_type"), F.when(refers, F.col("kept")).alias("refers_to"))


def write_archives(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write rows of ``record_types`` to archives in a folder that driver and executors share."""
    spark = records.sparkSession
    ship_package(spark)
    spark.dataSource.register(WarcSource)
    records.write.format(WarcSource.name()).mode("append").option("archive_bytes", archive_bytes).save(path)


def read_archives(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """All records of the archives that ``write_archives`` has committed there."""
    ship_package(spark)
    spark.dataSource.register(WarcSource)
    return spark.read.format(WarcSource.name()).options(**options).load(path)


SQL = """
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS mark FROM pages
), kept AS (
    SELECT mark, max(page_id) AS newest FROM hashed GROUP BY mark
)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda j:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((('0x' || substr(mark, 5 * i + 1, 5))::BIGINT >> (15 - 5 * j)) & 31)::INTEGER + 1, 1)), '')), '') AS payload_digest,
    CASE WHEN page_id IS DISTINCT FROM newest AND newest IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM hashed JOIN kept USING (mark)
"""


@query("op11_warc", SQL)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "warc")
    write_archives(record_types(read(spark, sf_dir, "pages").select("page_id", "url", "html"), work), f"{work.root}/archives")
    return read_archives(spark, f"{work.root}/archives").where("record_type in ('response', 'revisit')").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
