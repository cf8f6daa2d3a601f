"""JSON documents of any size: written by many tasks, and read by many.

Writing: every task writes a piece, one record a line. The commit on the driver puts the pieces in the order of
the tasks and adds brackets and commas as small files between them, so that the files one after the other,
by name, are one JSON array or object; ``joined`` makes one file of them. Pieces of lost or repeated
tasks are never named by the commit.

Reading a document keyed by id: the file is dealt out in ranges of bytes. A first pass tells for every range how
it changes the depth of brackets and whether it ends inside a string, whatever state it begins in; from that
the state at the start of each range follows. In the second pass every task reads the entries that begin in its
range, to their ends.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..schemas import ddl
from ..shared_store import ship_package
from .stores import store

ENDS = {"array": ("[\n", "\n]\n"), "object": ("{\n", "\n}\n"), "record": ("", "\n")}
BETWEEN = ",\n"
BLOCK = 1 << 20
RANGE = 64 << 20
MANY_RANGES = 256  # small ranges grow rather than being more, up to RANGE


# --- writing ---------------------------------------------------------------------------------


@dataclass
class Piece(WriterCommitMessage):
    task: int
    name: str
    records: int


class PieceWriter(DataSourceArrowWriter):
    def __init__(self, path: str, kind: str) -> None:
        self.path, self.kind = path, kind

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Piece:
        at, task, records = store(self.path), TaskContext.get().partitionId(), 0
        at.system.create_dir(at.place)
        name = f"_piece-{uuid.uuid4().hex}"
        with at.system.open_output_stream(f"{at.place}/{name}") as out:
            for batch in iterator:
                for text in batch.column(0).to_pylist():
                    out.write(((BETWEEN if records else "") + text).encode())
                    records += 1
        return Piece(task, name, records)

    def commit(self, messages: list[Piece | None]) -> None:
        at = store(self.path)
        at.system.create_dir(at.place)
        for _, system, old in list(at.files(".json")):
            system.delete_file(old)
        done = sorted((m for m in messages if m), key=lambda m: m.task)
        number = 0

        def glue(text: str) -> None:
            nonlocal number
            with at.system.open_output_stream(f"{at.place}/part-{number:07d}.json") as out:
                out.write(text.encode())
            number += 1

        begin, end = ENDS[self.kind]
        glue(begin)
        first = True
        for m in done:
            if not m.records:
                at.system.delete_file(f"{at.place}/{m.name}")
                continue
            if not first:
                glue(BETWEEN)
            at.system.move(f"{at.place}/{m.name}", f"{at.place}/part-{number:07d}.json")
            first, number = False, number + 1
        glue(end)

    def abort(self, messages: list[Piece | None]) -> None:
        at = store(self.path)
        for m in messages:
            if m:
                at.system.delete_file(f"{at.place}/{m.name}")


class JsonDocument(DataSource):
    """``df.write.format("json_document")`` for one column of record texts; options ``path``, ``kind``."""

    @classmethod
    def name(cls) -> str:
        return "json_document"

    def writer(self, schema, overwrite: bool) -> PieceWriter:
        return PieceWriter(self.options["path"], self.options["kind"])


def _written(texts: DataFrame, path: str, kind: str) -> None:
    spark = texts.sparkSession
    ship_package(spark)
    spark.dataSource.register(JsonDocument)
    texts.write.format(JsonDocument.name()).mode("append").option("kind", kind).save(path)


def _text(record: Column) -> Column:
    return F.to_json(record, {"ignoreNullFields": "false"})


def write_json_array(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """Rows as one JSON array, in order over all pieces, NULL fields kept; replaces what is there."""
    rows = df.orderBy(*order) if order else df
    _written(rows.select(_text(F.struct(*df.columns)).alias("value")), path, "array")


def write_json_by_key(df: DataFrame, path: str, key: str, value: Column | None = None) -> None:
    """Rows as one JSON object keyed by ``key``; the value is the other columns, or ``value``."""
    held = F.struct(*[c for c in df.columns if c != key]) if value is None else value
    name = F.regexp_extract(F.to_json(F.array(F.col(key).cast("string"))), r"(?s)^\[(.*)\]$", 1)
    keyed = df.where(F.col(key).isNotNull()).orderBy(key)
    _written(keyed.select(F.concat(name, F.lit(": "), _text(held)).alias("value")), path, "object")


def write_json_record(df: DataFrame, path: str) -> None:
    """A one-row extract as one JSON object."""
    if len(df.take(2)) != 1:
        raise ValueError("an object extract has exactly one row")
    _written(df.select(_text(F.struct(*df.columns)).alias("value")), path, "record")


def joined(spark: SparkSession, folder: str, target: str) -> None:
    """One file of the pieces, copied in blocks by a single task; whoever needs a file pays for one."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_at = store(target)
            beside = f"{out_at.place}.{uuid.uuid4().hex}.new"
            with out_at.system.open_output_stream(beside) as out:
                for _, system, place in store(folder).files(".json"):
                    with system.open_input_stream(place) as piece:
                        while block := piece.read(BLOCK):
                            out.write(block)
            out_at.system.move(beside, out_at.place)
            yield batch

    spark.range(1).coalesce(1).mapInArrow(run, "id long").collect()


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of an array that ``write_json_array`` wrote, by as many tasks as its lines need."""
    lines = spark.read.text(path, pathGlobFilter="part-*.json").where(~F.col("value").isin("", "[", "]", ","))
    return lines.select(F.from_json(F.regexp_replace("value", ",$", ""), ddl(schema), {"mode": "FAILFAST"}).alias("r")).select("r.*")


# --- reading a document keyed by id ------------------------------------------------------------

OUTSIDE, INSIDE, ESCAPED = 0, 1, 2  # a byte stands outside strings, inside one, or after its backslash
_BODY = rb'[^"\\]*(?:\\.[^"\\]*)*'
BODY = re.compile(_BODY, re.S)
STRING = re.compile(rb'"' + _BODY + rb'"', re.S)
TOKEN = re.compile(rb'"' + _BODY + rb'"|[][{},"]', re.S)
# inside an entry only the next bracket counts that does not belong to an object without others in it
_PLAIN = rb'[^]["{}]*+(?:"' + rb'[^"\\]*+(?:\\.[^"\\]*+)*+' + rb'"[^]["{}]*+)*+'
DEEP = re.compile(_PLAIN + rb'(?:\{' + _PLAIN + rb'\}' + _PLAIN + rb')*+([]["{}])', re.S)


def state_after(block: bytes, state: int) -> tuple[int, int]:
    """State behind the block, and how many brackets more it opens than it closes."""
    at = 0
    if state != OUTSIDE:
        at = BODY.match(block, 1 if state == ESCAPED else 0).end()
        if at >= len(block):
            return INSIDE, 0
        if block[at : at + 1] == b"\\":
            return ESCAPED, 0
        at += 1
    bare = STRING.sub(b"", block[at:])
    outside, quote, rest = bare.partition(b'"')
    depth = sum(outside.count(c) for c in (b"{", b"[")) - sum(outside.count(c) for c in (b"}", b"]"))
    if not quote:
        return OUTSIDE, depth
    return (INSIDE if BODY.match(rest).end() == len(rest) else ESCAPED), depth


def range_states(source, start: int, stop: int) -> tuple[list[int], list[int]]:
    """For each state at the start of a range: the state at its end, and the change of depth."""
    source.seek(start)
    states, depths, left = [OUTSIDE, INSIDE, ESCAPED], [0, 0, 0], stop - start
    while left > 0:
        block = source.read(min(BLOCK, left))
        if not block:
            break
        left -= len(block)
        found = {s: state_after(block, s) for s in set(states)}
        depths = [d + found[s][1] for d, s in zip(depths, states, strict=True)]
        states = [found[s][0] for s in states]
    return states, depths


def range_entries(source, start: int, stop: int, state: int, depth: int) -> Iterator[bytes]:
    """Texts ``"key": value`` of the entries that begin in a range."""
    source.seek(start)
    data, base, at, entry = b"", start, 0, None  # data begins at byte ``base`` of the file; ``at`` is where to go on
    more = BLOCK
    while True:
        block = source.read(more)
        keep = at if entry is None else entry - base
        data, base, at = data[keep:] + block, base + keep, at - keep
        more = max(BLOCK, len(data))  # so that a long entry is not looked through again and again
        if state != OUTSIDE:
            at = BODY.match(data, at + (1 if state == ESCAPED else 0)).end() if data else 0
            if at >= len(data) or data[at : at + 1] == b"\\":
                if not block:
                    raise ValueError("the document ends inside a string")
                at, state = (at, INSIDE) if at <= len(data) else (len(data), INSIDE)
                continue
            at, state = at + 1, OUTSIDE
        while m := DEEP.match(data, at) if depth > 1 else TOKEN.search(data, at):
            begin = m.start(m.lastindex or 0)
            token, place = data[begin : m.end()], base + begin
            if token == b'"':  # a string whose end is not read yet
                at = begin
                break
            at = m.end()
            if len(token) > 1:
                continue
            if token in b"{[":
                if depth == 0 and token == b"[":
                    raise ValueError("the document is an array, not an object keyed by id")
                depth += 1
                if depth == 1 and place < stop:
                    entry = place + 1
            elif token in b"}]" or depth == 1:
                depth -= token in b"}]"
                if depth > (token == b","):
                    continue
                if entry is not None and (text := data[entry - base : begin].strip()):
                    yield text
                entry = place + 1 if token == b"," and place < stop else None
                if place >= stop:
                    return
        else:
            at = len(data)
        if not block:
            if entry is not None and data[entry - base :].strip():
                raise ValueError("the document ends inside an entry")
            return
        if entry is None and base + at >= stop and depth != 1:
            return


def key_and_value(text: bytes) -> tuple[str, str]:
    key = STRING.match(text)
    value = text[key.end() :].lstrip() if key else b""
    if value[:1] != b":":
        raise ValueError(f"not an entry: {text[:40]!r}")
    return json.loads(key.group()), value[1:].strip().decode()


def read_json_by_id(spark: SparkSession, path: str, value_schema: str, range_bytes: int = RANGE) -> DataFrame:
    """Files holding one JSON object keyed by id, as (id, value) rows; a missing file is an empty table."""
    ship_package(spark)
    found = store(path)
    files = [(f"{path.rstrip('/')}/{name}".rstrip("/"), system.get_file_info(place).size) for name, system, place in found.files()]
    width = max(range_bytes, min(RANGE, sum(size for _, size in files) // MANY_RANGES))
    ranges = [(f, a, min(a + width, size)) for f, size in files for a in range(0, size, width)]
    kind = f"STRUCT<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in ddl(value_schema))}>"
    if not ranges:
        return spark.createDataFrame([], f"id STRING, value {kind}")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = store(r["file"])
                with at.system.open_input_file(at.place) as source:
                    states, depths = range_states(source, r["start"], r["stop"])
                yield pa.RecordBatch.from_pylist([{**r, "states": states, "depths": depths}], schema=LOOKED)

    dealt = spark.createDataFrame(ranges, "file STRING, start BIGINT, stop BIGINT").repartition(len(ranges))
    looked = dealt.mapInArrow(look, "file STRING, start BIGINT, stop BIGINT, states ARRAY<INT>, depths ARRAY<BIGINT>")
    known, now = [], {}
    for r in sorted(looked.collect(), key=lambda r: (r["file"], r["start"])):  # one row a range; a sort by Spark would look twice
        state, depth = now.get(r["file"], (OUTSIDE, 0))
        known.append((r["file"], r["start"], r["stop"], state, depth))
        now[r["file"]] = (r["states"][state], depth + r["depths"][state])
    for file, (state, depth) in now.items():
        if (state, depth) != (OUTSIDE, 0):
            raise ValueError(f"{file} is not a whole JSON document")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = store(r["file"])
                with at.system.open_input_file(at.place) as source:
                    held: list[tuple[str, str]] = []
                    for text in range_entries(source, r["start"], r["stop"], r["state"], r["depth"]):
                        held.append(key_and_value(text))
                        if len(held) == 500:
                            yield _rows(held)
                            held = []
                    yield _rows(held)

    cut = spark.createDataFrame(known, "file STRING, start BIGINT, stop BIGINT, state INT, depth BIGINT").repartition(len(known))
    texts = cut.mapInArrow(entries, "id STRING, text STRING")
    return texts.select("id", F.from_json("text", ddl(value_schema), {"mode": "FAILFAST"}).alias("value"))


LOOKED = pa.schema([("file", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("states", pa.list_(pa.int32())), ("depths", pa.list_(pa.int64()))])


def _rows(held: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.string()), pa.array([v for _, v in held], pa.string())], ["id", "text"])
