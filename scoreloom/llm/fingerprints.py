"""Document fingerprints by context-triggered piecewise hashing.

A hash of the last eight bytes decides where a text is cut, so cuts depend on the text around them
alone and an edit moves only the cuts near it. Each piece gives a 12-bit symbol; the fingerprint is
``blocksize:symbols:symbols at twice the block size``. Two fingerprints are compared at block sizes
that both have, by the edit distance of their symbols.

Defined results: null and empty texts have the fingerprint ``4::``, like each other (1.0) and unlike
all else (0.0); equal texts have equal fingerprints; whole texts are read, whatever their length;
equal ids, nulls included, follow each other in the order of a 64-bit hash of their texts; the document
after the last is the first. Ranges are cut by id, hash and number of the row, so that an id or a whole
row that is repeated very often fills many ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared_store import Workspace, ship_package
from .registry import query, read

LEAST_BLOCK = 4
MOST_PIECES = 64  # pieces of a fingerprint; what follows belongs to the last
CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
MIX = np.uint64(0x9E3779B97F4A7C15)


def triggers(text: bytes) -> np.ndarray:
    """For each byte, a 32-bit hash of it and the seven before it."""
    padded = np.frombuffer(b"\0" * 7 + text, np.uint8)
    window = np.lib.stride_tricks.sliding_window_view(padded, 8)
    words = np.ascontiguousarray(window).view("<u8").ravel()
    mixed = (words ^ (words >> np.uint64(29))) * MIX
    return ((mixed ^ (mixed >> np.uint64(32))) * MIX) >> np.uint64(32)


def symbols(text: bytes, cuts: np.ndarray) -> str:
    ends = [*(cuts[: MOST_PIECES - 1] + 1).tolist()]
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
    out, start = [], 0
    for end in ends:
        h = xxhash.xxh3_64_intdigest(text[start:end]) & 4095
        out.append(CHARS[h >> 6] + CHARS[h & 63])
        start = end
    return "".join(out)


def fingerprint(text: bytes) -> str:
    if not text:
        return f"{LEAST_BLOCK}::"
    hashes = triggers(text)
    block = LEAST_BLOCK
    while block < len(text) // MOST_PIECES:
        block *= 2
    at = lambda b: np.flatnonzero(hashes < (1 << 32) // b)
    cuts = at(block)
    while len(cuts) >= MOST_PIECES and block < 1 << 30:
        block *= 2
        cuts = at(block)
    while block > LEAST_BLOCK and len(finer := at(block // 2)) < MOST_PIECES:
        block, cuts = block // 2, finer
    return f"{block}:{symbols(text, cuts)}:{symbols(text, at(2 * block))}"


def edit_distance(a: list[str], b: list[str]) -> int:
    """Levenshtein distance, a column of the table at a time in the bits of an integer."""
    if not a or not b:
        return max(len(a), len(b))
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = full, 0, len(a)
    for y in b:
        equal = places.get(y, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        right_up, right_down = down | ~(diagonal | up) & full, up & diagonal
        distance += bool(right_up & top) - bool(right_down & top)
        right_up, right_down = (right_up << 1 | 1) & full, right_down << 1 & full
        up, down = right_down | ~(diagonal | right_up) & full, right_up & diagonal
    return distance


def likeness(a: str, b: str) -> float:
    """0 to 1: the share of symbols that need no edit, at the best block size both have."""
    if a == b:
        return 1.0
    both = []
    (size_a, *of_a), (size_b, *of_b) = a.split(":"), b.split(":")
    for i, x in enumerate(of_a):
        for j, y in enumerate(of_b):
            if x and y and int(size_a) << i == int(size_b) << j:
                left, right = [x[k : k + 2] for k in range(0, len(x), 2)], [y[k : k + 2] for k in range(0, len(y), 2)]
                if not set(left).isdisjoint(right):
                    both.append(1 - edit_distance(left, right) / max(len(left), len(right)))
    return max(both, default=0.0)


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by the beginning of another."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def compared(doc_id, text: str, print_: str, following: str, next_print: str) -> tuple:
    changed = edited(text, following).encode("utf-8", "surrogatepass")
    changed_print = fingerprint(changed)
    return (doc_id, len(text), text, hashlib.sha256(changed).hexdigest(), print_, changed_print, likeness(print_, changed_print), likeness(print_, next_print))


def with_next(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Texts are sorted over the cluster once, and each task walks its range in order. Only the first and
    last rows of the ranges meet outside their task, joined by the number of the range.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"text_hash": F.xxhash64("text"), "row_no": F.monotonically_increasing_id()})
    columns = ["doc_id", "n_chars", "text", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "range", "place"]
    schema = f"doc_id {kind}, n_chars long, text string, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, range int, place string"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, kind = TaskContext.get().partitionId(), None, None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for at in range(0, batch.num_rows, 500):
                out, some = [], batch.slice(at, 500)
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist(), strict=True):
                    print_ = fingerprint(text.encode("utf-8", "surrogatepass"))
                    if before is None:
                        out.append((doc_id, len(text), text, None, print_, None, None, None, part, "first"))
                    else:
                        done = compared(*before, text, print_)
                        out.append((*done[:2], None, *done[3:], part, "done"))
                    before = doc_id, text, print_
                yield frame(out, kind)
        if before is not None:
            doc_id, text, print_ = before
            yield frame([(doc_id, len(text), text, None, print_, None, None, None, part, "last")], kind)

    def frame(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        text, number = pa.string(), pa.float64()
        types = [kind, pa.int64(), text, text, text, text, number, number, pa.int32(), text]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], columns)

    order = ["doc_id", "text_hash", "row_no"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    walked = work.save(ordered.mapInArrow(walk, schema), "walked")
    firsts = walked.where("place = 'first'")
    # one number per range: which range comes after it; the first after the last
    numbered = Window.orderBy("range")
    after = firsts.select("range").withColumn("next", F.lead("range").over(numbered)).withColumn(
        "next", F.coalesce("next", F.min("range").over(Window.partitionBy())))
    seams = (
        walked.where("place = 'last'").select("doc_id", "text", "fingerprint", "range")
        .join(after, "range").join(firsts.select(F.col("range").alias("next"), F.col("text").alias("following"), F.col("fingerprint").alias("next_print")), "next")
        .select("doc_id", "text", "fingerprint", "following", "next_print")
    )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [compared(*r.values()) for r in batch.to_pylist()]
            yield frame([(*r[:2], None, *r[3:], 0, "done") for r in made], batch.schema.field("doc_id").type)

    return walked.where("place = 'done'").unionByName(seams.mapInArrow(close, schema)).drop("text", "range", "place")


@query("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return with_next(docs, Workspace(spark, "fingerprints")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
