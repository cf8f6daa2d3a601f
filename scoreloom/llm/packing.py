"""Best-fit packing by hierarchical residual merging.

Documents become pieces of at most ``capacity`` tokens. Groups of pieces are packed best-fit (largest
first, each into the fullest sequence with room). Nearly full sequences, and those into which
nothing that is left can fit, are emitted; the underfull ones go up a tree, where the groups of
several children meet and their sequences are packed again as whole items, until one group or a
bounded number of rows per group is left.

Defined results: null and empty texts are one piece holding the end token; repeated rows are packed
each on its own; equal lengths are taken in stored order; an empty table gives no pieces; other
columns are ignored. A document longer than ``capacity`` is cut into full pieces and a rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared_store import Workspace, ship_package
from .bpe import REMEMBERED, VOCABULARY, encoder, forget_encoders, slices, vocabulary_path
from .registry import query, read

CAPACITY = 4096
END_TOKEN = 1
GROUP_ROWS = 20_000  # pieces packed together at the leaves
MOST_ROWS = 200_000  # and at inner nodes of the tree at most
FAN_IN = 8
NEARLY = 256  # a sequence that lacks at most 1/NEARLY of the capacity is emitted


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text",
    remembered: int = REMEMBERED, forget: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, checksum of its ids, and the row's number.

    ``remembered`` bounds what a worker keeps of encoded text; it changes memory and speed only,
    as does ``forget``, which frees the encoder after every partition.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    end, width = END_TOKEN.to_bytes(4, "little"), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary_path(vocabulary), remembered)
        for whole in batches:
            for batch in slices(whole):
                who, piece, length, crc = [], [], [], []
                for i, ids in enumerate(encode.many(batch.column("text"))):
                    ids += end
                    for k, first in enumerate(range(0, len(ids), width)):
                        part = ids[first : first + width]
                        who.append(i)
                        piece.append(k)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                number = np.array(piece, np.int64)
                columns = {
                    "doc_id": batch.column("doc_id").take(pa.array(who, pa.int64())), "piece": number.astype(np.int32), "start": number * capacity,
                    "length": np.array(length, np.int64), "ids_crc32": np.array(crc, np.int64),
                }
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))
        if forget:
            forget_encoders()

    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long").withColumn(
        "item", F.monotonically_increasing_id())


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each item, largest items first, each into the fullest with room."""
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    open_by_room: dict[int, list[int]] = {}
    rooms, made = 0, 0  # bit r is set if some sequence has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = open_by_room[room]
            s = at.pop()
            if not at:
                rooms ^= 1 << room
        else:
            room, s, made = capacity, made, made + 1
        sequence[i], offset[i] = s, capacity - room
        if room > size:
            at = open_by_room.setdefault(room - size, [])
            at.append(s)
            rooms |= 1 << (room - size)
    return sequence, offset


def pack_group(rows: pa.Table, capacity: int, level: int, smallest: int, last: bool) -> pa.Table:
    """Pack the items of one group; rows of an item keep their places relative to it."""
    codes, _ = pd.factorize(rows.column("item").to_numpy())
    length = rows.column("length").to_numpy()
    sizes = np.bincount(codes, length).astype(np.int64)
    sequence, base = best_fit(sizes, capacity)
    room = capacity - np.bincount(sequence, sizes).astype(np.int64)
    done = (room <= capacity // NEARLY) | (room < smallest) | last
    own = sequence[codes]
    new = {
        "item": (np.int64(level) << 56) + (rows.column("grp").to_numpy() << 24) + own,
        "offset": rows.column("offset").to_numpy() + base[codes], "done": done[own],
    }
    names = [*rows.column_names, "done"]
    return pa.table([pa.array(new[c]) if c in new else rows.column(c) for c in names], names)


def group_packer(*settings: int) -> Callable[[pa.Table], pa.Table]:
    return lambda rows: pack_group(rows, *settings)


def pack(items: DataFrame, work: Workspace, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, most_rows: int = MOST_ROWS) -> DataFrame:
    """Give every piece a sequence and its offset there. ``items`` has a unique long ``item`` per row."""
    rows, smallest = items.agg(F.count(F.lit(1)), F.min("length")).first()
    groups = max(1, -(-rows // group_rows))
    spread = F.pmod(F.xxhash64("item"), F.lit(groups))
    left = items.withColumn("offset", F.lit(0).cast("long")).withColumn("grp", spread.cast("long"))
    level, finished = 0, None
    while True:
        last = groups == 1
        run = group_packer(capacity, level, int(smallest or 0), last)
        packed = left.repartition(groups, "grp").groupBy("grp").applyInArrow(run, left.withColumn("done", F.lit(True)).schema)
        stored = work.save(packed, f"level{level}")
        emitted = stored.where("done")
        finished = emitted if finished is None else finished.unionByName(emitted)
        left = stored.where("not done").drop("done")
        if last:
            break
        fills = left.groupBy("item").agg(F.sum("length").alias("fill"), F.count(F.lit(1)).alias("n"))
        smallest, rows = fills.agg(F.min("fill"), F.sum("n")).first()
        if not rows:
            break
        fewer = max(-(-groups // FAN_IN), -(-rows // most_rows))
        if fewer >= groups:  # groups cannot be made fewer within the bound: what is open stays so
            finished = finished.unionByName(left.withColumn("done", F.lit(True)))
            break
        left = left.withColumn("grp", F.pmod("grp", F.lit(fewer)).cast("long"))
        groups, level = fewer, level + 1
    return finished.withColumnRenamed("item", "sequence_id").drop("grp", "done")


def packed_documents(docs: DataFrame, work: Workspace, capacity: int = CAPACITY, remembered: int = REMEMBERED, forget: bool = False) -> DataFrame:
    return pack(work.save(pieces(docs, capacity, remembered=remembered, forget=forget), "pieces"), work, capacity)


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return packed_documents(docs, Workspace(spark, "packing")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
