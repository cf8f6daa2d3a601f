"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record is hashed into one of ``SLOTS`` slots for good. Bytes are summed per slot, and the map
from slots to shards, a table of ``SLOTS`` rows per version, is edited until the shards' bytes
are near equal. Only the map changes when shards are added or weights move; records never hash
anew, and unmoved slots stay where they are.

An id that many records share would fill a slot that no map can divide. Where the records of one
key outweigh half a mean slot, in bytes or in number, they are spread over all slots by the row
number stored with them; at most four such keys per slot can exist, so their list is bounded.

Defined results: a null id hashes by the record's text, a null text has no bytes, an empty table
gives an empty result, further columns are left out and may have any names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared_store import Workspace
from .registry import query, read

SLOTS = 8192
ROW_OVERHEAD = 16
MAP_SCHEMA = "version INT, vslot INT, shard INT, first_place BIGINT"


def slotted(records: DataFrame, id_col: str, text_col: str, slots: int = SLOTS) -> DataFrame:
    """One narrow row per record: id, size, checksum of the text, key, number of the row, virtual slot."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    key = F.xxhash64(F.col(id_col), F.when(F.col(id_col).isNull(), F.col(text_col)))
    return records.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        key.alias("key"),
        F.monotonically_increasing_id().alias("row_no"),
        F.pmod(key, F.lit(slots)).cast("int").alias("vslot"),
    )


def slot_weights(rows: DataFrame) -> DataFrame:
    """Bytes and rows per slot: at most ``SLOTS`` rows, summed before the shuffle."""
    return rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def totals(rows: DataFrame, slots: int) -> tuple[np.ndarray, np.ndarray]:
    weight, count = np.zeros(slots), np.zeros(slots, np.int64)
    for r in slot_weights(rows).collect():  # at most SLOTS rows
        weight[r["vslot"]], count[r["vslot"]] = r["bytes"], r["rows"]
    return weight, count


def hot_keys(rows: DataFrame, weight: np.ndarray, count: np.ndarray) -> DataFrame | None:
    """Keys of several records that outweigh half a mean slot; None where no slot is heavy.

    Only records of slots of over twice the mean are counted, per key and before the shuffle.
    """
    bytes_, number = weight.mean(), count.mean()
    heavy = np.flatnonzero((weight > 2 * bytes_) | (count > 2 * number))
    if not len(heavy):
        return None
    keys = rows.where(F.col("vslot").isin(heavy.tolist())).groupBy("key").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return keys.where(
        (F.col("rows") > 1) & ((F.col("bytes") > float(bytes_ / 2)) | (F.col("rows") > float(number / 2)))
    ).select("key")


def spread(rows: DataFrame, keys: DataFrame, slots: int) -> DataFrame:
    """Deal the records of the listed keys over all slots, by the stored number of the row."""
    listed = keys.withColumn("hot", F.lit(True))  # at most four keys per slot
    dealt = F.pmod(F.xxhash64("key", "row_no"), F.lit(slots)).cast("int")
    return rows.join(F.broadcast(listed), "key", "left").withColumn(
        "vslot", F.when(F.col("hot"), dealt).otherwise(F.col("vslot"))).drop("hot")


def even_map(slots: int, shards: int) -> np.ndarray:
    """First version of a map: slots dealt out in turn."""
    return np.arange(slots) % shards


def rebalance(owner: np.ndarray, weight: np.ndarray, shards: int) -> np.ndarray:
    """Edit a map: move or swap slots between the heaviest and the lightest shard.

    Each step takes the slot, or pair of slots, that comes closest to halving the gap. It ends
    when no such step narrows the gap; most slots keep their shard. The work depends on the
    fixed number of slots alone.
    """
    owner, load = owner.copy(), np.bincount(owner, weight, shards)
    for _ in range(4 * len(owner)):
        light = int(load.argmin())
        for heavy in np.argsort(-load, kind="stable")[: shards - 1]:
            gap = load[heavy] - load[light]
            if gap <= 0:
                return owner
            mine = np.flatnonzero((owner == heavy) & (weight > 0))
            other = np.flatnonzero(owner == light)
            other = other[np.argsort(weight[other], kind="stable")]
            have = np.concatenate([[0.0], weight[other]])  # first: a plain move
            order = np.argsort(have, kind="stable")
            at = np.searchsorted(have[order], weight[mine] - gap / 2)
            best = None
            for near in (at - 1, at):
                pick = order[np.clip(near, 0, len(have) - 1)]
                moved = weight[mine] - have[pick]
                off = np.where((moved > 0) & (moved < gap), np.abs(moved - gap / 2), np.inf)
                if len(off) and (best is None or off.min() < best[0]):
                    k = int(off.argmin())
                    best = (off[k], mine[k], pick[k], moved[k])
            if best is not None and np.isfinite(best[0]):
                _, out, back, moved = best
                owner[out] = light
                if back:
                    owner[other[back - 1]] = heavy
                load[heavy] -= moved
                load[light] += moved
                break
        else:
            return owner
    return owner


def map_version(spark: SparkSession, version: int, owner: np.ndarray, rows: np.ndarray) -> DataFrame:
    """A version of the map as a table; ``first_place`` is where a slot's rows begin in its shard."""
    start = np.zeros(len(owner), np.int64)
    for shard in np.unique(owner):
        own = np.flatnonzero(owner == shard)
        start[own] = np.cumsum(rows[own]) - rows[own]
    table = [(version, i, int(s), int(p)) for i, (s, p) in enumerate(zip(owner, start, strict=True))]
    return spark.createDataFrame(table, MAP_SCHEMA).coalesce(1)


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Give each record its shard and its place there, gapless from 0.

    Rows are numbered within a virtual slot, which holds one part in ``SLOTS`` of the records, and
    follow the slot's first place; no task numbers a whole shard.
    """
    within = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "row_no")
    mapped = rows.join(F.broadcast(slot_map), "vslot")  # the map has SLOTS rows
    return mapped.withColumn("slot", F.col("first_place") + F.row_number().over(within) - 1)


def shard_by_bytes(
    records: DataFrame, shards: int, work: Workspace, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS,
) -> DataFrame:
    """Near equal bytes per shard; both map versions are stored in the workspace."""
    spark = records.sparkSession
    rows = work.save(slotted(records, id_col, text_col, slots), "slotted")
    weight, count = totals(rows, slots)
    keys = hot_keys(rows, weight, count)
    if keys is not None and (keys := work.save(keys.coalesce(1), "hot_keys")).take(1):
        rows = spread(rows, keys, slots)
        weight, count = totals(rows, slots)
    first = even_map(slots, shards)
    edited = rebalance(first, weight, shards)
    versions = map_version(spark, 1, first, count).unionByName(map_version(spark, 2, edited, count))
    stored = work.save(versions.coalesce(1), "slot_map")
    return placed(rows, stored.where("version = 2"))


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_by_bytes(docs, 40, Workspace(spark, "shards")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", F.col("version").alias("map_version"),
    )
