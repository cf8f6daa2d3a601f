"""Line dedup by a deletion-neighbourhood join.

A line is its words, A-Z taken as a-z. Two lines of at least ``LEAST_WORDS`` words are alike if at most
one word is replaced, inserted or missing; shorter ones only if they are equal. A line goes if it
occurs again, or is like a line that comes earlier, by document id, then place in the document.

1. Equal lines are grouped by 128-bit hash; the earliest place stays.
2. Lines that are alike share their first or their last half of words. Different lines that share such
   a half, counted by hash, are the only ones that go on; nothing alike is lost.
3. Of these, every variant with one word deleted is emitted as a hash with the place of the deletion.
   Equal variants with equal places are lines with one word replaced; a variant that equals a whole
   line is one with a word more. Only the earliest line of each key is linked to, so a key of any size
   is an aggregate, never pairs. Links are verified by edit distance on the words.

Defined results: null and empty texts and lines without words are never dropped; null ids come last;
equal ids are told apart by the text, equal rows are one document written twice and treated alike;
an empty table gives no rows; other columns pass through under their names. A document whose lines
are all dropped has an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from ..shared_store import Workspace, ship_package
from .near_dup import chunks, mixed, text_key, word_hashes
from .passing import tidy, veiled
from .registry import query, read
from .sides import maybe_among, sieved, small_side

LEAST_WORDS = 8
_random = np.random.default_rng(33)
BASES = _random.integers(1, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WHOLE = -1  # place of a variant from which nothing is deleted


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(max(1, n), np.uint64)
    out[1:] = base
    return np.cumprod(out, dtype=np.uint64)


def segments(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every segment, and the place of every element inside its own."""
    start = np.cumsum(counts) - counts
    return start, np.arange(int(counts.sum())) - np.repeat(start, counts)


def summed(values: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[stop] - total[first]


def line_keys(lines: list[bytes], least_words: int) -> dict[str, np.ndarray]:
    """Number of words, two hashes, and the keys of the halves (0 if there are none)."""
    words, count = word_hashes(lines)
    start, place = segments(count)
    stop, longest = start + count, int(count.max(initial=0))
    n = count.astype(np.uint64)
    forward = [words * powers(b, longest)[place] for b in BASES]
    backward = words * powers(BASES[0], longest)[np.repeat(count, count) - 1 - place]
    out = {"words": count, **{f"h{k + 1}": mixed(mixed(summed(f, start, stop)) + n) for k, f in enumerate(forward)}}
    halves = []
    for half in (count // 2, (count - 1) // 2):
        half = np.maximum(0, half)
        ahead = summed(forward[0], start, start + half)
        behind = summed(backward, stop - half, stop)
        for side, value in ((0, ahead), (1, behind)):
            key = mixed(mixed(value) + 2 * half.astype(np.uint64) + np.uint64(side)) | np.uint64(1)
            halves.append(np.where(count >= least_words, key, np.uint64(0)))
    same = (count // 2) == (count - 1) // 2  # odd: the second pair repeats the first
    halves[2:] = [np.where(same, np.uint64(0), x) for x in halves[2:]]
    return out | {"halves": np.stack(halves, 1)}


def variants(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, place of the deleted word (``WHOLE``: none) and hash, for every line and deletion."""
    words, count = word_hashes(lines)
    start, place = segments(count)
    stop, power = start + count, powers(BASES[0], int(count.max(initial=0)) + 1)
    here = words * power[place]
    moved = words * power[np.maximum(place - 1, 0)]  # once an earlier word is gone
    of = np.repeat(np.arange(len(lines)), count)
    at = start[of] + place
    left = summed(here, start[of], at) + summed(moved, at + 1, stop[of])
    cut = mixed(mixed(left) + (count[of] - 1).astype(np.uint64))
    whole = mixed(mixed(summed(here, start, stop)) + count.astype(np.uint64))
    return (np.concatenate([np.arange(len(lines)), of]), np.concatenate([np.full(len(lines), WHOLE), place]),
            np.concatenate([whole, cut]))


def plain_words(line: bytes) -> list[bytes]:
    return line.lower().split()


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether at most one word is replaced, inserted or missing."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def lines_of(texts: DataFrame, least_words: int) -> DataFrame:
    """One row per line with words: id, text key, line number, word count, hashes, half keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            everything = batch.column("content").to_pylist()
            for part in chunks(everything):
                split = [t.split(b"\n") for t in everything[part]]
                count = np.array([len(x) for x in split])
                keys = line_keys([line for x in split for line in x], least_words)
                own, number = np.repeat(np.arange(len(split)), count), segments(count)[1]
                full = np.flatnonzero(keys["words"])
                rows = batch.slice(part.start, part.stop - part.start).take(pa.array(own[full]))
                halves = keys["halves"][full].view(np.int64)
                columns = {
                    **{c: rows.column(c) for c in ("doc_id", "t1", "t2")}, "line": number[full].astype(np.int32),
                    "h1": keys["h1"][full].view(np.int64), "h2": keys["h2"][full].view(np.int64),
                    **{f"k{i}": np.ascontiguousarray(halves[:, i]) for i in range(4)},
                }
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))
        tidy()

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, t1 long, t2 long, line int, h1 long, h2 long, k0 long, k1 long, k2 long, k3 long")


PLACE = ["late", "doc_id", "t1", "t2", "line"]


def alike_to_earlier(distinct: DataFrame, texts: DataFrame, work: Workspace) -> DataFrame:
    """Hashes (h1, h2) of the lines that are like an earlier, different line."""
    keys = distinct.select("h1", "h2", F.explode(F.array("k0", "k1", "k2", "k3")).alias("k")).where("k <> 0")
    # aggregates are written down before a join, so that the join can split the rows of a hot key
    shared = work.save(keys.groupBy("k").agg((F.min("h1") != F.max("h1")).alias("several")).where("several").drop("several"), "shared")
    candidates = work.save(sieved(keys, "k", shared).join(shared, "k").select("h1", "h2").distinct(), "candidate_keys")
    # sorted by place, so that ids are in the order of places
    chosen = work.save(sieved(distinct, "h1", candidates).join(candidates, ["h1", "h2"]).select("h1", "h2", *PLACE).orderBy(*PLACE).withColumn(
        "node", F.monotonically_increasing_id()), "candidates")
    wanted = work.save(chosen.groupBy("t1", "t2").agg(F.collect_list(F.struct("line", "node")).alias("wanted")), "wanted")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, found = [], []
            for text, asked in zip(batch["content"], batch["wanted"], strict=True):
                lines = text.split(b"\n")
                nodes += [w["node"] for w in asked]
                found += [lines[w["line"]] for w in asked]
            yield pd.DataFrame({"node": np.array(nodes, np.int64), "content": found})
        tidy()

    fetched = texts.select("t1", "t2", "content").join(small_side(wanted, "wanted"), ["t1", "t2"]).select("content", "wanted").mapInPandas(
        fetch, "node long, content binary")
    lines = work.save(fetched.dropDuplicates(["node"]), "lines")

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            everything, node = list(batch["content"]), batch["node"].to_numpy()
            for part in chunks(everything):
                of, place, key = variants(everything[part])
                yield pd.DataFrame({"node": node[part][of], "place": place.astype(np.int32), "v": key.view(np.int64)})
        tidy()

    emitted = work.save(lines.mapInPandas(emit, "node long, place int, v long"), "variants")
    by_place = emitted.groupBy("v", "place").agg(F.min("node").alias("alone"), F.count(F.lit(1)).alias("n"))
    of_whole = F.when(F.col("place") == WHOLE, F.col("alone"))
    of_cut = F.when(F.col("place") != WHOLE, F.col("alone"))
    by_key = by_place.groupBy("v").agg(F.min(of_whole).alias("whole"), F.min(of_cut).alias("cut"), F.sum("n").alias("n")).where("n > 1").drop("n")
    earliest = work.save(by_place.drop("n").join(by_key, "v").select("v", "place", F.when(
        F.col("place") == WHOLE, F.col("cut")).otherwise(F.least("alone", "whole")).alias("earlier")), "earliest")
    links = emitted.join(earliest, ["v", "place"]).where("earlier < node").select("node", "earlier").distinct()

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = [within_one(plain_words(a), plain_words(b)) for a, b in zip(batch["content"], batch["other"], strict=True)]
            yield batch[["node"]][ok]
        tidy()

    other = lines.select(F.col("node").alias("earlier"), F.col("content").alias("other"))
    verified = links.join(lines, "node").join(other, "earlier").mapInPandas(verify, "node long").distinct()
    return work.save(chosen.join(verified, "node").select("h1", "h2"), "alike")


def without_repeated_lines(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows with ``_kept`` (UTF-8 of the remaining lines), ``_n_lines`` and ``_n_dropped``."""
    ship_package(docs.sparkSession)
    content = F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("content")
    texts = docs.select(F.col(id_col).alias("doc_id"), *text_key(text_col), content)
    lines = work.save(lines_of(texts, least_words), "all_lines").withColumn("late", F.col("doc_id").isNull())
    distinct = work.save(lines.groupBy("h1", "h2").agg(
        F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n"), *[F.first(f"k{i}").alias(f"k{i}") for i in range(4)]
    ).select("h1", "h2", "first.*", "n", *[f"k{i}" for i in range(4)]), "distinct")
    alike = alike_to_earlier(distinct, texts, work)
    repeated = maybe_among(distinct, "h1", alike).where("n > 1 or _maybe")
    judged = work.save(repeated.join(alike.withColumn("near", F.lit(True)), ["h1", "h2"], "left").where("n > 1 or near").select(
        "h1", "h2", F.coalesce("near", F.lit(False)).alias("near"), F.struct(*PLACE).alias("first")), "judged")
    own = F.struct(*PLACE)
    dropped = sieved(lines.select("h1", "h2", *PLACE), "h1", judged).join(small_side(judged), ["h1", "h2"]).where(F.col("near") | (own != F.col("first")))
    by_doc = work.save(dropped.groupBy("doc_id", "t1", "t2").agg(F.array_sort(F.collect_set("line")).alias("dropped")), "dropped")
    rows, names, back = veiled(docs)
    keyed = rows.select("*", *text_key(names[text_col]), F.coalesce(F.col(names[text_col]).cast("binary"), F.lit(b"")).alias("content"))
    gone = small_side(by_doc, "dropped")
    same = keyed[names[id_col]].eqNullSafe(gone["doc_id"]) & (keyed["t1"] == gone["t1"]) & (keyed["t2"] == gone["t2"])
    joined = keyed.join(gone, same, "left").select(*names.values(), "content", "dropped")
    new = ["_kept", "_n_lines", "_n_dropped"]
    schema = StructType([*rows.schema.fields]).add(new[0], BinaryType()).add(new[1], LongType()).add(new[2], LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, count, gone = [], [], []
            for text, drop in zip(batch.column("content").to_pylist(), batch.column("dropped").to_pylist(), strict=True):
                have, out = text.split(b"\n"), set(drop or ())
                kept.append(text if not out else b"\n".join([x for i, x in enumerate(have) if i not in out]))
                count.append(len(have))
                gone.append(len(out))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names.values()], pa.array(kept, pa.binary()), pa.array(count, pa.int64()), pa.array(gone, pa.int64())],
                [*names.values(), *new])
        tidy()

    return back(joined.mapInArrow(run, schema), *new)


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeated_lines(docs, Workspace(spark, "lines")).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("_kept", 256).alias("kept_sha256"))
