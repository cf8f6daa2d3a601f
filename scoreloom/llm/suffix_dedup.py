"""Suffix-array dedup: remove every byte covered by a long string that also starts elsewhere.

A string of ``length`` bytes may start at any byte. Each start belongs to an anchor inside its string:
the position whose eight bytes hash lowest among those that leave room for ``key`` more bytes. Equal
strings have equal anchors at equal distances, so strings are compared only with those whose
anchors begin with the same ``key`` bytes. The bytes around an anchor, as far as its strings reach,
are its context.

1. Every text gives its anchors, equal contexts of a text as one row; those whose key occurs once are done.
2. Equal contexts are counted before anything moves. Different contexts of one key meet in a shard of
   bounded size. Its contexts, cut into pieces from the anchor on, are sorted by one suffix array
   (``lyndon_grouping``); common prefixes of neighbours and hashes of the bytes before the anchor
   then tell which starts have an equal string.
3. A key with more contexts than a shard holds is spread over many shards; what a shard cannot
   decide leaves it as one hash per different string, and these are counted over all shards.

With ``passage_words`` the same is done once more on words, each taken as the 8 bytes of its hash: what
is covered by so many words in a row that also start elsewhere goes too, whatever their length in
bytes and the white space (ASCII) between them.

Texts are UTF-8 bytes, matches stay inside one text. Defined results: null and empty texts have no
bytes and nothing removed; equal rows count as two places, so long enough copies go wholly; overlaps
count; strings are judged on the input; an empty table gives no rows; other columns pass through
under their names. Texts are told apart by 128-bit hashes.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from ..shared_store import Workspace, ship_package
from .lyndon_grouping import suffix_array
from .near_dup import chunks, word_hashes
from .passing import tidy, veiled
from .registry import query, read
from .sides import maybe_among, sieved

LENGTH = 400
KEY_BYTES = 64
PIECE_BYTES = 32
SHARD_CONTEXTS = 4000
WORD_BYTES = 8
WORD = re.compile(rb"[^ \t-\r]+")
MIX = np.uint64(0x9E3779B97F4A7C15)
Seen = Callable[[list[bytes]], list[bytes]]  # what is compared in place of the texts' bytes


def octet_hashes(codes: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, 8)).view("<u8").ravel()
    mixed = (words ^ (words >> np.uint64(31))) * MIX
    return (mixed ^ (mixed >> np.uint64(29))) * MIX


def anchors(text: bytes, length: int = LENGTH, key: int = KEY_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, and the least and greatest distance back to the starts each owns."""
    starts = len(text) - length + 1
    if starts <= 0:
        return (np.zeros(0, np.int64),) * 3
    window = length - key + 1
    hashes = octet_hashes(np.frombuffer(text, np.uint8))[: starts + window - 1]
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    blocks = -(-len(ranked) // window)
    padded = np.full((blocks + 1) * window, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(ranked)] = ranked
    table = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    lowest = np.minimum(back[:starts], ahead[window - 1 : window - 1 + starts])
    at = (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    last = np.concatenate([first[1:], [starts]]) - 1
    place = at[first]
    return place, place - last, place - first


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")]


def keyed(docs: DataFrame, text_col: str) -> DataFrame:
    content = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.withColumn("_content", content).select("*", *text_key(F.col("_content")))


def anchor_rows(texts: DataFrame, length: int, key: int, seen: Seen | None = None) -> DataFrame:
    """One row per context of every row's text: text key, its anchors' places, distances, key hash, context hash.

    A text that repeats itself has equal contexts at many places, which stay one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                held = part.column("_content").to_pylist()
                rows, places, nears, fars, keys, contexts = [], [], [], [], [], []
                for i, text in enumerate(seen(held) if seen else held):
                    place, near, far = anchors(text, length, key)
                    rows.append(np.full(len(place), i))
                    places.append(place)
                    nears.append(near)
                    fars.append(far)
                    for p, a, b in zip(place.tolist(), near.tolist(), far.tolist(), strict=True):
                        keys.append(xxhash.xxh3_64_intdigest(text[p : p + key]))
                        contexts.append(xxhash.xxh3_64_intdigest(text[p - b : p - a + length], seed=a << 20 | b))
                own, place = np.concatenate(rows), np.concatenate(places)
                hashes = [np.array(h, np.uint64).view(np.int64) for h in (keys, contexts)]
                order = np.lexsort((place, *hashes, own))
                own, near, far, k, c = (x[order] for x in (own, np.concatenate(nears), np.concatenate(fars), *hashes))
                new = np.ones(len(own), bool)
                new[1:] = (own[1:] != own[:-1]) | (k[1:] != k[:-1]) | (c[1:] != c[:-1])
                first = np.flatnonzero(new)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(own)), pa.int32()), pa.array(place[order], pa.int32()))
                texts_of = pa.array(own[first])
                yield pa.RecordBatch.from_arrays(
                    [part.column("t1").take(texts_of), part.column("t2").take(texts_of), lists, pa.array(near[first], pa.int32()),
                     pa.array(far[first], pa.int32()), pa.array(k[first]), pa.array(c[first])],
                    ["t1", "t2", "places", "near", "far", "key", "context"])
        tidy()

    return texts.select("t1", "t2", "_content").mapInArrow(
        run, "t1 long, t2 long, places array<int>, near int, far int, key long, context long")


def context_bytes(texts: DataFrame, wanted: DataFrame, stored: DataFrame, length: int, seen: Seen | None = None) -> DataFrame:
    """Fetch the bytes of the wanted contexts, rows of a stored table, from the texts that hold them."""
    by_text = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct("place", "near", "far", "key", "context", "copies", "shard", "hot")).alias("wanted"))
    content = F.col("_content")
    cut = lambda w: F.substring(content, w["place"] - w["far"] + 1, w["far"] - w["near"] + length)
    held = sieved(texts.select("t1", "t2", "_content"), "t1", stored).join(by_text, ["t1", "t2"]).select("_content", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen(batch.column("_content").to_pylist()), pa.binary()), batch.column("wanted")], ["_content", "wanted"])
        tidy()

    found = (held.mapInArrow(run, held.schema) if seen else held).select(
        F.explode(F.transform("wanted", lambda w: F.struct(
            w["key"].alias("key"), w["context"].alias("context"), w["copies"].alias("copies"), w["near"].alias("near"),
            w["far"].alias("far"), w["shard"].alias("shard"), w["hot"].alias("hot"), cut(w).alias("bytes")))).alias("w"))
    return found.select("w.*").dropDuplicates(["key", "context"])


def piece_ranks(right: np.ndarray, sizes: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts from their anchors on as one text of ranked pieces; where each context begins in it."""
    count = -(-sizes // piece)
    wide = int(count.max()) * piece
    padded = np.zeros((len(right), wide), np.uint8)
    padded[:, : right.shape[1]] = right[:, :wide]
    row = np.repeat(np.arange(len(right)), count)
    begin = np.cumsum(count + 1) - count - 1
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    cells = padded.reshape(len(right), -1, piece)[row, nth]
    held = np.minimum(piece, sizes[row] - nth * piece).astype(np.uint8)
    cells = np.ascontiguousarray(np.hstack([cells, held[:, None]])).view(np.dtype((np.void, piece + 1))).ravel()
    text = np.zeros(len(row) + len(right), np.int64)  # 0 stands between contexts
    text[begin[row] + nth] = np.unique(cells, return_inverse=True)[1] + 1
    return text, begin


def range_minimum(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of ``values[a + 1 .. b]`` for each pair a < b."""
    levels = [values]
    while 2 ** len(levels) <= len(values):
        half = 2 ** (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    width = b - a
    level = np.frexp(width.astype(np.float64))[1] - 1
    out = np.zeros(len(a), values.dtype)
    for k in np.unique(level):
        own = level == k
        out[own] = np.minimum(levels[k][a[own] + 1], levels[k][b[own] - (1 << k) + 1])
    return out


def multipliers(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def side_hashes(side: np.ndarray, seed: int) -> np.ndarray:
    """Hash of the first d bytes of every row, for all d."""
    terms = (side.astype(np.uint64) + np.uint64(1)) * multipliers(seed, side.shape[1])
    return np.hstack([np.zeros((len(side), 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)])


def repeated_starts(rows: pd.DataFrame, length: int, piece: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which starts of a shard's contexts have an equal string in another of them.

    Returns the contexts in the order of the suffix array; then for every start its context, distance
    and class of equal left sides and whether its string occurs in more than one context.
    """
    far, near = rows["far"].to_numpy().astype(np.int64), rows["near"].to_numpy().astype(np.int64)
    sizes = length - near  # from the anchor on
    right = np.zeros((len(rows), int(sizes.max())), np.uint8)
    left = np.zeros((len(rows), int(far.max())), np.uint8)  # backwards from the anchor
    for i, held in enumerate(rows["bytes"]):
        codes = np.frombuffer(held, np.uint8)
        right[i, : sizes[i]] = codes[far[i] :]
        left[i, : far[i]] = codes[: far[i]][::-1]
    text, begin = piece_ranks(right, sizes, piece)
    rank = np.empty(len(text), np.int64)
    rank[suffix_array(text)] = np.arange(len(text))
    order = np.argsort(rank[begin])
    right, left, far, near, sizes = right[order], left[order], far[order], near[order], sizes[order]
    common = np.zeros(len(rows), np.int64)  # of a context and the one before it, from the anchor on
    differ = right[1:] != right[:-1]
    common[1:] = np.minimum(np.where(differ.any(1), differ.argmax(1), right.shape[1]), np.minimum(sizes[1:], sizes[:-1]))
    hashes = side_hashes(left, 101)
    span = np.arange(left.shape[1] + 1)
    at, back = np.nonzero((span >= near[:, None]) & (span <= far[:, None]))
    key = (hashes[at, back] ^ (back.astype(np.uint64) * MIX)) * MIX
    by_key = np.argsort(key, kind="stable")  # stays in suffix order inside a class
    a, b = by_key[:-1], by_key[1:]
    same = np.flatnonzero(key[a] == key[b])
    a, b = a[same], b[same]
    alike = range_minimum(common, at[a], at[b]) >= length - back[a] if len(a) else np.zeros(0, bool)
    repeated = np.zeros(len(at), bool)
    repeated[a[alike]] = True
    repeated[b[alike]] = True
    return rows.iloc[order].reset_index(drop=True), at, back, repeated, class_hashes(left, right, at, back, length)


def class_hashes(left: np.ndarray, right: np.ndarray, at: np.ndarray, back: np.ndarray, length: int) -> np.ndarray:
    out = []
    for seed in (211, 307):
        before, after = side_hashes(left, seed), side_hashes(right, seed + 1)
        out.append((before[at, back] + after[at, length - back] * np.uint64(3) + back.astype(np.uint64)) * MIX)
    return np.stack(out).view(np.int64)


def runs(distances: np.ndarray) -> list[int]:
    """Sorted distances as flat pairs of first and last."""
    if not len(distances):
        return []
    cut = np.flatnonzero(np.diff(distances) > 1)
    return np.stack([distances[np.r_[0, cut + 1]], distances[np.r_[cut, len(distances) - 1]]], 1).ravel().tolist()


SHARD_SCHEMA = "key long, context long, spans array<int>, h1 long, h2 long, back int, weight int"


def shard_worker(length: int, piece: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        gc.disable()  # the suffix array makes many small lists and no cycles
        try:
            rows, at, back, repeated, classes = repeated_starts(rows, length, piece)
        finally:
            gc.enable()
            tidy()
        repeated |= rows["copies"].to_numpy()[at] > 1
        bounds = np.searchsorted(at, np.arange(len(rows) + 1))
        spans = [runs(back[a:b][repeated[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        none = np.zeros(len(rows), np.int64)
        out = [pd.DataFrame({"key": rows["key"], "context": rows["context"], "spans": spans, "h1": none, "h2": none, "back": none, "weight": none})]
        hot = rows["hot"].to_numpy()[at]
        if hot.any():  # one row per different string: 2 if it is known to repeat, otherwise the start that waits
            open_ = np.flatnonzero(hot)
            found = pd.DataFrame({
                "key": rows["key"].to_numpy()[at[open_]], "context": rows["context"].to_numpy()[at[open_]], "h1": classes[0][open_],
                "h2": classes[1][open_], "back": back[open_], "weight": 1 + repeated[open_]}).drop_duplicates(["h1", "h2"])
            out.append(found.assign(spans=[[]] * len(found)))
        return pd.concat(out)[["key", "context", "spans", "h1", "h2", "back", "weight"]]

    return run


PASSING = ["anchors", "keys", "several", "contexts", "of_key", "judged"]  # tables that only lead to the spans


def repeated_spans(
    texts: DataFrame, work: Workspace, length: int = LENGTH, key: int = KEY_BYTES, piece: int = PIECE_BYTES, shard_contexts: int = SHARD_CONTEXTS,
    seen: Seen | None = None,
) -> DataFrame:
    """Per text key the sorted byte spans to remove: t1, t2, spans (array of lo, hi)."""
    found = work.save(anchor_rows(texts, length, key, seen), "anchors")
    copies = F.sum(F.size("places"))
    # aggregates are written down before a join, so that the join can split the rows of a hot key
    keys = work.save(found.groupBy("key").agg(
        copies.alias("n"), (F.min("context") != F.max("context")).alias("mixed")).where("n > 1").drop("n"), "keys")
    several = work.save(sieved(found, "key", keys).join(keys, "key"), "several")
    contexts = work.save(several.where("mixed").groupBy("key", "context").agg(
        copies.alias("copies"), F.min(F.struct("t1", "t2", F.get("places", F.lit(0)).alias("place"), "near", "far")).alias("at")
    ).select("key", "context", "copies", "at.*"), "contexts")
    total = contexts.count()
    shards = max(1, -(-total // shard_contexts))
    of_key = work.save(contexts.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "of_key")
    hot = F.col("n") > shard_contexts
    dealt = contexts.join(of_key, "key").withColumn("hot", hot).withColumn(
        "shard", F.pmod(F.when(hot, F.xxhash64("key", "context")).otherwise(F.xxhash64("key")), F.lit(shards)).cast("int")).drop("n")
    met = context_bytes(texts, dealt, contexts, length, seen)
    judged = work.save(met.groupBy("shard").applyInPandas(shard_worker(length, piece), SHARD_SCHEMA), "judged")
    spans = judged.where("weight = 0").select("key", "context", "spans")
    waiting = judged.where("weight > 0")
    agreed = waiting.groupBy("h1", "h2").agg(F.sum("weight").alias("n")).where("n > 1").drop("n")
    late = waiting.where("weight = 1").join(agreed, ["h1", "h2"]).groupBy("key", "context").agg(
        F.flatten(F.collect_list(F.array("back", "back"))).alias("spans"))
    pairs = spans.unionByName(late).where(F.size("spans") > 0).select("key", "context", F.transform(
        F.filter(F.sequence(F.lit(0), F.size("spans") - 1), lambda i: i % 2 == 0),
        lambda i: F.struct(F.get("spans", i).alias("a"), F.get("spans", i + 1).alias("b"))).alias("pairs"))
    one = several.where("not mixed").select(
        "t1", "t2", "places", F.array(F.struct(F.col("near").alias("a"), F.col("far").alias("b"))).alias("pairs"))
    many = several.where("mixed").select("t1", "t2", "places", "key", "context").join(pairs, ["key", "context"]).select(
        "t1", "t2", "places", "pairs")
    cover = one.unionByName(many).select("t1", "t2", F.flatten(F.transform("places", lambda p: F.transform(
        "pairs", lambda x: F.struct((p - x["b"]).alias("lo"), (p - x["a"] + length).alias("hi"))))).alias("spans"))
    return work.save(cover.distinct().groupBy("t1", "t2").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")), "spans")


def word_bytes(texts: list[bytes]) -> list[bytes]:
    """Every text as the hashes of its words, ``WORD_BYTES`` each."""
    letters = multipliers(401, 256)
    letters[[32, *range(9, 14)]] = 0
    out = []
    for part in chunks(texts):
        words, count = word_hashes(texts[part], letters)
        held, ends = words.astype("<u8").tobytes(), np.cumsum(count) * WORD_BYTES
        out += [held[b - n * WORD_BYTES : b] for b, n in zip(ends.tolist(), count.tolist(), strict=True)]
    return out


def passage_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of ``word_bytes`` as spans of the text; words that are covered in part do not count."""
    at = [m.span() for m in WORD.finditer(text)] if spans else []
    inner = [(-(-lo // WORD_BYTES), hi // WORD_BYTES) for lo, hi in spans]
    return [(at[a][0], at[b - 1][1]) for a, b in inner if a < b]


def removed_runs(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of sorted spans; spans that touch are one run."""
    out: list[list[int]] = []
    for lo, hi in spans:
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def without_repeats(
    docs: DataFrame, work: Workspace, text_col: str = "text", passage_words: int | None = None, characters: bool = False, **settings: int,
) -> DataFrame:
    """The rows with ``_kept`` (the remaining bytes), ``_n_bytes``, ``_n_removed`` and ``_n_spans``.

    With ``characters``, what is left of characters cut in two is not in ``_kept`` either, which is UTF-8 then.
    """
    ship_package(docs.sparkSession)
    rows, names, back = veiled(docs)
    texts = keyed(rows, names[text_col])
    spans = repeated_spans(texts, work, **settings)
    if passage_words is None:
        cover = spans.withColumn("passages", F.lit(None).cast(spans.schema["spans"].dataType))
    else:
        work.drop(*PASSING)  # room for as many again
        again = Workspace(docs.sparkSession, "passages")
        passages = repeated_spans(texts, again, **settings | {"length": passage_words * WORD_BYTES}, seen=word_bytes)
        again.drop(*PASSING)
        cover = work.save(spans.join(passages.withColumnRenamed("spans", "passages"), ["t1", "t2"], "full"), "cover")
    # only texts that may lose something are shuffled
    maybe = maybe_among(texts, "t1", cover)
    held = [*names.values(), "_content", "spans", "passages"]
    joined = maybe.where("_maybe").join(cover, ["t1", "t2"], "left").select(*held).unionByName(
        maybe.where("not _maybe").select(*names.values(), "_content", *[F.lit(None).cast(cover.schema[c].dataType).alias(c) for c in held[-2:]]))
    new = ["_kept", "_n_bytes", "_n_removed", "_n_spans"]
    schema = StructType([*rows.schema.fields]).add(new[0], BinaryType())
    for name in new[1:]:
        schema = schema.add(name, LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, gone, count = [], [], [], []
            for text, held, words in zip(*[batch.column(c).to_pylist() for c in ("_content", "spans", "passages")], strict=True):
                own, more = ([(s["lo"], s["hi"]) for s in x or ()] for x in (held, words))
                cut = removed_runs(sorted(own + passage_spans(text, more)))
                ends = [0, *[x for lo_hi in cut for x in lo_hi], len(text)]
                left = b"".join([text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)])
                kept.append(left.decode("utf-8", "ignore").encode() if characters else left)
                sizes.append(len(text))
                gone.append(len(text) - len(left))
                count.append(len(cut))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names.values()], pa.array(kept, pa.binary()), *[pa.array(x, pa.int64()) for x in (sizes, gone, count)]],
                [*names.values(), *new])
        tidy()

    return back(joined.mapInArrow(run, schema), *new)


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs, Workspace(spark, "suffixes")).select(
        "doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"),
        (F.col("_n_bytes") - F.col("_n_removed")).alias("n_kept"))
