"""MinHash near-dedup with odd sketches.

Texts with equal shingle sets become one node. A node has ``BANDS * ROWS`` MinHash samples; bands of
``ROWS`` samples give buckets, and two sets of similarity 0.75 share none of them with a probability
under 3e-7. The samples of a node are also folded into an odd sketch, a bitmap in which each sample
flips one bit; the population count of the XOR of two sketches estimates their similarity. Pairs
whose estimate is below ``ESTIMATE`` (over five standard deviations below the bound) are left out, the others
are confirmed on their full sets.

Buckets are never expanded into pairs of rows. First every node meets the smallest node of its
buckets that its sketch likes best; the confirmed links give components. Then the buckets led by one
component that also hold nodes of others are compared across components alone, in blocks of bounded
size: sketches name the nodes that have a partner worth a look, and the full sets of these decide
inside the block, which returns links between components only.

Defined results: null texts, and texts without words, have an empty set and link with nothing; fewer
than five words are one shingle; repeated rows share their component; a null id is its own component
unless its set belongs to others; an empty table gives no rows; other columns are ignored.
Shingles are told apart by 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared_store import Workspace, ship_package
from .components import components
from .passing import tidy
from .registry import query, read

WORDS = 5
PERCENT = 75
BANDS, ROWS = 40, 4
SAMPLES = BANDS * ROWS
SKETCH_LONGS = 8
BITS = 64 * SKETCH_LONGS
ESTIMATE = 0.5
BLOCK_SHINGLES = 200_000  # of the nodes asked about in a block; four times as many of those they meet
TASK_ROWS = 4_000
CHUNK_BYTES = 1 << 19
MIX = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20)
BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUES[65:91] = BYTE_VALUES[97:123]  # A-Z as a-z
BYTE_VALUES[[32, *range(9, 14)]] = 0
STEP = _random.integers(1, 2**63, 1, dtype=np.uint64)[0] | np.uint64(1)
PLACES = _random.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SALT = np.arange(1, ROWS + 1, dtype=np.uint64) * MIX
TIMES = (_random.integers(1, 2**31, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
PLUS = _random.integers(0, 2**32, SAMPLES, dtype=np.uint64).astype(np.uint32)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return (x ^ (x >> np.uint64(29))) * MIX


def word_hashes(texts: list[bytes], letter_values: np.ndarray = BYTE_VALUES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, by default A-Z taken as a-z, and how many words each text has."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    values = letter_values[codes]
    word = values != 0
    begin = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    letters = np.flatnonzero(word)
    length = np.flatnonzero(word[:-1] & ~word[1:]) + 1 - begin
    first = np.cumsum(length) - length
    power = np.cumprod(np.full(int(length.max()), STEP, np.uint64), dtype=np.uint64)
    inside = np.arange(len(letters)) - np.repeat(first, length)
    words = mixed(np.add.reduceat(values[letters] * power[inside], first))
    text_begin = np.cumsum(sizes + 1) - sizes
    owner = np.searchsorted(text_begin, begin, "right") - 1
    return words, np.bincount(owner, minlength=len(texts))


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after the other, and how many each has."""
    words, count = word_hashes(texts)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    start = np.cumsum(count) - count
    own = np.maximum(1, count - WORDS + 1) * (count > 0)  # shingles with repeats
    of = np.repeat(np.arange(len(texts)), own)
    at = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(own) - own, own)
    padded = np.append(words, np.zeros(WORDS, np.uint64))
    short = np.minimum(count, WORDS)[of]
    total = short.astype(np.uint64)
    for j in range(WORDS):
        total = total + np.where(j < short, padded[at + j] * PLACES[j], np.uint64(0))
    hashes = mixed(total)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.bincount(of[new], minlength=len(texts))


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and odd sketches of the texts that have shingles."""
    begin = (np.cumsum(sizes) - sizes)[sizes > 0]
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.empty((len(begin), SAMPLES), np.uint32)
    for k in range(SAMPLES):
        least[:, k] = np.minimum.reduceat(low * TIMES[k] + PLUS[k], begin)
    wide = least.astype(np.uint64)
    band = np.zeros((len(begin), BANDS), np.uint64)
    for r in range(ROWS):
        band = mixed(band + wide[:, r::ROWS] + SALT[r])
    band = mixed(band + np.arange(BANDS, dtype=np.uint64))
    bit = (mixed(wide + np.arange(SAMPLES, dtype=np.uint64) * MIX) >> np.uint64(40)) % np.uint64(BITS)
    flips = np.zeros((len(begin), BITS), np.uint8)
    np.add.at(flips, (np.arange(len(begin))[:, None], bit.astype(np.int64)), 1)
    sketch = np.packbits(flips & 1, axis=1).view(np.int64)
    return band.view(np.int64), sketch


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[slice]:
    ends, start = np.cumsum([len(t) for t in texts]) // size, 0
    for stop in [*(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]:
        yield slice(start, stop)
        start = stop


def text_key(column: str) -> list[Column]:
    content = F.coalesce(F.col(column).cast("binary"), F.lit(b""))
    return [F.xxhash64(content).alias("t1"), F.xxhash64(F.lit("second"), content).alias("t2")]


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, text key, set size, set key, band keys and odd sketch (null for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            everything = batch.column("content").to_pylist()
            for part in chunks(everything):
                texts, rows = everything[part], batch.slice(part.start, part.stop - part.start)
                hashes, sizes = shingle_sets(texts)
                full = np.flatnonzero(sizes)
                s1, s2 = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                bands: list = [None] * len(texts)
                sketches: list = [None] * len(texts)
                if len(full):
                    band, sketch = signatures(hashes, sizes)
                    ends = np.cumsum(sizes)
                    for k, i in enumerate(full.tolist()):
                        digest = xxhash.xxh3_128_digest(hashes[ends[i] - sizes[i] : ends[i]].tobytes())
                        s1[i], s2[i] = np.frombuffer(digest, np.int64)
                        bands[i], sketches[i] = band[k], sketch[k]
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in ("doc_id", "t1", "t2")], *map(pa.array, (sizes, s1, s2)), pa.array(bands, longs), pa.array(sketches, longs)],
                    ["doc_id", "t1", "t2", "n_shingles", "s1", "s2", "bands", "sketch"])
        tidy()

    kind = docs.schema[id_col].dataType.simpleString()
    content = F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("content")
    return docs.select(F.col(id_col).alias("doc_id"), *text_key(text_col), content).mapInArrow(
        run, f"doc_id {kind}, t1 long, t2 long, n_shingles long, s1 long, s2 long, bands array<long>, sketch array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity by the XOR of two odd sketches."""
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return 1 + BITS / (4 * SAMPLES) * F.log(F.greatest(1 - 2 * differ / BITS, F.lit(1e-9)))


def worth(a: str, b: str) -> Column:
    """The sizes allow the bound; no pair that reaches it is left out."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that reach the bound on their full sets."""
    left = texts.select(F.col("node").alias("a"), F.col("content").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("content").alias("right"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = [t for pair in zip(batch["left"], batch["right"], strict=True) for t in pair]
            for part in chunks(both[::2]):
                rows = batch.iloc[part]
                hashes, sizes = shingle_sets(both[2 * part.start : 2 * part.stop])
                pair = np.repeat(np.arange(len(sizes)) // 2, sizes)
                order = np.lexsort((hashes, pair))
                hashes, pair = hashes[order], pair[order]
                shared = np.bincount(pair[1:][(hashes[1:] == hashes[:-1]) & (pair[1:] == pair[:-1])], minlength=len(rows))
                union = sizes[::2] + sizes[1::2] - shared
                yield rows[["a", "b"]][(100 * shared >= PERCENT * union) & (union > 0)]

    return pairs.join(left, "a").join(right, "b").mapInPandas(run, "a long, b long")


def block_parts(rows: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """The blocks of a task: rows, places of the nodes asked about, places of those they meet."""
    for _, block in rows.groupby(["grp", "h", "l"], sort=False):
        wide = block["wide"].to_numpy()
        yield block, np.flatnonzero(~wide), np.flatnonzero(wide)


def could_link(part: np.ndarray, size: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    return (part[others] != part[i]) & (100 * np.minimum(size[others], size[i]) >= PERCENT * np.maximum(size[others], size[i]))


def alike_by_sketch(rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes that have a partner of another component whose sketch is alike enough."""
    limit = BITS * (1 - np.exp((ESTIMATE - 1) * 4 * SAMPLES / BITS)) / 2
    out = [rows[["grp", "node"]].iloc[:0]]
    for block, asked, all_ in block_parts(rows):
        sketch = np.stack(block["sketch"].to_numpy()).view(np.uint64)
        part, size = block["component"].to_numpy(), block["n_shingles"].to_numpy()
        seen = np.zeros(len(block), bool)
        for i in asked.tolist():
            close = np.bitwise_count(sketch[all_] ^ sketch[i]).sum(1) <= limit
            fits = all_[close & could_link(part, size, i, all_)]
            seen[fits] = True
            seen[i] |= len(fits) > 0
        out.append(block[["grp", "node"]][seen])
    return pd.concat(out).drop_duplicates()


def linked_by_sets(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between components, confirmed on full sets; one for components that are joined already."""
    a, b = [], []
    for block, asked, all_ in block_parts(rows):
        node, part, size = (block[c].to_numpy() for c in ("node", "component", "n_shingles"))
        hashes, sizes = shingle_sets([bytes(t) for t in block["content"]])
        ends = np.cumsum(sizes)
        own = [hashes[e - n : e] for e, n in zip(ends, sizes, strict=True)]
        facing, owner = np.concatenate([own[i] for i in all_]), np.repeat(np.arange(len(all_)), sizes[all_])
        group = {c: c for c in set(part.tolist())}

        def root(c: int, group: dict[int, int] = group) -> int:
            while group[c] != c:
                group[c] = c = group[group[c]]
            return c

        for i in asked.tolist():
            at = np.minimum(np.searchsorted(own[i], facing), len(own[i]) - 1)
            shared = np.bincount(owner[own[i][at] == facing], minlength=len(all_))
            close = 100 * shared >= PERCENT * (size[i] + size[all_] - shared)
            for j in all_[close & could_link(part, size, i, all_)].tolist():
                x, y = root(part[i]), root(part[j])
                if x != y:
                    group[x] = y
                    a.append(max(node[i], node[j]))
                    b.append(min(node[i], node[j]))
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)}).drop_duplicates()


def blocks(nodes: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Groups of nodes dealt into blocks of bounded size, and blocks into tasks.

    ``grp`` names the component that leads a group's buckets. Nodes of other components are asked
    about, some at a time, against all nodes of the group, some at a time.
    """
    foreign = F.col("component") != F.col("grp")
    size = work.save(nodes.groupBy("grp").agg(
        F.ceil(F.sum("n_shingles") / (4 * BLOCK_SHINGLES)).alias("ls"),
        F.ceil(F.sum(F.when(foreign, F.col("n_shingles")).otherwise(0)) / BLOCK_SHINGLES).alias("hs")).where("hs > 0"), f"{name}_sizes")
    dealt = nodes.join(size, "grp")
    spread = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("long")
    up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
    wide = dealt.select(*nodes.columns, F.lit(True).alias("wide"), spread("ls", 2).alias("l"), up_to("hs").alias("h"))
    asked = dealt.where(foreign).select(*nodes.columns, F.lit(False).alias("wide"), up_to("ls").alias("l"), spread("hs", 1).alias("h"))
    rows = work.save(wide.unionByName(asked), name)
    tasks = max(1, -(-rows.count() // TASK_ROWS))
    return rows.withColumn("task", F.pmod(F.xxhash64("grp", "h", "l"), F.lit(tasks)))


def near_duplicates(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text key (t1, t2), n_shingles, component (null for empty sets), component_id (smallest id reachable), kept.

    ``component`` tells apart components without ids, and those that share an id. ``kept`` goes by ids
    alone: it holds for every row that has its component's id.
    """
    ship_package(docs.sparkSession)
    rows = work.save(described(docs, id_col, text_col), "rows")
    nodes = work.save(
        rows.where("n_shingles > 0").groupBy("s1", "s2").agg(
            F.min("doc_id").alias("first_id"), F.min(F.struct("n_shingles", "t1", "t2", "bands", "sketch")).alias("x"))
        .select("s1", "s2", "first_id", "x.*").withColumn("node", F.monotonically_increasing_id()), "nodes")
    bands = nodes.select("node", F.explode("bands").alias("band"))
    # written down, so that a join with it can split the rows of a very common band
    shared = work.save(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1").drop("n"), "shared")
    members = work.save(bands.join(shared, "band"), "members")
    narrow = nodes.select("node", "n_shingles", "sketch")
    wanted = members.select("node").distinct().join(nodes.select("node", "t1", "t2"), "node")
    content = F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("content")
    texts = work.save(
        docs.select(*text_key(text_col), content).join(wanted, ["t1", "t2"]).select("node", "content").dropDuplicates(["node"]), "texts")

    def side(name: str) -> DataFrame:
        return narrow.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))

    stars = members.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    liked = stars.join(side("a"), "a").join(side("b"), "b").withColumn("likeness", estimate(F.col("sketch_a"), F.col("sketch_b"))).where(
        (F.col("likeness") >= ESTIMATE) & worth("n_a", "n_b"))
    first = work.save(liked.groupBy("a").agg(F.max(F.struct("likeness", -F.col("b"))).alias("x")).select(
        "a", (-F.col("x.col2")).alias("b")), "first_pairs")
    links = work.save(confirmed(first, texts), "first_links")
    joined = components(links, work, "contracted")
    part = members.join(joined.withColumnRenamed("component", "found"), "node", "left").select(
        "band", "node", "leader", F.coalesce("found", "node").alias("component"))
    of_leader = work.save(part.where("node = leader").select("band", F.col("component").alias("grp")), "of_leader")
    met = part.join(of_leader, "band").select("grp", "node", "component").distinct()
    open_ = met.join(met.where("component <> grp").select("grp").distinct(), "grp", "left_semi").join(narrow, "node")
    worthy = work.save(blocks(open_, work, "sketch_blocks").groupBy("task").applyInPandas(
        alike_by_sketch, "grp long, node long").distinct(), "worthy")
    compared = worthy.join(part.select("node", "component").distinct(), "node").join(narrow.drop("sketch"), "node").join(texts, "node")
    more = work.save(blocks(compared, work, "set_blocks").groupBy("task").applyInPandas(
        linked_by_sets, "a long, b long").distinct(), "more_links")
    final = components(links.unionByName(more), work, "components")
    named = nodes.select("node", "s1", "s2", "first_id").join(final, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    found = work.save(named.join(least, "component").select("s1", "s2", "component", "component_id"), "named")
    full = rows.where("n_shingles > 0").join(found, ["s1", "s2"])
    empty = rows.where("n_shingles = 0").withColumn("component", F.lit(None).cast("long")).withColumn("component_id", F.col("doc_id"))
    return full.select("doc_id", "t1", "t2", "n_shingles", "component", "component_id").unionByName(
        empty.select("doc_id", "t1", "t2", "n_shingles", "component", "component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@query("op7_near_dup")
def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, Workspace(spark, "minhash")).select("doc_id", "n_shingles", "component_id", "kept")
