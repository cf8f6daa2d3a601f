"""Phrase collocation mining by vertical partitioning, after the ERA suffix tree construction.

A text is cut into pieces at ``SEPARATORS`` and these into words at blanks, A-Z taken as a-z. Every word
begins a suffix, cut off after ``LONGEST`` words or at the end of its piece. The tree of all suffixes of a
language has a node for every phrase, and the leaves below a node tell how often it occurs.

1. Prefixes of one word and of two are counted. A phrase can be frequent only if all its words and pairs are,
   so suffixes end where the next pair is not; bitmaps of fixed size tell most rare ones apart.
2. Prefixes of three words up to ``LONGEST`` - 1 are counted by slots of a hash, whose number is fixed. None in a slot
   with too small a total is frequent, so suffixes end there too; their last word is left to the tree. Those of three
   words and more are written down, equal ones of a stretch of text already combined.
3. Vertical partitioning: prefixes with more suffixes below them than the memory budget are lengthened by
   a word, again and again. What is within the budget is the root of a subtree; roots are dealt by hash into
   as many groups as the budget asks for. Suffixes that end with their prefix are in its count already and go
   no further.
4. Every group is sorted and its subtrees are built alone, level by level below their roots down to the
   depth of ``LONGEST``; the totals of the leaves below a node are its count.
5. Counts of phrases and of their parts meet in joins; scores are whole-number quotients of decimals.

Defined results: null texts are empty; a null language is ``und``; repeated rows count each; a text can be of
any length (it is read in stretches; one word is held whole); phrases of equal score and count are in the
byte order of their text; an empty table, or one without frequent phrases, gives no rows; other columns are
ignored. Words are told apart by 64-bit hashes while they are counted; frequent words that would be confused
stop the job.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared_store import Workspace, ship_package
from .passing import tidy
from .registry import query, read
from .sides import small_side

LONGEST = 5
LEAST = 100
TOP = 2000
RANK_PARTS = 64  # parts of a language that are ranked apart first
SEPARATORS, BLANKS = b".,;:!?\n\v\f\r", b" \t"
NO_LANGUAGE = "und"
STRETCH = 1 << 20  # bytes tokenised at a time
SHORT_STRETCH = 1 << 18  # the same where words are gathered afterwards
BLOCK = 1 << 16  # keys looked up at a time
GATHERED = 1 << 19  # words whose suffixes are combined at a time
HELD_BYTES = 16 << 20  # of combined suffixes that a task holds before they leave it
SENT_ROWS = 1 << 16  # in one batch
BUDGET = 400_000  # suffixes in a group of subtrees
FILTER_BITS = 24
SLOT_BITS = 26
IN_BLOCK = 16  # bits of a slot's place in its block
MIX = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(12)
STEP = _random.integers(1, 2**63, 1, dtype=np.uint64)[0] | np.uint64(1)
LETTERS = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LETTERS[65:91] = LETTERS[97:123]
LETTERS[list(SEPARATORS + BLANKS)] = 0
PARTS = np.zeros(256, np.int64)
PARTS[list(SEPARATORS)] = 1
W = [f"w{i + 1}" for i in range(LONGEST)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return (x ^ (x >> np.uint64(29))) * MIX


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(mixed(a) + b)


class Stretch:
    """Words of some bytes: key (with the language), number of the piece, first and last byte."""

    def __init__(self, codes: np.ndarray, firsts: np.ndarray, text_of: Callable[[np.ndarray], np.ndarray], language: np.ndarray, piece: int) -> None:
        values = LETTERS[codes]
        word = values != 0
        opens = word.copy()
        opens[1:] &= ~word[:-1]
        opens[firsts] = word[firsts]
        parts = PARTS[codes]
        np.add.at(parts, firsts, 1)
        parts = np.cumsum(parts)
        self.codes, self.begin = codes, np.flatnonzero(opens)
        self.piece, self.next_piece = parts[self.begin] + piece, piece + (int(parts[-1]) if len(parts) else 0)
        letters = np.flatnonzero(word)
        self.text = text_of(self.begin)
        if not len(letters):
            self.key, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return
        first = np.searchsorted(letters, self.begin)
        self.size = np.diff(np.append(first, len(letters)))
        inside = np.arange(len(letters)) - np.repeat(first, self.size)
        power = np.cumprod(np.full(int(self.size.max()), STEP, np.uint64), dtype=np.uint64)
        hashes = mixed(np.add.reduceat(values[letters] * power[inside], first))
        self.key = np.maximum(mixed(hashes ^ language[self.text]), np.uint64(1))

    def words(self, at: np.ndarray) -> list[bytes]:
        raw = self.codes.tobytes().lower()  # of bytes: A-Z alone
        return [raw[a : a + n] for a, n in zip(self.begin[at].tolist(), self.size[at].tolist(), strict=True)]


def stretches(batches: Iterator[pa.RecordBatch], size: int = STRETCH) -> Iterator[tuple[pa.RecordBatch, Stretch]]:
    """All texts as stretches in order; a cut lies between texts or at a byte that is in no word."""
    piece = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        codes = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if len(texts) else np.zeros(0, np.uint8)
        starts = (ends - ends[0])[:-1]
        kinds = batch.column("lang").dictionary_encode()
        language = np.array([xxhash.xxh3_64_intdigest(v.encode()) for v in kinds.dictionary.to_pylist()], np.uint64)[kinds.indices.to_numpy()]
        at = 0
        while at < len(codes):
            stop = at + size
            if stop < len(codes):
                near = starts[np.searchsorted(starts, stop, "right") - 1]
                cut = np.flatnonzero(LETTERS[codes[at:stop]] == 0)
                stop = max(int(near), at + int(cut[-1]) + 1 if len(cut) else 0)
                ahead = at + size
                while stop <= at:  # one word fills the stretch
                    after = starts[np.searchsorted(starts, ahead, "right") :][:1]
                    cut = np.flatnonzero(LETTERS[codes[ahead : ahead + size]] == 0)
                    found = [*after[after <= ahead + size].tolist(), *(ahead + cut[:1] + 1).tolist()]
                    ahead += size
                    stop = min(found) if found else (len(codes) if ahead >= len(codes) else at)
            own = starts[np.searchsorted(starts, at) : np.searchsorted(starts, min(stop, len(codes)))] - at
            found = Stretch(codes[at:stop], np.unique(own), lambda b, at=at: np.searchsorted(starts, at + b, "right") - 1, language, piece)
            piece, at = found.next_piece, stop
            yield batch, found


def gathered(batches: Iterator[pa.RecordBatch], words: int = GATHERED) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Keys and pieces of many words; a suffix belongs to the first that many of them, which are whole."""
    keys: list[np.ndarray] = []
    pieces: list[np.ndarray] = []
    over = LONGEST - 1

    def whole(kept: int) -> tuple[np.ndarray, np.ndarray, int]:
        key, piece = taken(keys), taken(pieces)
        if kept:  # copied, as a slice would hold all of them
            keys.append(key[-kept:].copy())
            pieces.append(piece[-kept:].copy())
        return key, piece, len(key) - kept

    for _, found in stretches(batches, SHORT_STRETCH):
        keys.append(found.key)
        pieces.append(found.piece)
        del found
        if sum(map(len, keys)) >= words + over:
            yield whole(over)
    if keys:
        yield whole(0)


def taken(parts: list[np.ndarray]) -> np.ndarray:
    """All of them as one; the list is empty afterwards, so that nothing is held twice."""
    one = np.concatenate(parts)
    parts.clear()
    return one


def given_texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in stretches(batches):
            key, at, n = np.unique(found.key, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(found.text[at])), pa.array(found.words(at), pa.binary()), pa.array(key.view(np.int64)), pa.array(n)],
                ["lang", "word", "key", "n"])
        tidy()

    counted = texts.mapInArrow(run, "lang string, word binary, key long, n long")
    return counted.groupBy("lang", "word", "key").agg(F.sum("n").alias("f"))


class KeyFilter:
    """A bitmap of fixed size over the leading bits of keys; it may keep a rare key, and never loses a frequent one."""

    def __init__(self, keys: DataFrame, key: str) -> None:
        slot = F.shiftrightunsigned(key, 64 - FILTER_BITS)
        bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({key}, {64 - FILTER_BITS}) & 63 as int))")
        self.bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        for r in keys.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).collect():  # of fixed size
            self.bits[r["at"]] = r["bits"]
        self.bits = self.bits.view(np.uint64)

    def __call__(self, key: np.ndarray, after: np.ndarray | None = None) -> np.ndarray:
        """Of every key, or of the pair that it is with the key in the same place of ``after``."""
        kept, below = np.empty(len(key), bool), np.uint64(65 - (64 * len(self.bits)).bit_length())
        for at in range(0, len(key), BLOCK):  # what is computed on the way is some times as large as the keys
            own = slice(at, at + BLOCK)
            slot = (key[own] if after is None else pair_keys(key[own], after[own])) >> below
            kept[own] = (self.bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
        return kept


def pair_counts(texts: DataFrame, frequent: KeyFilter) -> DataFrame:
    """How often pairs of words occur, at least those both of whose words are frequent."""
    def pairs(key: np.ndarray, piece: np.ndarray, own: int) -> list[np.ndarray]:
        kept = frequent(key)
        at = np.flatnonzero(kept[:-1] & kept[1:] & (piece[:-1] == piece[1:]))
        at = at[at < own]
        return [key[at], key[at + 1], np.ones(len(at), np.int64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from combining(itertools.starmap(pairs, gathered(batches)), [*W[:2], "n"], 0)  # few recur: holding them would cost memory for nothing

    return texts.mapInArrow(run, "w1 long, w2 long, n long").groupBy("w1", "w2").agg(F.sum("n").alias("f"))


def with_pair_key(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(w).to_numpy().view(np.uint64) for w in W[:2])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pair_keys(a, b).view(np.int64))], [*batch.schema.names, "pair"])

    return pairs.mapInArrow(run, "w1 long, w2 long, f long, pair long")


def changes(columns: Iterable[np.ndarray]) -> Iterator[np.ndarray]:
    """For sorted rows and every number of leading columns: where these differ from the row before."""
    changed = None
    for c in columns:
        changed = np.arange(len(c)) == 0 if changed is None else changed.copy()
        changed[1:] |= c[1:] != c[:-1]
        yield changed


def combined(columns: list[np.ndarray], n: np.ndarray) -> list[np.ndarray]:
    """Sorted different rows, and the sum of their counts as last column; one column is sorted at a time."""
    order = np.lexsort(columns[::-1])
    *_, new = changes(c[order] for c in columns)
    first = np.flatnonzero(new)
    total = np.add.reduceat(n[order], first) if len(first) else n[:0]
    order = order[first]
    return [*[c[order] for c in columns], total]


def combining(parts: Iterator[list[np.ndarray]], names: list[str], most: int = HELD_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows with their counts, equal ones combined as far as the bytes a task may hold allow."""
    held: list[np.ndarray] = []

    def sent() -> Iterator[pa.RecordBatch]:
        for at in range(0, len(held[0]), SENT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + SENT_ROWS].view(np.int64)) for c in held], names)

    for *columns, n in parts:
        more = combined(columns, n)
        del columns, n
        if held:
            *columns, n = [taken([held.pop(0), more.pop(0)]) for _ in range(len(held))]
            more = combined(columns, n)
            del columns, n
        held = more
        if sum(c.nbytes for c in held) >= most:
            yield from sent()
            held = []
    if held:
        yield from sent()
    tidy()


def chains(key: np.ndarray, piece: np.ndarray, own: int, frequent: KeyFilter) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For three words and more: where so many begin whose pairs may all be frequent, and the hash of these words."""
    link = np.zeros(len(key) + LONGEST, bool)
    link[: len(key) - 1] = (piece[:-1] == piece[1:]) & frequent(key[:-1], key[1:])
    at = np.flatnonzero(link[:own] & link[1 : own + 1])
    hashes = pair_keys(pair_keys(key[at], key[at + 1]), key[at + 2])
    yield at, hashes
    for j in range(3, LONGEST):
        on = link[at + j - 1]
        at, hashes = at[on], hashes[on]
        hashes = pair_keys(hashes, key[at + j])
        yield at, hashes


class SlotFilter(KeyFilter):
    """A bitmap of the slots that hold ``least`` and more of the prefixes of three words and longer ones, but the longest."""

    def __init__(self, texts: DataFrame, frequent: KeyFilter, least: int) -> None:
        self.bits = np.zeros(1 << (SLOT_BITS - 6), np.int64)
        words = 1 << (IN_BLOCK - 6)
        for r in slot_totals(texts, frequent, least).collect():  # of fixed size
            self.bits[r["block"] * words : (r["block"] + 1) * words] = np.frombuffer(r["bits"], np.int64)
        self.bits = self.bits.view(np.uint64)


def slot_totals(texts: DataFrame, frequent: KeyFilter, least: int) -> DataFrame:
    """For every block of slots a bitmap of those whose total is ``least`` or more."""
    def slots(key: np.ndarray, piece: np.ndarray, own: int) -> list[np.ndarray]:
        counted = itertools.islice(chains(key, piece, own, frequent), LONGEST - 3)
        found = np.concatenate([hashes >> np.uint64(64 - SLOT_BITS) for _, hashes in counted])
        return [found, np.ones(len(found), np.int64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in combining(itertools.starmap(slots, gathered(batches)), ["slot", "n"]):
            slot, n = rows.column("slot").to_numpy(), rows.column("n").to_numpy()
            block, place, n = slot >> IN_BLOCK, (slot & ((1 << IN_BLOCK) - 1)).astype("<u2"), np.minimum(n, 2**32 - 1).astype("<u4")
            first = np.flatnonzero(np.diff(block, prepend=-1))
            bounds = list(itertools.pairwise([*first.tolist(), len(block)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[first]), *[pa.array([c[a:b].tobytes() for a, b in bounds], pa.binary()) for c in (place, n)]], ["block", "places", "counts"])

    def total(rows: pa.Table) -> pa.Table:
        place, n = (np.frombuffer(b"".join(rows.column(c).to_pylist()), kind) for c, kind in (("places", "<u2"), ("counts", "<u4")))
        often = np.bincount(place, weights=n, minlength=1 << IN_BLOCK) >= least  # whole numbers below 2 ** 53
        return pa.table({"block": rows.column("block")[:1], "bits": pa.array([np.packbits(often, bitorder="little").tobytes()], pa.binary())})

    return texts.mapInArrow(run, "block long, places binary, counts binary").groupBy("block").applyInArrow(total, "block long, bits binary")


def suffixes(texts: DataFrame, frequent: KeyFilter, often: KeyFilter) -> DataFrame:
    """Suffixes of three words and more, 0 after their end, with how often each occurs in a stretch of text.

    Their prefixes of three words up to ``LONGEST`` - 1 may all be frequent.
    """
    def longer(key: np.ndarray, piece: np.ndarray, own: int) -> list[np.ndarray]:
        size = np.zeros(own, np.int8)
        for depth, (at, hashes) in enumerate(chains(key, piece, own, frequent), 3):
            at = at[often(hashes)] if depth < LONGEST else at
            size[at[size[at] == depth - 1] if depth > 3 else at] = depth
        at, padded = np.flatnonzero(size), np.append(key, np.zeros(LONGEST, np.uint64))
        size = size[at]
        return [*[np.where(size > j, padded[at + j], np.uint64(0)) for j in range(LONGEST)], np.ones(len(at), np.int64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from combining(itertools.starmap(longer, gathered(batches)), [*W, "n"])

    return texts.mapInArrow(run, ", ".join(f"{w} long" for w in W) + ", n long")


def subtrees(least: int) -> Callable[[pa.Table], pa.Table]:
    """Nodes of a group's subtrees, below their roots, that are frequent."""
    def run(rows: pa.Table) -> pa.Table:
        columns = [rows.column(w).to_numpy() for w in W]
        order = np.lexsort(columns[::-1])
        columns, n, root = [c[order] for c in columns], rows.column("n").to_numpy()[order], rows.column("root").to_numpy()[order]
        out: list[list[np.ndarray]] = [[] for _ in range(LONGEST + 2)]
        for depth, new in enumerate(changes(columns), 1):
            first = np.flatnonzero(new)
            total = np.add.reduceat(n, first)  # of the leaves below
            kept = (total >= least) & (columns[depth - 1][first] != 0) & (root[first] < depth)
            first, total = first[kept], total[kept]
            for j, c in enumerate(columns):
                out[j].append(c[first] if j < depth else np.zeros(len(first), np.int64))
            out[LONGEST].append(np.full(len(first), depth, np.int32))
            out[LONGEST + 1].append(total)
        return pa.table([pa.array(np.concatenate(c)) for c in out], [*W, "depth", "f"])

    return run


NODE = [*W, "depth", "f"]


def padded_node(prefixes: DataFrame, depth: int) -> DataFrame:
    return prefixes.select(*W[:depth], *[F.lit(0).cast("long").alias(w) for w in W[depth:]], F.lit(depth).cast("int").alias("depth"), "f")


def phrase_nodes(found: DataFrame, pairs: DataFrame, work: Workspace, least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """All frequent phrases with their counts, from those of two words and from stored longer suffixes."""
    open_rows, nodes, dealt, roots = found, [padded_node(pairs, 2)], [], []
    for depth in range(2, LONGEST + 1):
        longer = F.col(W[depth]) != 0 if depth < LONGEST else F.lit(False)
        prefixes = work.save(open_rows.groupBy(*W[:depth]).agg(F.sum("n").alias("f"), F.count_if(longer).alias("rows")), f"prefixes{depth}")
        if depth > 2:
            nodes.append(padded_node(prefixes.where(F.col("f") >= least), depth))
        within, heavy = prefixes.where(F.col("rows").between(1, budget)), prefixes.where(F.col("rows") > budget)
        roots.append(within.select(F.lit(depth).alias("root"), *W[:depth], *[F.lit(0).cast("long").alias(w) for w in W[depth:]], "rows"))
        going = open_rows.where(longer)
        if depth == LONGEST or heavy.isEmpty():
            dealt.append(going)
            break
        lengthened = small_side(heavy.select(*W[:depth]))
        dealt.append(going.join(lengthened, W[:depth], "left_anti"))
        open_rows = going.join(lengthened, W[:depth], "left_semi")
    every = roots[0]
    for more in roots[1:]:
        every = every.unionByName(more)
    total = every.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    # no root has more suffixes than the budget, so that groups of half as many on average stay near it
    groups = max(1, -(-2 * total // budget))

    def group(depth: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(depth), *W[:depth]), F.lit(groups)).alias("grp")

    for depth, rows in enumerate(dealt, 2):
        nodes.append(rows.select(group(depth), F.lit(depth).alias("root"), *W, "n").groupBy("grp").applyInArrow(
            subtrees(least), ", ".join(f"{w} long" for w in W) + ", depth int, f long").select(*NODE))
    whole = nodes[0]
    for more in nodes[1:]:
        whole = whole.unionByName(more)
    return work.save(whole, "nodes")


def part(columns: list[Column], skip: int | Column, size: Column) -> list[Column]:
    """The words from ``skip`` on, as many as ``size``, 0 after them."""
    whole = F.array(*columns)
    return [F.when(F.lit(j) < size, F.coalesce(F.get(whole, F.lit(j) + skip), F.lit(0).cast("long"))).otherwise(0).alias(W[j]) for j in range(LONGEST)]


def scored(nodes: DataFrame, words: DataFrame, totals: DataFrame, work: Workspace) -> DataFrame:
    """Phrases that no longer one makes superfluous, with the score of their weakest cut."""
    w = [F.col(x) for x in W]
    longer = nodes.where("depth > 2")
    within = longer.select(*part(w, 0, F.col("depth") - 1), "f").unionByName(longer.select(*part(w, 1, F.col("depth") - 1), "f")).distinct()
    live = work.save(nodes.join(within, [*W, "f"], "left_anti"), "live")
    counts = work.save(nodes.select(*W, "f").unionByName(words.select(F.col("key").alias("w1"), *[F.lit(0).cast("long").alias(x) for x in W[1:]], "f")), "counts")
    cuts = live.select("*", F.explode(F.sequence(F.lit(1), F.col("depth") - 1)).alias("k")).select(
        F.struct(*W).alias("phrase"), "f", "k", F.struct(*part(w, 0, F.col("k"))).alias("first"), F.struct(*part(w, F.col("k"), F.col("depth") - F.col("k"))).alias("rest"))
    of_part = counts.select(F.struct(*W).alias("part"), F.col("f").alias("of_part"))
    both = cuts.join(of_part.withColumnsRenamed({"part": "first", "of_part": "l"}), "first").join(of_part.withColumnsRenamed({"part": "rest", "of_part": "r"}), "rest")
    spoken = both.select(F.col("phrase.w1").alias("key"), "phrase", F.col("f").alias("a"), "k", "l", "r").join(
        small_side(words.select("key", "lang")), "key").join(small_side(totals), "lang")
    wide = "cast(1000 as decimal(4,0)) * cast(a as decimal(18,0)) * cast(n as decimal(18,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    weakest = spoken.withColumn("score", F.expr(wide)).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = work.save(weakest.select("lang", F.col("phrase.*"), "a", "n", "cut.l", "cut.r", "cut.score"), "weakest")
    named = best.select(*W, F.posexplode(F.array(*W)).alias("place", "key")).where("key <> 0").join(small_side(words.select("key", "word")), "key")
    texts = named.groupBy(*W).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", F.col("word").cast("string").alias("word")))), lambda x: x["word"]), " ").alias("phrase"))
    return best.join(texts, W).select("lang", "phrase", "a", "l", "r", "n", "score")


def collocations(
    docs: DataFrame, work: Workspace, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP, budget: int = BUDGET,
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    ship_package(docs.sparkSession)
    texts = given_texts(docs, text_col, lang_col)
    counted = work.save(word_counts(texts), "word_counts")
    totals = work.save(counted.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words = work.save(counted.where(F.col("f") >= least), "words")
    rows, different = words.agg(F.count(F.lit(1)), F.count_distinct("key")).first()
    if rows != different:
        raise ValueError("two frequent words have one hash; change the seed")
    pairs = work.save(with_pair_key(pair_counts(texts, KeyFilter(words, "key")).where(F.col("f") >= least)), "pairs")
    frequent = KeyFilter(pairs, "pair")
    found = work.save(suffixes(texts, frequent, SlotFilter(texts, frequent, least)), "suffixes")
    best_first = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    # the first of every part of a language hold its first, so one task ranks RANK_PARTS * top rows at most
    ranked = (
        scored(phrase_nodes(found, pairs, work, least, budget), words, totals, work)
        .withColumn("in_part", F.row_number().over(Window.partitionBy("lang", part).orderBy(*best_first)))
        .where(F.col("in_part") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best_first)))
    )
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) AS piece
        FROM documents)
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), grams AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM starts, range(1, 6) s(size) WHERE i + size - 1 <= len(w)
), counts AS (
    SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1
), live AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (
        SELECT 1 FROM candidates o WHERE o.lang = c.lang AND o.size > c.size AND 100 * o.a >= 100 * c.a
            AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
    SELECT lang, phrase, a, size, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail FROM live, range(1, 5) c(k) WHERE k < size
), scores AS (
    SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, n, (1000::HUGEINT * c.a * n // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM cuts c JOIN totals t ON t.lang = c.lang JOIN counts l ON l.lang = c.lang AND l.phrase = head JOIN counts r ON r.lang = c.lang AND r.phrase = tail
), weakest AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM weakest QUALIFY rank <= 2000
"""


@query("op12_collocations", SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("text", "lang")
    return collocations(docs, Workspace(spark, "collocations"))
