"""BPE against the library, packing and sharding against their laws."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import corpus, documents, workspace
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scoreloom.llm.bpe import FragmentEncoder, encoded, encoder, slices, vocabulary_path
from scoreloom.llm.packing import best_fit, pack, packed_documents
from scoreloom.llm.sharding import even_map, rebalance, shard_by_bytes

LIBRARY = Tokenizer.from_file(vocabulary_path())
HARD = [
    "<|endoftext|>a <|startoftext|>B", "İstanbul ΑΣ ὈΔΥΣΣΕΎΣ", "a b c\x1cd\x85e", "don't they'LL 12345 ½ ²", "日本語テキスト é ́x",
    "!?!?...--", "😀👩‍👩‍👧 ok", "it's'd'll", "ﬁ ŉ ǰ", "a<|b|> <|endoftext|", "x" * 3000, "́́ á", "한국어 가", "\x00\x01", "",
]


def library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), LIBRARY.decode(ids, skip_special_tokens=False).encode()


@pytest.mark.parametrize("text", HARD)
def test_hard_texts_equal_the_library(text):
    ours = encoder(vocabulary_path())
    ids = ours.ids(text.encode())
    assert (ids, ours.decode(ids)) == library(text)


@given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"]), max_size=40))
@settings(max_examples=400, deadline=None)
def test_any_text_equals_the_library(text):
    assert encoder(vocabulary_path()).ids(text.encode()) == library(text)[0]


def test_encoded_rows(spark):
    rows = corpus()
    got = encoded(documents(spark, rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    want = sorted(((d, *library(t or "")) for d, t in rows), key=key)
    assert sorted(((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in got), key=key) == want
    assert encoded(documents(spark, [])).count() == 0


@pytest.mark.parametrize(("remembered", "at_once"), [(1000, 1 << 20), (3, 40), (1, 1)])
def test_texts_looked_up_together_equal_the_library(remembered, at_once):
    rng = random.Random(3)
    texts = [*HARD, " \t\n", *[" ".join(rng.choices([*HARD, "Ba.", "ba", "é!", "x1"], k=rng.randrange(9))) for _ in range(60)]]
    ours = FragmentEncoder(vocabulary_path(), remembered)
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts], pa.binary())], ["text"]).slice(1)
    got = [ids for part in slices(batch, at_once) for ids in ours.many(part.column("text"))]
    assert got == [library(t)[0] for t in texts[1:]]


@given(st.lists(st.integers(1, 50), max_size=60))
@settings(max_examples=200, deadline=None)
def test_best_fit_fills_sequences_without_gaps(sizes):
    sequence, offset = best_fit(np.array(sizes, np.int64), 50)
    for s in set(sequence.tolist()):
        own = sorted((int(offset[i]), sizes[i]) for i in np.flatnonzero(sequence == s))
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[-1][0] + own[-1][1] <= 50  # noqa: B905


def hold(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= capacity  # noqa: B905
    return len(by)


def test_packed_documents(spark):
    rows = corpus()
    got = packed_documents(documents(spark, rows), workspace(spark)).collect()
    hold(got, 4096)
    want = []
    for d, t in rows:
        ids = np.frombuffer(library(t or "")[0] + (1).to_bytes(4, "little"), "<u4")
        want += [(d, k, k * 4096, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(ids[a : a + 4096] for a in range(0, len(ids), 4096))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    assert packed_documents(documents(spark, []), workspace(spark)).count() == 0


@pytest.mark.parametrize("lengths, least", [
    ([random.Random(1).randint(1, 60) for _ in range(3000)], None), ([51] * 500, 500), ([100] * 50, 50), ([30, 70] * 300, 300)])
def test_tree_of_groups_packs_nearly_as_well_as_one(spark, lengths, least):
    items = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "item BIGINT, piece INT, length BIGINT")
    used = hold(pack(items, workspace(spark), capacity=100, group_rows=100, most_rows=1000).collect(), 100)
    bound = least or -(-sum(lengths) // 100)
    assert bound <= used <= 1.02 * bound + 1


def test_groups_that_may_not_merge_are_left_apart(spark):
    items = spark.createDataFrame([(i, 0, 40) for i in range(900)], "item BIGINT, piece INT, length BIGINT")
    rows = pack(items, workspace(spark), capacity=100, group_rows=50, most_rows=50).collect()
    assert len(rows) == 900 and 450 <= hold(rows, 100) <= 480


def test_shards_have_near_equal_bytes(spark):
    rng = random.Random(3)
    rows = [*corpus(), *[(10_000 + i, "x" * rng.randint(0, 4000)) for i in range(3000)], (None, None), (None, None)]
    got = shard_by_bytes(documents(spark, rows), 8, workspace(spark)).collect()
    assert len(got) == len(rows)
    assert sorted(((r["size"], r["text_crc32"]) for r in got)) == sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in rows)
    load = defaultdict(int)
    places = defaultdict(list)
    for r in got:
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert max(load.values()) - min(load.values()) < 0.005 * sum(load.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert shard_by_bytes(documents(spark, []), 8, workspace(spark)).count() == 0


def test_repeated_ids_do_not_fill_one_shard(spark):
    rows = [(7, f"text {i} " * 9) for i in range(1500)] + [(None, "the same text again")] * 1500 + [(i, "x" * (i % 90)) for i in range(100, 1600)]
    got = shard_by_bytes(documents(spark, rows), 8, workspace(spark)).collect()
    assert len(got) == len(rows)
    load, places = defaultdict(int), defaultdict(list)
    for r in got:
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(Counter(r["vslot"] for r in got).values()) < 12  # records of one slot are numbered by one task


def test_only_repeated_ids_leave_their_slots(spark):
    rows = [(i, "x" * 40) for i in range(4000)]
    slots = lambda given: {r["doc_id"]: r["vslot"] for r in shard_by_bytes(documents(spark, given), 8, workspace(spark), slots=64).collect()}
    alone, crowded = slots(rows), slots([*rows, *[(-1, "y")] * 2000])
    assert all(crowded[i] == alone[i] for i in alone)


def test_a_map_is_edited_not_dealt_anew():
    weight = np.random.default_rng(1).integers(1, 1000, 2000).astype(float)
    first = rebalance(even_map(2000, 10), weight, 10)
    weight[first == 3] *= 1.5
    second = rebalance(first, weight, 10)
    load = np.bincount(second, weight, 10)
    assert (first != second).mean() < 0.1 and load.max() - load.min() < 0.001 * load.sum()
    assert (rebalance(first, np.zeros(2000), 10) == first).all()


def test_map_versions_are_stored(spark):
    work = workspace(spark)
    shard_by_bytes(documents(spark, corpus()), 4, work)
    stored = spark.read.parquet(f"{work.root}/slot_map")
    assert {r["version"]: r["n"] for r in stored.groupBy("version").agg(F.count("*").alias("n")).collect()} == {1: 8192, 2: 8192}
