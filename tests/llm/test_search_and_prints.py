"""Top-k search and fingerprints against plain Python."""

import hashlib
import math
import random

import pytest
import xxhash
from cases import corpus, documents, workspace
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoreloom.llm.fingerprints import edit_distance, edited, fingerprint, likeness, with_next
from scoreloom.llm.topk_kdtree import top_k


def vectors(seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(400, None), (401, [1.0, None] * 4), (402, [math.nan] * 8), (403, [math.inf] * 8), (450, None), (404, [0.5, 0.25]), (405, [])]
    rows += [(406, [1e7] * 8), (407, [-1e7] * 8)]  # sums beyond doubles
    return rows


def brute(rows, every, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(ok):
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(ok) if m != n)[:k]  # noqa: B905
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return out


@pytest.mark.parametrize("shape", [{}, {"shard_rows": 40, "query_rows": 7}])
def test_top_k_equals_brute_force(spark, shape):
    rows = vectors()
    table = spark.createDataFrame([(i, v, "s", 1) for i, v in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, shard STRING, row INT")
    got = top_k(table, F.col("vec_id") % 10 == 0, workspace(spark), 5, **shape).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 10, 5))


def test_top_k_of_few_and_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (3, [2.0])], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    got = top_k(few, F.col("vec_id") % 50 == 0, workspace(spark)).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 3, 131072)] * 2 + [(0, 2, 0, 65536)] * 2
    assert top_k(few.limit(0), F.col("vec_id") % 50 == 0, workspace(spark)).count() == 0


@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
@settings(max_examples=300, deadline=None)
def test_edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    assert edit_distance(a, b) == row[-1]


def test_likeness_follows_edits():
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(5000))
    other = bytes(rng.choice(b"abcdefgh ") for _ in range(5000))
    assert likeness(fingerprint(text), fingerprint(text)) == 1
    assert likeness(fingerprint(text), fingerprint(text[:2000] + b"x" + text[2000:])) > 0.9
    assert likeness(fingerprint(text), fingerprint(text[:3750] + other[:1250])) > 0.6
    assert likeness(fingerprint(text), fingerprint(other)) < 0.1
    assert likeness(fingerprint(b""), fingerprint(b"")) == 1 and likeness(fingerprint(b""), fingerprint(text)) == 0


def in_order(rows):
    """Nulls first, ids ascending, equal ids by the signed 64-bit hash of the text."""
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64
    return sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])))


HOT = [(None, "the same row again and again")] * 400 + [(7, f"text {i}") for i in range(400)] + [(i, f"row {i}") for i in range(400)]


def test_repeated_ids_fill_many_ranges(spark):
    work = workspace(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    got = with_next(documents(spark, HOT), work).collect()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    ranges = spark.read.parquet(f"{work.root}/walked").where("place <> 'last'").groupBy("range").count().collect()
    assert len(ranges) == 12 and max(r["count"] for r in ranges) < 200
    order = in_order(HOT)
    want = sorted(hashlib.sha256(edited(t, n).encode()).hexdigest() for (_, t), (_, n) in zip(order, [*order[1:], order[0]], strict=True))
    assert sorted(r["edited_sha256"] for r in got) == want


def test_every_document_meets_the_next(spark):
    rows = corpus()
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    got = with_next(documents(spark, rows), workspace(spark)).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    order = in_order(rows)
    want = []
    for (d, t), (_, n) in zip(order, [*order[1:], order[0]], strict=True):
        e = edited(t, n).encode()
        a, b = fingerprint(t.encode()), fingerprint(e)
        want.append((d, len(t), hashlib.sha256(e).hexdigest(), a, b, likeness(a, b), likeness(a, fingerprint(n.encode()))))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert with_next(documents(spark, []), workspace(spark)).count() == 0
    alone = with_next(documents(spark, [(1, "abcd")]), workspace(spark)).collect()
    assert [r["edited_sha256"] for r in alone] == [hashlib.sha256(b"abca").hexdigest()]
