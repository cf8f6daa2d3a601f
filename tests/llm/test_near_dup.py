"""Near-duplicate groups against comparing all shingle sets."""

import random

import numpy as np
import pandas as pd
from cases import corpus, documents, workspace

from scoreloom.llm import near_dup
from scoreloom.llm.components import components
from scoreloom.llm.near_dup import alike_by_sketch, linked_by_sets, near_duplicates, shingle_sets, signatures

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, (d, _) in zip(group, rows, strict=True):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    return [(d, len(s), least.get(g) if s else d) for (d, _), s, g in zip(rows, sets, group, strict=True)]


def check(spark, rows):
    got = near_duplicates(documents(spark, rows), workspace(spark)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    want = sorted(brute(rows), key=key)
    assert sorted([tuple(r)[:3] for r in got], key=key) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_groups_equal_brute_force(spark):
    check(spark, corpus())


def test_chains_of_edits_are_one_group(spark):
    rng = random.Random(3)
    w = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(40):
        rows.append((100 - i, " ".join(w)))
        w[rng.randrange(80)] = f"x{i}"
    check(spark, rows)


def test_empty_table(spark):
    assert near_duplicates(documents(spark, []), workspace(spark)).count() == 0


def test_sketches_estimate_high_similarity():
    rng = random.Random(4)
    for share in (0.75, 0.9):
        a = [f"a{rng.random()}" for _ in range(400)]
        same = round(400 * 2 * share / (1 + share))
        b = a[:same] + [f"b{rng.random()}" for _ in range(400 - same)]
        hashes = [np.unique(np.array([hash(x) & (2**64 - 1) for x in s], np.uint64)) for s in (a, b)]
        _, sketch = signatures(np.concatenate(hashes), np.array([400, 400]))
        differ = int(np.bitwise_count((sketch[0] ^ sketch[1]).view(np.uint64)).sum())
        guess = 1 + near_dup.BITS / (4 * near_dup.SAMPLES) * np.log(1 - 2 * differ / near_dup.BITS)
        assert abs(guess - share) < 0.2 and guess > near_dup.ESTIMATE


def test_blocks_look_across_components_only():
    texts = [b"a b c d e f g h i j", b"a b c d e f g h i j", b"q r s t u v w x y z"]
    hashes, sizes = shingle_sets(texts)
    _, sketch = signatures(hashes, sizes)
    at = [0, 1, 2, 1, 2]
    block = pd.DataFrame({
        "grp": 5, "h": 0, "l": 0, "node": [5, 6, 7, 6, 7], "component": [5, 6, 7, 6, 7], "n_shingles": 6,
        "sketch": [sketch[i] for i in at], "content": [texts[i] for i in at], "wide": [True, True, True, False, False]})
    assert set(alike_by_sketch(block)["node"]) == {5, 6}
    assert linked_by_sets(block)[["a", "b"]].to_numpy().tolist() == [[6, 5]]
    assert not len(alike_by_sketch(block.assign(component=5))) and not len(linked_by_sets(block.assign(component=5)))


def test_a_family_of_copies_with_many_edits(spark, monkeypatch):
    """Most copies are near the original, some near each other only; blocks are made small."""
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 800)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 9])):
            w[rng.randrange(100)] = f"x{rng.randrange(40)}"
        rows.append((i * 2, " ".join(w)))
    check(spark, rows)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (7, 7)], "a BIGINT, b BIGINT")
    got = {r["node"]: r["component"] for r in components(edges, workspace(spark), "c").collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}
