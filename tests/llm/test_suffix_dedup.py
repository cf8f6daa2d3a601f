"""Suffix arrays against sorting, and removed bytes against counting all strings."""

import random
from collections import Counter

import numpy as np
import pytest
from cases import corpus, documents, workspace

from scoreloom.llm.lyndon_grouping import suffix_array
from scoreloom.llm.sides import sieved
from scoreloom.llm.suffix_dedup import anchor_rows, anchors, keyed, passage_spans, word_bytes, without_repeats


def test_suffix_array_equals_sorting():
    rng = random.Random(1)
    for _ in range(2000):
        a = [rng.randint(0, rng.choice([0, 1, 2, 4])) for _ in range(rng.randint(0, 14))]
        assert suffix_array(np.array(a, np.int64)).tolist() == sorted(range(len(a)), key=lambda i: a[i:])


def test_anchors_own_every_start_once_and_depend_on_the_string_alone():
    rng = random.Random(2)
    text = bytes(rng.choice(b"abc") for _ in range(900))
    place, near, far = anchors(text, 60, 16)
    owned = {}
    for p, a, b in zip(place.tolist(), near.tolist(), far.tolist(), strict=True):
        for d in range(a, b + 1):
            assert p - d not in owned
            owned[p - d] = d
    assert sorted(owned) == list(range(len(text) - 60 + 1))
    for s in (0, 100, 555):
        assert anchors(text[s : s + 60], 60, 16)[2].tolist() == [owned[s]]


def test_a_text_that_repeats_itself_gives_one_row_for_each_context(spark):
    text = "begins " + "same words. " * 200 + "ends"
    rows = anchor_rows(keyed(documents(spark, [(1, text)]).select("doc_id", "text"), "text"), 60, 16).collect()
    place, near, far = anchors(text.encode(), 60, 16)
    assert len({(r["key"], r["context"]) for r in rows}) == len(rows) < len(place) / 5
    assert sorted((p, r["near"], r["far"]) for r in rows for p in r["places"]) == list(zip(place.tolist(), near.tolist(), far.tolist(), strict=True))


def test_a_sieve_loses_no_key_and_leaves_out_most_others(spark):
    rows = spark.range(20000).selectExpr("id", "xxhash64(id) as k")
    keys = rows.where("id % 1000 = 0").select("k")
    kept = {r["id"] for r in sieved(rows, "k", keys).collect()}
    assert set(range(0, 20000, 1000)) <= kept and len(kept) < 40
    assert sieved(rows, "k", keys.limit(0)).count() == 0


def brute(texts: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((sum(gone), runs, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("settings", [
    {"length": 60, "key": 16, "piece": 8}, {"length": 60, "key": 16, "piece": 32, "shard_contexts": 5}, {"length": 400},
])
def test_removal_equals_counting_all_strings(spark, settings):
    rows = corpus()
    if "shard_contexts" in settings:  # one passage before and after many different texts: more contexts than a shard holds
        rng = random.Random(5)
        common = "".join(rng.choice("abcdefgh ") for _ in range(90))
        rows += [(1000 + i, "".join(rng.choice("abz") for _ in range(70)) + common + "".join(rng.choice("xyz") for _ in range(70))) for i in range(40)]
    got = without_repeats(documents(spark, rows), workspace(spark), **settings).collect()
    want = brute([(t or "").encode() for _, t in rows], settings["length"])
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    left = sorted(((r["doc_id"], r["_n_removed"], r["_n_spans"], bytes(r["_kept"])) for r in got), key=key)
    right = sorted(((i, *w) for (i, _), w in zip(rows, want, strict=True)), key=key)
    assert left == right
    assert {r["t1"] for r in got} == {"x"} and {r["spans"] for r in got} == {2}


def test_empty_table(spark):
    assert without_repeats(documents(spark, []), workspace(spark)).count() == 0


def brute_passages(texts: list[bytes], length: int, n: int) -> list[bytes]:
    """What is left without strings of ``length`` bytes and passages of n words that start twice."""
    strings = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    passages = Counter(tuple(w[i : i + n]) for w in (t.split() for t in texts) for i in range(len(w) - n + 1))
    out = []
    for t in texts:
        gone, w, ends, at = bytearray(len(t)), t.split(), [], 0
        for word in w:
            at = t.index(word, at) + len(word)
            ends.append(at)
        for i in range(len(t) - length + 1):
            if strings[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        for i in range(len(w) - n + 1):
            if passages[tuple(w[i : i + n])] > 1:
                lo, hi = ends[i] - len(w[i]), ends[i + n - 1]
                gone[lo:hi] = b"\1" * (hi - lo)
        out.append(bytes(b for b, g in zip(t, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("settings", [{"passage_words": 51}, {"passage_words": 6, "length": 90, "key": 16, "piece": 8, "shard_contexts": 9}])
def test_removed_passages_equal_counting_all_passages(spark, settings):
    rng = random.Random(6)
    short = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 2) for _ in range(n)) for n in (50, 51, 60)]
    rows = corpus() + [(2000 + 10 * k + i, f"{i} begins\n{s} {i} ends ÄÖ") for k, s in enumerate(short) for i in range(2)]
    rows += [(3000, "other white space " + short[1].replace(" ", "\n\t", 3)), (3001, "other case " + short[0].upper())]
    got = without_repeats(documents(spark, rows), workspace(spark), **settings).collect()
    want = brute_passages([(t or "").encode() for _, t in rows], settings.get("length", 400), settings["passage_words"])
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r["doc_id"], bytes(r["_kept"])) for r in got], key=key) == sorted(
        [(i, w) for (i, _), w in zip(rows, want, strict=True)], key=key)


def test_a_short_passage_of_51_words_goes_and_one_of_50_stays(spark):
    rng = random.Random(7)
    for n, gone in ((51, True), (50, False)):
        passage = " ".join(rng.choice("abcdefghijkl") for _ in range(n))  # about 100 bytes
        rows = [(i, f"document {i} {passage} {i} goes on") for i in range(2)]
        got = without_repeats(documents(spark, rows), workspace(spark), passage_words=51).collect()
        assert [passage.encode() not in bytes(r["_kept"]) for r in got] == [gone] * 2


def test_words_covered_in_part_stay():
    text = b" one two\n three"
    assert [len(x) for x in word_bytes([text, b"", b"a"])] == [24, 0, 8]
    assert passage_spans(text, [(0, 16), (3, 21), (9, 20)]) == [(1, 8), (5, 8)]
