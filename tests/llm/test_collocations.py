"""Phrases against a brute-force count."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from cases import corpus, workspace
from pyspark.sql import functions as F

from scoreloom.llm import collocations as module
from scoreloom.llm.collocations import STRETCH, KeyFilter, collocations, combined, combining, gathered, phrase_nodes, stretches

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n\v\f\r]", (text or "").translate(LOWER))]


def brute(rows, least, top=2000):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for w in pieces(text):
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    have = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = {(lang, p[i : i + k]) for (lang, p), a in have.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 100 * f[lang, p[i : i + k]]}
    out = defaultdict(list)
    for (lang, p), a in have.items():
        if (lang, p) not in inside:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n, -s) for lang, found in out.items() for i, (s, a, p, l, r, n) in enumerate(sorted(found)[:top]))


def prose(seed, texts, vocabulary, longest):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)] + ["Ä", "ärger", "日本", "ẞ"]
    fixed = [[rng.choice(names) for _ in range(5)] for _ in range(3)]
    rows = []
    for i in range(texts):
        out = []
        for _ in range(rng.randint(0, longest)):
            out += rng.choice(fixed) if rng.random() < 0.2 else [rng.choice(names)]
            if rng.random() < 0.1:
                out[-1] += rng.choice(".,;:!?\n\r\t")
        rows.append((rng.choice(["en", "de", "und", None]), " ".join(out).title() if i % 7 == 0 else " ".join(out)))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(lang, t, 1, "x", 2) for lang, t in rows], "lang STRING, text STRING, n INT, w1 STRING, grp INT")


def found(spark, rows, **settings):
    return sorted(tuple(r) for r in collocations(table(spark, rows), workspace(spark), **settings).collect())


def test_equals_brute_force(spark):
    rows = prose(1, 120, 12, 90)
    rows += rows[:9] + [("en", None), (None, None), ("en", ""), ("fr", " .,; \t\n"), ("en", "one"), ("xx", "a b " * 40)]
    want = brute(rows, 20)
    assert len({r[0] for r in want}) > 3
    assert found(spark, rows, least=20) == want
    assert found(spark, rows, least=20, top=3) == [r for r in want if r[1] <= 3]
    assert found(spark, rows[:3], least=1000) == [] and found(spark, [], least=1) == []


def test_heavy_prefixes_are_lengthened_and_groups_hold_the_budget(spark):
    rows = prose(2, 60, 6, 60) + [("en", "the the the the the the " * 30)] * 5
    want = brute(rows, 5)
    work = workspace(spark)
    assert sorted(tuple(r) for r in collocations(table(spark, rows), work, least=5, budget=40).collect()) == want
    held = spark.read.parquet(*[f"{work.root}/prefixes{d}" for d in (2, 3)])
    assert held.where("rows > 40").count() > 0  # some were lengthened


def test_stored_suffixes_end_where_they_are_no_longer_frequent(spark):
    rows = prose(4, 300, 20, 60)
    work = workspace(spark)
    want = brute(rows, 40)
    assert sorted(tuple(r) for r in collocations(table(spark, rows), work, least=40).collect()) == want and max(len(r[2].split()) for r in want) == 5
    stored = [tuple(r) for r in spark.read.parquet(f"{work.root}/suffixes").collect()]
    totals = Counter()
    for *w, n in stored:
        totals.update({tuple(w[:k]): n for k in (3, 4) if w[k - 1]})
    assert stored and min(totals.values()) >= 40


def test_shared_cases_with_ties(spark):
    rows = [("en", t) for _, t in corpus()]
    assert found(spark, rows, least=3) == brute(rows, 3)


def batches(texts, langs=None):
    return iter([pa.RecordBatch.from_arrays([pa.array(langs or ["en"] * len(texts)), pa.array([t.encode() for t in texts], pa.binary())], ["lang", "text"])])


def test_stretches_cut_long_texts_between_words():
    rng = random.Random(3)
    texts = ["", "a" * 300, " ".join(rng.choice(["x", "yy", "z,", "Ä."]) * rng.randint(1, 4) for _ in range(400)), "", "end"]
    whole = next(stretches(batches(texts)))[1]
    for size in (1, 7, 64, 1000):
        parts = [s for _, s in stretches(batches(texts), size)]
        assert (np.concatenate([p.key for p in parts]) == whole.key).all()
        both = np.concatenate([p.piece for p in parts])
        assert ((both[1:] == both[:-1]) == (whole.piece[1:] == whole.piece[:-1])).all()
        assert [w for p in parts for w in p.words(np.arange(len(p.key)))] == [w.encode().lower() for t in texts for q in pieces(t) for w in q]


def test_suffixes_across_gathered_stretches():
    texts = ["a b c d e f g " * 50, "h i. j"]
    key, piece, own = next(gathered(batches(texts)))
    got = [(k[:n], p[:n]) for k, p, n in gathered(batches(texts), words=10)]
    assert (np.concatenate([k for k, _ in got]) == key[:own]).all()
    assert sum(len(k) for k, _ in got) == own == len(key)


def test_a_very_long_text(spark):
    text = "alpha beta gamma delta. " * 100_000  # over two stretches
    assert len(text) > 2 * STRETCH
    got = {r[2]: r[3] for r in found(spark, [("en", text), ("en", "alpha beta")])}
    assert got == {"alpha beta gamma delta": 100_000, "alpha beta": 100_001}


def test_nodes_of_made_up_suffixes(spark):
    rng = random.Random(5)
    rows = [tuple(x[:k] + [0] * (5 - k)) + (rng.randint(1, 3),) for x, k in (([rng.randint(1, 3) for _ in range(5)], rng.randint(2, 5)) for _ in range(500))]
    stored = workspace(spark).save(spark.createDataFrame(rows, "w1 long, w2 long, w3 long, w4 long, w5 long, n long"), "made")
    pairs = stored.groupBy("w1", "w2").agg(F.sum("n").alias("f")).where("f >= 4")
    want = Counter()
    for *w, n in rows:
        size = 5 - w.count(0)
        for k in range(2, size + 1):
            want[tuple(w[:k])] += n
    for budget in (1, 20, 10_000):
        got = {tuple(r[:5])[: r["depth"]]: r["f"] for r in phrase_nodes(stored.where("w3 <> 0"), pairs, workspace(spark), least=4, budget=budget).collect()}
        assert got == {k: v for k, v in want.items() if v >= 4}


def test_constants_name_every_separator():
    assert (module.LETTERS == 0).sum() == 12 and module.PARTS.sum() == 10


def test_combining_loses_nothing_whatever_it_may_hold():
    rng = np.random.default_rng(1)
    parts = [[rng.integers(0, 5, 40), rng.integers(0, 5, 40), rng.integers(1, 4, 40)] for _ in range(7)] + [[np.zeros(0, np.int64)] * 3]
    want = Counter()
    for a, b, n in parts:
        for x, y, k in zip(a.tolist(), b.tolist(), n.tolist(), strict=True):
            want[x, y] += k
    for most in (1, 500, 1 << 20):
        got = Counter()
        for batch in combining(iter(parts), ["a", "b", "n"], most):
            for r in batch.to_pylist():
                got[r["a"], r["b"]] += r["n"]
        assert got == want


def peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_what_a_worker_computes_on_the_way_is_small():
    rng, n = np.random.default_rng(2), 400_000
    columns = [rng.integers(0, 3, n) for _ in range(5)]
    assert peak(lambda: combined(columns, np.ones(n, np.int64))) < 5 * 8 * n  # less than the rows again
    frequent, keys = KeyFilter.__new__(KeyFilter), rng.integers(0, 2**63, n, dtype=np.uint64)
    frequent.bits = np.zeros(1 << 18, np.uint64)
    assert peak(lambda: frequent(keys)) < 8 * n


def test_gathered_words_are_not_held_once_they_are_given_out():
    parts = gathered(batches(["a b c d e f g " * 5_000] * 4), words=100_000)
    tracemalloc.start()
    try:
        got = next(parts)
        size, before = got[0].nbytes + got[1].nbytes, tracemalloc.get_traced_memory()[0]
        del got
        assert before - tracemalloc.get_traced_memory()[0] > 0.9 * size
    finally:
        tracemalloc.stop()
