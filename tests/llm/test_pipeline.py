"""Stages of the pipeline, and all of them in a row, against brute force."""

from __future__ import annotations

import random
import zlib

import corpus_pipeline
import pytest
from cases import corpus, documents
from test_line_dedup import brute as brute_lines
from test_near_dup import shingles
from test_suffix_dedup import brute_passages

from scoreloom.llm.bpe import VOCABULARY, encoder, vocabulary_path
from scoreloom.llm.packing import CAPACITY, END_TOKEN

CLASHING = "doc_id BIGINT, text STRING, n_chars BIGINT, t1 STRING, _kept INT, spans INT, number STRING, own_id INT"


def groups(texts):
    """Group of every text, by comparing all shingle sets; None for texts without words."""
    sets = [shingles(t) for t in texts]
    group = [i if s else None for i, s in enumerate(sets)]
    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    return group


def check_one_of_each_group(spark, rows):
    """Exactly one row of a group stays, it has the group's least id, and rows without words stay."""
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicate(spark, documents(spark, rows), "").collect()]
    group = groups([t for _, t in rows])
    at = {t: g for (_, t), g in zip(rows, group, strict=True)}
    assert all(x in rows for x in got)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    blank = [r for r, g in zip(rows, group, strict=True) if g is None]
    assert sorted([r for r in got if at[r[1]] is None], key=key) == sorted(blank, key=key)
    held = [at[t] for _, t in got if at[t] is not None]
    assert sorted(held) == sorted(set(group) - {None})
    for d, t in got:
        ids = [i for (i, _), g in zip(rows, group, strict=True) if g == at[t] and i is not None]
        assert at[t] is None or d == min(ids, default=None)


def test_near_duplicates_leave_one_row_of_each_group(spark):
    rng = random.Random(11)
    w = [[f"v{rng.random()}" for _ in range(60)] for _ in range(4)]
    near = lambda x: " ".join([*x[:-1], "other"])
    text = [" ".join(x) for x in w]
    more = [(None, text[0]), (None, text[0]), (None, near(w[0])), (None, text[1]), (None, near(w[1]))]  # no ids at all
    more += [(7000, text[2])] * 3 + [(7000, near(w[2])), (7000, text[3])]  # one id for several texts and groups
    check_one_of_each_group(spark, corpus() + more)


def test_a_source_loaded_twice_comes_out_once(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(120))) for i in range(8)]
    rows = rows * 2 + [(None, " ".join(f"w{rng.randrange(10**6)}" for _ in range(120)))] * 2
    kept = corpus_pipeline.suffixes(spark, corpus_pipeline.near_duplicate(spark, documents(spark, rows), ""), "").collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r["doc_id"], r["text"]) for r in kept], key=key) == sorted(set(rows), key=key)
    assert {(r["t1"], r["node"], r["spans"]) for r in kept} == {("x", 1, 2)}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, ""), (None, "")]])
def test_near_duplicates_of_nothing(spark, rows):
    got = corpus_pipeline.near_duplicate(spark, documents(spark, rows), "").collect()
    assert [(r["doc_id"], r["text"]) for r in got] == rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, None if t is None else len(t), "x", 1, 2, "y", 3) for i, t in rows], CLASHING)


def stored(spark, tmp_path, rows, labels):
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def left(rows, texts):
    """Rows with their new texts, empty for null; those that lost all their words are gone."""
    new = [(i, n.decode("utf-8", "ignore")) for (i, _), n in zip(rows, texts, strict=True)]
    return [b for a, b in zip(rows, new, strict=True) if (a[1] or "") == b[1] or b[1].split()]


def after_lines(rows):
    return left(rows, [kept for *_, kept in brute_lines(rows)])


def after_near_duplicates(rows):
    """For rows in which equal ids have equal texts."""
    first = {}
    group = groups([t for _, t in rows])
    for k, ((i, _), g) in enumerate(zip(rows, group, strict=True)):
        first[g] = min(first.get(g, (True, 0, k)), (i is None, i or 0, k))
    return [r for k, (r, g) in enumerate(zip(rows, group, strict=True)) if g is None or first[g][2] == k]


def after_suffixes(rows):
    return left(rows, brute_passages([(t or "").encode() for _, t in rows], 400, corpus_pipeline.PASSAGE_WORDS))


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def shared_cases():
    return [(i, t) for i, t in corpus() if t is None or len(t) < 5000]


@pytest.mark.parametrize(("stage", "brute"), [(corpus_pipeline.lines, after_lines), (corpus_pipeline.suffixes, after_suffixes)])
def test_stages_that_change_texts(spark, stage, brute):
    rows = shared_cases()
    got = stage(spark, table(spark, rows), "").collect()
    assert in_order([(r["doc_id"], r["text"]) for r in got]) == in_order(brute(rows))
    assert all((r["n_chars"] or 0) == len(r["text"]) for r in got)  # null stays null
    assert {tuple(r)[3:] for r in got} == {("x", 1, 2, "y", 3)}


def test_one_worker_a_task_cuts_and_mends_texts(spark):
    plan = corpus_pipeline.suffixes(spark, table(spark, [(1, "a b"), (2, "é" * 900)]), "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert "EvalPython" not in plan


def test_characters_cut_in_two_go_wholly(spark):
    rows = [(1, "xé" + "ab" * 300 + "éx"), (2, "yè" + "ab" * 300 + "èy")]  # a byte of é and è is the same
    got = corpus_pipeline.suffixes(spark, table(spark, rows), "").collect()
    assert in_order([(r["doc_id"], r["text"]) for r in got]) == in_order(after_suffixes(rows))
    assert {r["n_chars"] for r in got} == {len(r["text"]) for r in got}


def test_all_stages_in_a_row(spark, tmp_path):
    rows = shared_cases()
    # one label only: the classifier keeps all
    got = corpus_pipeline.run(spark, stored(spark, tmp_path, rows, [(10 + 3 * i, 1) for i in range(20)])).collect()
    encode, want = encoder(vocabulary_path(VOCABULARY), 1000), []
    for i, text in after_suffixes(after_near_duplicates(after_lines(rows))):
        ids = encode.ids((text or "").encode()) + END_TOKEN.to_bytes(4, "little")
        want += [(i, k, zlib.crc32(ids[at : at + 4 * CAPACITY])) for k, at in enumerate(range(0, len(ids), 4 * CAPACITY))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r["doc_id"], r["piece"], r["ids_crc32"]) for r in got], key=key) == sorted(want, key=key)
    used = {}
    for r in got:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= CAPACITY


def test_quality_drops_what_only_bad_labels_know_and_nothing_is_nothing(spark, tmp_path):
    folder = stored(spark, tmp_path, [], [(i, 0) for i in range(100)])
    rows = [(i, f"words of document {i}") for i in range(100)]
    assert corpus_pipeline.quality(spark, table(spark, rows), folder).count() == 0
    assert corpus_pipeline.run(spark, folder).count() == 0
