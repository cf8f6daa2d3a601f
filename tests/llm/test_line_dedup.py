"""Dropped lines against comparing all lines, one by one."""

import numpy as np
import pytest
from cases import corpus, documents, workspace
from hypothesis import given, settings
from hypothesis import strategies as st

from scoreloom.llm.line_dedup import LEAST_WORDS, WHOLE, line_keys, plain_words, variants, within_one, without_repeated_lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@given(st.lists(st.sampled_from("abc"), max_size=7), st.lists(st.sampled_from("abc"), max_size=7))
@settings(max_examples=300, deadline=None)
def test_within_one_is_edit_distance(a, b):
    assert within_one(a, b) == (distance(a, b) <= 1)


@given(st.lists(st.sampled_from("abc"), min_size=8, max_size=11), st.lists(st.sampled_from("abc"), min_size=8, max_size=11))
@settings(max_examples=300, deadline=None)
def test_alike_lines_share_a_half_and_a_variant(a, b):
    if a == b or not within_one(a, b):
        return
    lines = [" ".join(x).encode() for x in (a, b)]
    halves = line_keys(lines, LEAST_WORDS)["halves"]
    assert set(halves[0]) & set(halves[1]) - {0}
    of, place, key = variants(lines)
    mine, other = ({(int(p), int(k)) for o, p, k in zip(of, place, key, strict=True) if o == i} for i in (0, 1))
    cut = lambda x: {k for p, k in x if p != WHOLE}
    whole = lambda x: {k for p, k in x if p == WHOLE}
    assert (mine & other) or (whole(mine) & cut(other)) or (cut(mine) & whole(other))


def brute(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first, near, places = {}, set(), {}
    for i in order:
        for k, line in enumerate((rows[i][1] or "").encode().split(b"\n")):
            w = tuple(plain_words(line))
            if w:
                first.setdefault(w, (rows[i], k))
                places.setdefault(w, len(places))
    long = [w for w in places if len(w) >= LEAST_WORDS]
    for a in long:
        near |= {a} if any(places[b] < places[a] and distance(a, b) <= 1 for b in long) else set()
    out = []
    for d, t in rows:
        lines = (t or "").encode().split(b"\n")
        gone = [bool(w := tuple(plain_words(x))) and (w in near or first[w] != ((d, t), k)) for k, x in enumerate(lines)]
        out.append((d, len(lines), sum(gone), b"\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return out


def test_dropped_lines_equal_brute_force(spark):
    rows = [(i, t) for i, t in corpus() if t is None or len(t) < 5000]
    got = without_repeated_lines(documents(spark, rows), workspace(spark)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r["doc_id"], r["_n_lines"], r["_n_dropped"], bytes(r["_kept"])) for r in got], key=key) == sorted(brute(rows), key=key)
    assert {r["content"] for r in got} == {"y"} and sum(r["_n_dropped"] for r in got) > 5


def test_one_very_common_frame_of_lines(spark):
    rows = [(i, f"this line is in every one of the documents but number {i}") for i in range(200)]
    got = without_repeated_lines(documents(spark, rows, extra=False), workspace(spark)).collect()
    assert sorted(r["doc_id"] for r in got if not r["_n_dropped"]) == [0]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "")]])
def test_nothing_to_drop(spark, rows):
    got = without_repeated_lines(documents(spark, rows), workspace(spark)).collect()
    assert [r["_n_dropped"] for r in got] == [0] * len(rows)
    assert np.all([bytes(r["_kept"]) == b"" for r in got])
