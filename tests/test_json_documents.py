"""JSON arrays and objects written by many tasks, and documents keyed by id read in ranges of bytes."""

import io
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoreloom.sources.json_documents import (
    joined, key_and_value, range_entries, range_states, read_json_array, read_json_by_id, state_after, write_json_array, write_json_by_key, write_json_record,
)

HARD = ['"', "\\", '\\"', "}", "{", "[", "]", ",", ":", "é", "\n", "日本", '{"a": 1},', "\\\\"]


def whole(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*.json")))


def entries_of(raw, size):
    """All entries, with every range read on its own from the state the first pass finds."""
    out, state, depth = [], 0, 0
    for a in range(0, len(raw), size):
        b = min(a + size, len(raw))
        out += [key_and_value(t) for t in range_entries(io.BytesIO(raw), a, b, state, depth)]
        states, depths = range_states(io.BytesIO(raw), a, b)
        state, depth = states[state], depth + depths[state]
    assert (state, depth) == (0, 0)
    return out


VALUES = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text(alphabet=st.sampled_from('"\\{}[],:a é'), max_size=6),
                      lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(alphabet='"\\}{,a', max_size=3), x, max_size=3), max_leaves=8)


@given(st.dictionaries(st.text(alphabet='"\\}{,:ab', max_size=4), VALUES, max_size=5), st.integers(1, 40), st.sampled_from([None, 2]), st.booleans())
@settings(max_examples=300, deadline=None)
def test_ranges_of_any_size_give_every_entry_once(document, size, indent, ascii_only):
    raw = json.dumps(document, indent=indent, ensure_ascii=ascii_only).encode()
    got = entries_of(raw, size)
    assert [(k, json.loads(v)) for k, v in got] == list(document.items())


def test_states_at_every_cut():
    raw = json.dumps({h: [h, {h: h * 3}] for h in HARD}, ensure_ascii=False).encode()
    for cut in range(len(raw)):
        middle, depth = state_after(raw[:cut], 0) if cut else (0, 0)
        end, more = state_after(raw[cut:], middle)
        assert (end, depth + more) == (0, 0)


@pytest.mark.parametrize("raw, fault", [(b'{"a": 1, "b": {"c"', "inside"), (b'{"a": "x', "inside"), (b'[{"a": 1}]', "array"), (b"{1: 2}", "not an entry")])
def test_broken_documents_are_refused(raw, fault):
    with pytest.raises(ValueError, match=fault):
        [key_and_value(t) for t in range_entries(io.BytesIO(raw), 0, len(raw), 0, 0)]


def test_array_of_many_pieces_is_one_ordered_array(spark, tmp_path):
    rows = spark.range(500).select((F.col("id") * 37 % 500).alias("n"), F.when(F.col("id") % 3 == 0, F.concat(F.lit('a"\\\n,'), F.col("id").cast("string"))).alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_json_array(rows.repartition(7), str(tmp_path / "a"), [F.col("n").asc()])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = json.loads(whole(tmp_path / "a"))
    assert [r["n"] for r in got] == list(range(500)) and set(got[0]) == {"n", "t"}
    assert len(list((tmp_path / "a").glob("part-*"))) > 5
    back = read_json_array(spark, str(tmp_path / "a"), "n BIGINT, t STRING")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    write_json_array(rows.where("n < 2"), str(tmp_path / "a"))  # replaces, pieces without rows are left out
    assert sorted(r["n"] for r in json.loads(whole(tmp_path / "a"))) == [0, 1]
    write_json_array(rows.limit(0), str(tmp_path / "a"))
    assert json.loads(whole(tmp_path / "a")) == []


def test_object_keyed_by_id_and_back_in_ranges(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"k{i}" + rng.choice(HARD), i, [rng.choice(HARD) for _ in range(i % 4)]) for i in range(300)]
    df = spark.createDataFrame([*rows, (None, 1, [])], "id STRING, n INT, tags ARRAY<STRING>")
    write_json_by_key(df, str(tmp_path / "o"), "id")
    assert json.loads(whole(tmp_path / "o")) == {k: {"n": n, "tags": t} for k, n, t in rows}
    joined(spark, str(tmp_path / "o"), str(tmp_path / "one.json"))
    assert (tmp_path / "one.json").read_text() == whole(tmp_path / "o")
    for size in (97, 1000, 1 << 20):
        got = read_json_by_id(spark, str(tmp_path / "one.json"), "n INT, tags ARRAY<STRING>", size).collect()
        assert sorted((r.id, r.value.n, r.value.tags) for r in got) == sorted(rows)


def test_small_ranges_grow_with_the_document(spark, tmp_path):
    held = {str(i): {"t": "}{" * (i % 5)} for i in range(2000)}
    (tmp_path / "d.json").write_text(json.dumps(held))
    found = read_json_by_id(spark, str(tmp_path / "d.json"), "t STRING", 8)
    assert found.rdd.getNumPartitions() <= 300
    assert {r.id: r.value.t for r in found.collect()} == {k: v["t"] for k, v in held.items()}


def test_one_long_entry_and_whole_folders(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.json").write_text(json.dumps({"long": {"t": "x" * 3_000_000}, "b": {"t": None}}))
    (tmp_path / "d" / "b.json").write_text("{}")
    got = {r.id: r.value.t for r in read_json_by_id(spark, str(tmp_path / "d"), "t STRING", 100_000).collect()}
    assert len(got["long"]) == 3_000_000 and got["b"] is None and len(got) == 2
    with pytest.raises(ValueError, match="whole"):
        (tmp_path / "c.json").write_text('{"a": {"t": "x')
        read_json_by_id(spark, str(tmp_path / "c.json"), "t STRING")


def test_record(spark, tmp_path):
    write_json_record(spark.createDataFrame([(1, None)], "a INT, b STRING"), str(tmp_path / "r"))
    assert json.loads(whole(tmp_path / "r")) == {"a": 1, "b": None}
    for n in (0, 2):
        with pytest.raises(ValueError, match="exactly one"):
            write_json_record(spark.range(n), str(tmp_path / "r"))
