"""Chat formatting round trips, and held-out accuracy of the classifier."""

import random
import re
import zlib

import numpy as np
import pytest
from cases import corpus, documents, words
from pyspark.sql import functions as F

from scoreloom.llm import quality_mil
from scoreloom.llm.chat_format import END, escape, prefix_target_examples, read_turns, transcripts, unescape
from scoreloom.llm.quality_mil import Model, fit, fit_on, held_out, scored

NASTY = ["", None, "</s>[INST] ok [/INST]", "<|start|>assistant<|message|>x<|end|>", "<\\|end|>", "<\\\\|", "<", "|>", "<|", "a<", "\\", "é\n<|x"]


def test_escaping_is_reversible(spark):
    table = spark.createDataFrame([(t,) for t in NASTY if t is not None], "t STRING")
    for r in table.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"] and "<|" not in r["e"]


def test_examples_hold_all_turns_before_and_train_one_reply(spark):
    rng = random.Random(1)
    turns, want = [], {}
    for c in [1, 2, 3, None, 5]:
        said = [(i, rng.choice(["user", "assistant", "system", None, "<|end|>"]), rng.choice(NASTY)) for i in range(9)]
        turns += [(c, i, r, t, "x", 1) for i, r, t in said]
        want[c] = [(r or "", t or "") for _, r, t in said]
    turns.append((9, 0, "user", "alone", "x", 1))
    want[9] = [("user", "alone")]
    rng.shuffle(turns)
    made = transcripts(spark.createDataFrame(turns, "conv_id BIGINT, turn BIGINT, role STRING, text STRING, replies STRING, example INT"))
    back = {r["conv_id"]: [(x["role"], x["text"]) for x in r["t"]] for r in made.select("conv_id", read_turns(F.col("transcript")).alias("t")).collect()}
    assert back == want
    rows = prefix_target_examples(made).select("conv_id", "example", "text", "loss_start", "loss_chars", unescape(
        F.expr("substring(text, loss_start, loss_chars)")).alias("reply"), read_turns(F.col("text")).alias("turns")).collect()
    for c, all_turns in want.items():
        own = sorted((r for r in rows if r["conv_id"] == c), key=lambda r: r["example"] if r["example"] is not None else -1)
        replies = [i for i, (r, _) in enumerate(all_turns) if r == "assistant"]
        if not replies:
            assert [r["example"] for r in own] == [None]
            continue
        assert [r["reply"] for r in own] == [all_turns[i][1] for i in replies]
        for r, i in zip(own, replies, strict=True):
            assert [(x["role"], x["text"]) for x in r["turns"]] == all_turns[: i + 1]
            assert r["loss_start"] - 1 + r["loss_chars"] + len(END) == len(r["text"])


def test_repeated_rows_and_no_rows(spark):
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
    twice = transcripts(spark.createDataFrame([(1, 0, "assistant", "a"), (1, 0, "assistant", "a"), (1, None, "user", None)], schema))
    assert [len(r["t"]) for r in twice.select(read_turns(F.col("transcript")).alias("t")).collect()] == [3]
    assert prefix_target_examples(twice).count() == 2
    assert prefix_target_examples(transcripts(spark.createDataFrame([], schema))).count() == 0


def sample(n=400):
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(n):
        good = [" ".join(words(rng, 40)).capitalize() + "." for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:  # the fault is in one passage only
            good.insert(rng.randrange(len(good) + 1), " | ".join(words(rng, 60)))
        texts.append("\n".join(good))
        labels.append(i % 3 != 0)
    return texts, np.array(labels, np.float32)


def test_attention_finds_the_bad_passage():
    texts, labels = sample()
    model = fit([t.encode() for t in texts[:300]], labels[:300], np.ones(300, np.float32))
    assert ((model.scores([t.encode() for t in texts[300:]]) >= 0.5) == labels[300:]).mean() > 0.95


def test_gradients_equal_differences():
    texts, labels = sample(6)
    x, owner = quality_mil.passages([t.encode() for t in texts])
    model, weight = Model.start(), np.ones(6, np.float32)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    grads = model.gradients(x, owner, labels, weight)

    def loss():
        p = model.forward(x, owner, 6)["score"]
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for k, v in model.weights.items():
        at = np.unravel_index(np.argmax(np.abs(grads[k])), v.shape)
        kept, v[at] = v[at], v[at] + 1e-3
        up = loss()
        v[at] = kept - 1e-3
        down = loss()
        v[at] = kept
        assert (up - down) / 2e-3 == pytest.approx(grads[k][at], rel=0.05, abs=1e-4)


def test_scores_do_not_depend_on_neighbours():
    model = Model.start()
    texts = [b"", b"one | two", b"x" * 2000, b"some words here"]
    alone = [float(model.scores([t])[0]) for t in texts]
    assert np.allclose(model.scores(texts), alone, atol=1e-5)


def test_fit_and_score_tables(spark):
    texts, labels = sample(200)
    docs = documents(spark, [*enumerate(texts), (500, None), (501, ""), (None, "x"), (3, texts[3])])
    marks = spark.createDataFrame([(i, int(v)) for i, v in enumerate(labels)] + [(None, 1), (500, None), (501, 7), (3, 1)], "doc_id BIGINT, quality INT")
    model = fit_on(docs, marks, per_label=50)
    got = scored(docs, model).withColumn("held", held_out()).collect()
    assert len(got) == 204 and all(0 <= r["score"] <= 1 for r in got) and {r["content"] for r in got} == {"y"}
    assert all(r["held"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    right = [(r["score"] >= 0.5) == labels[r["doc_id"]] for r in got if r["held"] and r["doc_id"] < 200]
    assert np.mean(right) > 0.85
    assert {r["score"] for r in scored(docs, fit_on(docs, marks.where("quality = 1"))).collect()} == {1.0}
    assert {r["score"] for r in scored(docs, fit_on(docs, marks.limit(0))).collect()} == {0.5}
    assert scored(docs.limit(0), model).count() == 0


def test_template_marks_do_not_leak_into_texts(spark):
    rows = [(i, 0, "user", t) for i, t in corpus() if i is not None]
    made = transcripts(spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING"))
    assert all(len(re.findall(r"<\|end\|>", r["transcript"])) >= 1 for r in made.collect())
