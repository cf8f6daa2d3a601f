"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages, only the bag has a label. Every passage is encoded from hashed
byte trigrams, once as characters and once as shapes (letter, capital, digit, blank, sign), and from
how often the passage repeats itself.
A gated attention weighs the passages, and a logistic layer scores their weighted sum. Encoder,
attention and score are learned together from document labels.

The model is fitted on at most ``SAMPLE_PER_LABEL`` labelled documents of each label, those whose
id hashes lowest; weights restore the share of each label. Scoring reads every whole text.

Defined results: null and empty texts are one empty passage and get a score like all others; repeated
rows get the same score; without documents of both labels every score is the share of label 1 (0.5
without labels); an empty table gives no rows; labels other than 0 and 1 are not learned from; only
the text is an input of a score, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from ..shared_store import ship_package
from .passing import tidy, veiled
from .registry import query, read

PASSAGE_BYTES = 512
BUCKETS = 512  # of each kind of trigram
DENSE = 3
GAP = 8
HIDDEN, ATTENTION = 24, 12
SAMPLE_PER_LABEL = 800
FIT_TEXTS = 50  # texts encoded at a time when fitting
EPOCHS, BATCH, RATE, DECAY = 12, 32, 0.01, 1e-4


def shape_codes() -> np.ndarray:
    code = np.full(256, 6, np.uint32)
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    code[signs] = np.arange(7, 7 + len(signs))
    code[[b for b in range(128) if chr(b).islower()]] = 1
    code[[b for b in range(128) if chr(b).isupper()]] = 2
    code[[b for b in range(128) if chr(b).isdigit()]] = 3
    code[32], code[[9, 10, 11, 12, 13]] = 4, 5
    return code


SHAPE = shape_codes()


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Encoder inputs of all passages of the texts, and the text each belongs to."""
    lengths = np.array([len(t) for t in texts], np.int64)
    gap = b"\n" * GAP  # no gram reaches into the next text
    codes = np.frombuffer(gap.join(texts) + gap, np.uint8)
    count = np.maximum(1, -(-lengths // PASSAGE_BYTES))
    owner = np.repeat(np.arange(len(texts)), count)
    starts = np.cumsum(lengths + GAP) - lengths - GAP
    text_of = np.repeat(np.arange(len(texts)), lengths)
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = inside + starts[text_of]
    row = ((np.cumsum(count) - count)[text_of] + inside // PASSAGE_BYTES) * BUCKETS

    def counted(bucket: np.ndarray) -> np.ndarray:
        return np.bincount(row + bucket, minlength=len(owner) * BUCKETS).reshape(-1, BUCKETS).astype(np.float32)

    def trigrams(letters: np.ndarray, bits: int) -> np.ndarray:
        gram = letters[at] | letters[at + 1] << np.uint32(bits) | letters[at + 2] << np.uint32(2 * bits)
        table = np.sqrt(counted((gram * np.uint32(2654435761)) >> np.uint32(23)))
        return table / np.maximum(1e-6, np.linalg.norm(table, axis=1, keepdims=True))

    lower = codes | np.where((codes >= 65) & (codes <= 90), 32, 0).astype(np.uint8)
    octets = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, GAP)).view("<u8").ravel()[at]
    repeats = counted(((octets * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(55)).astype(np.uint32))
    total = np.maximum(1, repeats.sum(1, keepdims=True))
    # how much of a passage the same few strings make up; about 0 in prose, up to 1
    alike = np.sqrt(np.maximum(0, (repeats * (repeats - 1)).sum(1, keepdims=True))) / total
    dense = 3 * np.hstack([alike, repeats.max(1, keepdims=True) / total, total / PASSAGE_BYTES]).astype(np.float32)
    return np.hstack([trigrams(SHAPE[codes], 6), trigrams(lower.astype(np.uint32), 8), dense]), owner


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def per_bag(values: np.ndarray, owner: np.ndarray, bags: int) -> np.ndarray:
    out = np.zeros((bags, *values.shape[1:]), np.float32)
    np.add.at(out, owner, values)
    return out


@dataclass
class Model:
    """Encoder (E, e), gated attention (V, U, w), and score (c, d)."""

    weights: dict[str, np.ndarray]
    share: float | None = None  # a constant score, if nothing could be learned

    @staticmethod
    def start(seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        shape = {"E": (2 * BUCKETS + DENSE, HIDDEN), "e": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "w": (ATTENTION,), "c": (HIDDEN,), "d": (1,)}
        return Model({k: (rng.normal(0, 0.3, s) if len(s) > 1 or k in "wc" else np.zeros(s)).astype(np.float32) for k, s in shape.items()})

    def forward(self, x: np.ndarray, owner: np.ndarray, bags: int) -> dict[str, np.ndarray]:
        m = self.weights
        h = np.tanh(x @ m["E"] + m["e"])
        v, u = np.tanh(h @ m["V"]), sigmoid(h @ m["U"])
        raw = (v * u) @ m["w"]
        top = np.full(bags, -np.inf, np.float32)
        np.maximum.at(top, owner, raw)
        exp = np.exp(raw - top[owner])
        a = exp / per_bag(exp, owner, bags)[owner]
        z = per_bag(a[:, None] * h, owner, bags)
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "score": sigmoid(z @ m["c"] + m["d"][0])}

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.share is not None:
            return np.full(len(texts), self.share)
        x, owner = passages(texts)
        return self.forward(x, owner, len(texts))["score"].astype(np.float64)

    def gradients(self, x: np.ndarray, owner: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        m, f = self.weights, self.forward(x, owner, len(label))
        out = (weight * (f["score"] - label) / weight.sum()).astype(np.float32)
        dz = out[:, None] * m["c"]
        da = (dz[owner] * f["h"]).sum(1)
        draw = f["a"] * (da - per_bag(f["a"] * da, owner, len(label))[owner])
        dgate = draw[:, None] * m["w"]
        dv, du = dgate * f["u"] * (1 - f["v"] ** 2), dgate * f["v"] * f["u"] * (1 - f["u"])
        dh = f["a"][:, None] * dz[owner] + dv @ m["V"].T + du @ m["U"].T
        dpre = dh * (1 - f["h"] ** 2)
        return {"E": x.T @ dpre, "e": dpre.sum(0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
                "w": (f["v"] * f["u"]).T @ draw, "c": f["z"].T @ out, "d": np.array([out.sum()])}


def fit(texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> Model:
    """Adam on batches of documents; the same input gives the same model."""
    if len(set(labels.tolist())) < 2:
        return Model({}, float(labels[0]) if len(labels) else 0.5)
    model, rng = Model.start(), np.random.default_rng(11)
    parts = [passages(texts[at : at + FIT_TEXTS]) for at in range(0, len(texts), FIT_TEXTS)]
    owner = np.concatenate([own + k * FIT_TEXTS for k, (_, own) in enumerate(parts)])
    x = np.concatenate([p for p, _ in parts])
    del parts
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    slow = {k: np.zeros_like(v) for k, v in model.weights.items()}
    square = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            bags = order[at : at + BATCH]
            rows = np.concatenate([np.arange(first[b], first[b + 1]) for b in bags])
            own = np.repeat(np.arange(len(bags)), first[bags + 1] - first[bags])
            step += 1
            for k, g in model.gradients(x[rows], own, labels[bags], weights[bags]).items():
                g = g + DECAY * model.weights[k]
                slow[k] = 0.9 * slow[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                model.weights[k] = (model.weights[k] - RATE * (slow[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: the checksum of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Fit on labelled documents that are not held out; ``labels`` has doc_id and quality."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    order = F.xxhash64("doc_id"), F.col("doc_id")
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}  # two rows
    parts = [usable.where(F.col("quality") == q).orderBy(*order).limit(per_label) for q in (0, 1)]
    chosen = parts[0].unionByName(parts[1]).dropDuplicates(["doc_id"])
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")).join(
        F.broadcast(chosen), "doc_id").orderBy(*order).limit(2 * per_label).toPandas()  # bounded by the parameter
    label = rows["quality"].to_numpy(np.float32)
    seen = np.bincount(label.astype(int), minlength=2)
    weight = np.array([counts.get(q, 0) / max(1, seen[q]) for q in (0, 1)], np.float32)
    texts = [bytes(t) for t in rows["text"]]
    del rows
    return fit(texts, label, weight[label.astype(int)])


def scored(docs: DataFrame, model: Model, out: str = "score", chunk_bytes: int = 1 << 19) -> DataFrame:
    """The rows with a score; texts are encoded in chunks of bounded size."""
    ship_package(docs.sparkSession)
    rows, names, back = veiled(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("content").to_pylist()
            parts = np.cumsum([len(t) for t in texts]) // chunk_bytes
            score = np.zeros(len(texts))
            for part in np.unique(parts):
                own = np.flatnonzero(parts == part)
                score[own] = model.scores([texts[i] for i in own])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names.values()], pa.array(score)], [*names.values(), out])
        tidy()

    given = rows.withColumn("content", F.coalesce(F.col(names["text"]), F.lit("")).cast("binary"))
    return back(given.mapInArrow(run, StructType([*rows.schema.fields]).add(out, DoubleType())), out)


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_on(docs, read(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
