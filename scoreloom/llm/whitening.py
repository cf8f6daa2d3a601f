"""Embedding whitening by shifted CholeskyQR.

Every component c of a vector becomes the whole number floor(64 c) + 1,000,000. The distinct vectors are
the fit list. Its centred rows X are orthogonalised in passes over the cluster: a pass sends every
row through triangular solves with the factors found so far and sums the Gram matrix of the result;
the driver takes its Cholesky factor. The first pass adds a shift to the diagonal, so that the factor
exists however ill-conditioned X is; two more passes make Q orthogonal. With R the product of all
factors, X = QR, and the singular values of R (a matrix of the size of a vector squared) are those of X,
its right singular vectors the principal components. The covariance is never formed.

A Gram matrix leaves a task once, and matrices are summed in a tree of ``FAN_IN``, so that the driver
adds at most that many. Sums and deviations are exact.

Defined results: rows whose vector is null, or holds null or non-finite components, are left out, as are
vectors of another length than the commonest (the longer of equally common ones); a null id is an id like
others; repeated rows count once in the fit list and get a result each; directions in which the fit list
does not vary have whitened values of null and explain 0 (null if nothing varies at all); deviations
that pass 63 bits are null, and components that do so are taken as the last whole number that does not;
vectors without components are left out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared_store import Workspace, ship_package
from .registry import query, read

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
PASSES = 3  # one with a shift, two without
FAN_IN = 32
UNIT = 2.0**-53
NO_VARIANCE = 1e-14  # of the largest singular value, times the dimension


@dataclass
class Whitening:
    """What was learned from ``n`` distinct vectors."""

    n: int
    sums: list[int]  # per dimension, less OFFSET per vector
    mean: np.ndarray  # of the vectors less OFFSET
    axes: np.ndarray  # unit components as columns, all of them
    eigenvalues: np.ndarray
    projection: np.ndarray  # of centred rows on the leading components with variance, over sqrt(e)
    identity_error: float | None = None

    def explained(self) -> list[float | None]:
        total = self.eigenvalues.sum()
        return [e / total if total > 0 else None for e in self.eigenvalues.tolist()]

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2, null where they pass 63 bits."""
        sums = np.array(self.sums, object)
        widest = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))), max(map(abs, self.sums), default=0) // self.n + 1)
        if (2 * self.n * widest) ** 2 * max(1, x.shape[1]) < 2**62:
            return ((self.n * x - sums.astype(np.int64)) ** 2).sum(1).tolist()
        exact = ((self.n * x.astype(object) - sums) ** 2).sum(1)
        return [v if v < 2**63 else None for v in exact.tolist()]


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Per usable row: vec_id and x, the components as whole numbers less ``OFFSET``."""
    v = F.col(vector_col).cast("array<double>")

    def unusable(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    usable = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", unusable))
    length = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return usable.where((F.size("v") == (length["d"] if length else 0)) & (F.size("v") > 0)).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x"))


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def solved(x: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """The rows q with q R = x, column after column."""
    q = np.empty_like(x)
    for j in range(x.shape[1]):
        q[:, j] = (x[:, j] - q[:, :j] @ factor[:j, j]) / factor[j, j]
    return q


def partial_sums(rows: DataFrame, start: Callable[[int], np.ndarray], part: Callable[[np.ndarray], np.ndarray], work: Workspace, name: str) -> np.ndarray | None:
    """Sum of ``part`` over all rows: one matrix a task, added in a tree.

    Whole numbers are kept exact of any size, as Python numbers; the tree ends in at most ``FAN_IN`` rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"))
                total = part(x) + (start(x.shape[1]) if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held(total)], pa.binary())], ["held"])

    def added(rows: pa.Table) -> pa.Table:
        return pa.table({"grp": rows.column("grp")[:1], "held": pa.array([held(sum(map(taken, rows.column("held").to_pylist())))], pa.binary())})

    stored = work.save(rows.select("x").mapInArrow(run, "held binary"), name)
    count, level = stored.count(), 0
    while count > FAN_IN:
        count, level = -(-count // FAN_IN), level + 1
        dealt = stored.select(F.pmod(F.xxhash64("held"), F.lit(count)).alias("grp"), "held")
        stored = work.save(dealt.groupBy("grp").applyInArrow(added, "grp long, held binary").select("held"), f"{name}{level}")
    parts = [taken(r["held"]) for r in stored.collect()]
    return sum(parts) if parts else None


def held(values: np.ndarray) -> bytes:
    if values.dtype == object:
        return b"i" + json.dumps(values.tolist()).encode()
    return b"f" + values.shape[0].to_bytes(4, "little") + values.astype("<f8").tobytes()


def taken(kept: bytes) -> np.ndarray:
    if kept[:1] == b"i":
        return np.array(json.loads(kept[1:]), object)
    return np.frombuffer(kept[5:], "<f8").reshape(int.from_bytes(kept[1:5], "little"), -1)


def exact_sums(x: np.ndarray) -> np.ndarray:
    """Number of rows, and sums per dimension, as Python numbers."""
    small = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) * len(x) < 2**62
    return np.array([len(x), *((x if small else x.astype(object)).sum(0).tolist())], object)


def factored(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor; a shift is added, or grows, until there is one."""
    least = 11 * (gram.shape[0] + 1) ** 2 * UNIT * np.linalg.norm(gram, 2)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, least)


def fit(distinct: DataFrame, work: Workspace, components: int = COMPONENTS) -> Whitening | None:
    """Learn from a stored table of distinct vectors (column x); None if it is empty."""
    ship_package(distinct.sparkSession)
    totals = partial_sums(distinct, lambda d: np.zeros(d + 1, object), exact_sums, work, "sums")
    if totals is None or len(totals) == 1:
        return None
    n, sums = totals[0], totals[1:].tolist()
    d, mean = len(sums), np.array([s / n for s in sums])
    factors: list[np.ndarray] = []

    def gram(x: np.ndarray) -> np.ndarray:
        q = x - mean
        for factor in factors:
            q = solved(q, factor)
        return q.T @ q

    for k in range(PASSES):
        found = partial_sums(distinct, lambda d: np.zeros((d, d)), gram, work, f"gram{k}")
        if not found.any():
            break  # nothing varies
        shift = 11 * (n * d + d * (d + 1)) * UNIT * np.linalg.norm(found, 2)
        factors.append(factored(found, 0.0 if k else shift))
    whole = np.eye(d) if factors else np.zeros((d, d))
    for factor in factors:
        whole = factor @ whole
    _, stretch, axes = np.linalg.svd(whole)
    stretch[stretch <= stretch[0] * d * NO_VARIANCE] = 0
    axes = axes.T * np.where(axes[np.arange(d), np.abs(axes).argmax(1)] < 0, -1, 1)
    eigenvalues = stretch**2 / n
    lead = int((eigenvalues[:components] > 0).sum())
    model = Whitening(n, sums, mean, axes, eigenvalues, axes[:, :lead] / np.sqrt(eigenvalues[:lead]))
    if lead:
        def whitened_gram(x: np.ndarray) -> np.ndarray:
            z = (x - mean) @ model.projection
            z = np.hstack([z, np.ones((len(z), 1))])
            return z.T @ z

        second = partial_sums(distinct, lambda d: np.zeros((lead + 1, lead + 1)), whitened_gram, work, "check") / n
        covariance = second[:lead, :lead] - np.outer(second[-1, :lead], second[-1, :lead])
        model.identity_error = float(np.abs(covariance - np.eye(lead)).max())
    return model


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """One row per row of ``rows`` (vec_id, x) and component."""
    ship_package(rows.sparkSession)
    kind = rows.schema["vec_id"].dataType.simpleString()
    count, lead = min(components, len(model.mean)), model.projection.shape[1]
    explained = model.explained()[:count]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, each = matrix(batch.column("x")), np.repeat(np.arange(batch.num_rows), count)
            z = np.full((len(x), count), np.nan)
            z[:, :lead] = (x - model.mean) @ model.projection
            columns = {
                "vec_id": batch.column("vec_id").take(pa.array(each)), "component": pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(each), model.n, np.int64)), "deviation": pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                "whitened": pa.array(z.ravel(), from_pandas=True), "explained": pa.array(explained * len(x), pa.float64()),
                "identity_error": pa.array([model.identity_error] * len(each), pa.float64()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rows.mapInArrow(run, f"vec_id {kind}, {RESULT}")


def whitening(vectors: DataFrame, work: Workspace, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit on the distinct vectors and whiten every usable row."""
    rows = whole_vectors(vectors, id_col, vector_col)
    model = fit(work.save(rows.select("x").distinct(), "distinct"), work, components)
    if model is None:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, {RESULT}")
    return whitened(rows, model, components)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening(vectors, Workspace(spark, "whitening"))
