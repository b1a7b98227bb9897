"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The rows of a matrix X are the centred vectors.  Starting from a random unit vector, products with X and with its
transpose alternate: ``X V = U B`` with orthonormal V and U and an upper bidiagonal B.  The singular values of the small
B, scaled by the number of rows, are the deviations; V times its right singular vectors are the components.

X and U are as long as the corpus and stay where they are.  A column of U is a combination of products of X, so it
is kept as the short vector y with ``u = X y``.  One pass over the blocks of X gives a whole step: it forms
``p = X v - beta u``, and sums p'p, U'p and X'p.  From these the driver, which holds vectors of one dimension only,
orthogonalises p against all earlier columns, and has both the next alpha and the next transposed product.  V is
orthogonalised on the driver, twice.  A step that breaks down goes on from a new random vector, so that components of
equal deviation are all found; the steps end with the dimension, or before when the components that are asked for
no longer change.

The vectors are stored once more as blocks of centred rows, packed, which the passes read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import map_in_arrow, whole_row
from weftline.session import drop_stored, write_stored

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)
BLOCK_ROWS = 1024
EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """``sums`` of the whole numbers of ``n`` vectors, ``components`` as columns and their ``variances``."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float


def whole_numbers(vector: Column) -> Column:
    """floor(1024 c) + 100000 of each entry c; null for a vector that is null or has a null or non-finite entry.

    An entry beyond 2^40 counts as 2^40, so that sums fit.
    """
    entries = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    held = F.transform(entries, lambda c: F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST)))
    return F.when(~bad, F.transform(held, lambda c: F.floor(c * SCALE).cast("bigint") + SHIFT))


def fitting_vectors(vectors: DataFrame, column: str, carry: Sequence[str]) -> DataFrame:
    """(row, x): the ``carry`` columns and the whole numbers of the vectors that remain, all of one dimension.

    Vectors of another dimension than most, or than the larger one on a tie, are left out, as are those without entries.
    """
    rows = vectors.select(whole_row(vectors.select(*carry)).alias("row"), whole_numbers(F.col(f"`{column}`")).alias("x"))
    rows = rows.filter(F.size("x") > 0)
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    best = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return rows.filter(F.size("x") == (best["size"] if best else 0))


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(n, -1)


def _added(rows: DataFrame, function, name: str = "sums") -> np.ndarray:
    """The sum over all batches of the vectors that ``function`` makes of them, added up in Spark."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = function(batch)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", name]
            )

    parts = map_in_arrow(rows, apply, f"place int, {name} double")
    return np.array([r[1] for r in sorted(parts.groupBy("place").agg(F.sum(name)).collect())])


def _exact_sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and the sums of their entries, in whole numbers."""
    each = rows.select(F.posexplode("x").alias("place", "value")).groupBy("place")
    found = sorted(each.agg(F.sum("value"), F.count("*")).collect())
    return (found[0][2] if found else 0), np.array([r[1] for r in found], np.int64)


def _centred(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """x - sums / n.  The whole part of the mean goes first, so that only small numbers are rounded."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def _packed(rows: DataFrame, sums: np.ndarray, n: int) -> DataFrame:
    """(block): the centred rows as float64 in blocks."""

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                x = _centred(_matrix(batch.column("x"), np.int64), sums, n)
                blocks = [x[i : i + BLOCK_ROWS].tobytes() for i in range(0, len(x), BLOCK_ROWS)]
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["block"])

    return map_in_arrow(rows.select("x"), pack, "block binary")


def _blocks(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    for block in batch.column("block"):
        yield np.frombuffer(block.as_buffer()).reshape(-1, d)


def _step(blocks: DataFrame, d: int, v: np.ndarray, ys: np.ndarray, beta: float) -> tuple[float, np.ndarray, np.ndarray]:
    """p'p, U'p and X'p for p = X v - beta u, with u the last column of U = X Y."""
    k = ys.shape[1]

    def products(batch):
        total = np.zeros(1 + k + d)
        for x in _blocks(batch, d):
            u = x @ ys
            p = x @ v
            if k:
                p = p - beta * u[:, -1]
            total += np.concatenate([[p @ p], p @ u, p @ x])
        return total

    found = _added(blocks, products)
    return float(found[0]), found[1 : 1 + k], found[1 + k :]


def _new_direction(rng: np.random.Generator, vs: np.ndarray, d: int) -> np.ndarray:
    v = _against(rng.standard_normal(d), vs)
    return v / np.linalg.norm(v)


def _against(w: np.ndarray, vs: np.ndarray) -> np.ndarray:
    for _ in range(2):
        w = w - vs @ (vs.T @ w)
    return w


def bidiagonalise(
    blocks: DataFrame, d: int, n: int, top: int, total: float, tolerance: float = 1e-14, seed: int = 42
) -> tuple[np.ndarray, np.ndarray]:
    """(components as columns, their variances) of the centred rows in ``blocks``, by falling variance.

    ``total`` is the sum of squares of all entries.  A step that adds less than rounding to it breaks down.
    """
    rng = np.random.default_rng(seed)
    floor = EPS * max(total, 1e-300) ** 0.5 * d
    vs, ys = np.zeros((d, 0)), np.zeros((d, 0))
    products = np.zeros((d, 0))  # X'u of the columns of U
    alphas, betas = [], []
    v, beta = _new_direction(rng, vs, d), 0.0
    while True:
        square, along, transposed = _step(blocks, d, v, ys, beta)
        y = v - (beta * ys[:, -1] if ys.shape[1] else 0.0) - ys @ along
        transposed = transposed - products @ along
        alpha = max(square - along @ along, 0.0) ** 0.5
        if alpha <= floor:
            alpha, y, transposed = 0.0, np.zeros(d), np.zeros(d)
        else:
            y, transposed = y / alpha, transposed / alpha
        vs, ys, products = (np.column_stack([m, c]) for m, c in ((vs, v), (ys, y), (products, transposed)))
        alphas.append(alpha)
        k = len(alphas)
        b = np.diag(alphas) + np.diag(betas, 1)
        left, sigma, right = np.linalg.svd(b)
        if k == d:
            break
        w = _against(transposed - alpha * v, vs)
        beta = float(np.linalg.norm(w))
        if beta <= floor:
            beta, v = 0.0, _new_direction(rng, vs, d)
        else:
            v = w / beta
            if k > top and (beta * np.abs(left[-1, :top]) <= tolerance * sigma[0]).all():
                break
        betas.append(beta)
    return vs @ right.T, sigma**2 / n


def fit(rows: DataFrame, top: int = 8) -> Whitening:
    """The whitening of ``rows(x)``.  Components without variance, as all of equal vectors are, are left out."""
    n, sums = _exact_sums(rows)
    d = len(sums)
    if not n:
        return Whitening(0, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0)
    blocks, path = write_stored(_packed(rows, sums, n), "centred-vectors")
    moments = _added(
        blocks, lambda batch: sum(np.concatenate([x.sum(axis=0), [(x * x).sum()]]) for x in _blocks(batch, d))
    )
    offset, total = moments[:d] / n, float(moments[d])
    if not total:
        drop_stored(rows.sparkSession, path)
        return Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0)
    components, variances = bidiagonalise(blocks, d, n, top, total)
    good = int((variances[:top] > EPS * d * variances[0]).sum())
    components, variances = components[:, :good], variances[:good]
    turned = components / np.sqrt(variances)

    def covariance(batch):
        out = np.zeros(good * good)
        for x in _blocks(batch, d):
            w = (x - offset) @ turned
            out += (w.T @ w).ravel()
        return out

    found = _added(blocks, covariance).reshape(good, good) / n
    drop_stored(rows.sparkSession, path)
    error = float(np.abs(found - np.eye(good)).max())
    return Whitening(n, sums, components, variances, total / n, error)


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(row, whitened, deviation) of ``rows(row, x)``: the coordinates on the components, each over its deviation, and
    the exact sum of (n x - sums)^2, null where that is no 64-bit number."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL("whitened array<double>, deviation bigint").fields])

    def apply(batches):
        m = shared.value
        turned = m.components / np.sqrt(m.variances)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), np.int64)
            found = _centred(x, m.sums, m.n) @ turned
            columns = [batch.column("row"), pa.array(list(found), pa.list_(pa.float64())), _deviations(x, m.sums, m.n)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "whitened", "deviation"])

    return map_in_arrow(rows, apply, schema)


def _deviations(x: np.ndarray, sums: np.ndarray, n: int) -> pa.Array:
    whole = sums // n
    most = (float(np.abs(x - whole).max(initial=0)) + 1.0) * n
    if most * most * x.shape[1] < 2.0**62:
        apart = (x - whole) * n - (sums - whole * n)
        return pa.array((apart * apart).sum(axis=1), pa.int64())
    apart = x.astype(object) * n - sums.astype(object)
    exact = (apart * apart).sum(axis=1)
    return pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())


def whitened_components(vectors: DataFrame, column: str, carry: Sequence[str], top: int = 8) -> DataFrame:
    """(row, component, n, deviation, whitened, explained, identity_error) for each vector of ``vectors`` that remains and
    each of at most ``top`` components, numbered from 1 by falling variance.

    Null vectors and those with null or non-finite entries are left out, repeated rows count each for themselves.  An
    empty table, and vectors that are all equal, give no rows.
    """
    rows, path = write_stored(fitting_vectors(vectors, column, carry), "whole-vectors")
    model = fit(rows, top)
    k = len(model.variances)
    explained = [float(e / model.trace) for e in model.variances]
    each = F.transform(
        F.sequence(F.lit(1), F.lit(max(k, 1))),
        lambda c: F.struct(c.alias("component"), F.get("whitened", c - 1).alias("whitened"),
                           F.get(F.array(*map(F.lit, explained or [0.0])), c - 1).alias("explained")),
    )
    found = whiten(rows if k else rows.limit(0), model).select("row", "deviation", F.explode(each).alias("c"))
    return found.select(
        "row", "c.component", F.lit(model.n).cast("bigint").alias("n"), "deviation", "c.whitened", "c.explained",
        F.lit(model.identity_error).alias("identity_error"),
    )
