"""Whitening of integer-scaled vectors by a block Jacobi-Davidson eigensolver without a covariance matrix.

The driver holds a search basis of a few dozen columns; the covariance is only ever
applied: every product is one Spark job over the vectors, centred row by row before
multiplying (``centred_product``). Each outer step

* projects the covariance on the basis (Rayleigh-Ritz),
* locks the leading Ritz pairs whose residuals have reached double precision,
* solves the projected correction equation of all other wanted pairs together by a
  few MINRES steps (one job a step, whatever the number of pairs), and
* extends the basis by the corrections; a basis that is full restarts from its
  leading Ritz vectors.

It ends when all wanted pairs are locked, and raises if their residuals do not get
there in ``OUTER`` steps. Memory on the driver is d x basis doubles, whatever the
number of rows; tasks send d x block sums, added up by a shuffle.

Components become integers x = floor(64 c) + 1000000; the sums S and each row's
deviation (sum of (n x - S)^2) are exact. Defined results: rows whose vector is null
or holds null or non-finite entries are left out; shorter vectors count as padded
with zeros; repeated rows and null ids all count; components whose variance is
rounding noise (up to d * eps of the largest) do not exist, so equal vectors (or a
single one) give no components; an empty table gives no rows. A deviation that
does not fit 64 bits raises.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
GUARD = 8  # further pairs carried along, so that close values do not stall
INNER = 6  # MINRES steps of a correction
OUTER = 60
EPS = float(np.finfo(np.float64).eps)


@dataclass
class Fit:
    """n, exact sums of x, components as columns by falling variance, their variances, total variance."""
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float


# distributed part

def integer_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and y = floor(64 c) of the rows that take part, written once (x is y + 1000000)."""
    good = F.col(vec_col).isNotNull() & F.forall(
        vec_col, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    rows = table.where(good).select(F.col(id_col).alias("id"), F.transform(
        vec_col, lambda v: F.floor(v.cast("double") * SCALE).cast("bigint")).alias("y"))
    return cut_lineage(rows, "whitening_vectors")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of an Arrow list column as integers; short rows are padded with zeros."""
    flat, n = column.flatten().to_numpy(zero_copy_only=False), len(column)
    if len(flat) == n * d:
        return flat.reshape(n, d)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((n, d), dtype=np.int64)
    row = np.repeat(np.arange(n), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _centre(sums_y: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole and fractional part of the mean, so that y - mean loses nothing to the size of y."""
    return (np.array([s // n for s in sums_y], dtype=np.int64),
            np.array([(s % n) / n for s in sums_y], dtype=np.float64))


def _summed(rows: DataFrame, d: int, columns: int, partial: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """``partial`` (d x columns) of all rows' matrices, added up within tasks and then by a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(_matrix(batch.column(0), d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())],
                                             names=["at", "v"])

    got = (rows.select("y").mapInArrow(run, f"at int, v {kind}").groupBy("at")
           .agg(F.sum(F.col("v").cast("decimal(38,0)") if kind == "bigint" else F.col("v")).alias("v")).collect())
    out = np.zeros(d * columns, dtype=object if kind == "bigint" else np.float64)
    for r in got:
        out[r["at"]] = int(r["v"]) if kind == "bigint" else r["v"]
    return out.reshape(d, columns)


def centred_product(rows: DataFrame, n: int, whole: np.ndarray, rest: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) times ``block``: one job that centres each row, then multiplies."""
    def partial(y: np.ndarray) -> np.ndarray:
        c = (y - whole) - rest
        return c.T @ (c @ block)

    return _summed(rows, len(whole), block.shape[1], partial, "double") / n


# eigensolver: the covariance is a function

def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions of symmetric systems, one per column, that share each step's product."""
    beta = np.linalg.norm(rhs, axis=0)
    norm = np.where(beta > 0, beta, 1)
    v, v_old = rhs / norm, np.zeros_like(rhs)
    x, w, w_old = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    p = rhs.shape[1]
    eta, low = beta.copy(), np.zeros(p)
    c, c_old, s, s_old = np.ones(p), np.ones(p), np.zeros(p), np.zeros(p)
    for _ in range(steps):
        if (np.abs(eta) <= tolerance * norm).all():
            break
        q = apply(v)
        alpha = (v * q).sum(axis=0)
        q = q - alpha * v - low * v_old
        high = np.linalg.norm(q, axis=0)
        diagonal = c * alpha - c_old * s * low
        size = np.hypot(diagonal, high)
        live = size > 0
        safe = np.where(live, size, 1)
        above, far = s * alpha + c_old * c * low, s_old * low
        c_old, s_old = c, s
        c, s = np.where(live, diagonal / safe, 1), np.where(live, high / safe, 0)
        w, w_old = np.where(live, (v - far * w_old - above * w) / safe, 0), w
        x = x + c * eta * w
        eta = -s * eta
        v_old, v, low = v, np.where(high > 0, q / np.where(high > 0, high, 1), 0), high
    return x


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span ``new`` outside of ``against``; directions that are not new are dropped."""
    new = new / np.maximum(np.linalg.norm(new, axis=0), np.finfo(float).tiny)
    for _ in range(2):
        for basis in against:
            new = new - basis @ (basis.T @ new)
    q, s, _ = np.linalg.svd(new, full_matrices=False)
    q = q[:, s > 1e-10]
    for basis in against:
        q = q - basis @ (basis.T @ q)
    return np.linalg.qr(q)[0]


def leading_pairs(apply: Callable[[np.ndarray], np.ndarray], d: int, k: int, seed: int = 7
                  ) -> tuple[np.ndarray, np.ndarray, float]:
    """The k largest eigenvalues, their unit vectors as columns, and the largest residual left."""
    k = min(k, d)
    block = min(d, k + GUARD)
    full = min(d, 4 * block)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, block)))[0]
    image = apply(basis)
    done, values, worst, largest = np.empty((d, 0)), [], 0.0, 0.0
    for _ in range(OUTER):
        h = basis.T @ image
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        ritz, image_ritz = basis @ s, image @ s
        largest = max(largest, float(theta[0]))
        limit = 16 * EPS * np.sqrt(d) * largest
        residual = image_ritz - ritz * theta
        size = np.linalg.norm(residual, axis=0)
        want = k - len(values)
        ready = 0
        while ready < min(want, len(theta)) and size[ready] <= limit:
            ready += 1
        # a pair is locked only with all larger ones, so that none is passed over
        if ready:
            done = np.hstack([done, ritz[:, :ready]])
            values += theta[:ready].tolist()
            worst = max(worst, float(size[:ready].max()))
        if len(values) == k:
            return np.array(values), done, worst
        basis, image = ritz[:, ready:], image_ritz[:, ready:]
        theta, residual = theta[ready:], residual[:, ready:]
        if basis.shape[1] + block > full and basis.shape[1] > block and basis.shape[1] + done.shape[1] < d:
            basis, image = basis[:, :block], image[:, :block]
        active = min(block - done.shape[1], basis.shape[1])
        known = np.hstack([done, basis[:, :active]])
        if known.shape[1] >= d or basis.shape[1] + done.shape[1] >= d:
            basis = _orthonormal(basis, done)  # the whole space: only rounding is left to remove
            image = apply(basis)
            continue

        def project(t: np.ndarray, known: np.ndarray = known) -> np.ndarray:
            return t - known @ (known.T @ t)

        shift = theta[:active]
        # every correction has its own shift; all share the products
        def shifted(t: np.ndarray, shift: np.ndarray = shift) -> np.ndarray:
            return project(apply(t) - t * shift)

        t = minres(shifted, -project(residual[:, :active]), INNER, 1e-2)
        t = t[:, np.linalg.norm(t, axis=0) > 0]
        new = _orthonormal(t, done, basis) if t.shape[1] else t
        if not new.shape[1]:
            new = _orthonormal(residual[:, :active], done, basis)
        basis = np.hstack([basis, new[:, : max(0, d - basis.shape[1] - done.shape[1])]])
        image = np.hstack([image, apply(basis[:, image.shape[1]:])]) if basis.shape[1] > image.shape[1] else apply(basis)
    raise RuntimeError(f"{k - len(values)} of {k} components have not converged in {OUTER} steps")


# operator

def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Fits ``integer_vectors``; None without rows."""
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("y")).alias("d")).first()
    n, d = r["n"], r["d"] or 0
    if not n:
        return None
    sums_y = [int(v) for v in _summed(rows, d, 1, lambda y: y.sum(axis=0)[:, None], "bigint")[:, 0]] if d else []
    sums = [s + n * SHIFT for s in sums_y]
    if not d:
        return Fit(n, sums, np.empty((0, 0)), np.empty(0), 0.0, 0.0)
    whole, rest = _centre(sums_y, n)
    trace = float(_summed(rows, d, 1, lambda y: (((y - whole) - rest) ** 2).sum(axis=0)[:, None], "double").sum() / n)
    if trace == 0:
        return Fit(n, sums, np.empty((d, 0)), np.empty(0), 0.0, 0.0)
    values, vectors, residual = leading_pairs(lambda b: centred_product(rows, n, whole, rest, b), d, components)
    keep = values > d * EPS * values[0]
    return Fit(n, sums, vectors[:, keep], values[keep], trace, residual)


def whiten(rows: DataFrame, model: Fit) -> DataFrame:
    """id, deviation (exact), whitened array<double> of every row of ``integer_vectors``."""
    n, d = model.n, len(model.sums)
    sums_y = [s - n * SHIFT for s in model.sums]
    whole, rest = _centre(sums_y, n)
    turn = model.vectors / np.sqrt(model.values) if d else model.vectors
    exact = np.array(sums_y, dtype=object)
    kind = rows.schema["id"].dataType.simpleString()

    def deviations(y: np.ndarray) -> list[int]:
        far = max(int(np.abs(y).max(initial=0)) * n, *map(abs, sums_y), 1) * 2
        if far * far * d < 1 << 63:
            gap = n * y - exact.astype(np.int64)
            return np.einsum("ij,ij->i", gap, gap).tolist()
        gap = y.astype(object) * n - exact
        return (gap * gap).sum(axis=1).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column(1), d)
            white = ((y - whole) - rest) @ turn if d else np.empty((len(y), 0))
            offsets = pa.array(np.arange(len(y) + 1, dtype=np.int32) * white.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviations(y) if d else [0] * len(y), pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(white.ravel(), pa.float64()))],
                names=["id", "deviation", "whitened"])

    return rows.select("id", "y").mapInArrow(run, f"id {kind}, deviation bigint, whitened array<double>")


def identity_error(white: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance (centred, divisor n) minus the identity."""
    rows = white.select(F.col("whitened").alias("y"))
    mean = _summed(rows, k, 1, lambda w: w.sum(axis=0)[:, None], "double")[:, 0] / n

    def partial(w: np.ndarray) -> np.ndarray:
        c = w - mean
        return c.T @ c

    return float(np.abs(_summed(rows, k, k, partial, "double") / n - np.eye(k)).max(initial=0))


def whiten_embeddings(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
                      vec_col: str = "embedding") -> DataFrame:
    """One row per remaining row and component: id, component, n, deviation, whitened, explained, identity_error."""
    rows = integer_vectors(table, id_col, vec_col)
    model = fit(rows, components)
    if model is None or not len(model.values):
        share, error = [], 0.0
        white = rows.select("id", F.lit(0).cast("bigint").alias("deviation"),
                            F.array().cast("array<double>").alias("whitened"))
    else:
        share = (model.values / model.trace).tolist()
        white = cut_lineage(whiten(rows, model), "whitening_rows")
        error = identity_error(white, model.n, len(share))
    explained = F.array(*[F.lit(v) for v in share]).cast("array<double>")
    return (white.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"),
                    F.lit(model.n if model else 0).cast("bigint").alias("n"), "deviation", "whitened",
                    F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))
