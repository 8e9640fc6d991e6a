"""Embedding whitening: exact sums, a distributed centred covariance, and its leading eigenvectors.

Each usable entry c becomes the whole number x = floor(scale * c). The fit list is every distinct x vector
once; equal vectors are combined before the shuffle, so a vector that a third of the rows share is
one row per task. Over the list, tasks add exact sums, then products of centred vectors; what leaves a task is
one row for each dimension, and those are added up in a shuffle by dimension, so the driver gets one
matrix of dimension by dimension however many rows or tasks there are. There it is made tridiagonal by
Householder reflections; counts of a Sturm sequence bisect the wanted eigenvalues; inverse iteration gives
their vectors, made orthogonal again within clusters of near eigenvalues, and the reflections
take them back. The projection, dimension by components numbers, is broadcast, and every row is projected
where it lies.

Edge cases: rows whose vector is null, empty or holds null or non-finite entries are dropped; so are those of another length
than most usable vectors have (of equal counts, the shorter length); x beyond 64 bits is the nearest such number. A component
whose eigenvalue is not above ``LEAST`` of the trace has no scale and is left out, so equal vectors or an
empty table give an empty result. A deviation beyond 64 bits is null. Ids may be null or repeat; equal rows
get equal results; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import stage

LEAST = 1e-12  # of the trace: an eigenvalue below it is rounding
CLUSTER = 1e-3  # of the matrix norm: nearer eigenvalues share a cluster
LONG = 1 << 63


@dataclass(frozen=True)
class Whitening:
    """A fitted model: ``n`` vectors, exact ``sums``, and for each component its eigenvalue and unit vector."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray  # dimension by component
    trace: float
    identity_error: float
    scale: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    @property
    def explained(self) -> list[float]:
        return [float(e) / self.trace for e in self.values]


# --- eigenvectors of a symmetric matrix ----------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflectors of a symmetric matrix, by Householder reflections."""
    a = matrix.astype(np.float64).copy()
    d = len(a)
    reflectors = []
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        most = np.max(np.abs(v))
        if not most:
            reflectors.append(v)
            continue
        v /= most  # else squares of small entries would vanish
        norm = np.copysign(np.linalg.norm(v), v[0])
        v[0] += norm
        v /= np.linalg.norm(v)
        norm *= most
        reflectors.append(v)
        part = a[k + 1 :, k + 1 :]
        p = 2 * (part @ v)
        q = p - (p @ v) * v
        part -= np.outer(v, q) + np.outer(q, v)
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = -norm
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def reflect_back(vectors: np.ndarray, reflectors: list[np.ndarray]) -> np.ndarray:
    """Vectors of the tridiagonal matrix as vectors of the first one."""
    out = vectors.copy()
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        out[k + 1 :] -= 2 * np.outer(v, v @ out[k + 1 :])
    return out


def below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues are below each shift: the negative terms of the Sturm sequence."""
    most = float(np.max(off**2)) if len(off) else 1.0
    tiny = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, most)
    count = np.zeros(len(shifts), int)
    q = diagonal[0] - shifts
    for i in range(len(diagonal)):
        if i:
            q = diagonal[i] - shifts - off[i - 1] ** 2 / q
        q = np.where(np.abs(q) < tiny, -tiny, q)  # a shift that is an eigenvalue counts as above it
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected to the last bit it can have."""
    d = len(diagonal)
    around = np.zeros(d)
    around[:-1] += np.abs(off)
    around[1:] += np.abs(off)
    slack = np.finfo(float).eps * d * max(1e-300, np.max(np.abs(diagonal) + around))
    low = np.full(k, np.min(diagonal - around) - slack)
    high = np.full(k, np.max(diagonal + around) + slack)
    rank = d - np.arange(k)  # the largest has d - 1 below it, and d below what is above it
    for _ in range(200):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        beyond = below(diagonal, off, middle) >= rank
        high, low = np.where(beyond, middle, high), np.where(beyond, low, middle)
    return (low + high) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of the shifted tridiagonal system, by elimination with row exchanges."""
    d = len(diagonal)
    main, upper, second, y = diagonal - shift, np.append(off, 0.0), np.zeros(d), right.copy()
    for i in range(d - 1):
        b = off[i]
        if abs(b) > abs(main[i]):  # exchange rows i and i + 1
            factor = main[i] / b
            main[i], upper[i], main[i + 1], second[i], carry = b, main[i + 1], upper[i] - factor * main[i + 1], upper[i + 1], upper[i + 1]
            upper[i + 1] = -factor * carry
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            if abs(main[i]) < least:
                main[i] = least
            factor = b / main[i]
            main[i + 1] -= factor * upper[i]
            y[i + 1] -= factor * y[i]
    for i in range(d - 1, -1, -1):
        rest = y[i] - (upper[i] * y[i + 1] if i + 1 < d else 0) - (second[i] * y[i + 2] if i + 2 < d else 0)
        y[i] = rest / (main[i] if abs(main[i]) >= least else np.copysign(least, main[i]))
    return y


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit eigenvector for each of the falling ``values``, orthogonal within clusters."""
    d = len(diagonal)
    norm = max(1e-100, float(np.max(np.abs(diagonal)) + 2 * (np.max(np.abs(off)) if len(off) else 0)))
    least = np.finfo(float).eps * norm
    random = np.random.default_rng(7)
    out: list[np.ndarray] = []
    for k, value in enumerate(values):
        near = [j for j in range(k) if values[j] - value < CLUSTER * norm]
        # Equal values would solve the same system: those of a cluster are moved a few last bits apart.
        shift = value - least * sum(values[j] - value < 10 * least for j in near)
        z = random.standard_normal(d)
        for _ in range(6):
            z = z / np.max(np.abs(z))
            z = _solve(diagonal, off, shift, z, least)
            for _ in range(4 if near else 1):  # what is left may be small beside what is taken off
                z = z / np.linalg.norm(z)
                for j in near:
                    z = z - (out[j] @ z) * out[j]
            z = z / np.linalg.norm(z)
        out.append(z)
    return np.array(out).T


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    k = min(k, len(matrix))
    diagonal, off, reflectors = tridiagonal(matrix)
    values = leading_values(diagonal, off, k)
    vectors = reflect_back(inverse_iteration(diagonal, off, values), reflectors)
    return values, vectors / np.linalg.norm(vectors, axis=0)


# --- on Spark ------------------------------------------------------------------------------------


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(vec_id, x)`` for the usable vectors, x in whole numbers."""
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("c"))
    double = F.transform("c", lambda c: c.cast("double"))
    bound = F.lit(float("inf"))
    usable = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < bound))
    rows = rows.where("c IS NOT NULL AND size(c) > 0").withColumn("c", double).where(F.coalesce(usable, F.lit(False)))
    return rows.select("vec_id", F.transform("c", lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))


def _matrix(column) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix of 64-bit numbers."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _exact_sums(x: np.ndarray) -> list[int]:
    if len(x) * max(int(np.max(x)), -int(np.min(x))) < LONG:
        return [int(s) for s in x.sum(axis=0)]
    return [sum(map(int, column)) for column in x.T]


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    def run(batches):
        n, total = 0, []
        for batch in batches:
            if batch.num_rows:
                part = _exact_sums(_matrix(batch.column(0)))
                n, total = n + batch.num_rows, [a + b for a, b in zip(total, part)] if total else part
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array(map(str, total), pa.string()).cast(kind),
             pa.array([n] * len(total), pa.int64())], ["i", "total", "n"])

    parts = fit.mapInArrow(run, "i int, total decimal(38,0), n long")
    rows = parts.groupBy("i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    rows.sort(key=lambda r: r["i"])
    return (rows[0]["n"] if rows else 0), [int(r["total"]) for r in rows]


def _covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance over the fit list: products of centred vectors, by task, then by row of the matrix."""
    shared = fit.sparkSession.sparkContext.broadcast(np.array([s / n for s in sums]))
    d = len(sums)
    kind = pa.list_(pa.float64())

    def products(batches):
        mean = shared.value
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch.column(0)) - mean
                total += y.T @ y
        for i in range(0, d, 256):  # a few rows of the matrix at a time
            rows = total[i : i + 256]
            flat = pa.ListArray.from_arrays(pa.array(range(0, rows.size + 1, d), pa.int32()), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(range(i, i + len(rows)), pa.int32()), flat.cast(kind)], ["i", "v"])

    def added(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), _matrix(batch.column(1))):
                total[i] = total[i] + v if i in total else v
        yield pa.RecordBatch.from_arrays(
            [pa.array(total, pa.int32()), pa.array([list(v) for v in total.values()], kind)], ["i", "v"])

    schema = "i int, v array<double>"
    # Dealt by row of the matrix: a task adds up what all tasks have for its rows, one batch at a time.
    rows = fit.mapInArrow(products, schema).repartition("i").mapInArrow(added, schema).collect()
    matrix = np.array([r["v"] for r in sorted(rows, key=lambda r: r["i"])]) / n
    return (matrix + matrix.T) / 2


def _projected(rows: DataFrame, model: Whitening) -> DataFrame:
    """``whitened`` and the exact ``deviation`` of each row of ``(vec_id, x)``."""
    shared = rows.sparkSession.sparkContext.broadcast((model.n, model.sums, model.mean, model.projection))
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        n, sums, mean, projection = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            most = n * int(max(np.max(x), -np.min(x))) + max(map(abs, sums))
            if len(sums) * most * most < LONG:
                deviation = ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
            else:
                exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
                deviation = [v if v < LONG else None for v in exact]
            whitened = (x - mean) @ projection
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation, pa.int64()), pa.array(whitened.tolist(), pa.list_(pa.float64()))],
                ["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)
    rows = _projected(fit.select(F.lit(0).alias("vec_id"), "x"), model)
    w = stage(rows.select(*[F.col("whitened")[i].alias(f"w{i}") for i in range(k)]), "whitened")
    means = w.agg(*[F.avg(f"w{i}").alias(f"w{i}") for i in range(k)]).first()
    centred = [F.col(f"w{i}") - F.lit(means[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    found = w.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, found))


def fit_whitening(df: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> Whitening:
    """The model of a table of embeddings; see the module's head for what counts."""
    vectors = whole_vectors(df, id_col, vector_col, scale)
    usual = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if usual is None:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, 0.0, scale)
    fit = stage(vectors.where(F.size("x") == usual["d"]).select("x").distinct(), "fit")
    n, sums = _sums(fit)
    covariance = _covariance(fit, n, sums)
    trace = float(np.trace(covariance))
    values, found = leading_components(covariance, components)
    kept = values > LEAST * trace
    model = Whitening(n, tuple(sums), values[kept], found[:, kept], trace, 0.0, scale)
    if not kept.any():
        return model
    return Whitening(n, tuple(sums), model.values, model.vectors, trace, _identity_error(fit, model), scale)


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per usable row its exact ``deviation`` and its ``whitened`` coordinates."""
    rows = whole_vectors(df, id_col, vector_col, model.scale).where(F.size("x") == len(model.sums))
    return _projected(rows, model).withColumnRenamed("vec_id", id_col)


def whitened_components(df: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id",
                        vector_col: str = "embedding") -> DataFrame:
    """One row for each usable row and component, with what the model says of the component."""
    model = fit_whitening(df, components, scale, id_col, vector_col)
    explained = F.array(*[F.lit(e) for e in model.explained]).cast("array<double>")
    return whiten(df, model, id_col, vector_col).select(
        id_col, "deviation", F.posexplode("whitened").alias("_at", "whitened")
    ).select(
        id_col,
        (F.col("_at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.try_element_at(explained, F.col("_at") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
