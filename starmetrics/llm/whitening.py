"""Operator 11 — embedding whitening with a polarisation covariance.

Entries become integers, so sums have no rounding and no order.  One pass gives the sums, a second one the squared
centred values of every dimension and of every sum of two dimensions; by polarisation

    cov(i, j) = (var(i + j) - var(i) - var(j)) / 2

so variances alone give the whole matrix.  Centring is exact too: a value is taken against the whole part of its mean,
and the rest of the mean (a fraction r / n) leaves n * sum(y^2) - r^2 as n^2 times the variance, in whole numbers of any
size.  The matrix (dimensions squared, whatever the number of rows) is turned into components on the driver; a third
pass measures the covariance of the whitened rows, and the last one writes them.

A task adds up its rows and sends one packed row for each dimension; these are added in two levels.  There is no key
of the data in any shuffle, so equal vectors and hot labels don't matter.

Edge cases: rows whose vector is null, or holds a null or non-finite entry, go.  So do vectors of another length than
the most frequent one (the longest among equally frequent ones; an empty vector has no dimension and always goes) and
entries of 2^50 or more, whose sums would not be whole numbers of 64 bits.  Repeated rows and ids count each.  A component
without variance has whitened 0.0 and is left out of identity_error; explained is 0.0 if there is no variance at all.
A deviation beyond 64 bits is null.  Without rows the result is empty.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmetrics.llm.common import table

#: Entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries from here on are no longer sums of 64-bit numbers.
LARGEST = 2.0 ** 50
#: Partial sums that one task adds in the first of two levels.
FAN = 512


class Fit(NamedTuple):
    n: int
    sums: list[int]  # of x, one a dimension
    cov: np.ndarray  # of x, divisor n
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors in columns


def vectors(batch: pa.RecordBatch, dims: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x) of the usable vectors of one length; of all lengths one after the other without ``dims``."""
    col = batch.column(batch.num_columns - 1)
    size = np.where(col.is_valid().to_numpy(zero_copy_only=False), col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    flat = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null entries become NaN
    for d in [dims] if dims else np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == d)
        c = flat[(start[rows][:, None] + np.arange(d)).ravel()].reshape(-1, d)
        fine = (np.abs(c) < LARGEST).all(axis=1)
        yield rows[fine], np.floor(SCALE * c[fine]).astype(np.int64) + SHIFT


def exact_sum(a: np.ndarray) -> list[int]:
    """Column sums as whole numbers of any size: the low and high halves are summed apart."""
    low, high = (a & 0xFFFFFFFF).sum(axis=0), (a >> 32).sum(axis=0)
    return [int(l) + (int(h) << 32) for l, h in zip(low, high)]


def exact_squares(a: np.ndarray) -> list[int]:
    """Column sums of squares; in 64 bits where these hold them."""
    most = int(np.abs(a).max(initial=0))
    if most ** 2 * max(1, len(a)) < 1 << 62:
        return [int(v) for v in np.einsum("ij,ij->j", a, a)]
    high, low = a >> 24, a & 0xFFFFFF  # a = high * 2^24 + low; each product is split before it is summed
    if int(np.abs(high).max(initial=0)) < 1 << 31:
        hh, hl, ll = exact_sum(high * high), exact_sum(high * low), exact_sum(low * low)
        return [(p << 48) + (q << 25) + r for p, q, r in zip(hh, hl, ll)]
    return [sum(v * v for v in col) for col in a.T.tolist()]


def _pack(values: list[int]) -> bytes:
    return ",".join(map(str, values)).encode()


def _add_whole(parts: list[bytes]) -> bytes:
    rows = [list(map(int, p.split(b","))) for p in parts]
    return _pack([sum(c) for c in zip(*rows)])


def add_up(partial: DataFrame, add: Callable[[list[bytes]], bytes]) -> DataFrame:
    """``key, sums`` of the rows ``key, part, sums`` that tasks sent: added in two levels, in order of task, so that
    no task reads more than a share of all partial rows and reruns agree."""
    def level(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        return pa.table({"key": t.column("key").slice(0, 1), "part": t.column("part").slice(0, 1),
                         "sums": pa.array([add([x.as_py() for x in t.column("sums")])], pa.binary())})

    schema = "key int, part long, sums binary"
    first = partial.groupBy("key", F.floor(F.col("part") / FAN)).applyInArrow(level, schema)
    return first.groupBy("key").applyInArrow(level, schema).select("key", "sums")


def _sums(rows: DataFrame) -> tuple[int, int, list[int]]:
    """(dimensions, rows, sums of x) of the most frequent length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[int]] = {}
        for b in batches:
            for _, x in vectors(b):
                if len(x):
                    new = [len(x), *exact_sum(x)]
                    total[x.shape[1]] = [p + q for p, q in zip(total.get(x.shape[1], [0] * len(new)), new)]
        part = TaskContext.get().partitionId()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([part] * len(total), pa.int64()),
                                              pa.array([_pack(v) for v in total.values()], pa.binary())], ["key", "part", "sums"])

    per = add_up(rows.mapInArrow(run, "key int, part long, sums binary"), _add_whole)
    per = per.withColumn("n", F.substring_index(F.decode("sums", "UTF-8"), ",", 1).cast("long"))
    best = per.orderBy(F.desc("n"), F.desc("key")).first()
    if best is None:
        return 0, 0, []
    n, *sums = map(int, best["sums"].split(b","))
    return best["key"], n, sums


def _squares(rows: DataFrame, dims: int, centre: np.ndarray) -> list[list[int]]:
    """Row i: sums of y_i^2, then of (y_i + y_j)^2 for j > i, where y = x - centre."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for _, x in vectors(b, dims):
                if not len(x):
                    continue
                y = x - centre
                new = [[*exact_squares(y[:, i:i + 1]), *exact_squares(y[:, i:i + 1] + y[:, i + 1:])] for i in range(dims)]
                total = new if total is None else [[p + q for p, q in zip(s, t)] for s, t in zip(total, new)]
        part = TaskContext.get().partitionId()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([part] * dims, pa.int64()),
                                              pa.array([_pack(v) for v in total], pa.binary())], ["key", "part", "sums"])

    per = add_up(rows.mapInArrow(run, "key int, part long, sums binary"), _add_whole)
    return [list(map(int, r["sums"].split(b","))) for r in per.orderBy("key").collect()]  # dimensions squared numbers


def fit(rows: DataFrame) -> Fit | None:
    """Sums, covariance and components of ``rows`` (the vector in their last column); None without usable rows."""
    dims, n, sums = _sums(rows)
    if not n:
        return None
    centre = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]  # n * mean of y
    squares = _squares(rows, dims, centre)
    # n^2 * var, in whole numbers, of each dimension and of each sum of two
    own = [n * squares[i][0] - rest[i] ** 2 for i in range(dims)]
    cov = np.empty((dims, dims))
    for i in range(dims):
        cov[i, i] = own[i] / (n * n)  # whole numbers: rounded once
        for k, j in enumerate(range(i + 1, dims), 1):
            both = n * squares[i][k] - (rest[i] + rest[j]) ** 2
            cov[i, j] = cov[j, i] = (both - own[i] - own[j]) / (2 * n * n)
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    lead = np.abs(vecs).argmax(axis=0)
    vecs = vecs * np.where(vecs[lead, np.arange(dims)] < 0, -1.0, 1.0)  # the largest entry is positive
    values = np.where(values > max(values[0], 0.0) * dims * 2.0 ** -50, values, 0.0)  # rounding of a zero
    return Fit(n, sums, cov, np.ascontiguousarray(values), np.ascontiguousarray(vecs))


def whitener(model: Fit, components: int) -> Callable[[np.ndarray], np.ndarray]:
    """x → whitened values, one column a component."""
    n = model.n
    centre = np.array([s // n for s in model.sums], np.int64)
    rest = np.array([s % n / n for s in model.sums])
    e = model.values[:components]
    scale = np.divide(1.0, np.sqrt(e), out=np.zeros_like(e), where=e > 0)
    basis = model.vectors[:, :components] * scale

    def white(x: np.ndarray) -> np.ndarray:
        """Dimension by dimension: a row's values don't depend on the rows beside it."""
        z, out = (x - centre) - rest, np.zeros((len(x), basis.shape[1]))
        for j in range(len(basis)):
            out += z[:, j:j + 1] * basis[j]
        return out

    return white


def _moments(parts: list[bytes]) -> bytes:
    """Counts, means and centred products of two parts give those of both."""
    n, mean, prod = 0.0, 0.0, 0.0
    for p in parts:
        a = np.frombuffer(p)
        k = int(round(np.sqrt(len(a) - 0.75) - 0.5))  # 1 + k + k^2 numbers
        m, mu, c = a[0], a[1:1 + k], a[1 + k:].reshape(k, k)
        d = mu - mean
        prod = prod + c + np.outer(d, d) * (n * m / (n + m))
        mean = mean + d * (m / (n + m))
        n += m
    return np.concatenate([[n], mean, prod.ravel()]).tobytes()


def identity_error(rows: DataFrame, model: Fit, components: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over components with variance."""
    dims, white, live = len(model.sums), whitener(model, components), np.flatnonzero(model.values[:components] > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for _, x in vectors(b, dims):
                if len(x):
                    w = white(x)[:, live]
                    mean = w.mean(axis=0)
                    own = np.concatenate([[float(len(w))], mean, ((w - mean).T @ (w - mean)).ravel()]).tobytes()
                    total = own if total is None else _moments([total, own])
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([total], pa.binary())], ["key", "part", "sums"])

    if not len(live):
        return 0.0
    a = np.frombuffer(add_up(rows.mapInArrow(run, "key int, part long, sums binary"), _moments).first()["sums"])
    cov = a[1 + len(live):].reshape(len(live), -1) / a[0]
    return float(np.abs(cov - np.eye(len(live))).max())


def deviations(x: np.ndarray, model: Fit) -> list[int | None]:
    """Per row, the sum over dimensions of (n * x - S)^2; None beyond 64 bits."""
    n, centre = model.n, np.array([s // model.n for s in model.sums], np.int64)
    rest = [s % n for s in model.sums]
    y = x - centre
    most = (int(np.abs(y).max(initial=0)) + 1) * n
    if most ** 2 * len(rest) < 1 << 62:
        z = n * y - np.array(rest, np.int64)
        return np.einsum("ij,ij->i", z, z).tolist()
    out = [sum((n * v - r) ** 2 for v, r in zip(row, rest)) for row in y.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def whiten(table_: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    rows = table_.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    only = rows.select("v")
    model = fit(only)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    dims = len(model.sums)
    k = min(components, dims)
    error, white = identity_error(only, model, k), whitener(model, k)
    trace = float(np.trace(model.cov))
    explained = model.values[:k] / trace if trace > 0 else np.zeros(k)
    n, slim = model.n, model._replace(cov=None, vectors=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                for at, x in vectors(part, dims):
                    if not len(x):
                        continue
                    ids = part.column(0).take(pa.array(np.repeat(at, k)))
                    dev = pa.array(deviations(x, slim), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k)))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(ids), n)), dev,
                         pa.array(white(x).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(ids), error))],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
