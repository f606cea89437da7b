"""Whitening of vectors along the leading components of their covariance.

One pass adds up sums and covariance: every batch centres its own vectors before multiplying, and batches are joined by
the rule for merged moments, so no precision is lost to a large mean and what moves is one matrix per task.  The
eigenpairs come from contour integration (``feast``): inertia counts slice the spectrum, Spark tasks solve one interval
each, and the counts prove that none is missed.  A further pass measures the covariance of the whitened vectors; the
rows are whitened as they are read.  No vector is ever shuffled.

The driver holds one matrix of dimension x dimension, whatever the number of rows.

An entry c becomes x = floor(1024 c) + 100000, so sums are exact.  Defined cases: vectors that are null or empty, or
hold null, non-finite or unusably large entries (|x| >= 2^44), are dropped; so are those of another than the commonest
dimension (of equally common ones the smallest counts); repeated rows count as often as they stand there; a null id is
kept; components without variance (below 1e-12 of all) have ``whitened`` null; fewer dimensions than components give
fewer; without usable vectors there are no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.llm import feast
from contactloom.llm.common import map_arrow
from contactloom.sources.staging import stage

COMPONENTS = 8
SCALE, OFFSET, LARGEST = 1024, 100_000, float(1 << 44)
FLAT = 1e-12
#: Dimensions whose sums a task keeps at once.
OPEN_DIMENSIONS = 8
#: Entries of one dense block.
BLOCK_ENTRIES = 1 << 20
MOMENTS = "dimension int, n bigint, sums array<decimal(38,0)>, mean array<double>, products array<double>"
#: Bytes of moments that the driver may take at once; more are joined by further tasks first.
DRIVER_BYTES, FAN_IN = 1 << 25, 16
WHITENED = "id bigint, deviation decimal(38,0), whitened array<double>"


@dataclass
class Model:
    """Vectors, their sums, falling eigenvalues, eigenvectors as columns, total variance, identity error."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float | None = None

    @property
    def dimension(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def scaled(self) -> np.ndarray:
        """Projection to whitened values; columns without variance are 0."""
        live = self.live
        return np.where(live, self.vectors / np.sqrt(np.where(live, self.values, 1.0)), 0.0)

    @property
    def live(self) -> np.ndarray:
        return self.values > FLAT * self.trace


def usable(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the batch, their whole numbers as an int64 matrix) by dimension, in blocks."""
    lists = batch.column(1)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()  # skips null lists
    entries = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    for size in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == size)
        step = max(BLOCK_ENTRIES // size, 1)
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(SCALE * entries[(ends[part] - size)[:, None] + np.arange(size)]) + OFFSET
                good = (np.abs(x) < LARGEST).all(axis=1)  # false for NaN
            if good.any():
                yield part[good], x[good].astype(np.int64)


class Moments:
    """Count, exact sums, mean and centred products of vectors, joined block by block."""

    def __init__(self, n: int, sums: list[int], mean: np.ndarray, products: np.ndarray):
        self.n, self.sums, self.mean, self.products = n, sums, mean, products

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        mean = x.mean(axis=0)
        centred = x - mean
        sums = x.sum(axis=0).tolist() if x.dtype == np.int64 else [0] * x.shape[1]
        return cls(len(x), sums, mean, centred.T @ centred)

    def add(self, other: Moments) -> None:
        n, apart = self.n + other.n, other.mean - self.mean
        self.products += other.products + np.outer(apart, apart) * (self.n * other.n / n)
        self.mean = self.mean + apart * (other.n / n)
        self.sums = [a + b for a, b in zip(self.sums, other.sums)]
        self.n = n

    @property
    def covariance(self) -> np.ndarray:
        return (self.products + self.products.T) / (2 * self.n)


def _as_batch(parts: list[Moments]) -> pa.RecordBatch:
    whole = pa.decimal128(38, 0)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([len(m.sums) for m in parts], pa.int32()), pa.array([m.n for m in parts], pa.int64()),
            pa.array([[Decimal(s) for s in m.sums] for m in parts], pa.list_(whole)),
            pa.array([m.mean for m in parts], pa.list_(pa.float64())), pa.array([m.products.ravel() for m in parts], pa.list_(pa.float64())),
        ],
        names=["dimension", "n", "sums", "mean", "products"],
    )


def _from_row(row) -> Moments:
    size = len(row["mean"])
    return Moments(row["n"], [int(s) for s in row["sums"]], np.array(row["mean"]), np.array(row["products"]).reshape(size, size))


def _summed(parts: Iterator[Moments]) -> Iterator[pa.RecordBatch]:
    """Moments by dimension; a few dimensions stay open, so that odd lengths do not fill the memory."""
    open_: dict[int, Moments] = {}
    for m in parts:
        if len(m.sums) in open_:
            open_[len(m.sums)].add(m)
            continue
        if len(open_) >= OPEN_DIMENSIONS:
            least = min(open_, key=lambda k: open_[k].n)
            yield _as_batch([open_.pop(least)])
        open_[len(m.sums)] = m
    if open_:
        yield _as_batch(list(open_.values()))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _summed(_from_row(r) for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist())


def _join(parts: DataFrame) -> Moments | None:
    """Moments of the commonest dimension, joined in a tree of tasks until the driver can take the rest."""
    parts = stage(parts)
    common = parts.groupBy("dimension").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")).orderBy(F.desc("n"), "dimension").limit(1).collect()
    if not common:
        return None
    size, left = common[0]["dimension"], common[0]["parts"]
    parts = parts.where(F.col("dimension") == size)
    while left > 1 and left * size * size * 8 > DRIVER_BYTES:
        parts = stage(map_arrow(parts.coalesce(-(-left // FAN_IN)), _merge, MOMENTS))
        fewer = parts.count()
        if fewer >= left:
            break
        left = fewer
    total = None
    for row in parts.toLocalIterator():
        m = _from_row(row)
        if total is None:
            total = m
        else:
            total.add(m)
    return total


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))


def components(covariance: np.ndarray, wanted: int, spark) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues, falling, and eigenvectors (columns); every interval is solved by a task of its own."""
    size = len(covariance)
    wanted = min(wanted, size)
    if np.trace(covariance) <= 0:
        return np.zeros(wanted), np.eye(size)[:, :wanted]
    slices = feast.intervals(covariance, wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                values, vectors = feast.solve_interval(covariance, s["low"], s["high"], s["number"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))], names=["value", "vector"]
                )

    rows = spark.createDataFrame(slices, "low double, high double, number int").repartition(len(slices))
    found = map_arrow(rows, run, "value double, vector array<double>").collect()
    if len(found) != sum(n for _, _, n in slices):
        raise ArithmeticError("the intervals hold other numbers of eigenvalues than their inertia says")
    basis, _ = np.linalg.qr(np.array([r["vector"] for r in sorted(found, key=lambda r: -r["value"])]).T)
    values, ritz = np.linalg.eigh(basis.T @ covariance @ basis)
    vectors = (basis @ ritz)[:, ::-1][:, :wanted]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])
    return values[::-1][:wanted], vectors * sign


def fit(df: DataFrame, components_: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> Model | None:
    """A model of all usable vectors, or None if there are none."""
    vectors = _vectors(df, id_col, vector_col)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _summed(Moments.of(x) for batch in batches for _, x in usable(batch))

    got = _join(map_arrow(vectors, first, MOMENTS))
    if got is None:
        return None
    values, basis = components(got.covariance, components_, df.sparkSession)
    model = Model(got.n, got.sums, values, basis, float(np.trace(got.covariance)))
    mean, scaled, size = model.mean, model.scaled, model.dimension

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _summed(Moments.of((x - mean) @ scaled) for batch in batches for _, x in usable(batch) if x.shape[1] == size)

    live = model.live
    if live.any():
        cov = _join(map_arrow(vectors, second, MOMENTS)).covariance
        model.error = float(np.abs(cov - np.eye(len(values)))[np.ix_(live, live)].max())
    return model


def squared_deviation(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Exact sums over dimensions of (n x - S)^2, in machine integers where these cannot overflow."""
    top = max(int(np.abs(x).max()), 1)
    if n * top + max(abs(s) for s in sums) < 1 << 62:
        d = x * n - np.array(sums, np.int64)
        if x.shape[1] * int(np.abs(d).max()) ** 2 < 1 << 63:
            return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
        d = d.astype(object)
    else:
        d = x.astype(object) * n - np.array(sums, object)
    return pa.array([Decimal(v) if v < 10**38 else None for v in (d * d).sum(axis=1).tolist()], pa.decimal128(38, 0))


def whiten(df: DataFrame, model: Model, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, deviation (null beyond 38 digits) and whitened entries of every usable vector of the model's dimension."""
    n, sums, mean, scaled, size, live = model.n, model.sums, model.mean, model.scaled, model.dimension, model.live

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in usable(batch):
                if x.shape[1] != size:
                    continue
                out = (x - mean) @ scaled
                flat = pa.array(out.ravel(), mask=np.broadcast_to(~live, out.shape).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * out.shape[1], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), squared_deviation(x, n, sums), lists], names=["id", "deviation", "whitened"]
                )

    return map_arrow(_vectors(df, id_col, vector_col), run, WHITENED)


def report(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component; ``deviation`` is null where it exceeds a long."""
    model = fit(df, COMPONENTS, id_col, vector_col)
    if model is None:
        return df.sparkSession.createDataFrame(
            [], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        )
    shares = (model.values / model.trace).tolist() if model.trace > 0 else [0.0] * len(model.values)
    shares = F.array(*[F.lit(v) for v in shares])
    rows = whiten(df, model, id_col, vector_col).select("id", "deviation", F.posexplode("whitened").alias("place", "value"))
    return rows.select(
        F.col("id").alias("vec_id"), (F.col("place") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
        F.col("deviation").try_cast("bigint").alias("deviation"), F.col("value").alias("whitened"),
        F.get(shares, F.col("place")).alias("explained"), F.lit(model.error).cast("double").alias("identity_error"),
    )
