"""Embedding whitening by a bidiagonal qd solver.

Entries are made whole numbers, so that sums and deviations are exact. Tasks
reduce the centred rows to a triangular factor block by block (QR), factors are
stacked and reduced again in groups, and the last one is made bidiagonal; its
singular values (dqds) and right vectors (twisted factorisations) give the
covariance's eigenvalues and directions. ``transform`` projects every row.

The covariance is never formed: factors keep the relative accuracy of rows. Data
that comes to the driver: one sum for each dimension and at most ``FAN`` factors.

Rows whose vector is null, empty, holds a null or an entry that isn't finite, or
an entry beyond 2**52 after scaling, take no part. So do rows whose vector's
length isn't the most frequent one (of equally frequent ones, the longest). Ids
may be null or repeat: every row is fitted and returned. No rows: an empty
result. A component whose eigenvalue is zero but for rounding has the whitened
value null and explains 0. A deviation beyond 64 bits is null. Columns other than
the two named are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm import bidiagonal, store, vectors

#: Bytes of numbers that a task handles at once; partial results that are combined at once.
BLOCK, FAN = 1 << 24, 64


@dataclass(frozen=True)
class Scale:
    """Whole numbers of entries: floor(times * entry) + plus."""

    times: int = 64
    plus: int = 1_000_000


@dataclass
class Model:
    """What ``transform`` needs: rows and exact sums of the fit list, eigenvalues
    of the covariance (falling), unit directions as columns, their share of the
    trace, and how far the whitened covariance is from the identity."""

    scale: Scale
    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def roots(self) -> np.ndarray:
        """1 / sqrt(eigenvalue); NaN where the eigenvalue is zero."""
        return 1 / np.sqrt(np.where(self.values > 0, self.values, np.nan))


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``BLOCK`` bytes of entries."""
    rows = max(1, BLOCK // (8 * d))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n; the subtraction of the mean's whole part is exact."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums over dimensions of (n * x - sums) squared."""
    whole = sums // n
    near, rest = x - whole, sums - whole * n
    if x.shape[1] * (float(np.abs(near).max(initial=0)) * n + n) ** 2 < 2.0 ** 62:
        return ((near * n - rest) ** 2).sum(axis=1).tolist()
    exact = [sum((int(v) * n - int(r)) ** 2 for v, r in zip(row, rest, strict=True)) for row in near]
    return [v if v < 1 << 63 else None for v in exact]


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))


def _sums(rows: DataFrame, scale: Scale) -> tuple[int, list[int]]:
    """Usable rows of the most frequent length, and exact sums of its dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            column = batch.column(0)
            for d in np.unique(vectors.lengths(column)).tolist():
                if d > 0:
                    for part in _blocks(iter([batch]), d):
                        _, x = vectors.whole(part.column(0), d, scale.times, scale.plus)
                        # halves of the numbers: neither sum can pass 64 bits
                        n, total = found.get(d, (0, np.zeros((2, d), dtype=np.int64)))
                        found[d] = n + len(x), total + np.stack(((x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)))
        for d, (n, total) in found.items():
            yield pa.RecordBatch.from_pydict({"d": [d], "n": [n], "high": [total[0].tolist()], "low": [total[1].tolist()]}, pa.schema([
                ("d", pa.int32()), ("n", pa.int64()), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))]))

    parts = store.save(rows.select("v").mapInArrow(run, "d int, n bigint, high array<bigint>, low array<bigint>"), "sums")
    best = parts.groupBy("d").agg(F.sum("n").alias("n")).where("n > 0").orderBy(F.desc("n"), F.desc("d")).first()
    if best is None:
        return 0, []
    each = parts.where(F.col("d") == best["d"]).select(F.posexplode(F.arrays_zip("high", "low")).alias("at", "x"))
    total = F.sum(F.col("x.high").cast("decimal(38,0)") * 67_108_864 + F.col("x.low").cast("decimal(38,0)"))
    return best["n"], [int(r["total"]) for r in each.groupBy("at").agg(total.alias("total")).orderBy("at").collect()]


def _reduced(parts: DataFrame, combine: Callable[[list[object]], object]) -> object:
    """Pickled partial results (part binary) made one, ``FAN`` at a time."""

    def merge(table: pa.Table) -> pa.Table:
        made = combine([pickle.loads(x) for x in table.column("part").to_pylist()])
        return pa.table({"part": pa.array([pickle.dumps(made)], pa.binary())})

    parts = store.save(parts, "parts")
    while (count := parts.count()) > FAN:
        dealt = parts.withColumn("g", F.pmod(F.xxhash64("part"), F.lit(-(-count // max(FAN // 2, 2)))))
        parts = store.save(dealt.groupBy("g").applyInArrow(merge, "part binary"), "parts")
    found = [pickle.loads(bytes(r["part"])) for r in parts.collect()]
    return combine(found) if found else None


def _stack(factors: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(factors), mode="r")


def _factor(rows: DataFrame, scale: Scale, n: int, sums: list[int]) -> np.ndarray:
    """The triangular factor of all centred rows."""
    d, total = len(sums), _numbers(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.zeros((0, d))
        for batch in _blocks(batches, d):
            _, x = vectors.whole(batch.column(0), d, scale.times, scale.plus)
            if len(x):
                factor = _stack([factor, _centred(x, n, total)])
        if len(factor):
            yield pa.RecordBatch.from_pydict({"part": [pickle.dumps(factor)]}, pa.schema([("part", pa.binary())]))

    return _reduced(rows.select("v").mapInArrow(run, "part binary"), _stack)


def _numbers(sums: list[int]) -> np.ndarray:
    """Sums as 64-bit numbers, as objects where one doesn't fit."""
    return np.asarray(sums, dtype=np.int64 if max(map(abs, sums), default=0) < 1 << 62 else object)


def _project(model: Model, x: np.ndarray) -> np.ndarray:
    return (_centred(x, model.n, _numbers(model.sums)).astype(float) @ model.directions) * model.roots


def _merge_moments(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Counts, means and centred products of disjoint sets of rows made one."""
    n, mean, product = parts[0]
    for m, other, more in parts[1:]:
        away = other - mean
        product = product + more + np.outer(away, away) * (n * m / (n + m))
        mean, n = mean + away * (m / (n + m)), n + m
    return n, mean, product


def _identity_error(rows: DataFrame, model: Model) -> float:
    """The largest entry of the whitened rows' covariance less the identity, over
    components with an eigenvalue above zero; 0 where there is none."""
    d = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sofar = []
        for batch in _blocks(batches, d):
            _, x = vectors.whole(batch.column(0), d, model.scale.times, model.scale.plus)
            if len(x):
                w = _project(model, x)[:, model.values > 0]
                away = w - w.mean(axis=0)
                sofar = [_merge_moments([*sofar, (len(w), w.mean(axis=0), away.T @ away)])]
        if sofar:
            yield pa.RecordBatch.from_pydict({"part": [pickle.dumps(sofar[0])]}, pa.schema([("part", pa.binary())]))

    n, _, product = _reduced(rows.select("v").mapInArrow(run, "part binary"), _merge_moments)
    return float(np.abs(product / n - np.eye(len(product))).max(initial=0.0))


def fit(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, scale: Scale | None = None) -> Model | None:
    """The whitening of all usable rows; None where there are none. Three passes
    over the vectors: sums, factor, and the check of the result."""
    scale = scale or Scale()
    rows = _vectors(df, id_col, vector_col)
    n, sums = _sums(rows, scale)
    if not n:
        return None
    factor = _factor(rows, scale, n, sums)
    squares, directions = bidiagonal.right_vectors(factor, components)
    trace = float((factor * factor).sum())
    zero = squares <= (16 * len(sums) * bidiagonal.EPS) ** 2 * trace
    values = np.where(zero, 0.0, squares) / n
    model = Model(scale, n, sums, values, directions, np.where(zero, 0.0, squares) / (trace or 1.0))
    model.identity_error = _identity_error(rows, model)
    return model


def transform(df: DataFrame, model: Model, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, deviation, whitened array) of every usable row."""
    d, total = len(model.sums), _numbers(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, d):
            places, x = vectors.whole(batch.column(1), d, model.scale.times, model.scale.plus)
            w = _project(model, x)
            flat = pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel()))
            ends = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places)), pa.array(_deviations(x, model.n, total), pa.int64()), pa.ListArray.from_arrays(ends, flat)],
                                             [id_col, "deviation", "whitened"])

    rows = _vectors(df, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, deviation bigint, whitened array<double>")


def components(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 32, scale: Scale | None = None) -> DataFrame:
    """A row for each usable row and component: its whitened value, with the fit's
    figures."""
    model = fit(df, id_col, vector_col, most, scale)
    shape = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None:
        kind = df.schema[id_col].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"`{id_col}` {kind}, {shape}")
    explained = F.array(*[F.lit(float(x)) for x in model.explained])
    return transform(df, model, id_col, vector_col).select(id_col, "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        id_col, (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
