"""Whitening by a covariance over distinct vectors, each weighted by one or by its number of copies.

1. Every entry becomes a whole number, ``floor(scale * c) + shift``. Rows with the same
   numbers fall together by a 128-bit fingerprint, each task merging its own first.
2. Number of vectors and sums per dimension: whole numbers, exact at any size.
3. Centred products: each batch is centred, weighted and multiplied with itself; Spark adds
   the matrices of the tasks entry by entry.
4. The driver takes the eigenvectors of one matrix of dimension x dimension.
5. Every distinct vector is whitened once, and joined back to its rows by the fingerprint;
   adaptive execution splits the rows of a vector with very many copies.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.llm.tables import stored

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Eigenvalues below this share of the largest are noise of double precision, not a component.
LEAST_EIGENVALUE = 1e-11
_MOST = 2.0**62  # whole numbers beyond it are not kept
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """``n``: total weight; ``sums``: exact weighted sums; ``vectors``: unit eigenvectors, one a row, by falling ``values``."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums/n; the whole part is taken off before anything is rounded."""
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - sums)^2; null where a long can't hold it.

        The arithmetic is modulo 2^64, so it is exact wherever the true value fits.
        """
        with np.errstate(over="ignore"):
            t = np.int64(self.n) * (x - self.base) - self.rest
            exact = (t * t).sum(1)
        about = ((self.n * self.centred(x)) ** 2).sum(1)
        return [int(e) if a < 9.2e18 else None for e, a in zip(exact, about)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T


def whole_numbers(batch: pa.Array, dimension: int, scale: int = SCALE, shift: int = SHIFT) -> tuple[np.ndarray, np.ndarray]:
    """(positions, numbers) of the usable vectors of a list array."""
    lengths = np.diff(batch.offsets.to_numpy())
    usable = (lengths == dimension) & ~batch.is_null().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(usable)
    if not len(at):
        return at, np.zeros((0, dimension), np.int64)
    values = batch.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(scale * values)
        fine = (np.abs(values) < _MOST).all(1)  # not a number compares false
    return at[fine], values[fine].astype(np.int64) + shift


def packed(numbers: np.ndarray) -> list[bytes]:
    """Bytes of each vector, four an entry where all of them fit."""
    short = (np.abs(numbers) < 2**31).all(1) if len(numbers) else np.zeros(0, bool)
    return [row.astype("<i4").tobytes() if s else row.astype("<i8").tobytes() for row, s in zip(numbers, short)]


def unpacked(column: pa.Array, dimension: int) -> np.ndarray:
    rows = column.to_pylist()
    return np.stack([np.frombuffer(r, "<i4" if len(r) == 4 * dimension else "<i8").astype(np.int64) for r in rows]) if rows else np.zeros((0, dimension), np.int64)


def _lists(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Entries as doubles; a null list or entry stays null."""
    return df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))


def _numbered(df: DataFrame, dimension: int, scale: int, shift: int, with_numbers: bool) -> DataFrame:
    schema = pa.schema([("vec_id", pa.int64()), ("print", pa.binary()), *([("x", pa.binary())] if with_numbers else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers = whole_numbers(batch.column("vector"), dimension, scale, shift)
            data = packed(numbers)
            columns = [batch.column("vec_id").take(pa.array(at)), pa.array([xxhash.xxh3_128_digest(x) for x in data], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(data, pa.binary())] if with_numbers else [])], schema=schema)

    return df.mapInArrow(run, "vec_id long, print binary" + (", x binary" if with_numbers else ""))


def _summed(distinct: DataFrame, dimension: int, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all batches of ``of(numbers, weights)``, a matrix of doubles of a fixed shape.

    Each task adds up its own batches; Spark adds the entries of the tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                part = of(unpacked(batch.column("x"), dimension), batch.column("weight").to_numpy().astype(np.float64))
                total = part if total is None else total + part
        for i, row in enumerate(total if total is not None else ()):
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(row), pa.int32()), pa.array(range(len(row)), pa.int32()), pa.array(row)], names=["i", "j", "v"])

    rows = distinct.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((rows["i"].max() + 1, rows["j"].max() + 1))
    out[rows["i"], rows["j"]] = rows["v"]
    return out


def _totals(distinct: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Exact total weight and weighted sums."""
    schema = pa.schema([("j", pa.int32()), ("s", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (dimension + 1)
        for batch in batches:
            x, weight = unpacked(batch.column("x"), dimension), batch.column("weight").to_numpy()
            high, low = x >> 32, x & 0xFFFFFFFF  # halves, so that no sum of a batch overflows
            most = max(1, 2**30 // max(1, int(weight.max(initial=1))))
            for a in range(0, len(x), most):
                w = weight[a : a + most, None]
                sums = [(int(h) << 32) + int(v) for h, v in zip((high[a : a + most] * w).sum(0), (low[a : a + most] * w).sum(0))]
                totals = [t + s for t, s in zip(totals, [int(w.sum()), *sums])]
        yield pa.RecordBatch.from_arrays([pa.array(range(dimension + 1), pa.int32()), pa.array([Decimal(t) for t in totals], pa.decimal128(38, 0))], schema=schema)

    rows = distinct.mapInArrow(run, "j int, s decimal(38,0)").groupBy("j").agg(F.sum("s").alias("s")).collect()
    found = {r.j: int(r.s) for r in rows}
    return found.get(0, 0), [found.get(j, 0) for j in range(1, dimension + 1)]


def usual_dimension(vectors: DataFrame) -> int:
    """The length that most vectors have (of several, the longest); 0 without any."""
    lengths = vectors.where("size(vector) > 0").groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return lengths[0].d if lengths else 0


def distinct_vectors(df: DataFrame, dimension: int, scale: int = SCALE, shift: int = SHIFT, weights: str = "one") -> DataFrame:
    """(print, x, weight): each distinct vector of numbers once."""
    if weights not in ("one", "count"):
        raise ValueError("weights are 'one' or 'count'")
    merged = _numbered(df, dimension, scale, shift, True).groupBy("print").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("weight"))
    return stored(merged if weights == "count" else merged.withColumn("weight", F.lit(1).cast("long")), "whitening-distinct")


def fit(distinct: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening | None:
    """Eigenvectors of the weighted covariance (divisor: total weight); None without vectors."""
    n, sums = _totals(distinct, dimension)
    if not n:
        return None
    centre = Whitening(n, tuple(sums), np.zeros(0), np.zeros((0, dimension)), 0.0)

    def gram(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
        c = centre.centred(x)
        return (c * weight[:, None]).T @ c

    covariance = _summed(distinct, dimension, gram) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors.T[::-1]
    kept = min(components, int((values > LEAST_EIGENVALUE * max(values[0], 0)).sum()))
    vectors = vectors[:kept]
    signs = np.sign(vectors[np.arange(kept), np.abs(vectors).argmax(1)])
    return Whitening(n, tuple(sums), values[:kept].copy(), vectors * signs[:, None], float(np.trace(covariance)))


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest entry, by size, of the whitened vectors' own covariance minus the identity."""

    def moments(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
        z = np.column_stack([np.ones(len(x)), model.whitened(x)])
        return (z * weight[:, None]).T @ z

    m = _summed(distinct, len(model.sums), moments) / model.n
    return float(np.abs(m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) - np.eye(len(m) - 1)).max())


def whiten(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, weights: str = "one", scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    Rows whose vector is null or empty, holds a null or non-finite entry, or one whose whole
    number exceeds 2^62, or is not of the most frequent length, take no part. Repeated rows
    and ids come back each; a null id stays null. Components whose eigenvalue is nothing but
    rounding (fewer distinct vectors than dimensions, constant entries) are left out, so one
    distinct vector gives no rows, nor does an empty table. ``deviation`` is null where a
    long can't hold it. Other columns are not read.
    """
    spark = df.sparkSession
    vectors = _lists(df, vec_id, vector)
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf))
    vectors = vectors.where(fine)
    dimension = usual_dimension(vectors)
    distinct = distinct_vectors(vectors, dimension, scale, shift, weights) if dimension else None
    model = fit(distinct, dimension, components) if dimension else None
    if model is None or not len(model.values):
        return spark.createDataFrame([], _OUT)
    error = identity_error(distinct, model)
    schema = pa.schema([("print", pa.binary()), ("deviation", pa.int64()), ("z", pa.list_(pa.float64()))])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column("x"), dimension)
            z = model.whitened(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("print"), pa.array(model.deviation(x), pa.int64()), lists], schema=schema)

    each = distinct.select("print", "x").mapInArrow(once, "print binary, deviation long, z array<double>")
    rows = _numbered(vectors, dimension, scale, shift, False).join(each, "print").select("vec_id", "deviation", F.posexplode("z").alias("k", "whitened"))
    explained = F.element_at(F.array(*[F.lit(float(v / model.trace)) for v in model.values]), F.col("k") + 1)
    return rows.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
