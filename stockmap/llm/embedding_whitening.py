"""Embedding whitening by a weighted multiplicity covariance.

1. Entries become whole numbers ``x = floor(1024 c) + 100000`` and the rows of
   equal x vectors one entry with their number of copies (map-side counts, so
   a vector that fills a third of the table is a few rows of the shuffle).
2. Each distinct vector has a fit weight: its copies (``by_copies``, the fit
   list is then all rows) or one. Sums per dimension are exact whole numbers.
3. Covariance: each task centres its distinct vectors, multiplies them by the
   roots of their weights and adds one dense product ``Z'Z`` to its own matrix;
   the matrices are summed row by row on the executors. Only the last sum of
   ``dims`` squared numbers reaches the driver, which finds its eigenvectors.
4. Each distinct vector is projected once and divided by the roots of the
   eigenvalues; a further pass over these short vectors measures how far their
   covariance is from the identity, centred before multiplying.
5. Results are joined back to the rows by vector. Vectors with more than one
   row in ``HOT`` (there can be no more than ``HOT``) are broadcast, the others
   meet their rows in a merge join, where no key holds more than that share.

Defined cases: a row takes no part if its vector is null, empty, holds null or
non-finite entries or one beyond ``LARGEST`` (x would not be exact), or has
another length than most (of equally frequent lengths the greater). Null and
repeated ids each give their own rows. A component whose variance is nothing
but rounding (``FLAT`` of the largest) has ``whitened`` null, and
``identity_error`` is over the others, null if there are none (all vectors
equal, or a single row). ``explained`` is null if there is no variance at all.
``deviation`` is null where the exact number is beyond 64 bits;
``deviation_exact`` (38 digits) still has it. An empty table gives an empty result.
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

from stockmap.llm.common import table
from stockmap.session import materialize

SCALE, SHIFT = 1024, 100_000
#: Largest entry: products with it stay exact in doubles.
LARGEST = 2.0 ** 36
COMPONENTS = 8
HOT = 256
FLAT = 1e-12

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
          "copies long, deviation_exact decimal(38,0)")


def quantized(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, x (64-bit whole numbers as bytes) of the rows of ``vectors`` (vec_id, embedding) that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = pc.fill_null(lists.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
            starts, row = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
            with np.errstate(invalid="ignore"):
                bad = np.bincount(row[~(np.abs(values) <= LARGEST)], minlength=len(sizes)) > 0
                x = (np.floor(np.where(np.isfinite(values), values, 0) * SCALE).astype("<i8") + SHIFT)
            keep = np.flatnonzero(~bad & (sizes > 0))
            rows = [x[starts[i]:starts[i] + sizes[i]].tobytes() for i in keep]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(keep, pa.int64())), pa.array(sizes[keep], pa.int32()), pa.array(rows, pa.binary())],
                                             names=["vec_id", "dim", "x"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, dim int, x binary")


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _weights(batch: pa.RecordBatch, by_copies: bool) -> np.ndarray:
    copies = batch.column("copies").to_numpy().astype(np.int64)
    return copies if by_copies else np.ones_like(copies)


def _add_rows(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of all tasks' doubles for one row of a matrix."""
    total = sum(_matrix(b.column("values"), "<f8").sum(axis=0) for b in batches if len(b))
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["row", "values"])


def _summed(df: DataFrame, partial, dims: int) -> np.ndarray:
    """The sum over all tasks of the ``dims``-row matrices that ``partial`` makes of batches, summed row by row on the executors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(partial(b) for b in batches if len(b))
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["row", "values"])

    rows = df.mapInArrow(run, "row int, values binary").groupBy("row").applyInArrow(_add_rows, "row int, values binary").collect()
    return np.stack([np.frombuffer(r["values"], "<f8") for r in sorted(rows, key=lambda r: r.row)]) if rows else np.zeros((dims, dims))


def dimension_sums(distinct: DataFrame, dims: int, by_copies: bool) -> list[int]:
    """Exact weighted sums of x per dimension: whole numbers of any size, as each task's sums travel in two halves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for b in batches:
            if len(b):
                x, w = _matrix(b.column("x"), "<i8"), _weights(b, by_copies)
                some = (x * w[:, None]).sum(axis=0) if int(np.abs(x).max()) * int(w.sum()) < 1 << 62 else (x.astype(object) * w[:, None]).sum(axis=0)
                total = [a + int(s) for a, s in zip(total, some, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["dim", "total"])

    rows = distinct.select("x", "copies").mapInArrow(run, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total")).collect()
    found = {r.dim: int(r.total) for r in rows}
    return [found.get(k, 0) for k in range(dims)]


@dataclass
class Centre:
    """Exact mean: the whole part and the rest of ``sums / n`` per dimension."""
    sums: list[int]
    n: int

    def apart(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n`` in doubles: the whole part is taken off exactly first."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole) - rest

    def deviation(self, x: np.ndarray) -> list[int]:
        """``sum((n x - sums)^2)``, exact."""
        span = max(abs(self.n * int(v) - s) for extreme in (x.min(axis=0), x.max(axis=0)) for v, s in zip(extreme, self.sums, strict=True))
        if span * span * x.shape[1] < 1 << 63:  # every difference fits, and so does every sum
            whole = np.array([s // self.n for s in self.sums], np.int64)
            d = (x - whole) * self.n - np.array([s % self.n for s in self.sums], np.int64)
            return (d * d).sum(axis=1).tolist()
        d = x.astype(object) * self.n - np.array(self.sums, object)
        return [int(v) for v in (d * d).sum(axis=1)]


@dataclass
class Whitening:
    """Unit eigenvectors as columns by falling eigenvalue, with ``explained`` shares."""
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @classmethod
    def of(cls, covariance: np.ndarray, components: int) -> Whitening:
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        order = np.argsort(-values, kind="stable")[:components]
        vectors = vectors[:, order]
        signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), range(vectors.shape[1])])
        return cls(vectors * np.where(signs == 0, 1, signs), np.maximum(values[order], 0), float(np.trace(covariance)))

    @property
    def usable(self) -> np.ndarray:
        return (self.values > FLAT * self.values[0]) & (self.values > 0)

    def white(self, centred: np.ndarray) -> np.ndarray:
        """Components of centred rows over the roots of their variances; NaN where there is none."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.usable, centred @ self.vectors / np.sqrt(self.values), np.nan)


def covariance(distinct: DataFrame, centre: Centre, by_copies: bool) -> np.ndarray:
    """Weighted covariance, centred before multiplying, divisor the sum of weights."""
    def partial(b: pa.RecordBatch) -> np.ndarray:
        z = centre.apart(_matrix(b.column("x"), "<i8")) * np.sqrt(_weights(b, by_copies))[:, None]
        return z.T @ z

    return _summed(distinct.select("x", "copies"), partial, len(centre.sums)) / centre.n


def identity_error(white: DataFrame, usable: np.ndarray, n: int, by_copies: bool) -> float | None:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    if not usable.any():
        return None
    k = int(usable.sum())

    def rows(b: pa.RecordBatch) -> np.ndarray:
        return _matrix(b.column("white"), "<f8")[:, usable]

    mean = _summed(white, lambda b: (rows(b) * _weights(b, by_copies)[:, None]).sum(axis=0)[None, :], 1)[0] / n

    def partial(b: pa.RecordBatch) -> np.ndarray:
        z = (rows(b) - mean) * np.sqrt(_weights(b, by_copies))[:, None]
        return z.T @ z

    return float(np.abs(_summed(white, partial, k) / n - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, by_copies: bool = True) -> DataFrame:
    """One row for each row of ``vectors`` that takes part and each component up to ``components`` (fewer dimensions: fewer)."""
    spark = vectors.sparkSession
    rows = materialize(quantized(vectors), "white-rows")
    dims = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).agg(F.max_by("dim", F.struct("n", "dim")).alias("dim")).first().dim
    if dims is None:
        return spark.createDataFrame([], RESULT)
    rows = rows.filter(F.col("dim") == dims).select("vec_id", "x")
    distinct, seen = materialize(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "white-distinct",
                                 [F.count(F.lit(1)).alias("distinct"), F.sum("copies").alias("rows")])
    n = seen["rows"] if by_copies else seen["distinct"]
    centre = Centre(dimension_sums(distinct, dims, by_copies), n)
    fitted = Whitening.of(covariance(distinct, centre, by_copies), components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                x = _matrix(b.column("x"), "<i8")
                white, deviation = fitted.white(centre.apart(x)), centre.deviation(x)
                yield pa.RecordBatch.from_arrays(
                    [b.column("x"), b.column("copies"), pa.array([Decimal(d) for d in deviation], pa.decimal128(38, 0)), pa.array([w.tobytes() for w in white], pa.binary()),
                     pa.array(white.tolist(), pa.list_(pa.float64()))], names=["x", "copies", "deviation_exact", "white", "components"])

    white = materialize(distinct.mapInArrow(run, "x binary, copies long, deviation_exact decimal(38,0), white binary, components array<double>"), "white-vectors")
    error = identity_error(white.select("white", "copies"), fitted.usable, n, by_copies)
    found = white.drop("white")
    hot = F.col("copies") > seen["rows"] / HOT
    # At most HOT vectors can each hold more than one row in HOT.
    few = F.broadcast(found.filter(hot))
    often = rows.join(few, "x")
    rest = rows.join(few.select("x"), "x", "left_anti").join(found.filter(~hot).hint("merge"), "x")
    shares = F.array(*[F.lit(float(v / fitted.trace)) if fitted.trace > 0 else F.lit(None).cast("double") for v in fitted.values])
    each = often.unionByName(rest).select("*", F.posexplode("components").alias("at", "whitened"))
    fits = F.col("deviation_exact") <= (1 << 63) - 1
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), F.when(fits, F.col("deviation_exact").cast("long")).alias("deviation"),
        F.nanvl("whitened", F.lit(None).cast("double")).alias("whitened"), F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"), "copies", "deviation_exact")


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """All usable ``embeddings`` whitened along their eight strongest components."""
    return whiten(table(spark, sf_dir, "embeddings"))
