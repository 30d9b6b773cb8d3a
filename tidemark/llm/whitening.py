"""Whitening of embeddings by a bidiagonal qd solver.

Entries c become integers floor(scale * c) + offset. One pass adds them up exactly, a second one reduces the centred
rows to a triangular matrix by QR: each task over its blocks of rows, then groups of tasks' triangles, so no task sees
more than a bounded number of them. The last triangle, as many rows as dimensions, is made bidiagonal; qd finds its
singular values and twisted factorisations the whitening directions (see qd). Rows are then projected where they lie.

Rows whose vector is null, or holds entries that are null or not finite, are dropped. All others take part, also those
with a null or repeated id; each gives its own result. Entries beyond 64 bits stop at the largest or smallest long, as
do deviations. The dimension is that of most vectors, of several the largest; vectors of another one, and empty
vectors, are dropped. Directions along which the rows don't vary can't be whitened: there are no more components than
the rank of the centred rows, none for one row or for equal rows. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import qd, repeats
from tidemark.llm.shared import stash, table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows that are reduced at a time, and triangles that one task reduces.
BLOCK_ROWS, FAN_IN = 2048, 16
LONG = (1 << 63) - 1
EXACT = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """Rows, exact sums by dimension, and for every component its direction (a column), variance and share of the total."""

    rows: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    scale: int = SCALE
    offset: int = OFFSET

    def centred(self, x: np.ndarray) -> np.ndarray:
        """rows * x - sums, exact: longs, or Python integers where those are too small."""
        most = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)
        if 2 * self.rows * most < EXACT:
            return x * np.int64(self.rows) - np.array(self.sums, np.int64)
        return x.astype(object) * self.rows - np.array(self.sums, object)

    def project(self, t: np.ndarray) -> np.ndarray:
        """Whitened values of centred rows, a column for each component."""
        return (t.astype(float) / self.rows) @ (self.directions / np.sqrt(self.variances))


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and v, the vector as doubles, of the rows that aren't dropped; any dimension."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return rows.select("vec_id", doubles.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)


def integers(batch: pa.RecordBatch, dim: int, scale: int, offset: int) -> np.ndarray:
    """The integer vectors of a batch whose vectors have one dimension."""
    flat, _ = repeats.lists(batch.column(batch.schema.get_field_index("v")))
    whole = np.floor(scale * flat)
    out = np.where(np.abs(whole) < 2.0**62, whole, 0).astype(np.int64) + offset
    out[whole >= 2.0**62] = LONG
    out[whole <= -(2.0**62)] = -LONG - 1
    return out.reshape(-1, dim)


def _sums(scale: int, offset: int) -> Callable:
    """mapInArrow function: the number and the exact sums of a task's vectors, by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            sizes = np.diff(repeats.lists(batch.column(batch.schema.get_field_index("v")))[1])
            for dim in np.unique(sizes).tolist():
                own = integers(batch.filter(pa.array(sizes == dim)), dim, scale, offset)
                most = max(int(own.max()), -int(own.min()))
                total = own.sum(axis=0) if most * len(own) < EXACT else own.astype(object).sum(axis=0)
                n, before = found.get(dim, (0, 0))
                found[dim] = n + len(own), before + total.astype(object)
        for dim, (n, total) in found.items():
            exact = pa.array([Decimal(int(x)) for x in total], pa.decimal128(38, 0))
            head = [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64())]
            yield pa.RecordBatch.from_arrays([*head, exact], ["dim", "place", "n", "total"])

    return run


def _triangle(block: np.ndarray) -> np.ndarray:
    return np.linalg.qr(block, mode="r")


def _reduced(model: Whitening) -> Callable:
    """mapInArrow function: the triangle of a task's centred rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim = len(model.sums)
        own = np.zeros((0, dim))
        for batch in batches:
            x = integers(batch, dim, model.scale, model.offset)
            for at in range(0, len(x), BLOCK_ROWS):
                own = _triangle(np.concatenate((own, model.centred(x[at : at + BLOCK_ROWS]).astype(float) / model.rows)))
        if len(own):
            yield pa.RecordBatch.from_arrays([pa.array([own.tobytes()], pa.binary())], ["triangle"])

    return run


def _merged(dim: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        own = np.zeros((0, dim))
        for value in rows.column("triangle").combine_chunks():
            own = _triangle(np.concatenate((own, np.frombuffer(value.as_buffer()).reshape(-1, dim))))
        return pa.table({"triangle": pa.array([own.tobytes()], pa.binary())})

    return run


def fit(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """The whitening of (vec_id, embedding) rows; None without any vectors. Only sums and triangles reach the driver."""
    valid = usable(rows)
    partial = stash(valid.select("v").mapInArrow(_sums(scale, offset), "dim int, place int, n long, total decimal(38,0)"))
    places = partial.groupBy("dim", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    commonest = places.where("place = 0").orderBy(F.desc("n"), F.desc("dim")).first()
    if commonest is None:
        return None
    dim, n = commonest["dim"], commonest["n"]
    sums = tuple(int(r["total"]) for r in places.where(F.col("dim") == dim).orderBy("place").collect())
    empty = np.zeros((dim, 0)), np.zeros(0), np.zeros(0)
    model = Whitening(n, sums, *empty, scale, offset)
    own = valid.where(F.size("v") == dim).select("v")
    triangles = stash(own.mapInArrow(_reduced(model), "triangle binary"))
    while (count := triangles.count()) > FAN_IN:
        groups = -(-count // FAN_IN)
        dealt = triangles.withColumn("part", F.pmod(F.xxhash64("triangle"), F.lit(groups)))
        triangles = stash(dealt.groupBy("part").applyInArrow(_merged(dim), "triangle binary"))
    last = _merged(dim)(triangles.toArrow()).column("triangle")[0]
    square = np.zeros((dim, dim))
    r = np.frombuffer(last.as_buffer()).reshape(-1, dim)
    square[: len(r)] = r
    squares, directions = qd.right_vectors(square, min(components, dim))
    variances = squares[: directions.shape[1]] / n
    return Whitening(n, sums, directions, variances, variances / max((squares / n).sum(), np.finfo(float).tiny), scale, offset)


def _projected(model: Whitening) -> Callable:
    """mapInArrow function: vec_id, deviation and whitened of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, width = model.directions.shape
        for batch in batches:
            x = integers(batch, dim, model.scale, model.offset)
            for at in range(0, len(x), BLOCK_ROWS):
                t = model.centred(x[at : at + BLOCK_ROWS])
                exact = t if t.dtype == np.int64 and dim * float(np.abs(t).max(initial=0)) ** 2 < EXACT else t.astype(object)
                deviation = np.minimum((exact * exact).sum(axis=1), LONG).astype(np.int64)
                offsets = pa.array(np.arange(len(t) + 1, dtype=np.int32) * np.int32(width))
                whitened = pa.ListArray.from_arrays(offsets, pa.array(model.project(t).ravel()))
                ids = batch.column(batch.schema.get_field_index("vec_id")).slice(at, len(t))
                yield pa.RecordBatch.from_arrays([ids, pa.array(deviation), whitened], ["vec_id", "deviation", "whitened"])

    return run


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (of rows * x from sums, squared and added up) and whitened (an entry for each component)."""
    own = usable(rows).where(F.size("v") == len(model.sums))
    kind = dict(own.dtypes)["vec_id"]
    return own.mapInArrow(_projected(model), f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened rows less the identity, measured over all rows."""
    width = len(model.variances)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, outer = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            w = repeats.lists(batch.column(0))[0].reshape(-1, width)
            total, outer = total + w.sum(axis=0), outer + w.T @ w
        i, j = (x.ravel().astype(np.int32) for x in np.indices((width, width)))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i]), pa.array(total[j]), pa.array(outer.ravel())], ["i", "j", "a", "b", "ab"])

    # rows are centred before they are projected, so the means that are taken off here are nothing but rounding
    sums = whiten(rows, model).select("whitened").mapInArrow(products, "i int, j int, a double, b double, ab double")
    entries = sums.groupBy("i", "j").agg(*((F.sum(c) / model.rows).alias(c) for c in ("a", "b", "ab")))
    error = F.abs(F.col("ab") - F.col("a") * F.col("b") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return entries.agg(F.max(error)).first()[0]


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(rows)
    if model is None or not len(model.variances):
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    found = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.get(F.array(*map(F.lit, model.explained.tolist())), F.col("at"))
    return found.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.rows).cast("long").alias("n"),
        "deviation",
        "whitened",
        share.alias("explained"),
        F.lit(identity_error(rows, model)).alias("identity_error"),
    )
