"""Embedding whitening from a blockwise QR and a bidiagonal qd solver.

Entries become x = floor(64 * c) + 1000000 and are centred exactly, as n * x - S over
n. Each task reduces its centred rows to one triangle R by QR of (R so far, next rows);
triangles are merged by QR in rounds of groups of bounded bytes, so V = R'R / n for the
last one without ever squaring the data. The driver holds that one triangle: it is made
bidiagonal, dqds gives its singular values and twisted factorisations its right vectors
(``bidiagonal``). Rows are then projected on these and divided by the roots of the
eigenvalues.

Four passes over the vectors, none with a shuffle of vectors: sums, triangles, the
covariance of the whitened values (``identity_error`` is measured from all rows, not
derived), and the result. Sums and covariances leave each task once, as a table of some
thousand numbers that Spark adds up.

Defined cases: vectors that are null, empty, or hold a null, a NaN, an infinity or an
entry beyond ``BOUND`` are left out. If the rest differ in length, those of the most
frequent length count (ties: the shorter) and the others are left out. Repeated ids and
vectors are rows of their own. Components whose eigenvalue is zero to working precision
don't exist, so there may be less than 32, and none (no rows) for one vector or equal
ones. Eigenvalues that are equal to working precision share a space, in which any
orthonormal basis serves. ``deviation`` is null where it exceeds 64 bits. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.bidiagonal import EPS, decompose
from ticketloom.llm.common import narrow, ready
from ticketloom.llm.vectors import SUMS, Sums, entries, gathered, table_batch, usable
from ticketloom.session import stage

SCALE, SHIFT = 64, 1_000_000
#: Largest |c|: entries and their sums over a batch stay exact in 64 bits.
BOUND = float(2**45)
#: Bytes of triangles that one task or the driver merges at once.
MERGE_BYTES = 64 << 20
QR_ROWS = 4096
LONG = 2**63


@dataclass(frozen=True)
class Fit:
    """Rows n, sums of x - SHIFT, eigenvalues, unit vectors (columns), and the trace of V."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float

    def directions(self) -> np.ndarray:
        return self.axes / np.sqrt(self.values)


def deviations(column: pa.Array, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S for each row: whole numbers of 64 bits, or of any length where needed."""
    rows = entries(column, SCALE)
    top = max(int(rows.max()), -int(rows.min())) if rows.size else 0
    if n * top + max(map(abs, sums)) < LONG:
        return rows * n - np.array(sums, np.int64)
    return rows.astype(object) * n - np.array(sums, object)


def centred(column: pa.Array, n: int, sums: list[int]) -> np.ndarray:
    return deviations(column, n, sums).astype(np.float64) / n


def column_sums(kept: DataFrame) -> tuple[int, list[int]]:
    """Vectors and the sum of each entry, without ``SHIFT``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            if batch.num_rows:
                sums.add(np.zeros(batch.num_rows, np.int32), entries(batch.column("vector"), SCALE))
        yield from sums.batches()

    return gathered(kept.select("vector").mapInArrow(run, SUMS)).get(0, (0, []))


def reduced(triangle: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The square triangle that stands for both."""
    size = rows.shape[1]
    factor = np.linalg.qr(np.vstack([triangle, rows]), mode="r")
    return np.vstack([factor, np.zeros((size - len(factor), size))])


def triangles(kept: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """(part, triangle): one for each task that has rows."""
    size = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle, held = np.zeros((size, size)), []
        for batch in batches:
            if batch.num_rows:
                held.append(centred(batch.column("vector"), n, sums))
            if sum(map(len, held)) >= QR_ROWS:
                triangle, held = reduced(triangle, np.vstack(held)), []
        if held:
            triangle = reduced(triangle, np.vstack(held))
        if triangle.any():
            yield table_batch(part=pa.array([TaskContext.get().partitionId()], pa.int64()), triangle=pa.array([triangle.tobytes()]))

    return kept.select("vector").mapInArrow(run, "part bigint, triangle binary")


def merged(parts: DataFrame, size: int) -> np.ndarray:
    """One triangle of all, in rounds over groups of at most ``MERGE_BYTES``."""
    fan = max(2, MERGE_BYTES // (8 * size * size))

    def fold(blobs: list[bytes]) -> np.ndarray:
        triangle = np.zeros((size, size))
        for blob in blobs:
            triangle = reduced(triangle, np.frombuffer(blob).reshape(size, size))
        return triangle

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part").to_pylist()[0] // fan
        return pa.table({"part": pa.array([part], pa.int64()), "triangle": pa.array([fold(table.column("triangle").to_pylist()).tobytes()])})

    state = stage(parts, "triangles")
    while state.count() > fan:
        grouped = state.groupBy(F.expr(f"part div {fan}"))
        state = stage(grouped.applyInArrow(run, "part bigint, triangle binary"), "triangles")
    return fold([bytes(r.triangle) for r in state.orderBy("part").collect()])


def fit(kept: DataFrame, components: int) -> Fit:
    """The whitening directions of all rows of ``vector``."""
    n, sums = column_sums(kept)
    size = len(sums)
    if not n:
        return Fit(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    triangle = merged(triangles(kept, n, sums), size)
    squares, axes = decompose(triangle)
    real = squares > (max(size, 2) * EPS) ** 2 * squares[0]
    number = min(components, int(real.sum()))
    return Fit(n, sums, squares[:number] / n, axes[:, :number], float(squares.sum() / n))


def identity_error(kept: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    number, directions = len(model.values), model.directions()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(number), np.zeros((number, number))
        for batch in batches:
            if batch.num_rows:
                white = centred(batch.column("vector"), model.n, model.sums) @ directions
                total += white.sum(axis=0)
                products += white.T @ white
        values = np.concatenate([total, products.ravel()])
        yield table_batch(at=pa.array(np.arange(len(values), dtype=np.int32)), value=pa.array(values))

    rows = kept.select("vector").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").collect()
    values = np.array([r.value for r in rows]) / model.n
    mean, products = values[:number], values[number:].reshape(number, number)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(number)).max())


def whitened(kept: DataFrame, model: Fit, error: float, id_col: str) -> DataFrame:
    """One row for each vector and component."""
    number, directions, n = len(model.values), model.directions(), model.n
    share = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            away = deviations(batch.column("vector"), n, model.sums)
            top = int(np.abs(away).max())
            exact = away if away.shape[1] * top * top < LONG else away.astype(object)
            squares = [int(s) if s < LONG else None for s in (exact * exact).sum(axis=1)]
            white = (away.astype(np.float64) / n) @ directions
            at = np.repeat(np.arange(count), number)
            yield table_batch(
                id=batch.column("id").take(pa.array(at)),
                component=pa.array(np.tile(np.arange(1, number + 1, dtype=np.int32), count)),
                deviation=pa.array(squares, pa.int64()).take(pa.array(at)),
                whitened=pa.array(white.ravel()),
                explained=pa.array(np.tile(share, count)),
            )

    kind = kept.schema["id"].dataType.simpleString()
    rows = kept.mapInArrow(run, f"id {kind}, component int, deviation bigint, whitened double, explained double")
    return rows.select(
        F.col("id").alias(id_col), "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).alias("identity_error"),
    )


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Whitened values of all usable vectors: id, component, n, deviation, whitened, explained, identity_error."""
    ready(vectors.sparkSession)
    kept = narrow(vectors.where(usable(F.col(vector), BOUND)), id=id_col, vector=vector)
    lengths = kept.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    kept = kept.where(F.size("vector") == (lengths[0].size if lengths else 0))
    model = fit(kept, components)
    if not len(model.values):
        return whitened(kept.where("false"), model, 0.0, id_col)
    return whitened(kept, model, identity_error(kept, model), id_col)
