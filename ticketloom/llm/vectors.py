"""Vectors in Arrow batches: which ones count, whole-number entries, exact sums, compact storage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}


def usable(vector: Column, bound: float) -> Column:
    """Neither null nor empty, and every entry a number of at most ``bound``."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= bound))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def entries(column: pa.Array, scale: int = 64) -> np.ndarray:
    """floor(scale * x) of a batch of equally long vectors without nulls, one row each."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * scale).astype(np.int64).reshape(len(column), -1)


def encoded(rows: np.ndarray) -> pa.Array:
    """One binary for each row, in the fewest bytes an entry that hold the batch."""
    top = int(max(rows.max(initial=0), -(rows.min(initial=0) + 1)))
    width = next(w for w in KINDS if top < 1 << (8 * w - 1))
    data = np.ascontiguousarray(rows.astype(KINDS[width]))
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def decoded(column: pa.Array, size: int) -> np.ndarray:
    """The rows that ``encoded`` made, which may differ in width."""
    widths = pc.binary_length(column).to_numpy() // max(size, 1)
    rows = np.empty((len(column), size), np.int64)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        blob = b"".join(column.take(pa.array(at)).to_pylist())
        rows[at] = np.frombuffer(blob, KINDS[int(width)]).reshape(len(at), size)
    return rows


def table_batch(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


class Sums:
    """Exact sums of entries by group, kept as whole numbers of any length."""

    def __init__(self) -> None:
        self.totals: dict[int, tuple[int, np.ndarray]] = {}

    def add(self, groups: np.ndarray, rows: np.ndarray) -> None:
        for group in np.unique(groups):
            part = rows[groups == group]
            n, held = self.totals.get(int(group), (0, 0))
            self.totals[int(group)] = (n + len(part), held + part.sum(axis=0).astype(object))

    def batches(self) -> Iterator[pa.RecordBatch]:
        for group, (n, held) in self.totals.items():
            size = len(held)
            yield table_batch(
                grp=pa.array([group] * size, pa.int32()),
                dim=pa.array(range(size), pa.int32()),
                n=pa.array([n] * size, pa.int64()),
                total=pa.array([str(t) for t in held], pa.string()),
            )


SUMS = "grp int, dim int, n bigint, total string"


def gathered(partial: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Sums of all tasks, added up by Spark: group to (vectors, total of each entry)."""
    rows = (
        partial.groupBy("grp", "dim")
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .orderBy("grp", "dim")
        .collect()
    )
    found: dict[int, tuple[int, list[int]]] = {}
    for row in rows:
        found.setdefault(row.grp, (row.n, []))[1].append(int(row.total))
    return found
