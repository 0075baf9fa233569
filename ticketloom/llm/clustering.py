"""Centroid clustering (k-means) over an incremental distance matrix, in whole numbers.

Entries are floor(64 * x). A vector's table row holds its entries and its exact dot
product with each centroid. A round replaces a centroid by the floored mean of its
vectors; the dot products then change only by (entries at the components that moved)
times (how far they moved), so a centroid that stands still costs nothing, and the
nearest centroid is read off |v|^2 - 2 v.c + |c|^2 again. Nothing is rounded, so
results do not depend on partitions, order or retries.

How it runs: each round reads the table of the round before and writes the next one to
shared storage, one pass without a shuffle; after that the older one is deleted. Sums for the new centroids are added up
in the tasks, then by Spark by (centroid, component); the driver sees centroids only,
k times the number of components. No vector is dealt by its cluster, so a cluster
with a third of all vectors is a partial sum like any other.

Defined cases: vectors that are null, of another length, or hold a null, a NaN, an
infinity or an entry beyond ``BOUND`` (where a squared distance could leave 64 bits)
are left out. Repeated ids and repeated vectors are rows of their own. Starting
centroids are the rows of smallest hash of the id; rows of one id tie by their entries.
A null id hashes as the empty text. With fewer rows than centroids there are as many
centroids as rows, none without rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import narrow, ready, unstaged
from ticketloom.llm.vectors import SUMS, Sums, decoded, encoded, entries, gathered, table_batch, usable
from ticketloom.session import stage

SCALE = 64
#: Largest |x|: entries stay within 2^27, so a squared distance over 64 of them fits 63 bits.
BOUND = float(2**27 - 1) / SCALE


def starts(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The entries of the k vectors whose hashed ids are smallest, in that order."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    # equal vectors may stand for each other, so the order of their texts settles ties
    first = vectors.select(F.sha2(told, 256).alias("hash"), "vector").orderBy("hash", "vector").limit(k)
    rows = [np.floor(np.array(r.vector, np.float64) * SCALE).astype(np.int64) for r in first.collect()]
    return np.array(rows)


def nearest(rows: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid (ties: the smaller number) and its squared distance."""
    away = (rows * rows).sum(axis=1)[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)[None, :]
    cluster = away.argmin(axis=1)
    return cluster, away[np.arange(len(rows)), cluster]


def moved(dots: np.ndarray, rows: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The dot products after centroids moved, by the components that did."""
    for number, step in enumerate(steps):
        at = np.flatnonzero(step)
        if len(at):
            dots[:, number] += rows[:, at] @ step[at]
    return dots


def state_batch(ids: pa.Array, rows: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    cluster, away = nearest(rows, dots, centroids)
    return table_batch(
        id=ids, entries=encoded(rows), dots=encoded(dots),
        cluster=pa.array(cluster.astype(np.int32)), distance=pa.array(away),
    )


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Vectors to (id, entries, dots, cluster, distance): all products worked out once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = entries(batch.column("vector"), SCALE)
                yield state_batch(batch.column("id"), rows, rows @ centroids.T, centroids)

    return vectors.mapInArrow(run, state_schema(vectors))


def reassigned(state: DataFrame, centroids: np.ndarray, steps: np.ndarray) -> DataFrame:
    """The state after each centroid moved by its row of ``steps`` to where it is now."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = decoded(batch.column("entries"), size)
                dots = moved(decoded(batch.column("dots"), k), rows, steps)
                yield state_batch(batch.column("id"), rows, dots, centroids)

    return state.mapInArrow(run, state_schema(state))


def state_schema(frame: DataFrame) -> str:
    return f"id {frame.schema['id'].dataType.simpleString()}, entries binary, dots binary, cluster int, distance bigint"


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid as the floored mean of its vectors; one without vectors stays."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            if batch.num_rows:
                sums.add(batch.column("cluster").to_numpy(), decoded(batch.column("entries"), size))
        yield from sums.batches()

    fresh = centroids.copy()
    for number, (n, totals) in gathered(state.select("cluster", "entries").mapInArrow(run, SUMS)).items():
        fresh[number] = [t // n for t in totals]
    return fresh


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, seed: int = 1, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row for each vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = ready(vectors.sparkSession)
    fits = usable(F.col(vector), BOUND) & (F.size(vector) == size)
    kept = narrow(vectors.where(fits), id=id_col, vector=vector)
    centroids = starts(kept, k, seed)
    if not len(centroids):
        empty = f"{id_col} {kept.schema['id'].dataType.simpleString()}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], empty)
    state = stage(assigned(kept, centroids), "cluster-state")
    for _ in range(rounds):
        fresh = means(state, centroids)
        steps, centroids = fresh - centroids, fresh
        before, state = state, stage(reassigned(state, centroids, steps), "cluster-state")
        unstaged(before)
    totals = stage(state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")), "cluster-totals")
    # at most k rows
    whole = totals.agg(F.sum("total")).first()[0]
    digests = [(n, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for n, c in enumerate(centroids.tolist())]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string").join(totals, "cluster")
    return state.join(F.broadcast(named), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance",
        F.col("total").try_cast("bigint").alias("cluster_inertia"),
        F.lit(whole).try_cast("bigint").alias("inertia"),
        "centroid_sha256",
    )
