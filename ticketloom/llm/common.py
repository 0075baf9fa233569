"""What the operators share: settings, bounded sizes, splits by checksum."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import prepare, unstaged  # noqa: F401

ARROW_ROWS = 1000
#: A batch ends with the row that reaches so many bytes: about what ``pieces`` works on at a time.
ARROW_BYTES = 2 << 20
#: A staged table of at most so many bytes may be broadcast.
BROADCAST_BYTES = 32 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Session settings; small Arrow batches, as texts may be long."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def checksum_mod(column: str, modulus: int) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, by one pass in the JVM."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def parts_for(total: int, each: int, least: int = 8) -> int:
    """How many parts of about ``each`` bytes hold ``total``."""
    return max(least, -(-total // each))


def narrow(docs: DataFrame, **columns: str | Column) -> DataFrame:
    """Just the named inputs, so that no other column can clash."""
    return docs.select(*[(F.col(c) if isinstance(c, str) else c).alias(k) for k, c in columns.items()])


def whole_rows(docs: DataFrame, text: str, name: str = "row") -> tuple[DataFrame, int]:
    """The rows as one struct column, and the place of ``text`` in it (see ``textbytes.own_text``)."""
    names = docs.columns if text in docs.columns else [c.lower() for c in docs.columns]
    return docs.select(F.struct("*").alias(name)), names.index(text if text in names else text.lower())


def semi(rows: DataFrame, ids: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Semi or anti join to staged fixed-width ids: sent to every executor up to
    ``BROADCAST_BYTES`` counted bytes, shuffled beyond."""
    if ids.count() * 8 <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    return rows.join(ids, on, how)


def by_bucket(bucket: np.ndarray, columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    """One row for each bucket that has entries: its entries of each column, packed
    by byte planes (all lowest bytes first, and so on), which compress well."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    to = np.append(at[1:], len(bucket))
    data = [pa.array(bucket[at].astype(np.int32))]
    for column in columns:
        column = np.ascontiguousarray(column[order])
        planes = column.view(np.uint8).reshape(len(column), column.dtype.itemsize)
        data.append(pa.array([planes[a:b].T.tobytes() for a, b in zip(at, to, strict=True)], type=pa.binary()))
    yield pa.RecordBatch.from_arrays(data, names=["bucket", *names])


def packed(column: np.ndarray) -> bytes:
    column = np.ascontiguousarray(column)
    return column.view(np.uint8).reshape(len(column), column.dtype.itemsize).T.tobytes()


def unpack(blob: bytes | pa.Buffer, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(blob, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def unpacked(table: pa.Table, name: str, dtype) -> np.ndarray:
    """The entries of all rows of a packed column; no copy but the one returned."""
    pa.default_memory_pool().release_unused()
    parts = [unpack(x.as_buffer(), dtype) for x in table.column(name)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)
