"""Sparse hashed features of whole texts, and bounded labelled samples of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import narrow
from ticketloom.llm.textbytes import WORD_ALNUM, Texts, distinct_pairs, hash_slices, pieces, word_hashes

#: Letters, digits and everything else, for the shape of a word.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[48:58] = 48
SHAPE[65:91] = 97
SHAPE[97:123] = 97
SHAPE[128:] = 97


def terms(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each distinct word of letters and digits."""
    words, hashes = word_hashes(t, WORD_ALNUM)
    return distinct_pairs(words.text, hashes)


def terms_and_shapes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words as terms, and each distinct shape of a space-separated word:
    runs of letters, digits or of one other character become one character."""
    words, hashes = word_hashes(t)
    shaped = SHAPE[t.buf]
    keep = np.ones(len(shaped), dtype=bool)
    keep[1:] = shaped[1:] != shaped[:-1]
    keep[words.starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    shapes = hash_slices(shaped[keep], at[words.starts], at[words.ends]) + np.uint64(1)
    return distinct_pairs(np.concatenate([words.text, words.text]), np.concatenate([hashes, shapes]))


def letters(t: Texts) -> np.ndarray:
    """For each text whether it has a letter of any script."""
    ascii_letter = np.zeros(256, dtype=np.int64)
    ascii_letter[65:91] = ascii_letter[97:123] = 1
    sums = np.concatenate([[0], np.cumsum(ascii_letter[t.buf])])
    found = sums[t.bounds[1:]] > sums[t.bounds[:-1]]
    for i in np.flatnonzero(~found):
        raw = t.buf[t.bounds[i] : t.bounds[i + 1]].tobytes()
        found[i] = any(c.isalpha() for c in raw.decode("utf-8", "ignore"))
    return found


def collected(rows: DataFrame, extract: Callable[[Texts], tuple[np.ndarray, np.ndarray]], label: str = "label", text: str = "text"):
    """Labels and features of a bounded sample, brought to the driver packed.

    Returns ``labels`` (array), ``bounds`` and ``hashes``: row i has
    ``hashes[bounds[i] : bounds[i + 1]]``. Rows are ordered by id.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in pieces(batches):
            owner, hashes = extract(t)
            cut = np.searchsorted(owner, np.arange(t.n + 1))
            packed = [hashes[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, type=pa.binary())], names=["id", "label", "packed"])

    kind = rows.schema[label].dataType.simpleString()
    table = narrow(rows, id="id", label=label, text=text).mapInArrow(task, f"id bigint, label {kind}, packed binary").toArrow()
    table = table.sort_by([("id", "ascending"), ("packed", "ascending")])
    labels, packed = np.array(table.column("label").to_pylist()), table.column("packed").to_pylist()
    del table
    bounds = np.concatenate([[0], np.cumsum([len(x) // 8 for x in packed])]).astype(np.int64)
    hashes = np.frombuffer(b"".join(packed), dtype=np.uint64)
    del packed
    pa.default_memory_pool().release_unused()
    return labels, bounds, hashes


def sized(marks: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Marks (id, label) of documents with the ``bytes`` of their texts; only numbers are joined."""
    sizes = narrow(docs, id=id_col, bytes=F.octet_length(text)).groupBy("id").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    return marks.join(sizes, "id")


#: Bytes of text of a sample's group at most, about: what the driver learns from has a bound in bytes too.
SAMPLE_BYTES = 12 << 20


def sampled(rows: DataFrame, groups: str, most: int, size: str | None = None) -> DataFrame:
    """About ``most`` rows of each group at most, chosen by a hash of ``id`` alone, and of about
    ``SAMPLE_BYTES`` at most where ``size`` names a column with the bytes of a row."""
    held = F.sum(size) if size else F.lit(0)
    counts = rows.groupBy(groups).agg(F.count(F.lit(1)).alias("n"), held.alias("held")).collect()  # a row for each label value
    share: Column = F.lit(0.0)
    for row in counts:
        part = min(1.0, most / row.n, SAMPLE_BYTES / max(row.held or 0, 1))
        share = F.when(F.col(groups) == row[0], F.lit(part)).otherwise(share)
    place = F.pmod(F.xxhash64(F.col("id"), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(place < share)


def vocabulary(hashes: np.ndarray, least: int) -> np.ndarray:
    """Ascending hashes that occur in ``least`` rows or more of the sample."""
    values, counts = np.unique(hashes, return_counts=True)
    return values[counts >= least]


def known(hashes: np.ndarray, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``vocab`` and the mask of those that are there."""
    if not len(vocab):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at, on = np.empty(len(hashes), np.int32), np.empty(len(hashes), bool)
    for low in range(0, len(hashes), 1 << 18):
        part = hashes[low : low + (1 << 18)]
        place = np.minimum(np.searchsorted(vocab, part), len(vocab) - 1)
        at[low : low + len(part)], on[low : low + len(part)] = place, vocab[place] == part
    return at, on


def rows_of(bounds: np.ndarray, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and hashes of some of the rows, in their order."""
    sizes = bounds[rows + 1] - bounds[rows]
    place = np.repeat(bounds[rows], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.concatenate([[0], np.cumsum(sizes)]), hashes[place]


def telling(y: np.ndarray, bounds: np.ndarray, hashes: np.ndarray, vocab: np.ndarray, evidence: float) -> np.ndarray:
    """Terms whose chi-square with the label is ``evidence`` or more; the others are noise."""
    at, on = known(hashes, vocab)
    label = np.repeat(y, np.diff(bounds))[on]
    both = np.bincount(at[on], label, len(vocab))
    n = np.bincount(at[on], minlength=len(vocab)).astype(np.float64)
    share = y.mean() if len(y) else 0.0
    spread = n * share * (1 - share) * (1 - n / max(len(y), 1))
    chi = np.square(both - n * share) / np.maximum(spread, 1e-9)
    return vocab[chi >= evidence]


def summed(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by ascending owner."""
    out = np.zeros((n, *values.shape[1:]), dtype=values.dtype)
    if len(owner):
        at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        out[owner[at]] = np.add.reduceat(values, at, axis=0)
    return out
