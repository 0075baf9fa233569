"""Removal of repeated byte strings by a column-wise suffix array construction.

A byte goes if it is covered by a ``WIDTH``-byte string (a window) that also
starts in a document with a smaller id. Windows are judged on the input.

1. Texts that are equal to one with a smaller id go whole, by digest.
2. The windows of the rest are dealt by their smallest ``GRAM``-byte hash: equal
   windows have equal hashes, and a run of windows with the same one is a segment
   (some 63 bytes for 14 windows). An entry is two hashes, the document and the
   place, not the bytes. Of entries with equal segments only the smallest id's
   stays (each task drops repeats before the shuffle, so a passage that a third
   of all documents share leaves one entry a task); the others' windows go.
3. Where one hash has several different segments, their bytes are fetched and
   become the strings of a collection. A string stays out if it shares none of its
   ``CUTS`` stretches around the gram (42 of the 50 bytes, one of which every equal
   window has) with another id. The Burrows-Wheeler transform and common
   prefixes are built column by column: round t inserts the suffix of length t of
   every string at once, at the rank that the transform so far gives for its
   symbol, and updates the common prefixes (up to WIDTH); the columns live in
   files that each round reads and writes once, in order. Neighbours with a
   common prefix of WIDTH are equal windows, of which the smallest id stays.
   A hash with over ``CROWD`` segments is dealt again, window by window.

Bytes are UTF-8. Defined cases: null texts are empty; texts under WIDTH bytes
keep everything; a null id is the largest; rows that repeat an id remove nothing
from each other, and each is judged by its own text.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.llm.common import BROADCAST_BYTES, by_bucket, packed, parts_for, ready, unpacked
from ticketloom.llm.textbytes import Texts, hash_slices, pieces, prefix_hash, slice_hash
from ticketloom.session import stage

WIDTH = 50
GRAM = 24
#: Windows in a segment at most.
LONGEST = 64
#: Different segments of one hash that are compared in one collection.
CROWD = 50_000
#: Bytes of text whose entries make up one bucket; bytes of strings dealt to one task,
#: and in one collection of them (small enough for the processor's cache).
BUCKET, DEALT, COLLECTION = 16 << 20, 4 << 20, 96 << 10
#: Bytes of strings whose stretches are compared at once.
MET = 512 << 10
#: Parts in which the texts of one id are numbered.
SLOTS = 1024
#: Stretches around a gram of which two equal windows share one.
CUTS = 3
#: Entries a task holds back to drop repeats.
HELD = 600_000
NO_SYMBOL = 256
LAST_ID = (1 << 63) - 1


def segments(t: Texts, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start in the text, windows, smallest hash, hash of the bytes) of each segment."""
    gram = min(GRAM, width)
    span = width - gram + 1
    out = []
    step = 1 << 20
    for low in range(0, max(len(t.buf) - width + 1, 0), step):
        part = t.buf[low : low + step + width - 1]
        prefix = prefix_hash(part)
        n = len(part) - gram + 1
        starts = np.arange(n)
        best = slice_hash(prefix, starts, starts + gram)
        size = 1
        while size * 2 <= span:
            best = np.minimum(best[: len(best) - size], best[size:])
            size *= 2
        if size < span:
            best = np.minimum(best[: len(best) - (span - size)], best[span - size :])
        at = np.clip(t.bounds, low, low + len(best))
        owner = np.repeat(np.arange(t.n), at[1:] - at[:-1])
        inside = np.arange(low, low + len(best)) + width < t.bounds[owner + 1]
        new = np.ones(len(best), dtype=bool)
        new[1:] = (best[1:] != best[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])
        at = np.flatnonzero(new)
        long = np.diff(np.append(at, len(best)))
        at, long = at[inside[at]], long[inside[at]]
        pieces_n = -(-long // LONGEST)
        if len(at) and pieces_n.max() > 1:
            number = np.arange(pieces_n.sum()) - np.repeat(np.cumsum(pieces_n) - pieces_n, pieces_n)
            rest = np.repeat(long, pieces_n) - number * LONGEST
            at, long = np.repeat(at, pieces_n) + number * LONGEST, np.minimum(rest, LONGEST)
        if len(at):
            out.append((owner[at], at + low - t.bounds[owner[at]], long, best[at], slice_hash(prefix, at, at + long + width - 1)))
    if not out:
        return tuple(np.zeros(0, d) for d in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate([x[i] for x in out]) for i in range(5))


# one row for each document of a bucket: starts and windows of runs that go, and of segments to compare
FOUND = "id bigint, nth int, gone boolean, hash binary, start binary, windows binary, crowded binary, size bigint"


def found_rows(gone: bool, ids, nth, starts, windows, hashes=None, crowded=None) -> Iterator[pa.RecordBatch]:
    if not len(ids):
        return
    order = np.lexsort((starts, nth, ids))
    ids, nth, starts, windows = ids[order], nth[order], starts[order], windows[order]
    hashes = np.zeros(0, np.uint64) if hashes is None else hashes[order]
    crowded = np.zeros(0, np.uint8) if crowded is None else crowded[order]
    at = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (nth[1:] != nth[:-1])]))
    cuts = list(zip(at, np.append(at[1:], len(ids)), strict=True))
    binary = lambda x, d: pa.array([x[a:b].astype(d).tobytes() for a, b in cuts], pa.binary())
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids[at]), pa.array(nth[at].astype(np.int32)), pa.array(np.full(len(at), gone)), binary(hashes, np.uint64),
         binary(starts, np.int32), binary(windows, np.int32), binary(crowded, np.uint8),
         pa.array(np.add.reduceat(windows + WIDTH, at).astype(np.int64))],
        names=["id", "nth", "gone", "hash", "start", "windows", "crowded", "size"])


def _repeats(hashes: np.ndarray, content: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Mask of the entries whose segment also has an entry with a smaller id."""
    out = np.zeros(len(hashes), dtype=bool)
    order = np.argsort(content)
    c = content[order]
    same = np.concatenate([[False], c[1:] == c[:-1], [False]])
    order = order[same[1:] | same[:-1]] if len(c) else order  # most segments are there once
    order = order[np.lexsort((ids[order], content[order], hashes[order]))]
    h, c, i = hashes[order], content[order], ids[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    first = i[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else i
    out[order] = i > first
    return out


def compare(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows (id, nth, text) to FOUND: runs of windows that go, and segments to compare."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids, nth, starts, windows, hashes, content = (np.concatenate([x[k] for x in held]) for k in range(6))
            gone = _repeats(hashes, content, ids)
            # decided ones pass by documents, in buckets of their own
            bucket = np.where(gone, buckets + ids % buckets, (hashes % np.uint64(buckets)).astype(np.int64))
            yield from by_bucket(bucket, [hashes, content, ids, nth.astype(np.int32), starts.astype(np.int32), windows.astype(np.uint8)],
                                 ["hash", "content", "id", "nth", "start", "windows"])

        for batch, t in pieces(batches):
            ids, nth = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            owner, starts, windows, hashes, content = segments(t)
            held.append((ids[owner], nth[owner], starts, windows, hashes, content))
            size += len(owner)
            if size > HELD:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def decide(table: pa.Table) -> pa.Table:
        ids, nth = unpacked(table, "id", np.int64), unpacked(table, "nth", np.int32)
        starts, windows = unpacked(table, "start", np.int32), unpacked(table, "windows", np.uint8).astype(np.int64)
        if table.column("bucket")[0].as_py() >= buckets:
            return pa.Table.from_batches(found_rows(True, ids, nth, starts, windows), schema=_found_schema())
        hashes, content = unpacked(table, "hash", np.uint64), unpacked(table, "content", np.uint64)
        gone = _repeats(hashes, content, ids)
        batches = list(found_rows(True, ids[gone], nth[gone], starts[gone], windows[gone]))
        left = np.flatnonzero(~gone)
        order = left[np.lexsort((content[left], hashes[left]))]
        h, c, i = hashes[order], content[order], ids[order]
        if len(h):
            at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]).astype(np.int64))
            several = np.minimum.reduceat(i, at) < np.maximum.reduceat(i, at)
            kinds = np.add.reduceat(np.concatenate([[1], (h[1:] != h[:-1]) | (c[1:] != c[:-1])]).astype(np.int64), at)
            on = several[group]
            pick = order[on]
            batches += list(found_rows(False, ids[pick], nth[pick], starts[pick], windows[pick], hashes[pick], (kinds > CROWD)[group][on].astype(np.uint8)))
        return pa.Table.from_batches(batches, schema=_found_schema())

    schema = "bucket int, hash binary, content binary, id binary, nth binary, start binary, windows binary"
    return rows.mapInArrow(local, schema).groupBy("bucket").applyInArrow(decide, FOUND)


def _found_schema() -> pa.Schema:
    return pa.schema([("id", pa.int64()), ("nth", pa.int32()), ("gone", pa.bool_()), ("hash", pa.binary()), ("start", pa.binary()),
                      ("windows", pa.binary()), ("crowded", pa.binary()), ("size", pa.int64())])


class Columns:
    """A collection's columns in two files, each read and written whole, in order, once a
    round: the suffixes (string, length and the symbol before it, in one number), and
    the common prefixes. Files only grow, so they are written over in place."""

    FIELDS = {"string": (32, 0xFFFFFFFF), "length": (16, 0xFFFF), "bwt": (0, 0xFFFF)}

    def __init__(self, folder: str):
        self.files = {k: open(Path(folder) / k, "w+b", buffering=0) for k in ("suffix", "lcp")}  # noqa: SIM115
        self.n = 0

    def write(self, suffix: np.ndarray, lcp: np.ndarray) -> None:
        self.n = len(suffix)
        for name, values in (("suffix", suffix), ("lcp", lcp)):
            self.files[name].seek(0)
            self.files[name].write(values.data)

    def read(self, name: str) -> np.ndarray:
        if name in self.FIELDS:
            shift, mask = self.FIELDS[name]
            return ((self.read("suffix") >> np.uint64(shift)) & np.uint64(mask)).astype(np.int64)
        self.files[name].seek(0)
        return np.frombuffer(bytearray(self.files[name].read()), np.uint8 if name == "lcp" else np.uint64)[: self.n]

    def close(self) -> None:
        for f in self.files.values():
            f.close()


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low .. high] for each pair, by minima over powers of two."""
    out = np.empty(len(low), dtype=values.dtype)
    long = high - low + 1
    level = np.frexp(long.astype(np.float64))[1] - 1
    table = values
    for k in range(int(level.max()) + 1 if len(level) else 0):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[: len(table) - half], table[half:])
        on = level == k
        if on.any():
            out[on] = np.minimum(table[low[on]], table[high[on] - (1 << k) + 1])
    return out


def construct(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, folder: str, width: int = WIDTH) -> Columns:
    """Symbol before it, common prefix with the rank before (up to ``width``), string and
    length of every suffix of the strings ``buf[start : start + size]``, in their order."""
    columns, m = Columns(folder), len(starts)
    no_symbol, symbol_bits = np.uint64(NO_SYMBOL), np.uint64(0xFFFF)
    columns.write((np.arange(m, dtype=np.uint64) << np.uint64(32)) | no_symbol, np.zeros(m, np.uint8))
    rank = np.arange(m)
    for t in range(int(sizes.max()) if m else 0):
        active = np.flatnonzero(sizes > t)
        suffix, lcp = columns.read("suffix"), columns.read("lcp")
        suffix[rank[active]] ^= buf[starts[active] + sizes[active] - 1 - t].astype(np.uint64) ^ no_symbol
        symbol = (suffix & symbol_bits).astype(np.uint16)
        some = np.flatnonzero(symbol != NO_SYMBOL)
        symbol = symbol.astype(np.uint8)  # bytes sort in one pass
        order = some[np.argsort(symbol[some], kind="stable")]
        place = np.empty(len(suffix), dtype=np.int64)
        place[order] = np.arange(m, m + len(order))
        rank[active] = place[rank[active]]
        new = np.zeros(m + len(order), dtype=bool)
        new[rank[active]] = True
        old = np.flatnonzero(~new)
        wider, prefixes = np.empty(len(new), np.uint64), np.empty(len(new), np.uint8)
        wider[old], prefixes[old] = suffix, lcp
        wider[rank[active]] = (active.astype(np.uint64) << np.uint64(32)) | np.uint64((t + 1) << 16) | no_symbol
        # a new suffix and the one after it have new neighbours before them
        new[1:] |= new[:-1].copy()
        at = np.flatnonzero(new)
        j = at - m
        before = order[np.maximum(j - 1, 0)]
        alike = (j > 0) & (symbol[order[j]] == symbol[before])
        values = np.zeros(len(at), dtype=np.uint8)
        values[alike] = np.minimum(range_minima(lcp, before[alike] + 1, order[j[alike]]).astype(np.int64) + 1, width)
        prefixes[at] = values
        columns.write(wider, prefixes)
    return columns


def equal_windows(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of the windows that a string with a smaller id has too."""
    with tempfile.TemporaryDirectory() as folder:
        columns = construct(buf, starts, sizes, folder, width)
        lcp, string, length = columns.read("lcp"), columns.read("string"), columns.read("length")
        columns.close()
    at = np.flatnonzero(lcp < width)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    smallest = np.minimum.reduceat(ids[string], at)
    group = np.cumsum(lcp < width) - 1
    hit = np.flatnonzero((ids[string] > smallest[group]) & (length >= width))
    return string[hit], sizes[string[hit]] - length[hit]


def strings(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows (id, nth, text, hash, start, windows, crowded: lists of blobs) to packed strings."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in pieces(batches):
            code_of, owner, at, size = [], [], [], []
            for d in range(t.n):
                text = t.buf[t.bounds[d] : t.bounds[d + 1] - 1]
                hashes, start, windows, crowded = (
                    np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(c))[d].as_py()), k)
                    for c, k in (("hash", np.uint64), ("start", np.int32), ("windows", np.int32), ("crowded", np.uint8)))
                one = np.flatnonzero(crowded)
                many = windows[one]
                inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                alone = np.sort(np.repeat(start[one], many) + inner)
                code = hash_slices(text, alone, alone + WIDTH)
                plain = crowded == 0
                starts = np.concatenate([start[plain], alone])
                sizes = np.concatenate([windows[plain] + WIDTH - 1, np.full(len(alone), WIDTH)])
                code_of.append(np.concatenate([hashes[plain], code]))
                owner.append(np.full(len(starts), d))
                at.append(starts)
                size.append(sizes)
            code_of = np.concatenate(code_of)
            owner, at, size = (np.concatenate(x).astype(np.int64) for x in (owner, at, size))
            bucket = (code_of % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, code_of, owner, at, size = bucket[order], code_of[order], owner[order], at[order], size[order]
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
            ids, nth = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ends = np.append(cut[1:], len(bucket)) if len(bucket) else []
            blobs = []
            for a, b in zip(cut, ends, strict=True):
                begin = t.bounds[owner[a:b]] + at[a:b]
                blobs.append(b"".join(t.buf[x : x + n].tobytes() for x, n in zip(begin, size[a:b], strict=True)))
            pack = lambda x, k: pa.array([packed(x[a:b].astype(k)) for a, b in zip(cut, ends, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cut].astype(np.int32) if len(bucket) else [], pa.int32()), pack(code_of, np.uint64), pack(ids[owner], np.int64), pack(nth[owner], np.int32),
                 pack(at, np.int32), pack(size, np.uint8), pa.array(blobs, pa.binary())], names=["bucket", "hash", "id", "nth", "start", "size", "data"])

    return rows.mapInArrow(task, "bucket int, hash binary, id binary, nth binary, start binary, size binary, data binary")


def meeting(buf: np.ndarray, begin: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, ids: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Mask of the strings that may share a window with a string of another id.

    A window has the gram of its hash with ``width - gram`` bytes around it. However these
    are split between both sides, one of ``CUTS`` stretches lies inside, at its gram's place
    in both strings. Strings dealt window by window have no such gram and stay."""
    gram = min(GRAM, width)
    span = width - gram + 1
    first = np.cumsum(sizes) - sizes
    string = np.repeat(np.arange(len(sizes)), sizes)
    prefix = prefix_hash(buf[np.repeat(begin - first, sizes) + np.arange(len(string))])
    at = np.arange(max(len(string) - gram + 1, 0))
    at = at[at + gram <= (first + sizes)[string[at]]]
    at = at[slice_hash(prefix, at, at + gram) == hashes[string[at]]]
    out = np.ones(len(sizes), dtype=bool)
    out[string[at]] = False
    for k in range(CUTS):
        low, high = at - span * k // CUTS, at + gram + span - span * (k + 1) // CUTS
        owner = string[at]
        inside = (low >= first[owner]) & (high <= (first + sizes)[owner])
        key, owner = slice_hash(prefix, low[inside], high[inside]), owner[inside]
        order = np.argsort(key)
        key, owner = key[order], owner[order]
        if len(key):
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            several = np.minimum.reduceat(ids[owner], heads) < np.maximum.reduceat(ids[owner], heads)
            out[owner[np.repeat(several, np.diff(np.append(heads, len(key))))]] = True
    return out


def by_hash(hashes: np.ndarray, sizes: np.ndarray, limit: int) -> list[np.ndarray]:
    """The strings in lists of ``limit`` bytes and one hash more; one hash is in one list.
    Hashes go by their longest string, as a collection takes as many rounds as its longest."""
    order = np.argsort(hashes, kind="stable")
    if not len(order):
        return []
    heads = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
    longest = np.repeat(np.maximum.reduceat(sizes[order], heads), np.diff(np.append(heads, len(order))))
    order = order[np.lexsort((hashes[order], longest))]
    before = np.cumsum(sizes[order]) - sizes[order]
    heads = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
    parts = np.repeat(before[heads] // limit, np.diff(np.append(heads, len(order))))
    return np.split(order, np.flatnonzero(parts[1:] != parts[:-1]) + 1)


def collections_of(table: pa.Table) -> pa.Table:
    """The windows of the strings dealt to a task that go, as FOUND rows. Strings of one
    hash are in one collection; a collection has ``COLLECTION`` bytes and one hash more."""
    hashes, ids, nth = unpacked(table, "hash", np.uint64), unpacked(table, "id", np.int64), unpacked(table, "nth", np.int32)
    at, sizes = unpacked(table, "start", np.int32).astype(np.int64), unpacked(table, "size", np.uint8).astype(np.int64)
    buf = np.frombuffer(b"".join(table.column("data").to_pylist()), np.uint8)
    begin = np.cumsum(sizes) - sizes
    kept = [part[meeting(buf, begin[part], sizes[part], hashes[part], ids[part])] for part in by_hash(hashes, sizes, MET)]
    kept = np.concatenate([np.zeros(0, np.int64), *kept])
    string, offset = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for part in (kept[x] for x in by_hash(hashes[kept], sizes[kept], COLLECTION)):
        found, place = equal_windows(buf, begin[part], sizes[part], ids[part])
        string.append(part[found])
        offset.append(place)
    string, offset = np.concatenate(string), np.concatenate(offset)
    batches = found_rows(True, ids[string], nth[string], at[string] + offset, np.ones(len(string), np.int64))
    return pa.Table.from_batches(batches, schema=_found_schema())


def _checked(small: DataFrame, width: int) -> DataFrame:
    return F.broadcast(small) if small.count() * width <= BROADCAST_BYTES else small


def trim(docs: DataFrame, id_col: str = "doc_id", text: str = "text", dealt_bytes: int = DEALT) -> DataFrame:
    """One row for each row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256,
    and ``spans`` (start and end of each removed run, in bytes; ends are exclusive)."""
    ready(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("id"), F.col(id_col).alias("own_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    digest = [F.xxhash64("text").alias("d1"), F.xxhash64(F.lit("again"), "text").alias("d2"), F.octet_length("text").alias("bytes")]
    base = stage(rows.select("own_id", "id", *digest, F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "suffix-texts")
    firsts = base.groupBy("d1", "d2", "bytes").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = stage(firsts.drop("n"), "suffix-firsts")
    copies = stage(base.join(_checked(firsts, 28), ["d1", "d2", "bytes"]).where("id > first").select("id", "d1", "d2").distinct(), "suffix-copies")
    # several texts under one id are told apart by a number, dealt in slots as many rows may have no id
    again = base.groupBy("id").agg(F.count_distinct("d1", "d2").alias("n")).where("n > 1").select("id")
    again = stage(again, "suffix-again")
    numbers = base.select("id", "d1", "d2").distinct().join(_checked(again, 8), "id").withColumn("slot", F.pmod("d1", F.lit(SLOTS)).cast("int"))
    in_slot = F.row_number().over(W.partitionBy("id", "slot").orderBy("d1", "d2")) - 1
    numbers = stage(numbers.select("id", "d1", "d2", (in_slot * SLOTS + F.col("slot")).alias("nth")), "suffix-numbers")
    keyed = rows.select("id", "text", *digest[:2])
    left = keyed.join(_checked(copies, 24), ["id", "d1", "d2"], "left_anti").join(_checked(numbers, 24), ["id", "d1", "d2"], "left")
    left = left.select("id", F.coalesce("nth", F.lit(0)).alias("nth"), "text")
    total = base.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    found = stage(compare(left, parts_for(total, BUCKET)), "suffix-found")
    asked = found.where("NOT gone").groupBy("id", "nth").agg(*[F.collect_list(c).alias(c) for c in ("hash", "start", "windows", "crowded")], F.sum("size").alias("size"))
    asked = stage(asked, "suffix-asked")
    volume = asked.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    needy = left.join(_checked(asked.select("id"), 8), "id", "left_semi").dropDuplicates(["id", "nth"]).join(asked.drop("size"), ["id", "nth"])
    more = strings(needy.select("id", "nth", "text", "hash", "start", "windows", "crowded"), parts_for(volume, dealt_bytes))
    extra = stage(more.groupBy("bucket").applyInArrow(collections_of, FOUND), "suffix-extra")
    gone = found.where("gone").unionByName(extra).groupBy("id", "nth").agg(F.collect_list("start").alias("start"), F.collect_list("windows").alias("windows"))
    gone = stage(gone, "suffix-gone")
    hit = left.join(_checked(gone.select("id"), 8), "id", "left_semi").dropDuplicates(["id", "nth"]).join(gone, ["id", "nth"])
    cut = stage(hit.select("id", "nth", "text", "start", "windows").mapInArrow(cut_texts, CUT), "suffix-cut")
    out = base.join(_checked(numbers, 24), ["id", "d1", "d2"], "left").withColumn("nth", F.coalesce("nth", F.lit(0)))
    out = out.join(copies.withColumn("copy", F.lit(True)), ["id", "d1", "d2"], "left").join(cut, ["id", "nth"], "left")
    whole = F.col("copy").isNotNull() & (F.col("bytes") >= WIDTH)
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    return out.select(
        F.col("own_id").alias(id_col), F.col("bytes").cast("bigint").alias("n_bytes"),
        F.when(whole, F.col("bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce(F.size("spans"), F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(whole, F.array(F.struct(F.lit(0).alias("start"), F.col("bytes").alias("end")))).otherwise(F.coalesce("spans", nothing)).alias("spans"))


CUT = "id bigint, nth int, n_removed bigint, kept_sha256 string, spans array<struct<start:int,end:int>>"


def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed runs of each text, and the digest of what is left."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch, t in pieces(batches):
        removed, sha, spans = [], [], []
        for d in range(t.n):
            text = t.buf[t.bounds[d] : t.bounds[d + 1] - 1]
            start, windows = (np.frombuffer(b"".join(batch.column(k)[d].as_py()), np.int32) for k in (3, 4))
            change = np.zeros(len(text) + 1, dtype=np.int64)
            np.add.at(change, start, 1)
            np.add.at(change, start + windows + WIDTH - 1, -1)
            covered = np.cumsum(change)[:-1] > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
            removed.append(int(covered.sum()))
            sha.append(hashlib.sha256(text[~covered].tobytes()).hexdigest())
            spans.append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(spans, kind)],
                                         names=["id", "nth", "n_removed", "kept_sha256", "spans"])
