"""Benchmark decontamination by spaced-seed hashing.

A seed looks at some of ``SPAN`` consecutive tokens and ignores the others; the
fixed masks ignore different positions, so a passage with replaced tokens still
agrees under some mask. Hashes of all seeds of the test items are joined with
those at every position of every document. Around each hit the two texts are
compared token by token: the match grows to both sides as long as it keeps
gaining (a match counts 1, a replaced token costs ``COST``), and a document is
contaminated by an item if the grown overlap has enough matching tokens:
``LEAST`` of them, or four fifths of an item that is shorter.

The test items go to the tasks in blocks of at most ``BLOCK`` tokens each; a
larger benchmark takes more passes over the documents, not more memory.

Tokens are words of letters, digits and bytes beyond ASCII, in lower case (A-Z).
An item with fewer than ``SPAN`` tokens is one seed by itself: all its tokens.

Defined cases: null and empty texts or items overlap with nothing; repeated
items are reported by each of their ids; repeated documents each give a row;
an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ticketloom.llm.common import narrow, ready, whole_rows
from ticketloom.llm.textbytes import BASE, WORD_ALNUM, Texts, mix64, own_text, pieces, texts, word_hashes
from ticketloom.session import stage

SPAN = 10
#: Fixed masks: the tokens a seed looks at; each ignores three others.
MASKS = (
    (0, 1, 2, 3, 4, 5, 6),
    (3, 4, 5, 6, 7, 8, 9),
    (0, 1, 2, 4, 6, 7, 9),
    (0, 2, 3, 5, 6, 8, 9),
    (0, 1, 3, 4, 5, 7, 8),
)
COST = 2.0
LEAST = 13
SHORT = 0.8
BLOCK = 2_000_000


def masked(hashes: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """A hash for every start: the looked-at tokens of ``SPAN`` from there."""
    n = max(len(hashes) - max(mask), 0)
    out = np.full(n, number + 1, dtype=np.uint64)
    for k in mask:
        out = out * np.uint64(BASE) + hashes[k : k + n]
    return mix64(out)


@dataclass
class Items:
    """Tokens of a block of test items, and their seeds in ascending order."""

    ids: np.ndarray
    first: np.ndarray
    tokens: np.ndarray
    seed: np.ndarray
    place: np.ndarray
    sizes: list[int]

    @classmethod
    def of(cls, ids: np.ndarray, raw: pa.Array) -> Items:
        t = texts(raw)
        words, hashes = word_hashes(t, WORD_ALNUM)
        counts = words.counts(t.n)
        first = np.concatenate([[0], np.cumsum(counts)])
        seeds, places = [], []
        for number, mask in enumerate(MASKS):
            value = masked(hashes, mask, number)
            at = np.arange(len(value))
            inside = at + SPAN <= first[words.text[: len(value)] + 1]
            seeds.append(value[inside])
            places.append(at[inside])
        short = np.flatnonzero((counts > 0) & (counts < SPAN))
        sizes = sorted(set(counts[short].tolist()))
        for i in short:
            seeds.append(masked(hashes[first[i] : first[i + 1]], tuple(range(counts[i])), 100 + int(counts[i])))
            places.append(np.array([first[i]]))
        seed = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        place = np.concatenate(places) if places else np.zeros(0, np.int64)
        order = np.argsort(seed, kind="stable")
        return cls(ids, first, hashes, seed[order], place[order], sizes)


class Finder:
    def __init__(self, items: Items):
        self.items = items
        self.bits = 22
        self.screen = np.zeros(1 << self.bits, dtype=bool)
        self.screen[items.seed >> np.uint64(64 - self.bits)] = True

    def hits(self, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token of the documents, token of the items) that start equal seeds."""
        seed, place = self.items.seed, self.items.place
        out_doc, out_item = [], []
        looks = [(mask, number, SPAN) for number, mask in enumerate(MASKS)]
        looks += [(tuple(range(n)), 100 + n, n) for n in self.items.sizes]
        for mask, number, width in looks:
            value = masked(hashes, mask, number)
            at = np.flatnonzero(self.screen[value >> np.uint64(64 - self.bits)])
            at = at[at + width <= len(hashes)]
            at = at[owner[at] == owner[at + width - 1]]
            low = np.searchsorted(seed, value[at], side="left")
            high = np.searchsorted(seed, value[at], side="right")
            many = high - low
            out_doc.append(np.repeat(at, many))
            inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            out_item.append(place[np.repeat(low, many) + inner])
        return np.concatenate(out_doc), np.concatenate(out_item)

    def overlaps(self, t: Texts) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, word after the last, matching words) of verified overlaps."""
        words, hashes = word_hashes(t, WORD_ALNUM)
        first = np.concatenate([[0], np.cumsum(words.counts(t.n))])
        doc_at, item_at = self.hits(hashes, words.text)
        found = []
        if not len(doc_at):
            return found
        item = np.searchsorted(self.items.first, item_at, side="right") - 1
        # hits of one alignment are compared once
        key = np.unique(np.stack([words.text[doc_at], item, doc_at - item_at]), axis=1)
        for d, i, shift in key.T:
            a = max(int(self.items.first[i]), int(first[d] - shift))
            b = min(int(self.items.first[i + 1]), int(first[d + 1] - shift))
            same = self.items.tokens[a:b] == hashes[a + shift : b + shift]
            low, high, matching = grown(same)
            size = int(self.items.first[i + 1] - self.items.first[i])
            if matching >= min(LEAST, int(np.ceil(SHORT * size))) and matching >= 1:
                found.append((int(d), int(i), int(a + low + shift - first[d]), int(a + high + shift - first[d]), matching))
        return found


def grown(same: np.ndarray) -> tuple[int, int, int]:
    """The stretch with the highest value: first, after the last, and its matches."""
    value = np.where(same, 1.0, -COST)
    sums = np.concatenate([[0.0], np.cumsum(value)])
    gain = sums - np.minimum.accumulate(sums)
    high = int(np.argmax(gain))
    low = int(np.argmin(sums[: high + 1]))
    return low, high, int(same[low:high].sum())


def blocks(benchmark: DataFrame, id_col: str, text: str, limit: int = BLOCK) -> Iterator[Items]:
    """The items in blocks of at most ``limit`` tokens (at least one item each)."""
    rows = narrow(benchmark, id=id_col, text=text).where("text IS NOT NULL")
    rows = stage(rows, "decon-items")
    # a space-separated token takes two bytes at least
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-total // (2 * limit)))
    for part in range(parts):
        mine = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        table = mine.toArrow().sort_by([("id", "ascending")])
        yield Items.of(np.array(table.column("id").to_pylist(), dtype=object), table.column("text").combine_chunks())


def search(docs: DataFrame, items: Items, place: int | None = None) -> DataFrame:
    """Rows (key, text) to ``key`` and the overlaps found in each text; with ``place``
    the text is that field of the key."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((items.ids, items.first, items.tokens, items.seed, items.place, items.sizes))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("from_word", pa.int64()), ("to_word", pa.int64()), ("matching", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(Items(*sent.value))
        for batch, t in pieces(batches if place is None else own_text(batches, place)):
            lists: list[list[dict]] = [[] for _ in range(t.n)]
            for d, i, low, high, matching in finder.overlaps(t):
                lists[d].append({"item_id": finder.items.ids[i], "from_word": low, "to_word": high, "matching": matching})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, kind)], names=["key", "found"])

    overlap = StructType([StructField(k, LongType()) for k in ("item_id", "from_word", "to_word", "matching")])
    schema = docs.select("key").schema.add("found", ArrayType(overlap))
    return docs.mapInArrow(task, schema)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", limit: int = BLOCK) -> DataFrame:
    """One row for each row of ``docs``: id, contaminated, item_ids (distinct,
    ascending), matching (most matching words of an overlap), overlaps."""
    ready(docs.sparkSession)
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("n")).alias("key"), F.col(text).alias("text"))
    several = list(blocks(benchmark, item_id, item_text, limit))
    if len(several) == 1:
        found = search(rows, several[0])
    else:
        rows = stage(rows.select("key", "text"), "decon-rows") if several else rows
        passes = [search(rows, items) for items in several]
        union = passes[0]
        for one in passes[1:]:
            union = union.unionByName(one)
        found = union.groupBy("key").agg(F.flatten(F.collect_list("found")).alias("found"))
    return found.select(
        F.col("key.id").alias(id_col),
        (F.size("found") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct("found.item_id")).alias("item_ids"),
        F.coalesce(F.array_max("found.matching"), F.lit(0)).cast("bigint").alias("matching"),
        F.array_sort("found").alias("overlaps"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", limit: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that overlap with no test item, unchanged."""
    ready(docs.sparkSession)
    rest = docs
    several = list(blocks(benchmark, item_id, item_text, limit))
    for items in several:
        if len(several) > 1:
            rest = stage(rest, "decon-rest")
        rows, place = whole_rows(rest, text, "key")
        rest = search(rows, items, place).where("size(found) = 0").select("key.*")
    return rest
