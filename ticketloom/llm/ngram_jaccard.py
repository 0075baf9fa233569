"""Exact Jaccard similarity join of word n-gram sets, by set-relation skipping.

Two sets link if 100 * |intersection| >= 75 * |union| (``PERCENT``). Equal sets
are one class, found by digest; only classes are compared.

1. Index. With shingles in one order for all, linked sets share one of the first
   n - ceil(0.75 n) + 1 of each (the prefix). Prefix entries are dealt by shingle
   into lists sorted by set size, then position. A list is read in blocks by
   size: a block too large for a set ends the set's walk. A pair none of whose
   shared places leaves enough shingles behind it is skipped. Lists of up to
   ``SHORT`` classes give pairs; how often a pair comes up counts its common
   prefix shingles exactly, and too small a count rules the pair out.
2. Rounds. The first order is by hash. Shingles with longer lists (a passage, a
   line, a family of near copies) are crowded, and classes with one in their prefix
   meet again, among themselves, in an order that puts crowded shingles last; so
   a passage drops out of the prefixes. Only prefixes are shipped, and in later
   rounds only those of the classes left. The order is told by a bit table of
   bounded size: a shingle that it wrongly takes for crowded only stands later.
3. Families. After ``ROUNDS`` rounds, a crowded list's smallest set leads it. A class
   is verified against the leader it shares most lists with, and what is linked to a
   leader is in one component without further comparison. Families that still fall into several components are
   compared in blocks (below), each family once however many lists it has.
4. Blocks. A family's classes are dealt by size class (linked sets are in the same or
   neighbouring ones) and by hash into blocks of at most ``BLOCK`` classes and
   ``BLOCK_BYTES``; two blocks meet in a task of their own. There a pair's answer is
   derived from both sets' counts with the task's smallest set where these decide it;
   sets with an open answer are intersected. A block gives a spanning forest of
   the links, not pairs.
5. Candidates are verified by intersecting the whole sets; linked classes give
   connected components, whose id is the smallest document id in them.
6. Numbers of links. The index verifies every link of a class that is in no family.
   Links within families lie within components, whose blocks count them as in
   step 4: the square of a component's classes that are in families in array
   work, and their number in rows.

A task drops what it knows to be crowded before the shuffle: a shingle that many
of its own classes share leaves a mark, not entries.

Defined cases: words are runs without ASCII white space, A-Z in lower case. A
text with fewer than ``SIZE`` words is one shingle, its whole sequence; null,
empty and blank texts have an empty set and link with nothing. Rows that repeat
an id count as documents of their own that share it. A null id stays null and
gives way to any other id. Shingles and classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ticketloom.llm.common import BROADCAST_BYTES, by_bucket, narrow, packed, parts_for, ready, text_bytes, unpack, unpacked, unstaged, whole_rows
from ticketloom.llm.components import components
from ticketloom.llm.textbytes import Texts, distinct_pairs, mix64, own_text, pieces, shingles, word_hashes
from ticketloom.session import stage

SIZE = 5
PERCENT = 75
SHORT = 16
#: Orders of shingles that are tried before lists count as families.
ROUNDS = 4
#: Bits that tell crowded shingles; the table goes to the driver and to every task.
BITS = 1 << 23
#: Bytes of text whose prefix entries make up one bucket.
BUCKET = 5 << 20
HELD = 300_000
#: Classes, and bytes of their sets, that make up a block; two blocks meet in a task.
BLOCK = 2048
BLOCK_BYTES = 24 << 20
#: From so many classes of a block on, a shingle is counted by a matrix product.
DENSE = 32
#: Rows of a table of pairs that are worked on at a time.
STRIP = 128
LAST_ID = (1 << 63) - 1


def sets(t: Texts, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of each text's set, the ascending shingles, and a number for each set."""
    words, hashes = word_hashes(t)
    owner, values = distinct_pairs(*shingles(words, hashes, t.n, size))
    bounds = np.searchsorted(owner, np.arange(t.n + 1))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(mix64(values), dtype=np.uint64, out=sums[1:])
    return bounds, values, mix64(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


def prefix_size(n, percent: int = PERCENT):
    return n - -(-n * percent // 100) + 1


def needed(n, m, percent: int = PERCENT):
    """Least intersection of linked sets of n and m shingles."""
    return -(-percent * (n + m) // (100 + percent))


def digests(rows: DataFrame) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in pieces(batches, limit=1 << 20):
            bounds, _, node = sets(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds).astype(np.int64)), pa.array(node)], names=["id", "n", "node"])

    return rows.select("id", "text").mapInArrow(task, "id bigint, n bigint, node bigint")


class Seen:
    """Classes that a task has already sent."""

    def __init__(self):
        self.known: set[int] = set()

    def fresh(self, node: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = np.zeros(len(node), dtype=bool)
        for i, value in enumerate(node.tolist()):
            if n[i] and value not in self.known:
                self.known.add(value)
                out[i] = True
        return out


def taken(bounds: np.ndarray, which: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the first ``most`` entries of the sets ``which``: (place, set, position)."""
    many = most[which]
    position = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(bounds[which], many) + position, np.repeat(which, many), position


def firsts(*keys: np.ndarray) -> np.ndarray:
    """Places where sorted keys change."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def crowd_bits(crowded: DataFrame) -> np.ndarray:
    """A table of ``BITS`` bits with one set for each hash (a column ``a``), of one size at any number of them."""
    place = F.pmod(F.col("a"), F.lit(BITS))
    words = crowded.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))).alias("bits"))
    found = words.toArrow()
    table = np.zeros(BITS // 64, np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def in_table(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the table has a bit for each hash."""
    place = np.mod(values.view(np.int64), BITS)
    return (table[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


def prefixes(t: Texts, table: np.ndarray | None, seen: Seen) -> tuple[np.ndarray, ...]:
    """(shingle, class, size, position) of the prefixes of classes that the task sees first:
    shingles by hash, those in the table last."""
    bounds, values, node = sets(t)
    n = np.diff(bounds)
    if table is not None and len(values):
        late = in_table(table, values)
        # values ascend within a set, and sorting by (set, late) keeps that
        values = values[np.argsort(np.repeat(np.arange(len(n)), n) * 2 + late, kind="stable")]
    which = np.flatnonzero(seen.fresh(node, n))
    place, owner, position = taken(bounds, which, prefix_size(n))
    return values[place], node[owner], n[owner], position


def short_lists(rows: DataFrame, buckets: int, table: np.ndarray | None = None) -> DataFrame:
    """One round: rows (a, b, n, m, room) for each shared prefix shingle of a pair of classes; rows
    with only a: classes with a crowded prefix shingle (n = 0) and crowded shingles (n = -1)."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = Seen(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, node, n, at = (np.concatenate([x[k] for x in held]) for k in range(4))
            values, place, counts = np.unique(h, return_inverse=True, return_counts=True)
            crowd = counts[place] > SHORT
            # a crowded shingle leaves one mark, and its classes pass by themselves
            marks = values[counts > SHORT]
            touched = np.unique(node[crowd])
            keep = ~crowd
            h, node, n, at = h[keep], node[keep], n[keep], at[keep]
            none = np.zeros(len(marks), np.int64)
            h = np.concatenate([h, marks, np.zeros(len(touched), np.uint64)])
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            bucket[len(bucket) - len(touched) :] = touched % buckets
            yield from by_bucket(bucket, [h, np.concatenate([node, none, touched]), np.concatenate([n, none - 1, np.full(len(touched), -2)]).astype(np.int32),
                                          np.concatenate([at, none, np.zeros(len(touched), np.int64)]).astype(np.int32)], ["h", "node", "n", "at"])

        for _, t in pieces(batches, limit=1 << 20):
            held.append(prefixes(t, table, seen))
            size += len(held[-1][0])
            if size > HELD:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def lists(table: pa.Table) -> pa.Table:
        h, node = unpacked(table, "h", np.uint64), unpacked(table, "node", np.int64)
        n, at = unpacked(table, "n", np.int32).astype(np.int64), unpacked(table, "at", np.int32).astype(np.int64)
        touched = [node[n == -2]]
        marks = np.unique(h[n == -1])
        on = n >= 0
        order = np.flatnonzero(on)[np.lexsort((node[on], at[on], n[on], h[on]))]
        h, node, n, at = h[order], node[order], n[order], at[order]
        new = firsts(h, node, n, at)  # other tasks may have sent the same class
        h, node, n, at = h[new], node[new], n[new], at[new]
        start = firsts(h)
        length = np.diff(np.append(start, len(h)))
        number = np.repeat(np.arange(len(start)), length)
        marked = marks[np.minimum(np.searchsorted(marks, h), len(marks) - 1)] == h if len(marks) else np.zeros(len(h), bool)
        crowd = (length[number] > SHORT) | marked if len(h) else marked
        touched.append(node[crowd])
        crowded = np.unique(np.concatenate([marks, h[crowd]])).view(np.int64)
        left, right = [], []
        rest = np.flatnonzero(~crowd)
        for step in range(1, SHORT):
            i = rest[rest + step < len(h)]
            j = i + step
            i, j = i[number[i] == number[j]], j[number[i] == number[j]]
            # sizes ascend in a list: once a block is too large, so are all after it
            fits = PERCENT * n[j] <= 100 * n[i]
            rest = i[fits]
            i, j = i[fits], j[fits]
            left.append(i)
            right.append(j)
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        # what the first shared shingle of a linked pair always leaves
        room = np.minimum(n[i] - at[i], n[j] - at[j]) >= needed(n[i], n[j])
        swap = node[i] > node[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        mine = np.unique(np.concatenate(touched))
        alone = np.zeros(len(mine) + len(crowded), np.int64)
        a, b = np.concatenate([node[i], mine, crowded]), np.concatenate([node[j], alone])
        none = np.arange(len(a)) >= len(i)
        kind = np.concatenate([alone[: len(mine)], alone[: len(crowded)] - 1])
        size_a, size_b = np.concatenate([n[i], kind]), np.concatenate([n[j], alone])
        room = np.concatenate([room, alone.astype(bool)])
        return pa.table({"a": a, "b": pa.array(b, mask=none), "n": size_a, "m": pa.array(size_b, mask=none), "room": room})

    entries = rows.select("text").mapInArrow(local, "bucket int, h binary, node binary, n binary, at binary")
    return entries.groupBy("bucket").applyInArrow(lists, "a bigint, b bigint, n bigint, m bigint, room boolean")


def family_entries(rows: DataFrame, table: np.ndarray | None, crowded: np.ndarray) -> DataFrame:
    """(h, node, n): places in lists that the last round found crowded."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for _, t in pieces(batches, limit=1 << 20):
            h, node, n, _ = prefixes(t, table, seen)
            on = in_table(crowded, h)
            yield pa.RecordBatch.from_arrays([pa.array(x[on]) for x in (h.view(np.int64), node, n.astype(np.int64))], names=["h", "node", "n"])

    return rows.select("text").mapInArrow(task, "h bigint, node bigint, n bigint").distinct()


class Verifier:
    """Verifies pairs of classes by whole sets, computed again from the texts of one
    document of each class; texts that no pair needs don't leave the scan."""

    def __init__(self, rows: DataFrame, homes: DataFrame):
        self.rows, self.homes = rows, homes

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link; staged."""
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        ids = stage(self.homes.join(nodes, "node").select("id").distinct(), "jaccard-ids")

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, t in pieces(batches, limit=1 << 20):
                bounds, values, node = sets(t)
                lists = pa.LargeListArray.from_arrays(bounds.astype(np.int64), pa.array(values.view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(node), lists], names=["node", "items"])

        found = self.rows.join(_checked(ids, 8), "id", "left_semi").select("text").mapInArrow(task, "node bigint, items array<bigint>")
        found = found.join(_checked(stage(nodes, "jaccard-nodes"), 8), "node", "left_semi").dropDuplicates(["node"])
        # a leader has as many pairs as members: its set goes to a salt for each ``BLOCK`` of them
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
        hot = ends.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("salts")).where("salts > 1")
        hot = _checked(stage(hot, "jaccard-hot"), 16)
        found = found.join(hot, "node", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1)) - 1)))
        both = pairs.select("a", "b")
        for end, other, items in (("a", "b", "x"), ("b", "a", "y")):
            salts = hot.select(F.col("node").alias(end), F.col("salts"))
            both = both.join(salts, end, "left").withColumn("salt", F.pmod(F.xxhash64(other), F.coalesce("salts", F.lit(1)))).drop("salts")
            both = both.join(found.select(F.col("node").alias(end), "salt", F.col("items").alias(items)), [end, "salt"]).drop("salt")
        both = both.select("a", "b", F.size("x").alias("n"), F.size("y").alias("m"), F.size(F.array_intersect("x", "y")).alias("common"))
        return stage(both.where(f"100 * common >= {PERCENT} * (n + m - common)").select("a", "b"), "jaccard-links")


def _checked(small: DataFrame, width: int) -> DataFrame:
    return F.broadcast(small) if small.count() * width <= BROADCAST_BYTES else small


def links(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``base`` (id, n, node for each row; staged), ``edges`` (a, b): verified links
    between classes that connect every pair of linked classes, and ``crowd`` (node):
    between two of these, not every link is an edge."""
    ready(docs.sparkSession)
    rows = narrow(docs, id=F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)), text=text)
    base = stage(digests(rows), "jaccard-base")
    buckets = parts_for(text_bytes(rows), BUCKET)
    # one document stands for its class
    homes = stage(base.where("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n")), "jaccard-homes")
    verifier = Verifier(rows, homes)

    members, table, parts = rows, None, []
    for number in range(ROUNDS):
        found = stage(short_lists(members, buckets, table), "jaccard-short")
        crowd = stage(found.where("b IS NULL AND n = 0").select(F.col("a").alias("node")).distinct(), "jaccard-crowd")
        parts.append(stage(candidates(found, crowd, last=number == ROUNDS - 1), "jaccard-pairs"))
        left = crowd.count()
        bits = crowd_bits(found.where("b IS NULL AND n = -1").select("a").distinct()) if left else None
        unstaged(found)
        if not left:
            break
        members = rows.join(_checked(stage(homes.join(crowd, "node").select("id").distinct(), "jaccard-members"), 8), "id", "left_semi")
        if number == ROUNDS - 1:
            entries = stage(family_entries(members, table, bits), "jaccard-entries")
            break
        table = bits if table is None else table | bits
        buckets = min(buckets, parts_for(left * 1000, BUCKET))
    pairs = parts[0]
    for more in parts[1:]:
        pairs = pairs.unionByName(more)
    pairs = pairs.select("a", "b")
    if not left:
        return base, verifier.linked(stage(pairs.distinct(), "jaccard-pairs")), crowd

    lists = entries.groupBy("h").agg(F.count(F.lit(1)).alias("long"), F.min(F.struct("n", "node")).alias("lead")).where("long > 1")
    lists = stage(lists.select("h", F.col("lead.node").alias("leader"), F.col("lead.n").alias("least")), "jaccard-lists")
    led = entries.join(_checked(lists, 24), "h").groupBy("leader", "node").agg(F.first("n").alias("n"), F.first("least").alias("least"), F.count(F.lit(1)).alias("c"))
    led = stage(led, "jaccard-led")
    stars = led.where(F.col("n") * PERCENT <= F.col("least") * 100).where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"), "c")
    # the leader that a class shares most lists with; what that leaves open, blocks decide
    best = stars.groupBy("b").agg(F.max(F.struct("c", "a")).alias("top")).select(F.col("top.a").alias("a"), "b")
    edges = verifier.linked(stage(pairs.unionByName(best).distinct(), "jaccard-pairs"))
    return base, stage(edges.unionByName(family_links(rows, homes, led, components(edges))), "jaccard-edges"), crowd


def candidates(found: DataFrame, crowd: DataFrame, last: bool) -> DataFrame:
    """Pairs of a round worth verifying. Those wholly in the crowd come up again in the next round."""
    pairs = found.where("b IS NOT NULL").groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first("m").alias("m"), F.max("room").alias("room"))
    # a pair that is not wholly in the crowd shares no crowded prefix shingle: c counts all it shares
    after = F.greatest(*[F.floor(F.col(k) * PERCENT / 100 + F.lit(0.999999)) - 1 for k in ("n", "m")])
    enough = F.col("c") + after >= F.ceil(PERCENT * (F.col("n") + F.col("m")) / (100 + PERCENT))
    inside = _checked(crowd, 8).withColumn("in", F.lit(True))
    pairs = pairs.join(inside.select(F.col("node").alias("a"), F.col("in").alias("ia")), "a", "left")
    pairs = pairs.join(inside.select(F.col("node").alias("b"), F.col("in").alias("ib")), "b", "left")
    whole = F.col("ia").isNotNull() & F.col("ib").isNotNull()
    kept = pairs.where((whole & F.lit(last)) | (~whole & F.col("room") & enough))
    return kept.select("a", "b")


def family_links(rows: DataFrame, homes: DataFrame, led: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges (a, b) that connect linked classes of families whose classes are in several components."""
    known = led.select("leader", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ones = known.groupBy("leader").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("leader")
    inside = known.join(_checked(stage(open_ones, "jaccard-open"), 8), "leader", "left_semi").select(F.col("leader").alias("family"), "node")

    def join(linked: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = forest(linked)
        return np.minimum(nodes[a], nodes[b]), np.maximum(nodes[a], nodes[b])

    return in_blocks(rows, homes, inside, join).select("a", "b").distinct()


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what a symmetric table of links connects, one less than there are members."""
    left, right = [], []
    new = np.ones(len(linked), bool)
    for root in range(len(linked)):
        if not new[root]:
            continue
        new[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            found = np.flatnonzero(linked[at] & new)
            new[found] = False
            left.append(np.full(len(found), at))
            right.append(found)
            queue.extend(found.tolist())
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def strips(k: int) -> list[slice]:
    """Rows of a ``k`` by ``k`` table in parts, so that only its answer is held whole."""
    return [slice(low, min(k, low + STRIP)) for low in range(0, k, STRIP)]


def common(owner: np.ndarray, items: np.ndarray, k: int) -> np.ndarray:
    """How many items each two of ``k`` sets share; the diagonal is left open."""
    order = np.lexsort((owner, items))
    owner, start = owner[order], firsts(items[order])
    length = np.diff(np.append(start, len(owner)))
    number = np.repeat(np.arange(len(start)), length)
    out = np.zeros((k, k), np.float32)
    many = np.flatnonzero(length >= DENSE)
    for low in range(0, len(many), 1024):
        part = many[low : low + 1024]
        column = np.full(len(start), -1)
        column[part] = np.arange(len(part))
        on = column[number] >= 0
        has = np.zeros((k, len(part)), np.float32)
        has[owner[on], column[number[on]]] = 1
        for rows in strips(k):
            out[rows] += has[rows] @ has.T
    rest = np.flatnonzero(length[number] < DENSE)
    for step in range(1, DENSE):
        rest = rest[rest + step < len(owner)]
        rest = rest[number[rest] == number[rest + step]]
        keys, counts = np.unique(owner[rest] * k + owner[rest + step], return_counts=True)
        out.ravel()[keys] += counts
        out.T[keys // k, keys % k] += counts
    return out


def answers(own: list[np.ndarray]) -> np.ndarray:
    """Which of the sets link: derived from their counts with the smallest set where these
    decide a pair, by intersection for sets that have an open pair."""
    n = np.array([len(x) for x in own], np.float64)
    lead = own[int(n.argmin())]
    c = np.array([np.isin(x, lead, assume_unique=True).sum() for x in own], np.float64)
    linked, undecided = np.zeros((len(own), len(own)), bool), np.zeros(len(own), bool)
    for rows in strips(len(own)):
        both = n[rows, None] + n[None, :]
        # the parts of two sets inside the leader overlap at least, and all parts at most, so much
        low = c[rows, None] + c[None, :] - len(lead)
        high = np.minimum(c[rows, None], c[None, :]) + np.minimum((n - c)[rows, None], (n - c)[None, :])
        linked[rows] = 100 * low >= PERCENT * (both - low)
        open_pairs = ~linked[rows] & (100 * high >= PERCENT * (both - high))
        open_pairs[np.arange(len(both)), np.arange(rows.start, rows.stop)] = False
        undecided[rows] = open_pairs.any(axis=1)
    at = np.flatnonzero(undecided)
    if len(at):
        part = [own[i] for i in at]
        met = common(np.repeat(np.arange(len(at)), [len(x) for x in part]), np.concatenate(part), len(at))
        for rows in strips(len(at)):
            here = met[rows].astype(np.float64)
            linked[np.ix_(at[rows], at)] = 100 * here >= PERCENT * (n[at[rows], None] + n[None, at] - here)
    np.fill_diagonal(linked, False)
    return linked


def in_blocks(rows: DataFrame, homes: DataFrame, inside: DataFrame, told: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(a, b) that ``told`` gives for (links, classes) of every two blocks of each family.

    ``inside`` holds (family, node). Links within a block are shown where it meets itself,
    where two blocks meet only links between them are.
    """
    grade = F.floor(F.log("n") / F.lit(float(np.log(100 / PERCENT)))).cast("bigint")
    placed = inside.join(homes, "node").withColumn("grade", grade)
    sizes = placed.groupBy("family", "grade").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("held"))
    whole = sizes.groupBy("family").agg(F.sum("k").alias("all_k"), F.sum("held").alias("all_held")).where("all_k > 1")
    few = (F.col("all_k") <= BLOCK) & (F.col("all_held") * 8 <= BLOCK_BYTES)
    # a small family is one block; else a size class has blocks of its own, numbered by size
    sizes = sizes.join(whole, "family").withColumn("one", few).withColumn("grade", F.when(few, F.lit(0)).otherwise(F.col("grade")))
    blocks = F.greatest(F.ceil(F.sum("k") / BLOCK), F.ceil(F.sum("held") * 8 / BLOCK_BYTES))
    graded = sizes.groupBy("family", "grade", "one").agg(F.when(F.first("one"), F.lit(1)).otherwise(blocks).alias("blocks"))
    ladder = W.partitionBy("family").orderBy("grade")
    graded = graded.withColumn("first", F.sum("blocks").over(ladder.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("blocks"))
    below = F.when(F.lag("grade").over(ladder) == F.col("grade") - 1, F.lag("first").over(ladder))
    above = F.when(F.lead("grade").over(ladder) == F.col("grade") + 1, F.lead("first").over(ladder) + F.lead("blocks").over(ladder))
    graded = graded.withColumn("low", F.coalesce(below, "first")).withColumn("high", F.coalesce(above, F.col("first") + F.col("blocks")))
    graded = stage(graded, "jaccard-grades")
    small = placed.join(whole.where(few).select("family"), "family", "left_semi").withColumn("grade", F.lit(0).cast("bigint"))
    large = placed.join(whole.where(~few).select("family"), "family", "left_semi")
    placed = small.unionByName(large).join(graded, ["family", "grade"])
    placed = stage(placed.withColumn("own", F.col("first") + F.pmod(F.xxhash64("node"), F.col("blocks"))).select("family", "node", "id", "n", "one", "own", "low", "high"), "jaccard-placed")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in pieces(batches, limit=1 << 20):
            bounds, values, node = sets(t)
            items = [packed(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node), pa.array(items, pa.binary())], names=["id", "node", "items"])

    texts_of = rows.join(_checked(placed.select("id").distinct(), 8), "id", "left_semi").select("id", "text")
    found = texts_of.mapInArrow(task, "id bigint, node bigint, items binary").dropDuplicates(["id", "node"]).join(_checked(placed, 64), ["id", "node"])
    # a block meets the blocks of its own and the neighbouring size classes, the smaller number first
    found = found.withColumn("other", F.explode(F.sequence(F.col("low"), F.col("high") - 1)))
    found = found.withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other"))
    # small families share tasks
    held = placed.where("one").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    deal = F.when(F.col("one"), F.pmod(F.xxhash64("family"), F.lit(parts_for(held * 8, BUCKET)))).otherwise(F.col("family"))
    found = found.withColumn("deal", deal).select("one", "deal", "left", "right", "own", "family", "node", "items")

    def meet(table: pa.Table) -> pa.Table:
        nodes, family, side = (table.column(k).to_numpy() for k in ("node", "family", "own"))
        two = table.column("left")[0].as_py() != table.column("right")[0].as_py()
        order = np.lexsort((nodes, family))
        order = order[firsts(family[order], nodes[order])]  # repeated rows send a class again
        start = firsts(family[order])
        items = table.column("items")
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for a, b in zip(start, np.append(start[1:], len(order)), strict=True):
            part = order[a:b]
            linked = answers([unpack(items[i].as_buffer(), np.uint64) for i in part.tolist()])
            if two:
                linked &= side[part][:, None] != side[part][None, :]
            out.append(told(linked, nodes[part]))
        return pa.table({k: np.concatenate([x[i] for x in out]) for i, k in enumerate("ab")})

    return found.groupBy("one", "deal", "left", "right").applyInArrow(meet, "a bigint, b bigint")


def degrees(docs: DataFrame, base: DataFrame, edges: DataFrame, crowd: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``node`` and ``n_links``, the number of classes it links with, for all that have links."""
    inside = labels.join(_checked(crowd, 8), "node").select(F.col("label").alias("family"), "node")
    homes = base.where("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    rows = narrow(docs, id=F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)), text=text)

    def count(linked: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nodes, linked.sum(axis=1)

    counted = in_blocks(rows, homes, inside, count).select(F.col("a").alias("node"), F.col("b").alias("n_links"))
    # every link with a class outside the crowd is an edge
    both = _checked(crowd, 8).withColumn("in", F.lit(True))
    outer = edges.join(both.select(F.col("node").alias("a"), F.col("in").alias("ia")), "a", "left")
    outer = outer.join(both.select(F.col("node").alias("b"), F.col("in").alias("ib")), "b", "left").where("ia IS NULL OR ib IS NULL")
    one = F.lit(1).cast("bigint").alias("n_links")
    ends = outer.select(F.col("a").alias("node"), one).unionByName(outer.select(F.col("b").alias("node"), one))
    return stage(ends.unionByName(counted).groupBy("node").agg(F.sum("n_links").alias("n_links")), "jaccard-degrees")


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id, class_id (the
    smallest id with an equal set), n_links (how many other classes its class links with)."""
    base, edges, crowd = links(docs, id_col, text)
    labels = components(edges)
    degree = degrees(docs, base, edges, crowd, labels, id_col, text)
    classes = base.where("n > 0").groupBy("node").agg(F.min("id").alias("class_id"))
    classes = classes.join(labels, "node", "left").join(degree, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = classes.groupBy("label").agg(F.min("class_id").alias("component_id"))
    # only classes with several documents or links need to be looked up
    placed = stage(classes.join(least, "label").select("node", "class_id", "component_id", "n_links"), "jaccard-classes")
    out = base.join(placed.withColumn("found", F.lit(True)), "node", "left")
    real = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    own = F.when((F.col("n") > 0) & F.col("found"), F.col("component_id")).otherwise(F.col("id"))
    return out.withColumn("component_id", own).withColumn("class_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id"))).select(
        real("id").alias(id_col), F.col("n").alias("n_shingles"), real("component_id").alias("component_id"), real("class_id").alias("class_id"),
        F.when(F.col("n") > 0, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_links"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of ``docs``, unchanged: that of the smallest (id, class), a
    null id last. Rows are told apart by id and class, so of an id's texts only the
    linked ones go. Rows without shingles link with nothing and all stay."""
    base, edges, _ = links(docs, id_col, text)
    rows = base.where("n > 0").groupBy("id", "node").agg(F.count(F.lit(1)).alias("rows"))
    rows = rows.join(components(edges), "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = rows.groupBy("label").agg(F.min(F.struct("id", "node")).alias("head"))
    rows = rows.join(heads, "label").withColumn("first", F.struct("id", "node") == F.col("head"))
    marks = stage(rows.where("NOT first OR rows > 1").select("id", "node", "first"), "jaccard-marks")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in pieces(own_text(batches, place), limit=1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets(t)[2])], names=["row", "node"])

    whole, place = whole_rows(docs, text)
    found = whole.mapInArrow(task, whole.select("row").schema.add("node", LongType()))
    found = found.withColumn("id", F.coalesce(F.col(f"row.{id_col}").cast("bigint"), F.lit(LAST_ID)))
    stays = found.join(_checked(marks.where("NOT first").select("id", "node"), 16), ["id", "node"], "left_anti")
    again = marks.where("first").select("id", "node")
    if again.isEmpty():
        return stays.select("row.*")
    again = _checked(again, 16)
    once = stays.join(again, ["id", "node"], "left_anti").select("row")
    repeated = stays.join(again, ["id", "node"], "left_semi").groupBy("id", "node").agg(F.first("row").alias("row")).select("row")
    return once.unionByName(repeated).select("row.*")
