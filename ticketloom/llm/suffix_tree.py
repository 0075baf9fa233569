"""Language-model scores from a probabilistic suffix tree.

A text is its words (A-Z in lower case), one space after each and an end symbol
after the last; symbols are bytes. The tree's nodes are all contexts of up to
``DEPTH`` preceding symbols in the training texts, however rare. A node is a state if a
divergence test finds its next-symbol distribution different from that of the next shorter
context's state (G statistic, twice count times the Kullback-Leibler divergence,
against a chi-square bound), or if it is the root. A state's distribution is
smoothed with ``PRIOR`` symbols' weight of its shorter state's; the root's with
one for each byte. A symbol is scored by the longest state that is a suffix of
what precedes it; contexts never cross texts.

A context and the symbol after it are one 64-bit entry, newest symbol first. Texts are
dealt into chunks; a chunk's distinct entries, sorted, with their numbers in its training
texts, are all that is counted from. Contexts that make up ``SHARE`` of the training symbols or
more, at most 1 / ``SHARE`` a depth, are the top of the tree: counted in one pass, sent to every
task. Below each of its leaves, and missing children, stands a subtree of rarer contexts. An entry whose
context ends there goes to a bucket by the hash of the subtree's first context, so a bucket holds
whole subtrees with all their counts, none of them hot. It grows and tests them, and sends each chunk
its entries' log probabilities in the order the chunk has them (1, which no logarithm is, where
the top of the tree decides). The top and these answers score the chunk's texts.

The unigram base needs each word's count for every text. Words that make up
``HEAVY`` of all tokens or more (at most 1 / HEAVY words) are looked up in the
scan. All others meet their counts in buckets by hash, as packed (word, text,
number) entries, one for each distinct word of a text; there is no hot word
among them.

Defined cases: null and empty texts are the end symbol alone (one token). A null
id counts as the empty text in the split. Rows that repeat an id and text give
equal rows; with an id repeated under other texts each row has its own values.
An empty training part leaves the uniform distribution and zero counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import by_bucket, checksum_mod, narrow, packed, parts_for, ready, text_bytes, unpack, unpacked, unstaged
from ticketloom.llm.textbytes import LOWER, SPACE, WORD_PLAIN, Texts, distinct_pairs, find_words, hash_slices, lowered, mix64, pieces
from ticketloom.session import shuffles_removed, stage

FOLDS, HELD = 7, 2
DEPTH = 7
SHARE = 1e-5
PRIOR = 4.0
TEST = 30.0
HEAVY = 1e-6
END = 10
END_WORD = np.uint64(0x0DDC0FFEE)
#: Bytes of text whose entries of rare words make up one bucket.
BUCKET = 12 << 20
#: Bytes of text whose distinct entries are counted, and answered, together.
CHUNK = 14 << 20
#: Bytes of text whose entries of rare contexts make up one bucket.
SUBTREES = 8 << 20
#: An entry holds so many symbols of context.
DEEPEST = 7
#: Entries in a row of the staged table, and about how many are sorted at a time.
ROW, SORTED = 1 << 10, 1 << 20


SYMBOL = np.where(SPACE, np.uint8(32), LOWER)


def sentences(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts, and where each text starts."""
    inside = WORD_PLAIN[t.buf]
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # the blank after a word; every text is followed by one
    counts = np.add.reduceat(keep, t.bounds[:-1], dtype=np.int64) if t.n else np.zeros(0, np.int64)
    none = counts == 0
    keep[t.bounds[1:][none] - 1] = True
    counts[none] = 1
    bounds = np.concatenate([[0], np.cumsum(counts)])
    out = SYMBOL[t.buf[keep]]
    out[bounds[1:] - 1] = END
    return out, bounds


#: Of a symbol ``o`` symbols after its text's start: what of its entry stands, and the end symbols that fill the rest.
_REST = [sum(255 << (56 - 8 * j) for j in range(o + 1, DEEPEST)) for o in range(DEEPEST + 1)]
STANDS = np.array([~r & (1 << 64) - 1 for r in _REST], dtype=np.uint64)
#: What of an entry is no part of its first ``d`` symbols.
FULL = np.array([(1 << 64 - 8 * d) - 1 for d in range(DEEPEST + 1)], dtype=np.uint64)
FILLS = np.array([r // 255 * END for r in _REST], dtype=np.uint64)


def grams(symbols: np.ndarray, bounds: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and their entries (context newest first, then the symbol), in parts whose
    entries ascend: by the two newest symbols of the contexts."""
    padded = np.concatenate([np.full(DEEPEST + 1, END, np.uint8), symbols])
    four = np.zeros(len(symbols) + 4, dtype=np.uint32)  # the four symbols before each, from four symbols before the first on
    blocks = [slice(low, min(low + (1 << 16), len(four))) for low in range(0, len(four), 1 << 16)]
    for block in blocks:
        for back in range(1, 5):
            four[block] <<= np.uint32(8)
            four[block] |= padded[block.start + 4 - back : block.stop + 4 - back]
    part_of = np.cumsum(np.bincount(four[::8] >> np.uint32(16), minlength=1 << 16)) * 8 // SORTED
    part_of = part_of.astype(np.uint8 if part_of[-1] < 256 else np.uint32)
    parts = np.empty(len(four), dtype=part_of.dtype)
    for block in blocks:
        parts[block] = part_of.take(four[block] >> np.uint32(16))
    # what stands before a text is no part of a context in it
    near = np.concatenate([np.stack([bounds[:-1] + o, np.full(len(bounds) - 1, o)])[:, bounds[:-1] + o < bounds[1:]] for o in range(DEEPEST - 1)], axis=1)
    near = near[:, np.argsort(near[0])]
    for part in np.unique(part_of):
        at = np.flatnonzero(parts[4:] == part)
        entry = four[4:].take(at).astype(np.uint64) << np.uint64(32)
        entry |= four.take(at) & np.uint32(0xFFFFFF00)
        entry |= symbols.take(at)
        own = near[:, parts[4:].take(near[0]) == part]
        place = np.searchsorted(at, own[0])
        entry[place] = (entry[place] & STANDS[own[1]]) | FILLS[own[1]]
        if depth < DEEPEST:
            entry = (entry & STANDS[depth - 1]) | FILLS[depth - 1]
        yield at, entry


def runs(ascending: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(ascending)), bool), ascending[1:] != ascending[:-1]]))


def alike(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal values stand together, and where runs of them start. Values are sorted by
    the top bits of a hash with their places in the bits below: where two hashes clash, a value has several runs."""
    low = np.uint64((1 << max(1, len(values) - 1).bit_length()) - 1)
    hashed = values * np.uint64(0x9E3779B97F4A7C15)
    hashed &= ~low
    hashed |= np.arange(len(values), dtype=np.uint64)
    hashed.sort()
    hashed &= low
    order = hashed.astype(np.int64)
    return order, runs(values.take(order))


def dealt(rows: DataFrame, size: int | None = None) -> DataFrame:
    """The rows, staged, with ``chunk``: each of about ``size`` bytes of text that one task read in a row."""
    each = size or CHUNK

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, read = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0).to_numpy(zero_copy_only=False)
            upto = read + np.cumsum(lengths.astype(np.int64) + 1)
            chunk = first + (upto - lengths - 1) // each
            read = int(upto[-1]) if len(upto) else read
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunk)], names=[*batch.schema.names, "chunk"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return stage(rows.mapInArrow(task, f"{schema}, chunk bigint"), "lm-chunks")


def entries(rows: DataFrame, depth: int, share: float) -> DataFrame:
    """Distinct entries of each chunk of ``(chunk, text, train)`` and their numbers in its training
    texts, packed, some in a row; ascending in a chunk. In rows whose ``depth`` is not 0, the contexts of
    so many symbols that make up ``share`` of the chunk's training symbols or more; all of one symbol. Staged."""

    def count(table: pa.Table) -> pa.Table:
        found, learned = [], []
        for batch, t in pieces(table.select(["text", "train"]).to_batches()):
            found.append(sentences(t))
            learned.append(np.repeat(np.array(batch.column(1).to_pylist(), dtype=bool), np.diff(found[-1][1])))
        symbols, bounds = joined(found)
        learned = np.concatenate(learned)
        out: list[tuple[int, bytes, bytes]] = []
        least, single = max(1.0, share * learned.sum()), np.zeros(256, dtype=np.int64)
        for at, entry in grams(symbols, bounds, depth):
            own = np.sort(entry[learned[at]])
            values = np.sort(entry)
            values = values[runs(values)]
            first = runs(own)
            numbers = np.zeros(len(values), dtype=np.int32)
            numbers[np.searchsorted(values, own[first])] = np.diff(np.append(first, len(own)))
            out += [(0, packed(values[k : k + ROW]), packed(numbers[k : k + ROW])) for k in range(0, len(values), ROW)]
            for d in range(depth, 0, -1) if len(values) else ():
                first = runs(values >> np.uint64(64 - 8 * d))
                values, numbers = values[first], np.add.reduceat(numbers, first, dtype=np.int64)
                if d == 1:
                    single += np.bincount((values >> np.uint64(56)).astype(np.int64), numbers, 256).astype(np.int64)
                    break
                # a context ends with its text's start
                on = np.flatnonzero((numbers >= least) & ((values >> np.uint64(72 - 8 * d)) & np.uint64(255) != END))
                if len(on):
                    out.append((d, packed(values[on] & ~FULL[d]), packed(numbers[on].astype(np.int32))))
        seen = np.flatnonzero(single)
        out.append((1, packed(seen.astype(np.uint64) << np.uint64(56)), packed(single[seen].astype(np.int32))))
        chunk, (depths, blobs, sums) = table.column("chunk")[0].as_py(), zip(*out, strict=True)
        return pa.table({"chunk": np.full(len(out), chunk), "depth": pa.array(depths, pa.int32()), "entry": pa.array(blobs, pa.binary()), "n": pa.array(sums, pa.binary())})

    counted = rows.select("chunk", "text", "train").groupBy("chunk").applyInArrow(count, "chunk bigint, depth int, entry binary, n binary")
    return stage(counted, "lm-entries")


def joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and bounds of several ``sentences`` as one."""
    shift = np.cumsum([0, *[len(symbols) for symbols, _ in found]])
    bounds = [bounds[:-1] + k for (_, bounds), k in zip(found, shift[:-1], strict=True)]
    return np.concatenate([symbols for symbols, _ in found]), np.concatenate([*bounds, shift[-1:]])


def learned_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Entries with a training number, a batch at a time."""
    for batch in batches:
        numbers = np.concatenate([unpack(x.as_buffer(), np.int32) for x in batch.column(1)]) if batch.num_rows else np.zeros(0, np.int32)
        entry = np.concatenate([unpack(x.as_buffer(), np.uint64) for x in batch.column(0)]) if batch.num_rows else np.zeros(0, np.uint64)
        yield entry[numbers > 0], numbers[numbers > 0]


def reported(counted: DataFrame, most: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Depth, context and number of what chunks report, the most frequent ``most`` if there are more."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, contexts, numbers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = unpack(contexts, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), d, np.int32)), pa.array(values), pa.array(unpack(numbers, np.int32).astype(np.int64))], names=["depth", "context", "n"])

    rows = counted.where("depth > 0").select("depth", "entry", "n").mapInArrow(task, "depth int, context bigint, n bigint")
    summed = rows.groupBy("depth", "context").agg(F.sum("n").alias("n"))
    with shuffles_removed(counted.sparkSession):
        table = (summed if most is None else summed.orderBy(F.desc("n"), "depth").limit(most)).toArrow()
    return table.column("depth").to_numpy(), table.column("context").to_numpy().view(np.uint64), table.column("n").to_numpy()


def _table(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and summed numbers, by key; bounded by nodes times symbols."""
    with shuffles_removed(counted.sparkSession):
        table = counted.groupBy("key").agg(F.sum("n").alias("n")).toArrow().sort_by("key")
    return table.column("key").to_numpy(), table.column("n").to_numpy()


@dataclass
class Tree:
    """``code`` numbers the bytes of the training texts; all others share the last number.
    ``child[node, code]`` is the node of the context one symbol longer (older); the last
    row of ``child`` stands for no node and leads to itself. ``state[node]`` is the node's
    row in ``logs``, log10 of the next byte's probability."""

    code: np.ndarray
    child: np.ndarray
    state: np.ndarray
    logs: np.ndarray

    def walk(self, codes: np.ndarray, depth: int) -> np.ndarray:
        """For each symbol the deepest node of what precedes it."""
        none, width, flat = len(self.child) - 1, self.child.shape[1], self.child.ravel()
        padded = np.concatenate([np.full(depth, self.code[END]), codes])
        node = np.zeros(len(codes), dtype=np.int32)
        best = node
        for d in range(1, depth + 1):
            node = flat.take(node * width + padded[depth - d : depth - d + len(codes)])
            best = np.where(node == none, best, node)
        return best

    def blocks(self, codes: np.ndarray, depth: int) -> Iterator[tuple[slice, np.ndarray]]:
        """``walk`` over parts of the symbols that fit the processor's cache."""
        for low in range(0, len(codes), 1 << 17):
            high = min(len(codes), low + (1 << 17))
            lead = min(low, depth)
            yield slice(low, high), self.walk(codes[low - lead : high], depth)[lead:]

    def top(self, entry: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The deepest node of each entry's context, and its depth; contexts that stand together are looked up once."""
        none, width, flat = len(self.child) - 1, self.child.shape[1], self.child.ravel()
        values, sizes = [entry], []
        for d in range(depth, 0, -1):
            first = runs(values[-1] >> np.uint64(64 - 8 * d))
            sizes.append(np.diff(np.append(first, len(values[-1]))))
            values.append(values[-1][first])
        node = best = np.zeros(len(values[-1]), dtype=np.int32)
        level = np.zeros(len(values[-1]), dtype=np.int8)
        for d in range(1, depth + 1):
            symbol = (values[-d] >> np.uint64(64 - 8 * d)) & np.uint64(255)
            node = flat.take(node * width + self.code.take(symbol.astype(np.uint8)))
            best, level = np.where(node == none, best, node), np.where(node == none, level, np.int8(d))
            node, best, level = (np.repeat(x, sizes[-d]) for x in (node, best, level))
        return best, level

    def logs_of(self, node: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return self.logs[self.state[node], self.code[entry & np.uint64(255)]]

    def score(self, t: Texts, depth: int = DEPTH) -> np.ndarray:
        """By this tree alone."""
        symbols, bounds = sentences(t)
        codes = self.code[symbols]
        width, flat = self.logs.shape[1], self.logs.ravel()
        out = np.zeros(len(codes) + 1)
        for part, node in self.blocks(codes, depth):
            out[part.start + 1 : part.stop + 1] = flat.take(self.state.take(node) * width + codes[part])
        np.cumsum(out, out=out)
        return out[bounds[1:]] - out[bounds[:-1]]


def trie(code: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """``child`` and parents of the nodes of contexts, given by depth and ascending, and the contexts
    that are nodes: those whose shorter ones are."""
    width = int(code.max()) + 1
    kept, parents, first = [np.zeros(1, np.uint64)], [np.array([-1])], [0, 1]
    for d, contexts in enumerate(levels, 1):
        shorter = contexts & ~FULL[d - 1]
        place = np.minimum(np.searchsorted(kept[-1], shorter), max(len(kept[-1]) - 1, 0))
        on = kept[-1][place] == shorter if len(kept[-1]) else np.zeros(len(contexts), bool)
        kept.append(contexts[on])
        parents.append(place[on] + first[-2])
        first.append(first[-1] + len(kept[-1]))
    made = first[-1]
    child = np.full((made + 1, width), made, dtype=np.int32)
    for d, contexts in enumerate(kept[1:], 1):
        older = code[((contexts >> np.uint64(64 - 8 * d)) & np.uint64(255)).astype(np.int64)]
        child[parents[d], older] = np.arange(first[d], first[d + 1])
    return child, np.concatenate(parents), kept


def node_counts(counted: DataFrame, code: np.ndarray, child: np.ndarray, parent: np.ndarray, depth: int) -> tuple[np.ndarray, int]:
    """How often each symbol follows each node's context, and the number of tokens."""
    sent = counted.sparkSession.sparkContext.broadcast((code, child))
    nodes, width = len(child) - 1, child.shape[1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(*sent.value, np.zeros(0), np.zeros(0))
        total = np.zeros(nodes * width, dtype=np.int64)
        tokens = 0
        for entry, numbers in learned_entries(batches):
            new, newest = entry & np.uint64(255), entry >> np.uint64(56)
            # a word ends in a blank or, the last one, in the text's end; a text of one symbol has no word
            tokens += int(numbers[new == 32].sum() + numbers[new == END].sum() + numbers[(new == END) & (newest != END)].sum())
            np.add.at(total, tree.top(entry, depth)[0].astype(np.int64) * width + tree.code[new], numbers)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], tokens))], names=["key", "n"])

    keys, numbers = _table(counted.where("depth = 0").select("entry", "n").mapInArrow(task, "key bigint, n bigint"))
    sent.destroy()
    tokens, on = int(numbers[keys < 0].sum()), keys >= 0
    counts = np.bincount(keys[on], numbers[on], nodes * width).reshape(nodes, width)
    for node in range(nodes - 1, 0, -1):  # longer contexts come last
        counts[parent[node]] += counts[node]
    return counts, tokens


def grow(rows: DataFrame, depth: int = DEPTH, share: float = SHARE, prior: float = PRIOR, test: float = TEST) -> tuple[Tree, int]:
    """The tree of the training rows' contexts of ``share`` of the symbols or more, and their number of tokens."""
    return top_of(entries(dealt(rows.select("text", F.lit(True).alias("train"))), depth, share), depth, share, prior, test)


def top_of(counted: DataFrame, depth: int, share: float, prior: float = PRIOR, test: float = TEST) -> tuple[Tree, int]:
    """``grow`` from counted entries. Rarer contexts than it holds are left to ``answers``.

    A context of ``share`` of all training symbols or more has that share in one chunk at least, which reports it.
    All that are reported are counted at once; only where chunks differ so much that they report more than
    2 / ``share`` in all are the rarest of them left to ``answers`` too.
    """
    depths, contexts, numbers = reported(counted, int(2 / share) + 256 if share else None)
    total = int(numbers[depths == 1].sum())
    present = np.unique(np.append(contexts[depths == 1] >> np.uint64(56), np.uint64(END))).astype(np.int64)
    code = np.full(256, len(present), dtype=np.int32)
    code[present] = np.arange(len(present))
    child, parent, levels = trie(code, [np.sort(contexts[depths == d]) for d in range(1, depth + 1)])
    counts, tokens = node_counts(counted, code, child, parent, depth)
    enough = counts.sum(axis=1) >= max(1.0, share * total)
    first = np.cumsum([0, *[len(x) for x in levels]])
    child, parent, kept = trie(code, [x[enough[a : a + len(x)]] for x, a in zip(levels[1:], first[1:], strict=False)])
    enough[0] = True
    return _states(code, child, parent, counts[enough], prior, test), tokens


def _states(code: np.ndarray, child: np.ndarray, parent: np.ndarray, counts: np.ndarray, prior: float, test: float) -> Tree:
    """Keeps the nodes whose distribution diverges from their shorter state's."""
    state = np.zeros(len(parent), dtype=np.int32)
    logs = [np.log10((counts[0] + 1) / (counts[0].sum() + 256))]
    for node, own in enumerate(counts[1:], 1):  # shorter contexts come first
        shorter, total, seen = state[parent[node]], own.sum(), own > 0
        g = 2 * float((own[seen] * (np.log(own[seen] / total) - logs[shorter][seen] * np.log(10))).sum()) if total else 0.0
        if g > test + 2 * seen.sum():
            state[node] = len(logs)
            logs.append(np.log10((own + prior * 10 ** logs[shorter]) / (total + prior)))
        else:
            state[node] = shorter
    return Tree(code, child, state, np.array(logs, dtype=np.float32))


def deepen(tree: Tree, entry: np.ndarray, numbers: np.ndarray, depth: int, prior: float, test: float) -> np.ndarray:
    """log10 probability of each entry's symbol by the longest state of its context, or 1 where that is
    one of ``tree``; ascending entries of whole subtrees below it, and their training numbers."""
    shift = lambda d: np.uint64(64 - 8 * d)
    node, level = tree.top(entry, depth)
    p = 10.0 ** tree.logs_of(node, entry).astype(np.float64)
    below = np.zeros(len(entry), dtype=bool)
    going = np.ones(len(entry), dtype=bool)  # the context has a symbol more
    new = entry & np.uint64(255)
    for d in range(1, depth + 1):
        on = np.flatnonzero(going & (level < d))
        going &= (entry >> shift(d)) & np.uint64(255) != END
        if not len(on):
            continue
        # equal context and symbol, then equal context
        pair = ((entry[on] >> shift(d)) << np.uint64(8)) | new[on]
        order = np.argsort(pair)
        on, pair = on[order], pair[order]
        first = runs(pair)
        shorter, own = p[on[first]], np.add.reduceat(numbers[on], first)
        group = runs(pair[first] >> np.uint64(8))
        size = np.diff(np.append(group, len(first)))
        total, seen = np.add.reduceat(own, group), np.add.reduceat(own > 0, group, dtype=np.int64)
        alike = own * np.log(np.maximum(own, 1) / (np.repeat(np.maximum(total, 1), size) * shorter))
        state = 2 * np.add.reduceat(alike, group) > test + 2 * seen
        whole = np.repeat(state, size)
        smooth = np.where(whole, (own + prior * shorter) / (np.repeat(total, size) + prior), shorter)
        each = np.diff(np.append(first, len(on)))
        p[on], below[on] = np.repeat(smooth, each), below[on] | np.repeat(whole, each)
    return np.where(below, np.log10(p), 1).astype(np.float32)


def subtrees(tree: Tree, entry: np.ndarray, depth: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each entry's node in the top of the tree, whether its context goes on below, and the bucket of the subtree there."""
    first = runs(entry >> np.uint64(8))
    sizes, entry = np.diff(np.append(first, len(entry))), entry[first]
    node, level = tree.top(entry, depth)
    deeper = np.minimum(level + 1, depth).astype(np.uint64) * np.uint64(8)
    root = entry >> (np.uint64(64) - deeper)
    last = np.where(level > 0, (entry >> (np.uint64(64) - np.maximum(level, 1).astype(np.uint64) * np.uint64(8))) & np.uint64(255), 0)
    whole = (level == depth) | ((level > 0) & (last == END))  # a context ends at its text's start
    bucket = mix64(root ^ (deeper << np.uint64(56))) % np.uint64(buckets)
    bucket = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64)  # 16 bits are sorted by radix
    return np.repeat(node, sizes), np.repeat(~whole, sizes), np.repeat(bucket, sizes)


def answers(counted: DataFrame, tree: Tree, depth: int, buckets: int, prior: float = PRIOR, test: float = TEST) -> DataFrame:
    """For each chunk and bucket the ``deepen`` of the chunk's entries in it, in their order, packed and compressed."""
    sent = counted.sparkSession.sparkContext.broadcast((tree.code, tree.child, tree.state, tree.logs))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, codec = Tree(*sent.value), pa.Codec("zstd", 1)

        def flush() -> Iterator[pa.RecordBatch]:
            entry, numbers = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            _, on, bucket = subtrees(tree, entry, depth, buckets)
            for b in by_bucket(bucket[on], [entry[on], numbers[on]], ["entry", "n"]):
                size = [len(x.as_buffer()) // 4 for x in b.column(2)]
                small = [pa.array([codec.compress(x.as_buffer(), asbytes=True) for x in c], pa.binary()) for c in b.columns[1:]]
                yield pa.RecordBatch.from_arrays([b.column(0), *small, pa.array(np.full(b.num_rows, chunk)), pa.array(size, pa.int64())],
                                                 names=["bucket", "entry", "n", "chunk", "size"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        chunk = None
        for batch in batches:
            for k, own in enumerate(batch.column(0).to_pylist()):
                if held and (own != chunk or len(held) * ROW >= SORTED):
                    yield from flush()
                    held = []
                chunk = own
                held.append((unpack(batch.column(1)[k].as_buffer(), np.uint64), unpack(batch.column(2)[k].as_buffer(), np.int32)))
        if held:
            yield from flush()

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        codec, sizes = pa.Codec("zstd"), table.column("size").to_pylist()
        entry = np.concatenate([unpack(codec.decompress(x.as_buffer(), 8 * k), np.uint64) for x, k in zip(table.column("entry"), sizes, strict=True)])
        numbers = np.concatenate([unpack(codec.decompress(x.as_buffer(), 4 * k), np.int32) for x, k in zip(table.column("n"), sizes, strict=True)])
        chunks, of = np.unique(table.column("chunk").to_numpy(), return_inverse=True)
        of = np.repeat(of, sizes)
        values, place = np.unique(entry, return_inverse=True)
        logs = deepen(Tree(*sent.value), values, np.bincount(place, numbers, len(values)), depth, prior, test)
        order = np.argsort(of * len(values) + place, kind="stable")
        logs, of = logs[place[order]], of[order]
        at = np.append(runs(of), len(of))
        blobs = [codec.compress(packed(logs[a:b]), asbytes=True) for a, b in zip(at[:-1], at[1:], strict=True)]
        return pa.table({"chunk": chunks, "bucket": pa.array(np.full(len(chunks), table.column("bucket")[0].as_py()), pa.int32()),
                         "logs": pa.array(blobs, pa.binary()), "size": np.diff(at)})

    spread_out = counted.where("depth = 0").select("chunk", "entry", "n").mapInArrow(spread, "bucket int, entry binary, n binary, chunk bigint, size bigint")
    return spread_out.groupBy("bucket").applyInArrow(answer, "chunk bigint, bucket int, logs binary, size bigint")


def symbol_logs(tree: Tree, found: tuple[np.ndarray, np.ndarray], answered: pa.Table, depth: int, buckets: int) -> np.ndarray:
    """The log10 probability of each text of a chunk, by the tree's top and the chunk's answers."""
    answered = answered.sort_by("bucket")
    codec, told = pa.Codec("zstd"), answered.column("size").to_numpy()
    logs = np.concatenate([np.zeros(0, np.float32), *[unpack(codec.decompress(x.as_buffer(), 4 * int(k)), np.float32) for x, k in zip(answered.column("logs"), told, strict=True)]])
    sizes = np.zeros(buckets, dtype=np.int64)
    sizes[answered.column("bucket").to_numpy()] = told
    start = np.cumsum(sizes) - sizes  # where a bucket's next answer stands
    symbols, bounds = found
    out = np.zeros(len(symbols), dtype=np.float32)
    for at, entry in grams(symbols, bounds, depth):
        order, first = alike(entry)
        # an entry may have several runs
        values, place = np.unique(entry[order[first]], return_inverse=True)
        node, rare, bucket = subtrees(tree, values, depth, buckets)
        own = tree.logs_of(node, values)
        rare = np.flatnonzero(rare)
        rare = rare[np.argsort(bucket[rare], kind="stable")]
        numbers = np.bincount(bucket[rare], minlength=buckets)
        told = logs[np.repeat(start - (np.cumsum(numbers) - numbers), numbers) + np.arange(len(rare))]
        start += numbers
        own[rare] = np.where(told > 0, own[rare], told)
        each = np.empty(len(at), dtype=np.float32)
        each[order] = np.repeat(own[place], np.diff(np.append(first, len(order))))
        out[at] = each
    return np.add.reduceat(out, bounds[:-1], dtype=np.float64)


def tokens_of(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, word, number) with the end as a word; ascending by text."""
    buf = lowered(t.buf)
    words = find_words(t, buf, WORD_PLAIN)
    hashes = hash_slices(buf, words.starts, words.ends)
    owner = np.concatenate([words.text, np.arange(t.n)])
    return distinct_pairs(owner, np.concatenate([hashes, np.full(t.n, END_WORD)]), weights=True)


def word_counts(rows: DataFrame, buckets: int, heavy_from: float) -> DataFrame:
    """A row for each bucket of words: its training tokens, distinct training words,
    and the packed (word, training count) of those with ``heavy_from`` tokens or more."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            words = np.concatenate([x[0] for x in held])
            values, place = np.unique(words, return_inverse=True)
            learned = np.bincount(place, np.concatenate([x[1] for x in held]), len(values)).astype(np.int64)
            every = np.bincount(place, np.concatenate([x[2] for x in held]), len(values)).astype(np.int64)
            yield from by_bucket((values % np.uint64(buckets)).astype(np.int64), [values, learned, every], ["word", "learned", "every"])

        for batch, t in pieces(batches):
            train = np.array(batch.column(1).to_pylist(), dtype=bool)
            owner, words, numbers = tokens_of(t)
            values, place = np.unique(words, return_inverse=True)
            held.append((values, np.bincount(place, numbers * train[owner]), np.bincount(place, numbers)))
            size += len(values)
            if size > 4_000_000:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def total(table: pa.Table) -> pa.Table:
        words, learned, every = (unpacked(table, "word", np.uint64), unpacked(table, "learned", np.int64), unpacked(table, "every", np.int64))
        values, place = np.unique(words, return_inverse=True)
        learned = np.bincount(place, learned, len(values)).astype(np.int64)
        every = np.bincount(place, every, len(values))
        top = every >= heavy_from
        return pa.table({"tokens": [int(learned.sum())], "vocab": [int((learned > 0).sum())],
                         "word": pa.array([packed(values[top])], pa.binary()), "learned": pa.array([packed(learned[top])], pa.binary())})

    entries = rows.select("text", "train").mapInArrow(local, "bucket int, word binary, learned binary, every binary")
    return entries.groupBy("bucket").applyInArrow(total, "tokens bigint, vocab bigint, word binary, learned binary")


def light_sums(rows: DataFrame, buckets: int, heavy: np.ndarray) -> DataFrame:
    """For each key: sums over its rows' words that are not heavy."""
    sent = rows.sparkSession.sparkContext.broadcast(heavy)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = sent.value
        for batch, t in pieces(batches, limit=4 << 20):
            keys = batch.column(1).to_numpy()
            train = np.array(batch.column(2).to_pylist(), dtype=bool)
            owner, words, numbers = tokens_of(t)
            at = np.minimum(np.searchsorted(heavy, words), max(len(heavy) - 1, 0))
            on = heavy[at] != words if len(heavy) else np.ones(len(words), bool)
            owner, words, numbers = owner[on], words[on], numbers[on]
            signed = np.where(train[owner], numbers, -numbers).astype(np.int32)
            yield from by_bucket((words % np.uint64(buckets)).astype(np.int64), [words, keys[owner], signed], ["word", "key", "n"])

    def total(table: pa.Table) -> pa.Table:
        words, keys, signed = unpacked(table, "word", np.uint64), unpacked(table, "key", np.int64), unpacked(table, "n", np.int32)
        values, place = np.unique(words, return_inverse=True)
        counts = np.bincount(place, np.maximum(signed, 0), len(values))[place]
        numbers = np.abs(signed)
        own, at = np.unique(keys, return_inverse=True)
        logs, known = np.bincount(at, numbers * np.log10(counts + 1), len(own)), np.bincount(at, numbers * (counts > 0), len(own))
        kind = pa.schema([("bucket", pa.int32()), *[(k, pa.binary()) for k in ("key", "logs", "known")]])
        return pa.Table.from_batches(list(by_bucket(own % buckets, [own, logs, known.astype(np.int64)], ["key", "logs", "known"])), schema=kind)

    def summed(table: pa.Table) -> pa.Table:
        own, at = np.unique(unpacked(table, "key", np.int64), return_inverse=True)
        logs, known = unpacked(table, "logs", np.float64), unpacked(table, "known", np.int64)
        return pa.table({"key": own, "light_logs": np.bincount(at, logs, len(own)), "light_known": np.bincount(at, known, len(own)).astype(np.int64)})

    entries = rows.select("text", "key", "train").mapInArrow(local, "bucket int, word binary, key binary, n binary")
    parts = entries.groupBy("bucket").applyInArrow(total, "bucket int, key binary, logs binary, known binary")
    return parts.groupBy("bucket").applyInArrow(summed, "key bigint, light_logs double, light_known bigint")


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", depth: int = DEPTH, share: float = SHARE) -> DataFrame:
    """One row for each row of ``docs``: id, held_out, n_tokens, n_known, train_tokens,
    base_score, score. Learns from rows whose id's crc32 mod 7 is not 2. ``depth`` is 7 at most;
    ``share`` divides the work, the result does not depend on it."""
    if not 0 < depth <= DEEPEST:
        raise ValueError(f"contexts have 1 to {DEEPEST} symbols")
    ready(docs.sparkSession)
    rows = narrow(docs, id=id_col, text=text)
    rows = dealt(rows.select("id", "text", (checksum_mod("id", FOLDS) != HELD).alias("train"), F.xxhash64("id", "text").alias("key")))
    size = text_bytes(rows)
    buckets, below = parts_for(size, BUCKET), parts_for(size, SUBTREES)
    counted = entries(rows, depth, share)
    tree, tokens = top_of(counted, depth, share)
    with shuffles_removed(docs.sparkSession):
        # a row for each bucket; heavy words are at most 1 / HEAVY
        words = word_counts(rows, buckets, max(2.0, HEAVY * max(tokens, 1))).toArrow()
    heavy = unpacked(words, "word", np.uint64)
    order = np.argsort(heavy)
    heavy, learned = heavy[order], unpacked(words, "learned", np.int64)[order]
    n, v = sum(words.column("tokens").to_pylist()), sum(words.column("vocab").to_pylist())
    # rows that repeat id and text share a key: their sums are divided by their number
    light = stage(light_sums(rows, buckets, heavy), "lm-light")
    sent = docs.sparkSession.sparkContext.broadcast((tree.code, tree.child, tree.state, tree.logs, heavy, learned))

    def task(chunk: pa.Table, answered: pa.Table) -> pa.Table:
        *parts, heavy, learned = sent.value
        found, sums = [], []
        for _, t in pieces(chunk.select(["text"]).to_batches()):
            owner, words, numbers = tokens_of(t)
            at = np.minimum(np.searchsorted(heavy, words), max(len(heavy) - 1, 0))
            on = heavy[at] == words if len(heavy) else np.zeros(len(words), bool)
            c = np.where(on, learned[at], 0) if len(heavy) else np.zeros(len(words))
            sums.append((np.bincount(owner, numbers, t.n).astype(np.int64), np.bincount(owner, numbers * np.log10(c + 1), t.n),
                         np.bincount(owner, numbers * (c > 0), t.n).astype(np.int64)))
            found.append(sentences(t))
        own = chunk.select(["id", "train", "key"])
        if not found:
            sums, scores = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))], np.zeros(0)
        else:
            scores = symbol_logs(Tree(*parts), joined(found), answered, depth, below)
        columns = [np.concatenate(x) for x in zip(*sums, strict=True)]
        return pa.Table.from_arrays([*own.columns, *map(pa.array, columns), pa.array(scores)], names=["id", "train", "key", "n_tokens", "logs", "known", "score"])

    told = stage(answers(counted, tree, depth, below), "lm-answers")
    unstaged(counted)
    scored = rows.select("chunk", "id", "train", "key", "text").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        task, "id bigint, train boolean, key bigint, n_tokens bigint, logs double, known bigint, score double")
    scored = stage(scored, "lm-scores")
    unstaged(rows)
    unstaged(told)
    sent.destroy()
    copies = scored.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    out = scored.join(light.join(copies, "key"), "key", "left")
    one = lambda c: F.coalesce(F.col(c) / F.col("copies"), F.lit(0.0))
    floor = float(np.log10(n + v + 1))
    return out.select(
        F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("known") + F.round(one("light_known")).cast("bigint")).alias("n_known"),
        F.lit(int(n)).cast("bigint").alias("train_tokens"),
        (F.col("logs") + one("light_logs") - F.col("n_tokens") * F.lit(floor)).alias("base_score"), "score")
