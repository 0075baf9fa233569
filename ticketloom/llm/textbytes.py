"""Words of whole texts as arrays: UTF-8 bytes in, positions and 64-bit hashes out.

A batch of texts becomes one byte buffer in which every text is followed by a
line feed, so no word crosses texts. Everything is computed on at most
``PIECE`` bytes at a time; a longer text is hashed in pieces cut between words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
#: Longer slices are hashed by a keyed digest: a polynomial modulo 2**64 has equal values
#: for different texts of some 1,000 bytes that anyone can write down, whatever its base.
PLAIN = 64
KEY = b"ticketloom slices"


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
WORD_PLAIN = ~SPACE
#: Digits, small letters and every byte beyond ASCII, after lower-casing.
WORD_ALNUM = np.zeros(256, dtype=bool)
WORD_ALNUM[48:58] = True
WORD_ALNUM[97:123] = True
WORD_ALNUM[128:] = True

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    size = max(PIECE + 64, 1 << int(max(n, 1)).bit_length())
    if size not in _POWERS:
        inverse = pow(BASE, -1, 1 << 64)
        up = np.full(size, BASE, dtype=np.uint64)
        down = np.full(size, inverse, dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return _POWERS[size]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Sums of byte codes times powers, modulo 2**64; one entry more than bytes."""
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODE[buf] * powers(len(buf))[0][: len(buf)], dtype=np.uint64, out=out[1:])
    return out


def slice_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes [start, end) that does not depend on where they stand."""
    down = powers(len(prefix))[1]
    lengths = (ends - starts).astype(np.uint64)
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + lengths * np.uint64(BASE))


@dataclass
class Texts:
    """Texts ``0 .. n-1`` in one buffer; text i is ``buf[bounds[i] : bounds[i + 1] - 1]``."""

    buf: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray

    def counts(self, n: int) -> np.ndarray:
        return np.bincount(self.text, minlength=n)


def _pack(raw: list[bytes]) -> Texts:
    lengths = np.fromiter((len(x) + 1 for x in raw), dtype=np.int64, count=len(raw))
    bounds = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum(lengths, out=bounds[1:])
    return Texts(np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8), bounds)


def texts(column: pa.Array) -> Texts:
    """Null counts as empty."""
    return _pack([x or b"" for x in column.cast(pa.large_binary()).to_pylist()])


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 2 * PIECE) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Batches cut so that their texts take ``limit`` bytes, or one text alone more."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        raw = [x or b"" for x in column.to_pylist()]
        at = 0
        while at < len(raw):
            to, total = at, 0
            while to < len(raw) and (to == at or total + len(raw[to]) <= limit):
                total += len(raw[to])
                to += 1
            yield batch.slice(at, to - at), _pack(raw[at:to])
            at = to


def own_text(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    """Batches of one struct column, with its field ``place`` beside it as ``text``: a row's text
    that goes along with the row need not be sent twice."""
    for batch in batches:
        row = batch.column(0)
        yield pa.RecordBatch.from_arrays([row, row.field(place)], names=[batch.schema.names[0], "text"])


def lowered(buf: np.ndarray) -> np.ndarray:
    return LOWER[buf]


def find_words(t: Texts, buf: np.ndarray, table: np.ndarray) -> Words:
    inside = table[buf]
    change = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    starts = np.flatnonzero(change == 1)
    ends = np.flatnonzero(change == -1)
    if len(ends) < len(starts):
        ends = np.append(ends, len(buf))
    return Words(starts, ends, np.searchsorted(t.bounds, starts, side="right") - 1)


def hash_slices(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ascending slices, a bounded part of the buffer at a time; long ones by digest."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + PIECE, side="right")))
        prefix = prefix_hash(buf[low : ends[to - 1]])
        out[at:to] = slice_hash(prefix, starts[at:to] - low, ends[at:to] - low)
        at = to
    for i in np.flatnonzero(ends - starts > PLAIN):
        digest = hashlib.blake2b(buf[starts[i] : ends[i]].tobytes(), digest_size=8, key=KEY).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def word_hashes(t: Texts, table: np.ndarray = WORD_PLAIN) -> tuple[Words, np.ndarray]:
    """Words of the lower-cased (A-Z) texts and a hash of each."""
    buf = lowered(t.buf)
    words = find_words(t, buf, table)
    return words, hash_slices(buf, words.starts, words.ends)


def hash_word(word: str) -> int:
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(hash_slices(raw, np.array([0]), np.array([len(raw)]))[0])


def shingles(words: Words, hashes: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``size`` words; shorter texts give one whole run."""
    counts = words.counts(n)
    total = len(hashes)
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    keys = []
    acc = np.zeros(max(total - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        acc = acc * np.uint64(BASE) + mix64(hashes[k : k + len(acc)] + np.uint64(k))
    full = words.text[: len(acc)] == words.text[size - 1 :] if len(acc) else np.zeros(0, bool)
    keys.append((words.text[: len(acc)][full], mix64(acc[full])))
    first = np.concatenate([[0], np.cumsum(counts)])
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        part = np.full(len(short), 0x5151, dtype=np.uint64)
        for k in range(size - 1):
            on = counts[short] > k
            part[on] = part[on] * np.uint64(BASE) + mix64(hashes[first[short[on]] + k] + np.uint64(k))
        keys.append((short, mix64(part + counts[short].astype(np.uint64))))
    return np.concatenate([a for a, _ in keys]), np.concatenate([b for _, b in keys])


def distinct_pairs(text: np.ndarray, hashes: np.ndarray, weights: bool = False):
    """Distinct (text, hash), ascending; with ``weights`` their numbers too."""
    # one sort by the text and 44 bits of the hash; where those tie for different hashes, by all bits
    key = (text.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20))
    order = np.argsort(key)
    key, ordered = key[order], hashes[order]
    if len(text) and (text.max() >> 20 or ((key[1:] == key[:-1]) & (ordered[1:] != ordered[:-1])).any()):
        order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    if not weights:
        return text[new], hashes[new]
    at = np.flatnonzero(new)
    return text[new], hashes[new], np.diff(np.append(at, len(text)))
