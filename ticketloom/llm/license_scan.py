"""License scan: exact phrases, and a fuzzy search for short notices.

Both work on the text's words (letters, digits and bytes beyond ASCII, A-Z in
lower case) joined by single spaces, so line breaks and punctuation don't matter.

* Exact: every place where a phrase's words stand one after the other.
* Fuzzy: a notice may differ by up to k inserted, deleted or replaced
  characters. Cut into k + 1 pieces, at least one piece then stands unchanged
  (pigeonhole). The first eight bytes of each piece are the seeds; all places
  with a seed are found at once by hashing the eight bytes that start at every
  place. Around each, the ``regex`` module's bounded-error matching verifies the
  notice and gives span and errors. ``errors_for`` keeps pieces at eight bytes
  or more, so no match within the bound is missed.

Defined cases: null and empty texts have no words, places or labels and score 0;
the score is 1 with an exact phrase, else the best share of a notice's
characters that match, else 0. Each row of ``docs`` gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import narrow, ready
from ticketloom.llm.textbytes import WORD_ALNUM, Texts, Words, find_words, hash_slices, hash_word, lowered, pieces

SEED = 8

#: Phrases that count as base labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Short notices, in words, and their labels.
NOTICES = {
    "all rights reserved": "reserved",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache license version 2 0": "apache",
    "licensed under the gnu general public license": "gpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution": "cc",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "this is free and unencumbered software": "unlicense",
    "this work is dedicated to the public domain": "public-domain",
}


def errors_for(notice: str) -> int:
    """One error for ten characters, at most 3, with pieces of eight bytes or more."""
    return max(0, min(3, len(notice) // 10, len(notice.encode()) // SEED - 1))


def cut(notice: bytes, k: int) -> list[int]:
    """Starts of the k + 1 pieces."""
    return [len(notice) * i // (k + 1) for i in range(k + 1)]


def eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes that start at each place, as one number."""
    out = np.zeros(max(len(buf) - SEED + 1, 0), dtype=np.uint64)
    for i in range(SEED):
        out |= buf[i : i + len(out)].astype(np.uint64) << np.uint64(8 * i)
    return out


class Search:
    """Compiled notices and their seeds."""

    def __init__(self, notices: dict[str, str]):
        self.notices = [(n, label, errors_for(n)) for n, label in notices.items()]
        # words end in a space: without an error-free one on each side a match would start or end inside a
        # word. The module inserts nothing before the first character, so that is spelled out
        self.patterns = [
            [(more, regex.compile(rf"(?b)(?<![^ \n])[^ \n]{{{more}}}(?:{regex.escape(n)}){{e<={k - more}}}(?![^ \n])".encode())) for more in range(k + 1)]
            for n, _, k in self.notices
        ]
        seeds: dict[int, list[tuple[int, int]]] = {}
        for i, (n, _, k) in enumerate(self.notices):
            raw = n.encode()
            for at in cut(raw, k):
                value = int.from_bytes(raw[at : at + SEED], "little")
                seeds.setdefault(value, []).append((i, at))
        self.seeds = seeds
        self.values = np.array(sorted(seeds), dtype=np.uint64)
        self.screen = np.zeros(1 << 16, dtype=bool)
        self.screen[self._slot(self.values)] = True

    @staticmethod
    def _slot(x: np.ndarray) -> np.ndarray:
        return (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)

    def candidates(self, buf: np.ndarray) -> list[tuple[int, int]]:
        """(notice, place where it would start) for every seed found."""
        words = eights(buf)
        places = np.flatnonzero(self.screen[self._slot(words)])
        at = np.searchsorted(self.values, words[places])
        at[at == len(self.values)] = 0
        places = places[self.values[at] == words[places]]
        return sorted({(i, int(p) - offset) for p in places for i, offset in self.seeds[int(words[p])]})

    def matches(self, buf: np.ndarray, low: int, high: int, candidates: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, errors) inside [low, high), the best of those that overlap."""
        found = []
        done: dict[int, int] = {}
        for i, start in candidates:
            notice, _, k = self.notices[i]
            a, b = max(low, start - k), min(high, start + len(notice.encode()) + k)
            if a < done.get(i, -1):
                a = max(a, done[i])
            # one character more on each side tells whether a word goes on there
            first = max(low, a - 1)
            window = buf[first : min(high, b + 1)].tobytes()
            hits = [(sum(hit.fuzzy_counts) + more, hit.start(), hit.end()) for more, p in self.patterns[i] if b > a and (hit := p.search(window, a - first))]
            if hits:
                errors, begin, end = min(hits)
                found.append((i, first + begin, first + end, errors))
                done[i] = first + end
        return found


def joined(t: Texts, table: np.ndarray = WORD_ALNUM) -> tuple[Texts, Words]:
    """Texts of the words alone, lower-cased, one space between them (and one last)."""
    buf = lowered(t.buf)
    words = find_words(t, buf, table)
    keep = table[buf]
    keep[np.minimum(words.ends, len(buf) - 1)] = True
    keep[t.bounds[1:] - 1] = True
    out = np.where(table[buf], buf, np.uint8(32))
    out[t.bounds[1:] - 1] = 10
    at = np.concatenate([[0], np.cumsum(keep)])
    return Texts(out[keep], at[t.bounds]), Words(at[words.starts], at[words.ends], words.text)


def task_for(phrases: dict[str, str], notices: dict[str, str]):
    split = [(phrase.split(), label) for phrase, label in phrases.items()]
    codes = [(np.array([hash_word(w) for w in words], dtype=np.uint64), label) for words, label in split]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(notices)
        for batch, t in pieces(batches):
            plain, words = joined(t)
            hashes = hash_slices(plain.buf, words.starts, words.ends)
            counts = words.counts(t.n)
            first_word = np.concatenate([[0], np.cumsum(counts)])
            places, owners, said = [], [], [set() for _ in range(t.n)]
            for code, label in codes:
                n = max(len(hashes) - len(code) + 1, 0)
                hit = np.ones(n, dtype=bool)
                for k, value in enumerate(code):
                    hit &= hashes[k : k + n] == value
                if n:
                    hit &= words.text[:n] == words.text[len(code) - 1 :]
                at = np.flatnonzero(hit)
                for owner in set(words.text[at].tolist()):
                    said[owner].add(label)
                places.append(at)
                owners.append(words.text[at])
            at, owner = np.concatenate(places), np.concatenate(owners)
            local = at - first_word[owner]
            n_base = np.bincount(owner, minlength=t.n)
            low, high = np.full(t.n, np.iinfo(np.int64).max), np.full(t.n, -1)
            np.minimum.at(low, owner, local)
            np.maximum.at(high, owner, local)
            best = np.where(n_base > 0, 1.0, 0.0)
            spans: list[list[dict]] = [[] for _ in range(t.n)]
            labels = [set(x) for x in said]
            by_text: dict[int, list[tuple[int, int]]] = {}
            for i, start in search.candidates(plain.buf):
                middle = start + len(search.notices[i][0]) // 2
                text = int(np.searchsorted(plain.bounds, max(middle, 0), side="right")) - 1
                for d in {text, int(np.searchsorted(plain.bounds, max(start, 0), side="right")) - 1}:
                    if 0 <= d < t.n:
                        by_text.setdefault(d, []).append((i, start))
            for d, candidates in by_text.items():
                end = int(plain.bounds[d + 1]) - 1
                for i, a, b, errors in search.matches(plain.buf, int(plain.bounds[d]), end, sorted(candidates)):
                    notice, label, _ = search.notices[i]
                    labels[d].add(label)
                    best[d] = max(best[d], 1 - errors / len(notice))
                    start_word = int(np.searchsorted(words.ends, a, side="right") - first_word[d])
                    end_word = int(np.searchsorted(words.starts, b, side="left") - first_word[d])
                    spans[d].append({"label": label, "from_word": start_word, "to_word": end_word, "errors": errors})
            none = n_base == 0
            kind = pa.list_(pa.struct([("label", pa.string()), ("from_word", pa.int64()), ("to_word", pa.int64()), ("errors", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(counts.astype(np.int64)), pa.array(n_base.astype(np.int64)),
                    pa.array(low, mask=none), pa.array(high, mask=none),
                    pa.array([",".join(sorted(x)) for x in said], pa.string()), pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                    pa.array(best), pa.array(spans, kind),
                ],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    return task


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``. ``spans``: the notices found, as label,
    first word, word after the last, and errors. One scan, no shuffle."""
    ready(docs.sparkSession)
    schema = ("id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
              "score double, spans array<struct<label:string,from_word:bigint,to_word:bigint,errors:int>>")
    task = task_for(PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    return narrow(docs, id=id_col, text=text).mapInArrow(task, schema).withColumn("id", F.col("id")).withColumnRenamed("id", id_col)
