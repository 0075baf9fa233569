"""The text operators against brute force on small tables, and their defined cases."""

from __future__ import annotations

import collections
import hashlib
import re
import time
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticketloom.llm import (
    decontaminate, exact_dedup, language, license_scan, ngram_jaccard, poisson_mix, quality, suffix_dedup, suffix_tree, toxicity,
)
from ticketloom.llm.common import ARROW_BYTES, whole_rows
from ticketloom.llm.components import components
from ticketloom.llm.textbytes import hash_word, own_text, texts, word_hashes
from ticketloom.session import stage, staging_root

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FILLER = ["stone", "river", "cloud", "maple", "tiger", "amber", "quiet", "lemon", "ocean", "paper", "violet", "copper", "meadow", "walnut"]


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{FILLER[i]}{j}" for i, j in zip(rng.integers(0, len(FILLER), n), rng.integers(0, 90, n), strict=True))


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def corpus():
    """Long and short texts, copies, near copies, shared passages, ties, nulls, repeated rows."""
    base, passage = prose(1, 120), prose(2, 60)
    near = base.split()
    rows = [base, base.replace(" ", "  \n", 3), " ".join([*near[:50], "changed", *near[51:]]), None, "", " \t\n ", "one two three", "ONE two\tthree",
            "x", "é" * 60, "a" * 400, "a" * 90, prose(3, 40) + " " + passage, passage + " " + prose(4, 45), prose(5, 3000),
            "Released under the MIT License. " + prose(6, 30), "This is the apache license and the general public license. " + prose(7, 20),
            "Released under te MIT Licence " + prose(8, 20), passage, passage + " tail", base[:200], "日本語のテキスト " * 12]
    # a family of near copies that all share most shingles
    rows += [" ".join([*near[:k], f"swap{k}", *near[k + 1 :]]) for k in range(3, 115, 6)]
    rows += [prose(20 + k, 25) + " " + passage for k in range(12)]
    return [(i, t, "en" if i % 3 else "de", None if i % 7 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def awkward(spark, corpus):
    """The corpus with repeated rows, a null id, an id under two texts, and clashing column names."""
    rows = [*corpus, corpus[0], corpus[0], (None, "null id " + prose(9, 30), None, None, None), (5, "another text under five " + prose(10, 30), "en", "s1", 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "node", "key", "row", "digest", "score", "copies", "rate", "label", "bucket", "n"):
        frame = frame.withColumn(name, F.lit(name))
    return frame


def by_id(frame, *columns):
    return {r[0]: tuple(r[1:]) for r in frame.select("doc_id", *columns).collect()}


def test_words_and_hashes():
    t = texts(pa.array(["Ab  c\td", None, "", "É x"]))
    words, hashes = word_hashes(t)
    assert words.counts(t.n).tolist() == [3, 0, 0, 2]
    assert hashes[0] == hash_word("ab") and hashes[4] == hash_word("x")
    assert len(set(hashes.tolist())) == 5


def test_exact_dedup(docs, corpus):
    groups = collections.defaultdict(list)
    for i, text, *_ in corpus:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    expected = {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    assert by_id(exact_dedup.decide(docs), "keep_id", "group_size", "kept", "text_sha256") == expected
    assert {r.doc_id for r in exact_dedup.dedup(docs).collect()} == {min(g) for g in groups.values()}


def test_exact_dedup_exchanges_runs(docs):
    """Entries are combined once before the first exchange; then each round moves them by
    run number alone, sorts once and merges without an exchange of its own."""
    plan = exact_dedup.merged(stage(exact_dedup.digests(docs), "test-digests"))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange " in line]
    assert [("direct_shuffle_partition_id(run" in x, "hashpartitioning(run" in x) for x in exchanges] == [(True, False)] * 2 + [(False, True)]
    assert sum("Sort [run" in line for line in plan.splitlines()) == len(exchanges) + 1


def test_exact_dedup_of_repeated_rows(awkward):
    kept = exact_dedup.dedup(awkward)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    assert sum(r.doc_id == 0 for r in rows) == 1
    assert sum(r.doc_id is None for r in rows) == 1
    texts_kept = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in rows]
    assert len(texts_kept) == len(set(texts_kept))


def test_merge_has_no_long_runs(spark):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    row = exact_dedup.decide(hot).agg(F.min("keep_id"), F.max("keep_id"), F.min("group_size")).first()
    assert tuple(row) == (0, 0, 3000)


def brute_windows(corpus):
    raw = {i: (t or "").encode() for i, t, *_ in corpus}
    first = {}
    for i in sorted(raw):
        for k in range(len(raw[i]) - 49):
            first.setdefault(raw[i][k : k + 50], i)
    out = {}
    for i, text in raw.items():
        covered = np.zeros(len(text), bool)
        for k in range(len(text) - 49):
            if first[text[k : k + 50]] < i:
                covered[k : k + 50] = True
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
        out[i] = (len(text), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(docs, corpus):
    assert by_id(suffix_dedup.trim(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_windows(corpus)


def test_suffix_dedup_of_crowded_hashes(docs, corpus, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", 1)
    monkeypatch.setattr(suffix_dedup, "HELD", 5)
    monkeypatch.setattr(suffix_dedup, "COLLECTION", 300)
    assert by_id(suffix_dedup.trim(docs, dealt_bytes=2000), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_windows(corpus)


def test_suffix_dedup_strings_that_meet():
    """Leaving out strings that share no stretch with another id loses no window."""
    words = [f"{'abcdefgh'[i % 8]}{i * 7919 % 997}" for i in range(200)]
    plain = [" ".join(words[(d * 31 + i * i * (d % 5 + 1)) % 200] for i in range(300)).encode() for d in range(60)]
    shared = b"a passage of several words that some of the texts have in common, of odd length"
    plain = [x[: 10 * d] + shared[d % 30 :] + x[10 * d :] if d % 4 == 0 else x for d, x in enumerate(plain)]
    t = texts(pa.array(plain, pa.binary()))
    owner, start, windows, hashes, content = suffix_dedup.segments(t)
    left = np.flatnonzero(~suffix_dedup._repeats(hashes, content, owner))
    begin, sizes, ids, hashes = t.bounds[owner[left]] + start[left], windows[left] + suffix_dedup.WIDTH - 1, owner[left], hashes[left]

    def found(strings):
        out = set()
        for part in (strings[x] for x in suffix_dedup.by_hash(hashes[strings], sizes[strings], 50_000)):
            string, offset = suffix_dedup.equal_windows(t.buf, begin[part], sizes[part], ids[part])
            out |= set(zip(part[string].tolist(), offset.tolist(), strict=True))
        return out

    meeting = np.flatnonzero(suffix_dedup.meeting(t.buf, begin, sizes, hashes, ids))
    assert len(meeting) < len(left) / 2
    assert found(meeting) == found(np.arange(len(left))) != set()


def test_suffix_dedup_collections_of_like_strings():
    rng = np.random.default_rng(3)
    hashes = np.repeat(np.arange(400, dtype=np.uint64) * np.uint64(77777), 5)
    sizes = np.where(hashes % np.uint64(5) == 0, 113, 60) - rng.integers(0, 5, len(hashes))
    parts = suffix_dedup.by_hash(hashes, sizes, 2000)
    assert sorted(np.concatenate(parts).tolist()) == list(range(len(hashes)))
    assert sum(len(np.unique(hashes[p])) for p in parts) == 400
    # a collection takes as many rounds over its suffixes as its longest string has symbols
    assert sum(int(sizes[p].sum()) * int(sizes[p].max()) for p in parts) < 1.1 * sum(int(x) * (113 if x > 60 else 60) for x in sizes)


def test_suffix_dedup_repeats():
    rng = np.random.default_rng(4)
    hashes, content, ids = rng.integers(0, 40, 3000).astype(np.uint64), rng.integers(0, 900, 3000).astype(np.uint64), rng.integers(0, 50, 3000)
    least = collections.defaultdict(lambda: 99)
    for h, c, i in zip(hashes, content, ids, strict=True):
        least[h, c] = min(least[h, c], i)
    assert suffix_dedup._repeats(hashes, content, ids).tolist() == [i > least[h, c] for h, c, i in zip(hashes, content, ids, strict=True)]
    assert not len(suffix_dedup._repeats(hashes[:0], content[:0], ids[:0]))


def test_suffix_dedup_without_ids(spark):
    """Texts without an id are numbered in slots; each is judged by its own text."""
    shared = "these words stand in every one of the texts that have no identifier at all "
    rows = [(1, shared)] + [(None, f"{i} begins {shared} ends {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = suffix_dedup.trim(docs).where("doc_id IS NULL").collect()
    assert len(out) == 40 and all(r.n_removed == len(shared) and r.n_spans == 1 for r in out)
    kept = {hashlib.sha256(f"{i} begins  ends {i}".encode()).hexdigest() for i in range(40)}
    assert {r.kept_sha256 for r in out} == kept


def test_suffix_dedup_awkward(awkward):
    rows = suffix_dedup.trim(awkward).collect()
    assert len(rows) == awkward.count()
    five = sorted(r.n_removed for r in rows if r.doc_id == 5)
    assert five[0] == 0 and len(five) == 2
    assert {r.n_removed for r in rows if r.doc_id == 0} == {0}


@pytest.mark.parametrize("seed", range(4))
def test_column_wise_construction(seed, tmp_path):
    rng = np.random.default_rng(seed)
    strings = [bytes(rng.integers(97, 100, rng.integers(1, 30)).tolist()) for _ in range(12)]
    sizes = np.array([len(x) for x in strings])
    columns = suffix_dedup.construct(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(sizes) - sizes, sizes, str(tmp_path), width=6)
    string, length, lcp = columns.read("string"), columns.read("length"), columns.read("lcp")
    found = [strings[s][len(strings[s]) - n :] for s, n in zip(string, length, strict=True)]
    assert len(found) == sum(sizes) + len(strings)
    assert found == sorted(found)
    for k in range(1, len(found)):
        a, b = found[k - 1], found[k]
        common = next((j for j in range(min(len(a), len(b))) if a[j] != b[j]), min(len(a), len(b)))
        assert lcp[k] == min(common, 6)


def brute_components(corpus, percent=75):
    sets = {}
    for i, text, *_ in corpus:
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_ngram_jaccard(docs, corpus):
    assert by_id(ngram_jaccard.join(docs), "n_shingles", "component_id") == brute_components(corpus)


def test_ngram_jaccard_local_marks(docs, corpus, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "HELD", 1)
    monkeypatch.setattr(ngram_jaccard, "SHORT", 3)
    assert by_id(ngram_jaccard.join(docs), "n_shingles", "component_id") == brute_components(corpus)


def test_ngram_jaccard_awkward(awkward):
    rows = ngram_jaccard.join(awkward).collect()
    assert len(rows) == awkward.count()
    kept = ngram_jaccard.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} >= {0, 3, None}


def brute_links(corpus, percent=75):
    """For each id the number of other sets that its set links with."""
    sets = {}
    for i, text, *_ in corpus:
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    classes = {s for s in sets.values() if s}
    return {i: (sum(s != o and 100 * len(s & o) >= percent * len(s | o) for o in classes) if s else 0,) for i, s in sets.items()}


@pytest.mark.parametrize("block", [2048, 7])
def test_ngram_jaccard_counts_links(docs, corpus, monkeypatch, block):
    """A family of 21 different near copies, in one block and dealt over several."""
    monkeypatch.setattr(ngram_jaccard, "BLOCK", block)
    monkeypatch.setattr(ngram_jaccard, "DENSE", 9)
    expected = brute_links(corpus)
    assert max(expected.values()) > (8,) and by_id(ngram_jaccard.join(docs), "n_links") == expected


def test_ngram_jaccard_keeps_by_row(spark):
    """An id under a linked and a clean text, near copies and equal sets without an id, repeated rows."""
    near = lambda k: " ".join([*prose(60, 80).split()[:k], "changed", *prose(60, 80).split()[k + 1 :]])
    lone = prose(61, 50)
    rows = [(1, prose(60, 80)), (5, near(4)), (5, prose(62, 70)), (None, near(40)), (None, near(75)), (None, lone), (None, lone.upper()),
            (None, lone + " tail"), (8, prose(63, 40)), (8, prose(63, 40)), (9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("node", F.lit("x")).withColumn("first", F.lit(1)).repartition(3)
    kept = ngram_jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    found = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    lones = {k: n for k, n in found.items() if k[0] is None}
    assert len(lones) == 1 and set(lones.values()) == {1} and lowered(next(iter(lones))[1]).startswith(lone)
    assert found - collections.Counter(lones) == collections.Counter([(1, rows[0][1]), (5, rows[2][1]), (8, rows[8][1]), (9, None), (9, "")])


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (7, 3), (20, 20), *[(100, k) for k in range(101, 160)], *[(k, k + 1) for k in range(200, 230)]]
    labels = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert labels[7] == labels[1] == labels[3] == 1 and labels[11] == 10 and labels[150] == 100 and labels[230] == 200
    assert 20 not in labels


def test_components_leave_only_labels(spark, tmp_path):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)], "a long, b long")
    before = set(Path(staging_root(spark).removeprefix("file:")).rglob("*.parquet"))
    labels = components(edges)
    assert {(r.node, r.label) for r in labels.collect()} == {(i, 0) for i in range(41)}
    after = set(Path(staging_root(spark).removeprefix("file:")).rglob("*.parquet")) - before
    assert after and all("/labels-" in str(x) for x in after)


def test_stage_leaves_no_shuffle_files(spark):
    def shuffles():
        names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {x for x in names.split("\n") if "/shuffle_" in x}

    before = shuffles()
    rows = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "shuffled")
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert rows.count() == 7 and sum(r["count"] for r in rows.collect()) == 1000


def test_family_answers_are_bounded():
    rng = np.random.default_rng(5)
    base = np.sort(rng.integers(0, 1 << 62, 30).astype(np.uint64))
    own = [np.union1d(base[rng.random(30) > 0.25 * rng.random()], rng.integers(0, 1 << 62, 3).astype(np.uint64)) for _ in range(1200)]
    tracemalloc.start()
    linked = ngram_jaccard.answers(own)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6  # two tables of 1,200 * 1,200 doubles take 23 MB
    for i, j in rng.integers(0, 1200, (3000, 2)):
        met = len(np.intersect1d(own[i], own[j]))
        assert linked[i, j] == (i != j and 100 * met >= 75 * (len(own[i]) + len(own[j]) - met))


def test_license_scan(docs, corpus):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    rows = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    for i, text, *_ in corpus:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        places, labels = [], set()
        for phrase, label in phrases.items():
            q = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(q)] == q]
            places += at
            labels |= {label} if at else set()
        r = rows[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
    assert rows[17].base_labels == "" and rows[17].labels == "mit" and 0 < rows[17].score < 1
    assert rows[17].spans[0].errors > 0 and rows[17].spans[0].from_word == 0
    assert rows[3].labels == "" and rows[3].score == 0


def test_license_seeds_miss_nothing():
    """Every text within the error bound of a notice has an unchanged seed."""
    rng = np.random.default_rng(3)
    search = license_scan.Search(license_scan.NOTICES)
    for i, (notice, _, k) in enumerate(search.notices):
        for _ in range(20):
            text = list(notice)
            for _ in range(k):
                at, kind = int(rng.integers(1, len(text) - 1)), rng.integers(0, 3)
                text[at : at + (kind != 0)] = [] if kind == 1 else ["q"]
            buf = np.frombuffer(("aa " + "".join(text) + " zz").encode(), np.uint8)
            found = search.matches(buf, 0, len(buf), search.candidates(buf))
            assert any(m[0] == i for m in found), (notice, "".join(text))


def brute_base(corpus):
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lowered(t)), None] for i, t, *_ in corpus}
    counts = collections.Counter()
    for i, w in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    return {i: (len(w), sum(counts[x] > 0 for x in w), n, sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in w)) for i, w in tokens.items()}


def test_suffix_tree_symbols(monkeypatch):
    rows = [None, "", " ", "a", " \t\n", "A  b\x0b c ", "x", "\x1c\x00 y", " \u00e9 \u00dc\u2003z", "a b\n"]
    monkeypatch.setattr(suffix_tree, "find_words", None)  # seven passes need the symbols only
    symbols, bounds = suffix_tree.sentences(texts(pa.array(rows)))[:2]
    for row, a, b in zip(rows, bounds[:-1], bounds[1:], strict=True):
        assert symbols[a:b].tobytes() == b" ".join(re.findall(rb"[^\x20\x09-\x0d]+", lowered(row).encode())) + b"\n"


def test_suffix_tree_base(docs, corpus, monkeypatch):
    expected = brute_base(corpus)
    for heavy in (1e-6, 0.02):
        monkeypatch.setattr(suffix_tree, "HEAVY", heavy)
        found = by_id(suffix_tree.score(docs), "n_tokens", "n_known", "train_tokens", "base_score")
        for i, row in expected.items():
            assert found[i][:3] == row[:3]
            assert abs(found[i][3] - row[3]) < 1e-6


def test_suffix_tree_scores(spark, corpus):
    """The tree's counts and scores against a plain dictionary of contexts."""
    train = [lowered(t) for i, t, *_ in corpus if t and i < 20]
    rows = spark.createDataFrame([(t,) for t in train], "text string")
    tree, tokens = suffix_tree.grow(rows, depth=3, share=0.002, prior=4.0, test=10.0)
    symbols = [b"\n" + b" ".join(re.findall(rb"[^\x20\x09-\x0D]+", t.encode())) + b"\n" for t in train]
    counts = collections.defaultdict(collections.Counter)
    for s in symbols:
        for k in range(1, len(s)):
            for d in range(4):
                if k - d >= 0:
                    counts[s[k - d : k]][s[k]] += 1
    total = sum(counts[b""].values())
    assert tokens == sum(len(re.findall(rb"[^\x20\x09-\x0D]+", s)) + 1 for s in symbols)
    logs = {b"": {x: np.log10((counts[b""][x] + 1) / (total + 256)) for x in range(256)}}

    def state(context):
        while context not in logs:
            context = context[1:]
        return context

    for context in sorted((c for c in counts if c), key=len):
        n = sum(counts[context].values())
        if n < 0.002 * total or (context[1:] and sum(counts[context[1:]].values()) < 0.002 * total):
            continue
        shorter = logs[state(context[1:])]
        g = 2 * sum(c * (np.log(c / n) - shorter[x] * np.log(10)) for x, c in counts[context].items())
        if g > 10.0 + 2 * len(counts[context]):
            logs[context] = {x: np.log10((counts[context][x] + 4.0 * 10 ** shorter[x]) / (n + 4.0)) for x in range(256)}
    for text in (train[0], "unseen words ÿ here", ""):
        s = b"\n" + b" ".join(re.findall(rb"[^\x20\x09-\x0D]+", text.encode())) + b"\n"
        s = b"\n\n" if s == b"\n\n" else s
        expected = sum(logs[state(s[max(0, k - 3) : k])][s[k]] for k in range(1, len(s)))
        assert abs(tree.score(texts(pa.array([text])), 3)[0] - expected) < 1e-2
    assert len(tree.logs) == len(logs)


def test_suffix_tree_has_every_context(spark, corpus, monkeypatch):
    """Scores are those of all contexts up to seven symbols, however rare, whatever part of them every task holds."""
    rows = [*corpus, (100, "\x00\x00 a\x00 b", *corpus[0][2:]), (101, "\x00a \x7f\x7f", *corpus[0][2:])]
    said = {i: b"\n" + b" ".join(re.findall(rb"[^\x20\x09-\x0d]+", lowered(t).encode())) + b"\n" for i, t, *_ in rows}
    counts = collections.defaultdict(collections.Counter)
    for i, s in said.items():
        for k in range(1, len(s)) if zlib.crc32(str(i).encode()) % 7 != 2 else ():
            for d in range(min(k, 7) + 1):
                counts[s[k - d : k]][s[k]] += 1
    total = sum(counts[b""].values())
    logs = {b"": {x: np.log10((counts[b""][x] + 1) / (total + 256)) for x in range(256)}}

    def state(context):
        while context not in logs:
            context = context[1:]
        return context

    for context in sorted((c for c in counts if c), key=len):
        n, shorter = sum(counts[context].values()), logs[state(context[1:])]
        g = 2 * sum(c * (np.log(c / n) - shorter[x] * np.log(10)) for x, c in counts[context].items())
        if g > suffix_tree.TEST + 2 * len(counts[context]):
            logs[context] = {x: np.log10((counts[context][x] + suffix_tree.PRIOR * 10 ** shorter[x]) / (n + suffix_tree.PRIOR)) for x in range(256)}
    expected = {i: sum(logs[state(s[max(0, k - 7) : k])][s[k]] for k in range(1, len(s))) for i, s in said.items()}
    rare = sum(sum(counts[c].values()) < 0.002 * total for c in logs)
    assert rare > 100
    frame = spark.createDataFrame(rows, SCHEMA).repartition(2)
    for share, chunk, least in ((0.002, 1 << 25, 1 << 22), (1.0, 3000, 50), (0.0, 20000, 1 << 22)):
        monkeypatch.setattr(suffix_tree, "CHUNK", chunk)
        monkeypatch.setattr(suffix_tree, "SORTED", least)
        monkeypatch.setattr(suffix_tree, "ROW", max(10, least >> 12))
        found = by_id(suffix_tree.score(frame, share=share), "score")
        assert found.keys() == expected.keys()
        assert max(abs(found[i][0] - x) / max(1, abs(x)) for i, x in expected.items()) < 1e-4


def test_suffix_tree_probabilities_sum_to_one(spark, corpus):
    rows = spark.createDataFrame([(t,) for _, t, *_ in corpus[:10]], "text string")
    tree, _ = suffix_tree.grow(rows, depth=3, share=0.001)
    known = tree.logs.shape[1] - 1
    sums = (10.0 ** tree.logs[:, :known]).sum(axis=1) + (256 - known) * 10.0 ** tree.logs[:, known]
    assert np.allclose(sums, 1, atol=1e-4)


def test_poisson_mix(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("source"))
    weights = {"rare": 3.0, "common": 1.0}
    out = poisson_mix.replicate(docs, weights=weights, size=1.0, seed=3)
    counts = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(counts["rare"] - 4500) < 4 * 4500**0.5 and abs(counts["common"] - 1500) < 4 * 1500**0.5
    again = poisson_mix.replicate(docs.repartition(7), weights=weights, size=1.0, seed=3)
    rows = lambda d: sorted((r.doc_id, r.copy_no) for r in d.collect())
    assert rows(out) == rows(again)
    copies = [r["count"] for r in out.where("source = 'rare'").groupBy("doc_id").count().collect()]
    mean, variance = np.mean([*copies, *[0] * (600 - len(copies))]), np.var([*copies, *[0] * (600 - len(copies))])
    assert abs(mean - 7.5) < 0.6 and abs(variance - 7.5) < 2


def test_poisson_mix_large_rates_and_nulls(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (2, "b", "x"), (None, "c", "y")], "doc_id bigint, text string, source string")
    out = poisson_mix.replicate(docs, weights={None: 1.0, "x": 1.0}, size=300.0, seed=1)
    counts = {r.text: r["count"] for r in out.groupBy("text").count().collect()}
    assert 480 < counts["a"] < 720 and 420 < counts["b"] < 780 and "c" not in counts
    assert poisson_mix.replicate(docs.limit(0), size=2.0).count() == 0


def plain_overlaps(doc: list[str], item: list[str]) -> dict[tuple[int, int], int]:
    """Every alignment by plain loops: (first word, word after the last) of its most valuable stretch to its matches.
    An item shorter than a seed counts whole only."""
    least = min(decontaminate.LEAST, decontaminate.SHORT * len(item)) if len(item) >= decontaminate.SPAN else len(item)
    out = {}
    for shift in range(-len(item), len(doc)):
        pairs = [(i + shift, doc[i + shift] == w) for i, w in enumerate(item) if 0 <= i + shift < len(doc)]
        if sum(same for _, same in pairs) < least:
            continue
        best = None
        for high in range(1, len(pairs) + 1):
            value = 0.0
            for low in range(high - 1, -1, -1):
                value += 1.0 if pairs[low][1] else -decontaminate.COST
                if best is None or (value, -high, -low) > best[0]:
                    best = ((value, -high, -low), pairs[low][0], pairs[high - 1][0] + 1, sum(same for _, same in pairs[low:high]))
        if best[3] >= least:
            out[best[1], best[2]] = best[3]
    return out


@pytest.mark.parametrize("replaced", [0.0, 0.05, 0.1])
def test_decontaminate_against_all_alignments(replaced):
    """What the masks find is what plain loops find, and of these nothing is missed but worn stretches."""
    rng = np.random.default_rng(int(replaced * 100) + 1)
    items = [prose(1000 + i, n).split() for i, n in enumerate([4, 8, 9, 10, 12, 13, 20, 30, 30, 45])]
    docs = []
    for d in range(60):
        item = items[d % len(items)]
        worn = [f"other{k}" if rng.random() < replaced else w for k, w in enumerate(item)]
        docs.append([prose(2000 + d, d % 7 * 5).split() + worn[: len(worn) - d % 3] + prose(3000 + d, 25).split(), prose(4000 + d, 60).split()][d % 6 == 5])
    finder = decontaminate.Finder(decontaminate.Items.of(np.arange(len(items)), pa.array([" ".join(x) for x in items])))
    found = {(d, i, low, high): n for d, i, low, high, n in finder.overlaps(texts(pa.array([" ".join(x) for x in docs])))}
    expected = {(d, i, *k): n for d, x in enumerate(docs) for i, y in enumerate(items) for k, n in plain_overlaps(x, y).items()}
    assert found.items() <= expected.items()
    assert {k for k in expected if expected[k] == k[3] - k[2] >= min(len(items[k[1]]), decontaminate.LEAST)} <= set(found)
    assert len(found) >= 0.95 * len(expected) > 20


def test_decontaminate(spark, corpus):
    item = prose(50, 34).split()
    worn = [w if k % 8 else f"other{k}" for k, w in enumerate(item)]
    rows = [(0, prose(51, 60) + " " + " ".join(item) + " " + prose(52, 20)), (1, " ".join(worn) + " " + prose(53, 40)), (2, prose(54, 90)),
            (3, None), (4, ""), (5, " ".join(item[:8]) + " " + prose(55, 50)), (6, "alpha beta gamma delta epsilon"), (7, " ".join(item[10:26]).upper())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit(1)).withColumn("found", F.lit(2))
    bench = spark.createDataFrame([(10, " ".join(item)), (11, None), (12, ""), (13, "beta gamma delta"), (14, " ".join(item))], "item_id bigint, text string")
    found = by_id(decontaminate.report(docs, bench), "contaminated", "item_ids")
    assert {i for i, r in found.items() if r[0]} == {0, 1, 6, 7}
    assert found[0][1] == [10, 14] and found[6][1] == [13]
    blocks = by_id(decontaminate.report(docs, bench, limit=40), "contaminated", "item_ids")
    assert blocks == found
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, 3, 4, 5}
    assert decontaminate.keep_clean(docs, bench, limit=40).count() == 4
    assert decontaminate.report(docs, bench.limit(0)).where("contaminated").count() == 0


def test_whole_rows_send_their_text_once(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, Body string")
    whole, place = whole_rows(rows, "body")
    assert (whole.columns, place) == (["row"], 1)
    batch = pa.RecordBatch.from_arrays([whole.toArrow().column("row").combine_chunks()], names=["row"])
    (both,) = own_text([batch.slice(1)], place)
    assert both.schema.names == ["row", "text"] and both.column("text").to_pylist() == [None]
    bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    plan = decontaminate.keep_clean(rows, bench, text="Body")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow task(key" in plan and "AS text" not in plan
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b") == str(ARROW_BYTES)


def labelled(spark, n=900):
    bad = ["idiotword", "scumword", "trashword"]
    rows, marks = [], []
    for i in range(n):
        toxic = int(i % 5 == 1)
        words = prose(1000 + i, 30).split()
        words = [*words, bad[i % 3]] if toxic else words
        rows.append((i, " ".join(words), ["en", "de", "fr"][i % 3]))
        marks.append((i, 1 - toxic, toxic))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = labelled(spark)
    rows = toxicity.predict(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_learns_pairs():
    """A pair of terms is toxic, either alone is not: no additive weights can say that."""
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(3000):
        a, b = rng.integers(0, 2, 2)
        rows.append([*([1] if a else [2]), *([3] if b else [4])])
        y.append(int(a == b))
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    model = toxicity.fit(np.array(y), bounds, np.array([x for r in rows for x in r], dtype=np.uint64), evidence=0.0, epochs=60, rate=0.05, decay=0.0, seed=1)
    at = np.searchsorted(model.vocab, np.array([1, 3, 1, 4, 2, 3, 2, 4], dtype=np.uint64))
    score = toxicity.logistic(model.bias + toxicity.interactions(model.weight, model.factor, at, np.repeat(np.arange(4), 2), 4))
    assert (score >= 0.5).tolist() == [True, False, False, True]


def test_toxicity_learns_pairs_in_texts():
    """The same among filler words, with the defaults that ``train`` uses, on texts not learned from."""
    rng = np.random.default_rng(4)
    rows, y = [], []
    for i in range(2500):
        a, b = rng.integers(0, 2, 2)
        rows.append(f"{prose(5000 + i, 30)} {'alpha' if a else 'beta'} {'gamma' if b else 'delta'}")
        y.append(int(a == b))
    owner, hashes = toxicity.terms(texts(pa.array(rows[:2000])))
    model = toxicity.fit(np.array(y[:2000]), np.searchsorted(owner, np.arange(2001)), hashes)
    score = model.score(texts(pa.array(rows[2000:])))
    assert np.mean((score >= 0.5) == np.array(y[2000:])) > 0.95


def test_toxicity_without_labels(spark, awkward):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = toxicity.predict(awkward, none)
    assert rows.count() == awkward.count() and rows.where("score > 0.01 OR predicted = 1").count() == 0
    kept = toxicity.keep_clean(awkward, none)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def test_quality_grades(spark):
    docs, labels = labelled(spark)
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.concat(F.col("text"), F.lit(" %%% ### |||"))).otherwise(F.col("text")))
    ratings = labels.withColumn("grade", F.when(F.col("doc_id") % 7 == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2))
    model = quality.train(docs, ratings, F.col("grade"))
    assert len(model.cuts) == 2 and model.cuts[0] < model.cuts[1]
    rows = quality.grade(docs, model).join(ratings, "doc_id").where("held_out").collect()
    for r in rows:
        assert 0 <= r.tails[1] <= r.tails[0] <= 1 and abs(r.expected_grade - sum(r.tails)) < 1e-9
    means = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in (0, 1, 2)]
    assert means[0] < means[1] < means[2]
    assert np.mean([(r.tail_prob >= 0.5) == (r.grade >= 1) for r in rows]) > 0.95


def test_quality_without_ratings(spark, awkward):
    model = quality.train(awkward, spark.createDataFrame([], "doc_id bigint, grade int"), F.col("grade"))
    rows = quality.grade(awkward, model)
    assert rows.count() == awkward.count() and rows.where("expected_grade <> 0").count() == 0


def test_language(spark):
    samples = {"en": "the quick brown fox jumps over the lazy dog and then walks with them through that field",
               "de": "der schnelle braune fuchs springt über den faulen hund und geht dann durch das große feld",
               "fr": "le renard brun rapide saute par dessus le chien paresseux et traverse ensuite la forêt",
               "es": "el rápido zorro marrón salta sobre el perro perezoso y luego camina por aquella montaña"}
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(samples[k].split(), 12)), k) for i in range(400) for k in [list(samples)[i % 4]]]
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "123 !!", "en"), (1003, "the dog and the fox", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = language.predict(docs).join(docs, "doc_id").collect()
    held = [r for r in out if r.held_out and r.doc_id < 1000]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    found = {r.doc_id: r for r in out}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (1000, 1001, 1002))
    assert found[1003].lang_pred == "en"
    none = language.predict(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}


@pytest.mark.parametrize("k", [2, 3, 4, 5, 6, 12, 40])
def test_codewords_differ(k):
    code = language.codewords(k)
    assert len(np.unique(code, axis=0)) == k and (np.abs(code.sum(axis=0)) < k).all()


def test_one_wrong_bit_is_corrected():
    code = language.codewords(12)
    decoder = language.Decoder([str(i) for i in range(12)], code, np.ones_like(code) / code.shape[1], np.zeros(0), np.zeros(0))
    margins = code * 3.0
    margins[:, 4] *= -1
    assert (decoder.losses(margins).argmin(axis=1) == np.arange(12)).all()


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    for frame in (exact_dedup.decide(none), exact_dedup.dedup(none), suffix_dedup.trim(none), ngram_jaccard.join(none), license_scan.scan(none),
                  suffix_tree.score(none), toxicity.predict(none, labels), decontaminate.report(none, bench), language.predict(none),
                  poisson_mix.replicate(none), ngram_jaccard.keep_one(none), decontaminate.keep_clean(none, bench)):
        assert frame.count() == 0


def test_awkward_rows_elsewhere(spark, awkward):
    n = awkward.count()
    bench = spark.createDataFrame([(1, prose(1, 120))], "item_id bigint, text string")
    assert license_scan.scan(awkward).count() == n
    assert suffix_tree.score(awkward).count() == n
    assert language.predict(awkward).count() == n
    assert decontaminate.report(awkward, bench).count() == n
    mixed = poisson_mix.replicate(awkward, size=1.0)
    assert mixed.columns == [*awkward.columns, "copy_no"]


def thue_morse(n: int) -> tuple[str, str]:
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [1024, 2048])
def test_crafted_words_have_hashes_of_their_own(spark, size):
    """A word and its complement that polynomials modulo 2**64 take for one."""
    one, two = thue_morse(size)
    assert hash_word(one) != hash_word(two)
    found = word_hashes(texts(pa.array([f"{one} {two} {one}"])))[1]
    assert found[0] == found[2] != found[1] and found[0] == hash_word(one)
    docs = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id bigint, text string")
    assert by_id(ngram_jaccard.join(docs), "component_id") == {1: (1,), 2: (2,), 3: (1,)}


def test_language_of_a_text_does_not_depend_on_its_neighbours(docs):
    """One short text at every place of batches gets one score."""
    model = language.train(docs)
    rng = np.random.default_rng(8)
    found = set()
    for k in range(60):
        others = [prose(int(s), int(n)) for s, n in zip(rng.integers(0, 999, 9), rng.integers(0, 40, 9), strict=True)]
        place = k % 10
        names, best, close = model.decide(texts(pa.array([*others[:place], "la", *others[place:]])))
        found.add((names[place], float(best[place]), bool(close[place])))
    assert len(found) == 1


@pytest.mark.parametrize("text,errors", [
    ("football rights reserved", None), ("all rights reservedly so", None), ("all rights reserved", 0), ("xall rights reserved", 1),
    ("small rights reserved here", None), ("say all rihts reserved, ok", 1), ("all rights reservedx", 1), ("over all rights reserved", 0),
])
def test_license_notices_start_and_end_with_words(spark, text, errors):
    row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [s.errors for s in row.spans] == ([] if errors is None else [errors])
    assert row.labels == ("" if errors is None else "reserved")


def test_mix_with_a_column_of_its_own_name(docs, tmp_path):
    """The added column gives way, the result can be written, and partitions are even."""
    named = docs.withColumns({"copy_no": F.lit(7), "COPY_NO_": F.lit(8)})
    mixed = poisson_mix.replicate(named, size=40.0, rate_as="rate")
    assert mixed.columns == [*named.columns, "copy_no__", "rate"]
    mixed.write.parquet(str(tmp_path / "mixed"))
    back = mixed.sparkSession.read.parquet(str(tmp_path / "mixed"))
    assert back.count() == mixed.count() and {r.copy_no for r in back.select("copy_no").distinct().collect()} == {7}
    sizes = [r["count"] for r in mixed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
