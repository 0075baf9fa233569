"""Operators against brute force and stated properties on small fixtures."""

import json
import math
import random
import re
import statistics
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.views import all_tickets, document_tickets
from ticketloom import fixed
from ticketloom.functions import joins
from ticketloom.functions.fields import typed_fields
from ticketloom.functions.rules import expected_priority, instant
from ticketloom.functions.text import code_point_sum, key_hash, strip
from ticketloom.operators import dedupe, enrich, fixes, lengths, profile, quality, repair, synth, validate
from ticketloom.sources.taxonomy import built_in_remap, built_in_taxonomy, load_taxonomy


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def shuffle_only(spark, monkeypatch):
    """No broadcasts at all: every lookup goes the way of one that is too large."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- expressions -------------------------------------------------------------


@pytest.mark.parametrize("i,u,p", [(5, 5, 5), (1, 5, 3), (2, 2, 2), (4, 5, 5), (1, 2, 2), (1, 1, 1), (0, 0, 1), (0, 1, 1), (9, 9, 5), (-3, 0, 1)])
def test_priority(spark, i, u, p):
    assert spark.range(1).select(expected_priority(F.lit(i), F.lit(u))).first()[0] == p


def test_code_point_sum(spark):
    texts = ["TCKT-001", "", None, "تست 1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(code_point_sum(F.col("t"))).collect()]
    assert got == [sum(map(ord, t or "")) for t in texts]
    assert got[0] == 500


def test_strip_is_unicode_wide(spark):
    space = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())
    df = spark.createDataFrame([(space + "a b" + space,), (space,), ("x",)], "t string")
    assert [r[0] for r in df.select(strip(F.col("t"))).collect()] == ["a b", "", "x"]


def test_strip_at_every_edge(spark):
    """All white space and look-alikes by their bytes, at either end and alone."""
    letters = [" ", "\t", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000",
               "a", ".", "\x7f", "é", "ß", "Å", "à", "ت", "۝", "\u07ff", "\u0800", "\u200b", "\u20ac", "漢", "\ufeff", "😀"]
    texts = ["", *letters, *[x + y for x in letters for y in letters], *[x + "m m" + y for x in letters for y in letters]]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    got = {r.n: r.s for r in df.select("n", strip(F.col("t")).alias("s")).collect()}
    assert got == {n: t.strip() for n, t in enumerate(texts)}


def test_key_hash_keeps_tuples_apart(spark):
    pairs = [("a", "bc"), ("ab", "c"), ("", "abc"), (None, "abc"), ("1:a", ""), ("a", None), ("a", ""), ("-", ""), (None, "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.select(key_hash(F.col("a"), F.col("b"))).distinct().count() == len(pairs)


@pytest.mark.parametrize("text,good", [
    ("2026-02-10", True), ("2026-02-10T09:15", True), ("2026-02-10 09:15:01.123456Z", True),
    ("2026-02-10T09:15:00+03:00", True), ("2026-02-30", False), ("2026", False), ("2026-02", False),
    ("T09:15", False), ("2026-02-10T25:00", False), ("2026-02-10T09:15:00+0300", True), ("2026-02-10T09:15:00+030", False), ("2026-02-10+0300", False), ("", False),
])
def test_timestamp_spelling(spark, text, good):
    value = spark.range(1).select(instant(F.lit(text))).first()[0]
    assert (value is not None) == good


# --- taxonomy ----------------------------------------------------------------


def test_taxonomy_properties(spark):
    rows = built_in_taxonomy(spark).collect()
    assert len(rows) == 48 == len({r.path for r in rows}) == len({r.l3 for r in rows})
    assert len({(r.l1, r.l2) for r in rows}) == 16
    assert len({r.l1 for r in rows}) == 6
    assert [r.k for r in rows] == list(range(48))
    assert {row[:3] for row in fixed.TITLES} == {(r.l1, r.l2, r.l3) for r in rows}


def test_taxonomy_file(spark, tmp_path):
    nodes = [{"l1": a, "l2": b, "l3": c, "tags": t} for a, b, c, t in fixed.TAXONOMY]
    path = tmp_path / "taxonomy.json"
    path.write_text(json.dumps({"version": "1", "taxonomy": nodes + nodes[:1]}, indent=1))
    columns = ["k", "l1", "l2", "l3", "path", "tags"]
    loaded = load_taxonomy(spark, str(path)).select(columns)
    assert collected(loaded) == collected(built_in_taxonomy(spark).select(columns))


# --- validation --------------------------------------------------------------


def test_result_does_not_depend_on_partitions(spark, sf_dir):
    tickets = document_tickets(spark, sf_dir)
    taxonomy = built_in_taxonomy(spark)

    def run(df):
        return collected(validate.validate(df, taxonomy).select("pos", "reason", "autofix"))

    assert run(tickets.repartition(7)) == run(tickets.coalesce(1))


def test_hot_id_by_shuffle(spark, shuffle_only):
    """A third of the rows share an id; the duplicate check goes the shuffle way."""
    rng = random.Random(1)
    rows = [
        (pos, "hot" if pos % 3 == 0 else None if pos % 50 == 1 else f"id{rng.randrange(400)}",
         rng.choice(["", "", "bad:priority_rule", "bad:channel"]))
        for pos in range(3000)
    ]
    df = spark.createDataFrame(rows, "pos long, ticket_id string, codes string")
    checked = df.withColumn("id_key", F.coalesce("ticket_id", F.lit("null"))).repartition(5)
    got = {r.pos: (r.reason, r.autofix) for r in validate.resolve(checked).collect()}
    seen, expected = set(), {}
    for pos, key, codes in rows:
        errors = ([codes] if codes else []) + (["bad:duplicate_ticket_id"] if key in seen else [])
        autofix = errors == ["bad:priority_rule"]
        errors = [] if autofix else errors
        if not errors:
            seen.add(key)
        expected[pos] = (errors, autofix)
    assert got == expected


def test_report_counts_agree_with_codes(spark, sf_dir):
    tickets, taxonomy = document_tickets(spark, sf_dir), built_in_taxonomy(spark)
    report = {r.metric: r.n for r in quality.violations(tickets, taxonomy).collect()}
    codes = {r.code: r.n for r in validate.code_counts(validate.check_rows(tickets, taxonomy, typed_fields())).collect()}
    assert report["bad_channel"] == codes["bad:channel"]
    assert report["bad_sentiment"] == codes["bad:sentiment"]
    assert report["bad_priority"] == codes["bad:priority_rule"]
    assert report["bad_taxonomy"] == codes["bad:category_not_allowed"]


def test_split_is_a_partition(spark, sf_dir):
    tickets = document_tickets(spark, sf_dir)
    clean, rejected = validate.split(validate.validate(tickets, built_in_taxonomy(spark)))
    assert clean.columns == tickets.columns
    assert clean.count() == 163 and rejected.count() == 37
    assert clean.join(rejected, "pos").count() == 0


def test_empty_input(spark, sf_dir):
    empty = document_tickets(spark, sf_dir).where("false")
    taxonomy = built_in_taxonomy(spark)
    assert validate.run_summary(validate.validate(empty, taxonomy)).first()[:] == (0, 0, 0, 0)
    assert {(r.n, r.pct) for r in quality.violations(empty, taxonomy).collect()} == {(0, 0.0)}
    assert quality.duplicates(empty).first()[:] == (0, 0)
    assert dedupe.residual_duplicates(empty).first()[:] == (0, 0, 0.0)
    assert {(r.n, r.pct) for r in profile.duplicate_membership(empty).collect()} == {(0, 0.0)}
    assert quality.report(empty, taxonomy).where("ord = 0").first().text == "Total: 0"


# --- duplicates --------------------------------------------------------------


def text_rows(spark, n=1500):
    """A third of all rows share one text; others repeat now and then."""
    rng = random.Random(2)
    rows = []
    for pos in range(n):
        text = "hot text" if pos % 3 == 0 else f"text {rng.randrange(300)}"
        pad = rng.choice(["", " ", " \n"])
        rows.append((pos, f"TCKT-{pos:06d}", None if pos % 40 == 5 else f"title {pos % 2}", pad + text + pad))
    return rows, spark.createDataFrame(rows, "pos long, ticket_id string, title_ar string, description_ar string")


def check_duplicates(spark):
    rows, df = text_rows(spark)
    seen, repeats = set(), set()
    for pos, _, title, text in rows:
        key = ((title or "").strip(), text.strip())
        if key in seen:
            repeats.add(pos)
        seen.add(key)
    varied = {r.pos: r.description_ar for r in dedupe.vary_duplicates(df.repartition(6)).collect()}
    for pos, _, _, text in rows:
        assert varied[pos].startswith(text)
        assert (varied[pos] != text) == (pos in repeats)
    raw_seen, kept = set(), []
    for pos, _, title, text in rows:
        if (title, text) not in raw_seen:
            kept.append(pos)
        raw_seen.add((title, text))
    got = dedupe.drop_duplicates(df.repartition(6)).select("pos").collect()
    assert sorted(r.pos for r in got) == kept
    groups = Counter(((t or "").strip(), d.strip()) for _, _, t, d in rows)
    left = dedupe.residual_duplicates(df).first()
    assert left.dup_groups == sum(c > 1 for c in groups.values())
    assert left.dup_records == len(rows) - len(groups)


def test_duplicates_by_broadcast(spark):
    check_duplicates(spark)


def test_duplicates_by_shuffle(spark, shuffle_only):
    check_duplicates(spark)


def test_permuted_ids_draw_alike_only_by_sum(spark):
    df = spark.createDataFrame(
        [(n, i, "t", "d") for n, i in enumerate(["TCKT-001", "TCKT-123", "TCKT-321"])],
        "pos long, ticket_id string, title_ar string, description_ar string",
    )
    for mode, distinct in (("sum", 2), ("spread", 3)):
        assert dedupe.vary_duplicates(df, mode).select("description_ar").distinct().count() == distinct


# --- post-processing ---------------------------------------------------------


def tickets_of(spark, rows):
    schema = (
        "pos long, ticket_id string, category_level_1 string, category_level_2 string, category_level_3 string,"
        " category_path string, tags array<string>, labels_json struct<l1:string,l2:string,l3:string,tags:array<string>>,"
        " impact int, urgency int, priority int, title_ar string, description_ar string"
    )
    return spark.createDataFrame(rows, schema)


def post_row(pos, l1, l2, l3, text, impact=3, urgency=4, priority=1, tags=("a",)):
    return (pos, f"TCKT-{pos}", l1, l2, l3, f"{l1} > {l2} > {l3}", list(tags) if tags is not None else None,
            (l1, l2, l3, ["old"]), impact, urgency, priority, "t", text)


def test_postprocess(spark):
    rows = [
        post_row(0, "Software", "Office Apps", "Excel Crash", "x" * 89),
        post_row(1, "Network", "VPN", "Credentials", "x" * 90),
        post_row(2, "Network", "WiFi", "Slow Speed", "abc.."),
        post_row(3, "Software", "Email/Calendar", "Outlook Issue", None, impact=None),
        post_row(4, "Software", "Office Apps", "Performance", "short", tags=None),
        post_row(5, "Service", "Incident", "Outage", "short"),
    ]
    done = {r.pos: r for r in enrich.postprocess(tickets_of(spark, rows), built_in_remap(spark)).collect()}
    assert done[0].category_level_3 == "Crash" and done[0].category_path == "Software > Office Apps > Crash"
    assert done[0].labels_json.l3 == "Crash" and done[0].labels_json.tags == ["a"]
    assert done[0].description_ar.startswith("x" * 89 + ". نسخة الأوفيس: ")
    assert done[1].description_ar == "x" * 90 and done[1].labels_json.tags == ["old"]
    assert done[2].description_ar.startswith("abc. على شبكة ")
    assert done[3].description_ar.startswith(". Outlook على ")
    assert done[4].category_level_3 == "Word/Excel" and done[4].labels_json.tags == []
    assert [done[n].priority for n in (0, 1, 2, 4, 5)] == [4] * 5
    assert done[3].priority == 1
    for r in done.values():
        assert r.description_ar.endswith(".") or r.pos == 1


def test_absent_numbers_count_zero_and_null_ones_stay(spark):
    df = spark.createDataFrame(
        [(1, [], None, 4, 9), (2, ["impact"], None, 4, 9), (3, ["impact", "urgency"], None, None, 9)],
        "pos int, missing array<string>, impact int, urgency int, priority int",
    )
    got = {r.pos: r.priority for r in enrich.recompute_priority(df).collect()}
    assert got == {1: 9, 2: 2, 3: 1}


# --- fix merge ---------------------------------------------------------------


def check_fix_merge(spark):
    rng = random.Random(3)
    parts, repairs = [], []
    for part in ("p1.jsonl", "p2.jsonl", "p3.jsonl"):
        parts += [(part, n, rng.choice([None, "hot", "hot", *[f"i{k}" for k in range(30)]]), f"{part}-{n}") for n in range(1, 200)]
        repairs += [(part, n, rng.choice([None, "hot", *[f"i{k}" for k in range(20, 60)]]), f"fix-{part}-{n}") for n in range(1, 90)]
    expected = set()
    for part in ("p1.jsonl", "p2.jsonl", "p3.jsonl"):
        latest, first = {}, {}
        for _, n, key, raw in (r for r in repairs if r[0] == part):
            if key is not None:
                latest[key] = raw
                first.setdefault(key, n)
        for _, n, key, raw in (r for r in parts if r[0] == part):
            hit = key is not None and key in latest
            expected.add((part, n, latest.pop(key) if hit else raw, hit))
        expected |= {(part, 199 + first[key], raw, True) for key, raw in latest.items()}
    schema = "part string, line long, id_key string, raw string"
    merged = fixes.merge_fixes(
        spark.createDataFrame(parts, schema).repartition(5), spark.createDataFrame(repairs, schema).repartition(3), ["raw"]
    )
    got = [(r.part, r.line, r.raw, r.is_fix) for r in merged.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_fix_merge_by_broadcast(spark):
    check_fix_merge(spark)


def test_fix_merge_by_shuffle(spark, shuffle_only):
    check_fix_merge(spark)


# --- repair ------------------------------------------------------------------


def test_repair_is_idempotent_and_whole(spark, sf_dir):
    taxonomy = built_in_taxonomy(spark)
    rejected = validate.rejected_rows(validate.validate(document_tickets(spark, sf_dir), taxonomy))
    once = repair.repair(rejected.withColumns({"source": F.lit("s"), "line": F.col("pos")}), taxonomy)
    assert once.count() == rejected.count()
    assert collected(repair.repair(once, taxonomy)) == collected(once)
    again = validate.validate(once.withColumn("pos", F.col("line")), taxonomy, "strict")
    assert {tuple(r.reason) for r in again.collect()} <= {(), ("bad:duplicate_ticket_id",)}


def test_repair_lines(spark):
    bare = {"ticket_id": "A", "channel": "Emial", "impact": "9", "urgency": 2, "tags": "vpn",
            "category_path": "Network > VPN > Credential", "created_at": "2026-02-10", "updated_at": "2026-02-09"}
    lines = [json.dumps(bare), json.dumps({"reason": ["x"], "ticket": {**bare, "ticket_id": "B", "tags": [" ", "x", 5]}}), "{bad", "[1]"]
    df = spark.createDataFrame([("s", n, raw) for n, raw in enumerate(lines, 1)], "source string, line long, raw string")
    rows = {r.line: r for r in repair.repair_lines(df, built_in_taxonomy(spark)).collect()}
    assert set(rows) == {1, 2, 3, 4}
    one = rows[1]
    assert (one.ticket_id, one.channel, one.category_path) == ("A", "email", "Network > VPN > Credentials")
    assert (one.impact, one.urgency, one.priority) == (5, 2, 4)
    assert (one.created_at, one.updated_at) == ("2026-02-10T00:00:00+00:00", "2026-02-10T00:00:00+00:00")
    assert one.tags == ["vpn", "tunnel"] == one.labels_json.tags
    assert rows[2].ticket_id == "B" and rows[2].tags == ["x", "5"]
    assert all(re.fullmatch(r"TCKT-\d{6,19}", rows[n].ticket_id) for n in (3, 4))
    assert rows[3].ticket_id != rows[4].ticket_id


# --- synthesis ---------------------------------------------------------------


def test_synthesis(spark):
    taxonomy = built_in_taxonomy(spark)
    made = synth.synthesize_batch(spark, taxonomy, 1200, seed=7)
    rows = made.collect()
    assert collected(made) == collected(synth.synthesize_batch(spark, taxonomy, 1200, seed=7).repartition(3))
    assert collected(made) != collected(synth.synthesize_batch(spark, taxonomy, 1200, seed=8))
    assert validate.run_summary(validate.validate(made, taxonomy, "strict")).first()[:] == (1200, 1200, 0, 0)
    assert {r.ticket_id for r in rows} == {f"TCKT-001-{n:03d}" for n in range(1, 1201)}
    assert len({r.category_path for r in rows}) == 48
    assert {len(r.tags) for r in rows} == {2, 3, 4, 5, 6}
    assert all(len(set(r.tags)) == len(r.tags) for r in rows)
    assert {r.impact for r in rows} == {1, 2, 3, 4, 5} and {r.channel for r in rows} == set(fixed.CHANNELS)
    titles = defaultdict(set)
    for r in rows:
        titles[r.category_path].add(r.title_ar)
    assert sum(map(len, titles.values())) > 120


def test_synthesis_falls_back(spark):
    taxonomy = spark.createDataFrame(
        [(0, "A", "B", "C", "A > B > C", ["one"]), (1, "A", "B", "D", "A > B > D", None)],
        "k int, l1 string, l2 string, l3 string, path string, tags array<string>",
    )
    rows = synth.synthesize_batch(spark, taxonomy, 60).collect()
    assert all(len(r.tags) == 2 and set(r.tags) <= set(fixed.FALLBACK_TAGS) for r in rows)
    assert {r.title_ar for r in rows} == {"مشكلة في C", "مشكلة في D", "طلب متعلق بـ B"}


# --- statistics --------------------------------------------------------------


def test_length_statistics_against_numpy(spark):
    rng = np.random.default_rng(4)
    values = {"a": rng.integers(0, 500, 700), "b": rng.geometric(0.05, 333), "c": np.array([5, 5, 5])}
    rows = [(k, int(x)) for k, xs in values.items() for x in xs] + [(None, 3), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v int")
    freq = lengths.value_frequencies(df, F.col("v"), ["g"])
    box = {r.g: r for r in lengths.box_stats(freq, "g").collect()}
    medians = [(r.g, r["median"]) for r in lengths.medians(freq, "g").collect()]
    assert medians == sorted(((k, float(np.median(xs))) for k, xs in values.items()), key=lambda m: -m[1])
    hist = lengths.histogram(freq, ["g"]).collect()
    curve = lengths.density_curve(freq, ["g"]).collect()
    for k, xs in values.items():
        q1, q2, q3 = np.percentile(xs, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = xs[(xs >= low) & (xs <= high)]
        assert (box[k].q1, box[k]["median"], box[k].q3) == (q1, q2, q3)
        assert (box[k].whisker_low, box[k].whisker_high) == (inside.min(), inside.max())
        assert box[k].n_outliers == len(xs) - len(inside)
        counts, edges = np.histogram(xs, bins=40)
        mine = sorted((r.bin, r.bin_low, r.n) for r in hist if r.g == k)
        assert len(mine) == 40 and sum(r[2] for r in mine) == len(xs)
        assert np.allclose([r[1] for r in mine], edges[:-1])
        if k != "b":
            assert [r[2] for r in mine] == list(counts)
        heights = [r.height for r in sorted(curve, key=lambda r: r.j) if r.g == k]
        if k == "c":
            assert heights == []
            continue
        bw = statistics.stdev(map(float, xs)) * len(xs) ** -0.2
        grid = np.linspace(xs.min(), xs.max(), 200)
        width = (xs.max() - xs.min()) / 40
        expected = [np.exp(-0.5 * ((p - xs) / bw) ** 2).sum() * width / (bw * math.sqrt(2 * math.pi)) for p in grid]
        assert np.allclose(heights, expected)


def test_text_lengths_and_blanks(spark):
    df = spark.createDataFrame([("ab", None), ("  ", "é" * 5), (None, "")], "t string, d string")
    stats = {r.field: r for r in lengths.length_stats(df, ["t", "d"]).collect()}
    assert tuple(stats["t"])[1:] == (2, 2, 2.0, 2.0, 2)
    assert tuple(stats["d"])[1:] == (0, 5, 2.5, 2.5, 2)


def test_profile_leaves_out_nulls_and_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",), ("b",), ("c",)], "v string")
    assert [tuple(r) for r in profile.value_counts(df, "v").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert [tuple(r) for r in profile.class_shares(df, "v").collect()] == [("a", 2, 40.0), ("b", 2, 40.0), ("c", 1, 20.0)]
    one = profile.class_balance(df, ["v"]).first()
    assert (one.classes, one.min_size, one.max_size, one.imbalance_ratio) == (3, 1, 2, 2.0)
    assert math.isclose(one.std_size, statistics.stdev([2, 2, 1]))


def test_tag_parsing(spark):
    df = spark.createDataFrame([("['a', \"b\"]",), ('["c"]',), ("oops",), ("[]",), (None,), ('{"x":1}',)], "tags string")
    assert [r[0] for r in df.select(profile.parse_tags(df)).collect()] == [["a", "b"], ["c"], [], [], [], []]


def test_crosstab_with_given_columns(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "a"), ("y", "b"), (None, "a"), ("y", None)], "r string, c string")
    found = sorted(tuple(r) for r in profile.crosstab(df, "r", "c").collect())
    given = sorted(tuple(r) for r in profile.crosstab(df, "r", "c", ["a", "b", "z"]).collect())
    assert found == [("x", 2, 0), ("y", 0, 1)]
    assert given == [("x", 2, 0, 0), ("y", 0, 1, 0)]


def test_sample_is_stable(spark, sf_dir):
    tickets = all_tickets(spark, sf_dir)
    first = [tuple(r) for r in profile.sample_rows(tickets.repartition(5)).collect()]
    assert first == [tuple(r) for r in profile.sample_rows(tickets.coalesce(1)).collect()]
    assert len(first) == 8


def test_quantiles_of_any_number_of_values(spark, monkeypatch):
    """Ranks found by ranges give what numpy gives, for a class of most rows, ties, one row, and none."""
    monkeypatch.setattr(lengths, "SMALL", 0)
    rng = np.random.default_rng(4)
    values = {"hot": rng.normal(0, 1e6, 6000), "ties": rng.integers(-3, 3, 900).astype(float), "one": np.array([7.5]), "two": np.array([1.0, 2.0])}
    rows = [(g, float(x)) for g, xs in values.items() for x in xs] + [("null", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    freq = lengths.pinned(lengths.value_frequencies(df, F.col("x"), ["g"]))
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r.q for r in lengths.quantiles(freq, ["g"], shares).collect()}
    assert set(got) == set(values)
    for g, xs in values.items():
        assert np.allclose(got[g], np.quantile(xs, shares), rtol=1e-12, atol=0)
    plan = lengths.quantiles(freq, ["g"], shares)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan
    assert lengths.quantiles(freq.where("false"), ["g"], shares).collect() == []


@pytest.mark.parametrize("tails,chunk", [(dedupe.TAILS, dedupe.CHUNK), (50, 8)])
def test_numbered_copies_leave_no_duplicates(spark, monkeypatch, tails, chunk):
    """A third of all rows share one text, blanks aside; capacity beyond one sentence is tested with few sentences."""
    monkeypatch.setattr(dedupe, "TAILS", tails)
    monkeypatch.setattr(dedupe, "CHUNK", chunk)
    rows = [(n * 7, f"T{n % 5}", "t", " hot " if n % 3 == 0 and n % 2 else "hot" if n % 3 == 0 else f"text {n // 2}") for n in range(9000)]
    rows += [(100_000, "x", None, None), (100_001, "y", None, ""), (100_002, "z", " ", "")]
    df = spark.createDataFrame(rows, "pos bigint, ticket_id string, title_ar string, description_ar string").repartition(5)
    out = dedupe.vary_duplicates(df, mode="numbered")
    assert tuple(dedupe.residual_duplicates(out).first()) == (0, 0, 0.0)
    got = {r.pos: r.description_ar for r in out.collect()}
    assert len(got) == len(rows)
    seen = set()
    for pos, _, title, text in rows:
        key = ((title or "").strip(), (text or "").strip())
        assert (got[pos] == text) == (key not in seen)
        assert got[pos] == text or got[pos].startswith(text or ".")
        seen.add(key)
    numbers = {r.pos: r.copy_no for r in dedupe.copy_numbers(df, dedupe.trimmed_key()).collect()}
    hot = sorted(pos for pos, _, _, text in rows if (text or "").strip() == "hot")
    assert [numbers.get(p) for p in hot] == [None, *range(1, len(hot))]


def test_made_up_ids_are_free(spark):
    """A taken id gives way to the next one, rows of one place get two, and two runs agree."""
    import hashlib

    def made(place):
        return "TCKT-" + str(int(hashlib.sha256(place.encode()).hexdigest()[:15], 16)).zfill(6)

    lines = [("s", n, "{}") for n in (1, 2, 3, 3)] + [("s", 9, json.dumps({"ticket_id": made("s:2")}))]
    df = spark.createDataFrame(lines, "source string, line long, raw string")
    taken = spark.createDataFrame([(made("s:1"),), (made("s:1#1"),), (None,), ("",)], "ticket_id string")
    runs = []
    for parts in (1, 4):
        rows = repair.repair_lines(df.repartition(parts), built_in_taxonomy(spark), taken).collect()
        runs.append(sorted((r.line, r.ticket_id) for r in rows))
    assert runs[0] == runs[1] == sorted([
        (1, made("s:1#2")), (2, made("s:2#1")), (3, made("s:3")), (3, made("s:3#1")), (9, made("s:2"))])


def test_profile_and_report_read_their_table_once(spark, sf_dir, tmp_path):
    """Tables of a profile equal those of its single functions, and come from the narrow table but for a few rows."""
    path = str(tmp_path / "tickets")
    document_tickets(spark, sf_dir).write.parquet(path)
    df = spark.read.parquet(path)
    tables = profile.profile(df)
    assert len(tables) == 25
    single = {"overview": profile.overview(df), "missing": profile.missing_by_column(df), "balance": profile.class_balance(df),
              "duplicates": profile.duplicate_membership(df), "tags": profile.top_tags(df), "counts_l3": profile.value_counts(df, "category_level_3"),
              "length_stats": lengths.length_stats(df, ["title_ar", "description_ar"]), "preview": profile.preview(df), "sample": profile.sample_rows(df)}
    for name, frame in single.items():
        assert collected(tables[name].select(*frame.columns)) == collected(frame), name
    for name, frame in tables.items():
        reads = any(path in f for f in frame.inputFiles())
        assert reads == (name in ("preview", "sample")), name
    lines = quality.report(df, built_in_taxonomy(spark))
    assert not any(path in f for f in lines.inputFiles())


def test_profile_of_nothing(spark, sf_dir):
    tables = profile.profile(document_tickets(spark, sf_dir).where("false"))
    assert {r.metric: r.value for r in tables["overview"].collect()}["total_rows"] == 0
    for name in set(tables) - {"overview", "missing", "duplicates"}:
        assert all(r.n_blank == 0 for r in tables[name].collect()) if name == "length_stats" else tables[name].collect() == [], name
