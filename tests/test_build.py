"""Raw-line path on hand-written cases: each starts from a valid ticket and changes one thing."""

import json

import pytest
from pyspark.sql import functions as F

from ticketloom.plans.build import build, listing
from ticketloom.sources.lines import read_parts
from ticketloom.sources.tables import read_csv, read_jsonl

LEAF = ("Network", "WiFi", "Authentication")


def ticket(**changes):
    l1, l2, l3 = LEAF
    base = {
        "ticket_id": "TCKT-001",
        "created_at": "2026-02-10T09:15:00+03:00",
        "updated_at": "2026-02-10T09:45:00+03:00",
        "channel": "portal",
        "model": "test",
        "dialect": "Egyptian",
        "title_ar": "تست",
        "description_ar": "تست",
        "category_level_1": l1,
        "category_level_2": l2,
        "category_level_3": l3,
        "category_path": " > ".join(LEAF),
        "tags": ["wifi", "auth"],
        "labels_json": {"l1": l1, "l2": l2, "l3": l3, "tags": ["wifi", "auth"]},
        "impact": 3,
        "urgency": 4,
        "priority": 4,
        "sentiment": "negative",
    }
    return {**base, **changes}


def without(*keys, **changes):
    return {k: v for k, v in ticket(**changes).items() if k not in keys}


LABELS = ticket()["labels_json"]

CASES = [
    ("ok", ticket(), []),
    ("p999", ticket(impact=2, urgency=3, priority=999), ["bad:range:priority", "bad:priority_rule"]),
    ("autofix", ticket(impact=4, urgency=5, priority=4), []),
    ("float", ticket(impact=3.0), ["bad:type:impact"]),
    ("text-int", ticket(urgency="4"), ["bad:type:urgency"]),
    ("null-int", ticket(urgency=None), ["bad:type:urgency"]),
    ("bool", ticket(impact=True, urgency=1, priority=1), []),
    ("false", ticket(impact=False, urgency=1, priority=1), ["bad:range:impact"]),
    ("huge", ticket(impact=99999999999999999999), ["bad:range:impact", "bad:priority_rule"]),
    ("missing", without("model", "tags", channel="fax"), ["missing:model", "missing:tags"]),
    ("null-key", ticket(model=None), []),
    ("odd-model", ticket(model={"b": 1, "a": [1.5, None]}), []),
    ("enum", ticket(channel="fax", sentiment="angry"), ["bad:channel", "bad:sentiment"]),
    ("enum-list", ticket(channel=["email"]), ["bad:channel"]),
    ("ts-bad", ticket(updated_at="soon"), ["bad:timestamp"]),
    ("ts-null", ticket(updated_at=None), ["bad:timestamp"]),
    ("ts-year", ticket(created_at="2026"), ["bad:timestamp"]),
    ("ts-day", ticket(created_at="2026-02-30T00:00:00+00:00"), ["bad:timestamp"]),
    ("ts-mix", ticket(created_at="2026-02-10T09:15:00"), ["bad:timestamp"]),
    ("ts-naive", ticket(created_at="2026-02-10T09:15:00", updated_at="2026-02-10 09:15"), []),
    ("ts-date", ticket(created_at="2026-02-10", updated_at="2026-02-10"), []),
    ("ts-offset", ticket(created_at="2026-02-10T10:00:00+03:00", updated_at="2026-02-10T08:00:00+01:00"), []),
    ("ts-order", ticket(updated_at="2026-02-10T09:14:59+03:00"), ["bad:updated_at<created_at"]),
    ("path", ticket(category_path="Network > VPN > Credentials"), ["bad:category_path_mismatch"]),
    ("leaf", ticket(category_level_1="Software", category_level_2="Office Apps", category_level_3="Excel Crash",
                    category_path="Software > Office Apps > Excel Crash"), ["bad:category_not_allowed"]),
    ("null-level", ticket(category_level_1=None), ["bad:category_path_mismatch"]),
    ("tags-text", ticket(tags="vpn"), ["bad:tags"]),
    ("tags-int", ticket(tags=["a", 1]), ["bad:tags"]),
    ("tags-null", ticket(tags=["a", None]), ["bad:tags"]),
    ("tags-only-null", ticket(tags=[None]), ["bad:tags"]),
    ("tags-ints", ticket(tags=[1, 2]), ["bad:tags"]),
    ("tags-trim", ticket(tags=[" x ", "", "  "]), []),
    ("tags-empty", ticket(tags=[]), []),
    ("labels", ticket(labels_json="x"), ["bad:labels_json_type"]),
    ("labels-list", ticket(labels_json=[1]), ["bad:labels_json_type"]),
    ("labels-empty", ticket(labels_json={}),
     [f"bad:labels_json_missing:{k}" for k in ("l1", "l2", "l3", "tags")]),
    ("labels-l3", ticket(labels_json={k: v for k, v in LABELS.items() if k != "l3"}),
     ["bad:labels_json_missing:l3"]),
    ("extra", ticket(zz="more", aa={"k": [1, "é"]}), []),
]

RAW_CASES = [
    ("{bad", ["bad:json_parse"]),
    ("[1]", ["bad:not_object"]),
    ("7", ["bad:not_object"]),
    ("null", ["bad:not_object"]),
    ('{"a":1} x', ["bad:json_parse"]),
    ('{"a":1}]', ["bad:json_parse"]),
    ('{"a":1}}', ["bad:json_parse"]),
    ('{"a":1},', ["bad:json_parse"]),
    ('{"a":1},"b":2', ["bad:json_parse"]),
    ('{"a":1}}]', ["bad:json_parse"]),
    ('{"a":NaN}', ["bad:json_parse"]),
]


def dumps(obj):
    return json.dumps(obj, ensure_ascii=False)


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def read_lines(folder):
    from pathlib import Path

    return [
        json.loads(line)
        for f in sorted(f for f in Path(folder).rglob("part-*") if "_manifest" not in f.parts)
        for line in f.read_text(encoding="utf-8").split("\n")
        if line
    ]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("build")
    one = [dumps({**t, "ticket_id": f"TCKT-{name}"}) for name, t, _ in CASES]
    two = [raw for raw, _ in RAW_CASES]
    three = [
        dumps(ticket(ticket_id="D", channel="fax")),   # rejected, does not block
        "",
        dumps(ticket(ticket_id="D")),                  # accepted
        "   ",
        dumps(ticket(ticket_id="D")),                  # duplicate
        dumps(ticket(ticket_id="D", priority=1)),      # rule and duplicate
        "　" + dumps(ticket(ticket_id=None)) + " ",
        dumps(ticket(ticket_id=None)),                 # equal to the null id before
        dumps(ticket(ticket_id="null")),               # another id
        dumps(ticket(ticket_id=5)),
        dumps(ticket(ticket_id="5")),
    ]
    write(root / "parts" / "part_1.jsonl", one)
    write(root / "parts" / "part_2.jsonl", two)
    write(root / "parts" / "part_3.jsonl", three)
    return build(spark, str(root / "parts" / "part_*.jsonl"), str(root / "out"))


@pytest.fixture(scope="module")
def outcome(built):
    rows = built.validated.select("source", "line", "raw", "reason", "ticket_id").collect()
    return {(r.source.rsplit("/", 1)[1], r.line): r for r in rows}


@pytest.mark.parametrize("n,name,expected", [(n, c[0], c[2]) for n, c in enumerate(CASES, 1)])
def test_case(outcome, n, name, expected):
    row = outcome["part_1.jsonl", n]
    assert row.ticket_id == f"TCKT-{name}"
    assert row.reason == expected


@pytest.mark.parametrize("n,raw,expected", [(n, *c) for n, c in enumerate(RAW_CASES, 1)])
def test_raw_case(outcome, n, raw, expected):
    row = outcome["part_2.jsonl", n]
    assert (row.raw, row.reason) == (raw, expected)


def test_duplicates_and_blank_lines(outcome):
    got = {line: r.reason for (part, line), r in outcome.items() if part == "part_3.jsonl"}
    assert got == {
        1: ["bad:channel"],
        3: [],
        5: ["bad:duplicate_ticket_id"],
        6: ["bad:priority_rule", "bad:duplicate_ticket_id"],
        7: [],
        8: ["bad:duplicate_ticket_id"],
        9: [],
        10: [],
        11: [],
    }


def test_clean_json(built):
    clean = {t["ticket_id"]: t for t in read_lines(built.clean_jsonl)}
    by_name = {name: t for name, t, codes in CASES if not codes}
    for name, given in by_name.items():
        expected = {**given, "ticket_id": f"TCKT-{name}"}
        if name == "autofix":
            expected["priority"] = 5
        if name == "tags-trim":
            expected["tags"] = ["x"]
        assert clean[f"TCKT-{name}"] == expected
        assert list(clean[f"TCKT-{name}"]) == list(expected)
    assert len(read_lines(built.clean_jsonl)) == len(by_name) + 5


def test_clean_csv(spark, built):
    rows = read_csv(spark, built.clean_csv).collect()
    csv = {r.ticket_id: r for r in rows}
    row = csv["TCKT-tags-trim"]
    assert json.loads(row.tags) == ["x"]
    assert json.loads(row.labels_json)["tags"] == ["wifi", "auth"]
    assert row.title_ar == "تست" and row.priority == 4
    assert csv["TCKT-autofix"].priority == 5
    assert len(rows) == read_jsonl(spark, built.clean_jsonl).count()


def test_rejects(built):
    rejects = {(r["source"].rsplit("/", 1)[1], r["line"]): r for r in read_lines(built.rejected)}
    n = [c[0] for c in CASES].index("huge") + 1
    huge = rejects["part_1.jsonl", n]
    assert list(huge) == ["source", "line", "reason", "ticket"]
    assert huge["ticket"] == {**CASES[n - 1][1], "ticket_id": "TCKT-huge"}
    assert rejects["part_2.jsonl", 1] == {
        "source": huge["source"].replace("part_1", "part_2"), "line": 1,
        "reason": ["bad:json_parse"], "raw": "{bad",
    }
    assert rejects["part_2.jsonl", 2]["ticket"] == [1]


def test_listing(built):
    rows = {(r.row_id, r.causes) for r in listing(built).collect()}
    assert ("TCKT-p999", "bad:range:priority, bad:priority_rule") in rows
    assert any(i.endswith("part_2.jsonl:1") and c == "bad:json_parse" for i, c in rows)


def test_no_rejects_replaces_stale_listing(spark, tmp_path):
    write(tmp_path / "in" / "part_1.jsonl", [dumps(ticket(channel="fax"))])
    out = str(tmp_path / "out")
    assert len(read_lines(build(spark, str(tmp_path / "in" / "part_*.jsonl"), out).rejected)) == 1
    write(tmp_path / "in2" / "part_1.jsonl", [dumps(ticket())])
    assert read_lines(build(spark, str(tmp_path / "in2" / "part_*.jsonl"), out).rejected) == []


def test_strict_profile(spark, tmp_path):
    rows = [
        ticket(ticket_id="TCKT-000001"),
        ticket(ticket_id="T-2"),
        ticket(ticket_id="TCKT-001-003", tags=["one"]),
        ticket(ticket_id="TCKT-4", created_at="2026-02-10", updated_at="2026-02-10"),
        without("model"),
    ]
    write(tmp_path / "part_1.jsonl", [dumps(r) for r in rows])
    built = build(spark, str(tmp_path / "part_*.jsonl"), str(tmp_path / "out"), profile="strict")
    got = [r.reason for r in built.validated.orderBy("pos").collect()]
    assert got == [
        [],
        ["strict:ticket_id_format"],
        ["strict:tag_count", "strict:labels_differ"],
        ["strict:timestamp_zone"],
        ["missing:model"],
    ]


def test_line_numbers_across_splits(spark, tmp_path):
    """Files of many splits and mixed sizes, blank lines in between."""
    expected = {}
    for name, n in (("part_b.jsonl", 700), ("part_a.jsonl", 5), ("part_a_fixed.jsonl", 90)):
        lines = ["" if i % 7 == 3 else f"{name}-{i}" + "x" * (i % 50) for i in range(1, n + 1)]
        write(tmp_path / name, lines)
        expected |= {line: (name, i) for i, line in enumerate(lines, 1) if line}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        parts = read_parts(spark, str(tmp_path / "part_*.jsonl"))
        rows = parts.orderBy("pos").collect()
        splits = parts.select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert splits > 3
    got = {r.raw: (r.source.rsplit("/", 1)[1], r.line) for r in rows}
    assert got == expected
    order = [(r.source, r.line) for r in rows]
    assert order == sorted(order)


def test_fix_merge(spark, tmp_path):
    def named(name, **changes):
        return dumps(ticket(ticket_id=name, **changes))

    parts = tmp_path / "parts"
    write(parts / "part_1.jsonl", [named("a"), named("b", channel="fax"), "", named("b"), "{bad",
                                   named("e", channel="fax")])
    write(parts / "part_1_fixed.jsonl", [named("b", model="b1"), named("c", model="c1"), "{bad",
                                         dumps(without("ticket_id")), named("d", model="d1"),
                                         named("b", model="b2"), named("c", model="c2")])
    write(parts / "part_9_fixed.jsonl", [named("z", model="orphan")])
    write(parts / "other_fixed.jsonl", [named("y", model="not an input")])
    before = {p.name: p.read_bytes() for p in parts.iterdir()}
    built = build(spark, str(parts / "part_*.jsonl"), str(tmp_path / "out"), fixes_glob=str(parts / "*_fixed.jsonl"))
    rows = built.validated.orderBy("pos").collect()
    got = [(r.source.rsplit("/", 1)[1], r.ticket_id, json.loads(r.raw)["model"] if r.ticket_id else r.raw, r.reason)
           for r in rows]
    assert got == [
        ("part_1.jsonl", "a", "test", []),
        ("part_1.jsonl", "b", "b2", []),
        ("part_1.jsonl", "b", "test", ["bad:duplicate_ticket_id"]),
        ("part_1.jsonl", None, "{bad", ["bad:json_parse"]),
        ("part_1.jsonl", "e", "test", ["bad:channel"]),
        ("part_1.jsonl", "c", "c2", []),
        ("part_1.jsonl", "d", "d1", []),
        ("part_9_fixed.jsonl", "z", "orphan", []),
    ]
    assert {p.name: p.read_bytes() for p in parts.iterdir()} == before


def test_fixed_files_are_plain_parts_without_merge(spark, tmp_path):
    write(tmp_path / "part_1.jsonl", [dumps(ticket(channel="fax"))])
    write(tmp_path / "part_1_fixed.jsonl", [dumps(ticket())])
    built = build(spark, str(tmp_path / "part_*.jsonl"), str(tmp_path / "out"))
    got = [r.reason for r in built.validated.orderBy("pos").collect()]
    assert got == [["bad:channel"], []]
