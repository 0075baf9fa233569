"""The whole loop on files: build, repair rejects, merge, rebuild; passes and report."""

import json

import pytest

from checks.views import json_lines
from ticketloom.plans import build as plan
from ticketloom.plans import curate
from ticketloom.sources.tables import read_jsonl, write_report


@pytest.fixture(scope="module")
def parts(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("loop") / "parts"
    folder.mkdir()
    lines = [r.raw for r in json_lines(spark, sf_dir).orderBy("pos").collect()]
    (folder / "part_1.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return folder


def gathered(folder):
    files = sorted(folder.rglob("part-*"), key=lambda p: (p.parent != folder, str(p)))
    files = [p for p in files if "_manifest" not in p.parts]
    return "".join(p.read_text(encoding="utf-8") for p in files)


def test_reject_repair_merge_rebuild(spark, parts, tmp_path):
    glob = str(parts / "part_*.jsonl")
    first = plan.build(spark, glob, str(tmp_path / "first"))
    n_rejected = plan.rejected(first.validated).count()
    curate.repair_rejects(spark, first.rejected, str(tmp_path / "fixed"))
    fixed = gathered(tmp_path / "fixed")
    assert fixed.count("\n") == n_rejected > 0
    second_dir = tmp_path / "parts"
    second_dir.mkdir()
    for p in parts.iterdir():
        (second_dir / p.name).write_bytes(p.read_bytes())
    (second_dir / "part_1_fixed.jsonl").write_text(fixed, encoding="utf-8")
    second = plan.build(spark, str(second_dir / "part_*.jsonl"), str(tmp_path / "second"),
                        fixes_glob=str(second_dir / "*_fixed.jsonl"))
    reasons = {tuple(r.reason) for r in plan.rejected(second.validated).collect()}
    # lines without an id to go by stay; the fixes made for them are new rows
    assert reasons <= {("bad:duplicate_ticket_id",), ("bad:json_parse",), ("bad:not_object",)}
    clean_before = read_jsonl(spark, first.clean_jsonl).count()
    assert read_jsonl(spark, second.clean_jsonl).count() > clean_before


def test_passes_write_every_record(spark, parts, tmp_path):
    glob = str(parts / "part_*.jsonl")
    records = [o for o in map(parsed, (parts / "part_1.jsonl").read_text(encoding="utf-8").splitlines())
               if isinstance(o, dict)]
    for name, run in (("post", curate.postprocess_parts), ("vary", curate.vary_parts)):
        run(spark, glob, str(tmp_path / name))
        rows = [json.loads(line) for line in gathered(tmp_path / name).splitlines()]
        assert len(rows) == len(records)
        assert {r["ticket_id"] for r in rows} == {r["ticket_id"] for r in records}


def parsed(line):
    try:
        return json.loads(line)
    except ValueError:
        return None


def test_report_file(spark, parts, tmp_path):
    glob = str(parts / "part_*.jsonl")
    lines = curate.report_parts(spark, glob, str(tmp_path / "report"))
    text = gathered(tmp_path / "report").splitlines()
    assert text == [r.text for r in lines.orderBy("ord").collect()]
    objects = list(map(parsed, (parts / "part_1.jsonl").read_text(encoding="utf-8").splitlines()))
    assert text[0] == f"Total: {len(objects)}"
    missing = sum(isinstance(o, dict) and "model" not in o for o in objects)
    assert text[2] == f"Missing required keys: {missing} ({100 * missing / len(objects):.2f}%)"
    assert "== Duplicates ==" in text
    files = [p for p in (tmp_path / "report").iterdir() if p.name.startswith("part-")]
    assert len(files) == 1
    write_report(lines, str(tmp_path / "report"))


def test_merged_version_keeps_order(spark, tmp_path):
    from ticketloom.sources.lines import number_lines, read_parts
    from ticketloom.sources.tables import write_version
    from ticketloom.session import stage

    parts = tmp_path / "parts"
    parts.mkdir()
    for name, n in (("part_1.jsonl", 50), ("part_2.jsonl", 400)):
        lines = [json.dumps({"ticket_id": f"{name}-{i}", "n": i}) for i in range(n)]
        (parts / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    (parts / "part_1_fixed.jsonl").write_text(
        '{"ticket_id":"new","n":-1}\n{"ticket_id":"part_1.jsonl-7","n":-7}\n', encoding="utf-8"
    )
    scanned = stage(plan.scan_with_fixes(spark, str(parts / "part_?.jsonl"), str(parts / "*_fixed.jsonl")), "lines")
    merged = plan.apply_fixes(number_lines(scanned))
    expected = [r.raw for r in merged.orderBy("pos").collect()]
    assert len(expected) == 451
    assert json.loads(expected[7])["n"] == -7 and json.loads(expected[50])["ticket_id"] == "new"
    named = merged.selectExpr("regexp_extract(source, '[^/]+$', 0) AS part", "line", "raw")
    write_version(named, str(tmp_path / "version"))
    again = read_parts(spark, str(tmp_path / "version" / "*")).orderBy("pos")
    assert [r.raw for r in again.collect()] == expected


def test_passes_keep_what_they_do_not_change(spark, parts, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    ticket = next(o for o in map(parsed, (parts / "part_1.jsonl").read_text(encoding="utf-8").splitlines())
                  if isinstance(o, dict) and "model" in o)
    long = {"description_ar": "d" * 95}
    lines = [
        json.dumps({**ticket, **long, "ticket_id": "a"}, ensure_ascii=False)[:-1] + ', "big": ' + "1" * 42 + ', "x": [3.0, {"z": 1, "a": 2}]}',
        json.dumps({k: v for k, v in ticket.items() if k != "model"} | long | {"ticket_id": "b"}),
        json.dumps({**ticket, **long, "ticket_id": "c", "tags": ["a", {"k": 1}], "priority": "high", "impact": "abc"}),
        "{bad", "[1]",
        json.dumps({**ticket, "ticket_id": "d", "description_ar": "short", "extra": 3.0}),
    ]
    for name in ("part_b.jsonl", "part_a.jsonl", "part_c.jsonl"):
        tagged = [line.replace('"ticket_id": "', f'"ticket_id": "{name[5]}-') for line in lines]
        (folder / name).write_text("\n".join(tagged) + "\n", encoding="utf-8")
    glob = str(folder / "*.jsonl")
    for name, run in (("post", curate.postprocess_parts), ("vary", curate.vary_parts)):
        done = run(spark, glob, str(tmp_path / name))
        assert done.n_rejected == 6 and gathered(tmp_path / f"{name}_rejected").count("\n") == 6
        rows = [json.loads(line) for line in gathered(tmp_path / name).splitlines()]
        assert [r["ticket_id"] for r in rows] == [f"{p}-{i}" for p in "abc" for i in "abcd"]
        for k, row in enumerate(rows):
            assert list(row) == list(json.loads(lines[[0, 1, 2, 5][k % 4]]))
        assert '"big":' in gathered(tmp_path / name) and "1" * 42 in gathered(tmp_path / name) and "[3.0," in gathered(tmp_path / name)
        assert "model" not in rows[1] and rows[2]["tags"] == ["a", {"k": 1}]
        assert rows[2]["priority"] == "high" and rows[2]["impact"] == "abc"
        assert rows[3]["extra"] == 3.0 and isinstance(rows[3]["extra"], float)
    shown = [json.loads(line)["description_ar"] for line in gathered(tmp_path / "post").splitlines()]
    assert len(shown[3]) > 30 and shown[0] == "d" * 95
    varied = [json.loads(line)["description_ar"] for line in gathered(tmp_path / "vary").splitlines()]
    assert varied[0] == "d" * 95 and all(v != "d" * 95 for v in varied[4:7])


def test_repeated_key_and_bare_zone(spark):
    from pyspark.sql import functions as F

    from ticketloom.functions.fields import parse_json, patch_members
    from ticketloom.functions.rules import has_zone, instant
    from ticketloom.session import prepare

    prepare(spark)
    row = parse_json(spark.createDataFrame([('{"a":1,"b":"x\\"y","a":2.50}',)], "raw string")).select(
        "parse_ok", F.expr("try_variant_get(parsed, '$.a', 'double')").alias("a"),
        patch_members(F.col("raw"), {"b": F.lit(None).cast("string"), "c": F.lit("[7]")}).alias("patched")).first()
    assert row.parse_ok and row.a == 2.5 and json.loads(row.patched) == {"a": 2.5, "b": 'x"y', "c": [7]}
    assert list(json.loads(row.patched)) == ["a", "b", "c"]
    times = spark.createDataFrame([("2026-02-01T10:00:00+0300",), ("2026-02-01T10:00:00+03:00",), ("2026-02-01T10:00",), ("2026-02-01",)], "t string")
    found = times.select(has_zone(F.col("t")).alias("z"), instant(F.col("t")).cast("bigint").alias("s")).collect()
    assert [r.z for r in found] == [True, True, False, False]
    assert found[0].s == found[1].s and all(r.s is not None for r in found)


def test_repair_makes_the_same_ids_and_leaves_no_staging(spark, tmp_path):
    from ticketloom.session import staging_root

    rejects = tmp_path / "rejects"
    runs = []
    for k in range(2):
        rejects.mkdir(exist_ok=True)
        for p in rejects.iterdir():
            p.unlink()
        (rejects / f"random-{k}.jsonl").write_text(
            '{"source":"part_1.jsonl","line":3,"reason":["x"],"ticket":{"title_ar":"t"}}\n'
            '{"source":"part_1.jsonl","line":9,"reason":["x"],"raw":"{bad"}\n', encoding="utf-8")
        curate.repair_rejects(spark, str(rejects), str(tmp_path / f"fixed{k}"))
        runs.append([json.loads(line)["ticket_id"] for line in gathered(tmp_path / f"fixed{k}").splitlines()])
    assert runs[0] == runs[1] and len(set(runs[0])) == 2
    from pathlib import Path

    staged = Path(staging_root(spark).removeprefix("file:")) / "ticketloom"
    assert not [p for p in staged.glob("run-*")]


def test_leaf_numbers_have_no_gaps(spark, tmp_path):
    from ticketloom.operators.synth import synthesize_batch, write_batch
    from ticketloom.sources.taxonomy import load_taxonomy

    node = {"l1": "A", "l2": "B", "l3": ["x", "y", "x", "z"], "tags": ["p", "q"]}
    (tmp_path / "taxonomy.json").write_text(json.dumps({"taxonomy": [node]}), encoding="utf-8")
    taxonomy = load_taxonomy(spark, str(tmp_path / "taxonomy.json"))
    assert sorted((r.k, r.l3) for r in taxonomy.collect()) == [(0, "x"), (1, "y"), (2, "z")]
    rows = synthesize_batch(spark, taxonomy.withColumn("k", taxonomy["k"] * 2), 200).collect()
    assert len(rows) == 200 and {r.category_level_3 for r in rows} == {"x", "y", "z"}
    write_batch(spark, taxonomy, str(tmp_path / "batch"), 30)
    assert gathered(tmp_path / "batch").count("\n") == 30
