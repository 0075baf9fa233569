"""Order, numbers and versions of files: many splits, odd names, parts of several files, runs that die."""

import json
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tests.test_build import dumps, read_lines, ticket, write
from ticketloom.functions import joins
from ticketloom.plans import build as plan
from ticketloom.plans import curate
from ticketloom.sources import lines, tables, versions


@contextmanager
def small_splits(spark, size="3000"):
    keys = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "100"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in keys:
            spark.conf.unset(key)


def parts_of(tmp_path, sizes=(("part_b", 300), ("part_a", 7), ("part c", 60), ("part+d%20", 40))):
    """Files of tickets with ids in input order; some are rejected, some need trimming, some are repeats."""
    names = sorted(f"{name}.jsonl" for name, _ in sizes)
    size = {f"{name}.jsonl": n for name, n in sizes}
    count, expected = 0, []
    for name in names:
        rows = []
        for k in range(size[name]):
            count += 1
            changes = {"channel": "fax"} if count % 11 == 0 else {"tags": [" x ", "y"]} if count % 5 == 0 else {}
            rows.append(dumps(ticket(ticket_id=f"T-{1 if count % 17 == 0 else count:05d}", description_ar="d" * (count % 90), **changes)))
            expected.append((name, k + 1, rows[-1]))
        write(tmp_path / "parts" / name, rows)
    return str(tmp_path / "parts" / "part*.jsonl"), expected


def ids(folder):
    return [t["ticket_id"] for t in read_lines(folder)]


def test_outputs_are_in_input_order_over_many_splits(spark, tmp_path):
    glob, expected = parts_of(tmp_path)
    with small_splits(spark):
        built = plan.build(spark, glob, str(tmp_path / "out"))
        splits = built.validated.select(lines.SPLIT).distinct().count()
        rows = built.validated.orderBy("pos").collect()
    assert splits > 20
    assert [(r.source.rsplit("/", 1)[1], r.line, r.raw) for r in rows] == expected
    accepted = [r.ticket_id for r in rows if not r.reason]
    assert ids(built.clean_jsonl) == accepted
    assert [r.ticket_id for r in tables.read_csv(spark, built.clean_csv).collect()] != []
    assert sorted(r.ticket_id for r in tables.read_csv(spark, built.clean_csv).collect()) == sorted(accepted)
    assert [(r["source"].rsplit("/", 1)[1], r["line"]) for r in read_lines(built.rejected)] == [
        (r.source.rsplit("/", 1)[1], r.line) for r in rows if r.reason]
    held = spark.read.json(f"{built.clean_jsonl}/_manifest").orderBy("split").collect()
    assert sum(r.rows for r in held) == len(accepted)
    assert all(a.last_pos < b.first_pos for a, b in zip(held, held[1:]))
    again = lines.read_parts(spark, f"{built.clean_jsonl}/split=*/*").orderBy("pos").collect()
    assert [json.loads(r.raw)["ticket_id"] for r in again] == accepted


def test_same_outputs_where_rows_are_shuffled(spark, tmp_path, monkeypatch):
    glob, _ = parts_of(tmp_path)
    with small_splits(spark):
        kept = plan.build(spark, glob, str(tmp_path / "kept"))
        monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
        dealt = plan.build(spark, glob, str(tmp_path / "dealt"))
    for name in ("clean_jsonl", "rejected"):
        assert read_lines(getattr(kept, name)) == read_lines(getattr(dealt, name)) != []


def test_no_wide_row_is_shuffled(spark, tmp_path):
    glob, _ = parts_of(tmp_path)
    built = plan.build(spark, glob, str(tmp_path / "out"))
    for rows in (plan.clean_json(built.validated), plan.clean_rows(built.validated), plan.rejected(built.validated)):
        shown = tables.by_split(rows, moved=False)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in shown and "rangepartitioning" not in shown and "SinglePartition" not in shown
        assert shown.count("Sort [") == 1


def test_files_are_numbered_by_name_without_gaps(spark, tmp_path):
    names = [f"f{n:03d}.jsonl" for n in range(150)] + ["a b.jsonl", "a+b.jsonl", "a%41.jsonl", "ä.jsonl", "a.jsonl", "aZ.jsonl"]
    for name in names:
        write(tmp_path / name, [name, name])
    rows = lines.read_parts(spark, str(tmp_path / "*.jsonl")).orderBy("pos").collect()
    found = [(r.source.rsplit("/", 1)[1], r.file_no, r.line) for r in rows]
    assert found == [(name, n, line) for n, name in enumerate(sorted(names)) for line in (1, 2)]


def test_fixes_rewrite_only_their_parts(spark, tmp_path):
    glob, expected = parts_of(tmp_path)
    fixes = [dumps(ticket(ticket_id="T-00011", model="fixed")), dumps(ticket(ticket_id="new"))]
    write(tmp_path / "parts" / "part_a_fixed.jsonl", [dumps(ticket(ticket_id="new"))])
    write(tmp_path / "parts" / "part c_fixed.jsonl", fixes)
    with small_splits(spark):
        built = plan.build(spark, glob, str(tmp_path / "out"), fixes_glob=str(tmp_path / "parts" / "*_fixed.jsonl"))
        rows = built.validated.orderBy("pos").collect()
    store = str(tmp_path / "out" / "parts")
    assert versions.current(spark, store) == 2
    files = versions.manifest(spark, store).collect()
    rewritten = {r.part.rsplit("/", 1)[1] for r in files if r.version == 2}
    assert rewritten == {"part_a.jsonl", "part c.jsonl"}
    assert {r.part.rsplit("/", 1)[1] for r in files if r.version == 1 and r.file == r.part} == {"part_b.jsonl", "part+d%20.jsonl"}
    by_part = {}
    for r in rows:
        by_part.setdefault(r.source.rsplit("/", 1)[1], []).append((r.line, json.loads(r.raw)["ticket_id"]))
    assert list(by_part) == sorted(by_part)
    for name, got in by_part.items():
        own = [json.loads(raw)["ticket_id"] for part, _, raw in expected if part == name]
        assert got == list(enumerate([*own, "new"] if name in rewritten else own, 1))
    fixed = [json.loads(r.raw) for r in rows if r.ticket_id == "T-00011"]
    assert [t["model"] for t in fixed] == ["fixed"]
    with pytest.warns(UserWarning, match="without a part"):
        write(tmp_path / "elsewhere" / "x_fixed.jsonl", fixes)
        plan.fixed_version(spark, store, glob, str(tmp_path / "elsewhere" / "*"))


def test_a_run_that_dies_leaves_the_version_in_force(spark, tmp_path, monkeypatch):
    glob, _ = parts_of(tmp_path, (("part_a", 5), ("part_b", 5)))
    store = str(tmp_path / "store")
    assert versions.current(spark, store) == 0
    versions.start(spark, store, versions.listed(spark, glob))
    part = versions.manifest(spark, store).first().part
    fresh = spark.createDataFrame([(part, n, f"line {n}") for n in range(1, 2001)], "part string, line bigint, raw string")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "point_to", dies)
        with pytest.raises(RuntimeError):
            versions.replace_parts(spark, store, fresh)
    assert versions.current(spark, store) == 1
    assert versions.replace_parts(spark, store, fresh) == 2
    held = [r for r in versions.manifest(spark, store).collect() if r.part == part]
    assert sum(r.rows for r in held) == 2000 and sorted(r.ord for r in held) == list(range(len(held)))
    from ticketloom.session import stage

    files = versions.manifest(spark, store)
    read = lines.number_lines(stage(versions.scan(spark, files), "lines"), files)
    mine = read.where(F.col("source") == part).orderBy("line").collect()
    assert [(r.line, r.raw) for r in mine] == [(n, f"line {n}") for n in range(1, 2001)]
    # the version before can still be read
    assert {r.version for r in versions.manifest(spark, store, 1).collect()} == {1}


def test_the_loop_needs_no_names(spark, tmp_path):
    bad = [dumps(ticket(ticket_id=f"T-{n}", **({"channel": "fax"} if n % 4 == 0 else {}))) for n in range(40)]
    write(tmp_path / "parts" / "one.jsonl", [*bad[:20], "{broken", dumps(ticket(ticket_id="T-4", impact="x"))])
    write(tmp_path / "parts" / "two.jsonl", bad[20:])
    write(tmp_path / "parts" / "good.jsonl", [dumps(ticket(ticket_id="G-1"))])
    done = curate.fix_loop(spark, str(tmp_path / "parts" / "*.jsonl"), str(tmp_path / "loop"))
    before = [r for r in done.before.validated.collect() if r.reason]
    after = [(r.source.rsplit("/", 1)[1], r.line, tuple(r.reason)) for r in done.after.validated.orderBy("pos").collect() if r.reason]
    assert len(before) == 12
    # the broken line stays, its repair is a new row; the second T-4 replaced the first and is a repeat itself
    assert after == [("one.jsonl", 21, ("bad:json_parse",)), ("one.jsonl", 22, ("bad:type:impact", "bad:duplicate_ticket_id"))]
    assert done.after.validated.count() == 20 + 2 + 20 + 1 + 1
    kept = {r.part.rsplit("/", 1)[1]: r.version for r in versions.manifest(spark, done.store).collect()}
    assert kept == {"one.jsonl": 2, "two.jsonl": 2, "good.jsonl": 1}


def test_many_small_files_share_output_folders(spark, tmp_path):
    """Not a folder for each file; order and line numbers stay."""
    glob, expected = parts_of(tmp_path, [(f"part_{n:03d}", 1 + n % 4) for n in range(80)])
    built = plan.build(spark, glob, str(tmp_path / "out"))
    rows = built.validated.orderBy("pos").collect()
    assert [(r.source.rsplit("/", 1)[1], r.line, r.raw) for r in rows] == expected
    assert ids(built.clean_jsonl) == [r.ticket_id for r in rows if not r.reason]
    assert len(list((tmp_path / "out" / "clean_jsonl").glob("split=*"))) < 20
    held = spark.read.json(f"{built.clean_jsonl}/_manifest").orderBy("split").collect()
    assert all(a.last_pos < b.first_pos for a, b in zip(held, held[1:]))
    again = lines.read_parts(spark, f"{built.clean_jsonl}/split=*/*").orderBy("pos").collect()
    assert [json.loads(r.raw)["ticket_id"] for r in again] == ids(built.clean_jsonl)


def test_the_loop_keeps_little_beside_its_outputs(spark, tmp_path):
    """Files are compressed and hold every line; tables that only a step read are gone after it."""
    from pathlib import Path

    from ticketloom.session import staging_root

    glob, expected = parts_of(tmp_path, [(f"part_{n:03d}", 1 + n % 9) for n in range(80)])
    folder = Path(staging_root(spark).removeprefix("file:")) / "ticketloom"
    stood = set(folder.glob("*")) if folder.exists() else set()
    done = curate.fix_loop(spark, glob, str(tmp_path / "loop"))
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - stood if any(p.iterdir())}
    assert "in-ranges" in left
    assert not {"checked", "rejects", "part-lines", "fixes", "latest-fixes", "replacing", "rows-to-replace"} & left
    assert not list(folder.glob("run-*"))
    data = [p for p in (tmp_path / "loop").rglob("part-*") if "_manifest" not in str(p) and "manifest-" not in str(p)]
    assert data and all(p.name.endswith(".gz") for p in data)
    assert [r.raw for r in done.before.validated.orderBy("pos").collect()] == [raw for *_, raw in expected]
    rows = done.after.validated.orderBy("pos").collect()
    for built, reasons in ((done.before, {r.pos: r.reason for r in done.before.validated.collect()}), (done.after, {r.pos: r.reason for r in rows})):
        accepted = [r.ticket_id for r in built.validated.orderBy("pos").collect() if not reasons[r.pos]]
        again = lines.read_parts(spark, f"{built.clean_jsonl}/split=*/*").orderBy("pos").collect()
        assert [json.loads(r.raw)["ticket_id"] for r in again] == accepted
        assert sorted(r.ticket_id for r in tables.read_csv(spark, built.clean_csv).collect()) == sorted(accepted)
        assert len(lines.read_parts(spark, f"{built.rejected}/split=*/*").collect()) == sum(bool(r) for r in reasons.values())
    plain = curate.fix_loop(spark, glob, str(tmp_path / "plain"), compression="none")
    assert [(r.line, r.raw) for r in plain.after.validated.orderBy("pos").collect()] == [(r.line, r.raw) for r in rows]
    assert not list((tmp_path / "plain").rglob("*.gz"))
