"""Curation passes over clean tables, and the repair loop."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.fixed import REQUIRED_KEYS
from ticketloom.functions.fields import flatten_json, parse_json
from ticketloom.functions.rules import NOT_OBJECT, UNPARSEABLE
from ticketloom.functions.spans import json_string, patch_members
from ticketloom.operators.dedupe import vary_duplicates
from ticketloom.operators.enrich import LEVELS, postprocess
from ticketloom.operators.fixes import merge_fixes
from ticketloom.operators.quality import report
from ticketloom.operators.repair import repair_lines
from ticketloom.plans.build import Built, build, build_version, rejected
from ticketloom.session import prepare, shuffles_removed, stage, staging
from ticketloom.sources.lines import SPLIT, number_lines, read_parts, scan_lines
from ticketloom.sources.tables import in_order, project, reject_text, write_jsonl, write_ordered, write_report
from ticketloom.sources.taxonomy import built_in_remap, built_in_taxonomy, load_taxonomy
from ticketloom.sources.versions import listed, replace_parts, start


PLACE = ["source", "block", "row_id"]


def read_tickets(
    spark: SparkSession, glob: str, keep: tuple[str, ...] = (), keep_split: bool = False, moved: list[str] | None = None
) -> DataFrame:
    """Non-blank lines as typed columns with line numbers and ``pos``, ``split`` if asked for.

    The text is parsed in the scan; typed columns are staged, and whatever
    reads them again does so column by column. Unparseable lines have
    ``is_record`` false. ``keep`` names further columns of the parsed lines.
    """
    lines = scan_lines(spark, glob).withColumn("is_blank", F.col("raw") == "")
    typed = flatten_json(parse_json(lines), [*PLACE, "is_blank", *keep])
    numbered = number_lines(stage(typed, "tickets"), keep_split=keep_split, moved=moved)
    return numbered.where(~F.col("is_blank")).drop("is_blank")


@dataclass(frozen=True)
class Passed:
    """Where a pass wrote its lines and the lines it could not read, and how many those are."""

    lines: str
    rejected: str
    n_rejected: int


def patched_lines(after: DataFrame, keys: list[str]) -> DataFrame:
    """``(pos, split, json)``: lines with new members where a key differs from ``old_`` of it;
    a line without any difference stays as it is, byte for byte."""

    def text(key: str) -> Column:
        kind = after.schema[key].dataType.typeName()
        value = json_string(F.col(key)) if kind == "string" else F.col(key).cast("string")
        value = F.to_json(key, {"ignoreNullFields": "false"}) if kind in ("struct", "array") else value
        return F.when(~F.col(key).eqNullSafe(F.col(f"old_{key}")), F.coalesce(value, F.lit("null")))

    marked = after.select("pos", SPLIT, "raw", *[text(k).alias(k) for k in keys])
    same = F.coalesce(*[F.col(k) for k in keys]).isNull()
    patched = patch_members(F.col("raw"), {k: F.col(k) for k in keys})
    return marked.select("pos", SPLIT, F.when(same, F.col("raw")).otherwise(patched).alias("json"))


def run_pass(
    spark: SparkSession, glob: str, out: str, keys: list[str], change: Callable[[DataFrame, list[str]], DataFrame]
) -> Passed:
    """Change the members ``keys`` of every object and write all lines in input order.

    Lines that are no JSON object are written beside, as a build's rejects are.
    ``change`` tells in its second argument if it shuffled the lines.
    """
    with staging(spark):
        moved: list[str] = []
        lines = read_tickets(spark, glob, ("raw", "parse_ok"), keep_split=True, moved=moved)
        kept = [f"old_{k}" for k in keys]
        # what was read stands beside what becomes of it, so nothing is joined
        records = lines.where("is_record").withColumns({o: F.col(k) for o, k in zip(kept, keys, strict=True)})
        done = patched_lines(change(records, moved), keys)
        write_ordered(done, out, ["json"], "text", bool(moved))
        bad = lines.where(~F.col("is_record"))
        cause = F.when(F.col("parse_ok"), F.lit(NOT_OBJECT)).otherwise(F.lit(UNPARSEABLE))
        bad = bad.withColumn("reason", F.array(cause)).select("pos", SPLIT, reject_text().alias("json"))
        write_ordered(bad, f"{out}_rejected", ["json"], "text", bool(moved))
        return Passed(out, f"{out}_rejected", bad.count())


def postprocess_parts(spark: SparkSession, glob: str, out: str, mode: str = "spread") -> Passed:
    """Remap, recompute priority and enrich short texts of all parts."""
    prepare(spark)
    keys = [*LEVELS, "category_path", "labels_json", "priority", "description_ar"]
    return run_pass(spark, glob, out, keys, lambda df, moved: postprocess(df, built_in_remap(spark), mode))


def vary_parts(spark: SparkSession, glob: str, out: str, mode: str = "spread") -> Passed:
    """Tell repeated texts apart in all parts."""
    prepare(spark)
    return run_pass(spark, glob, out, ["description_ar"], lambda df, moved: vary_duplicates(df, mode, moved=moved))


def taxonomy_of(spark: SparkSession, path: str | None) -> DataFrame:
    return load_taxonomy(spark, path) if path else built_in_taxonomy(spark)


def report_parts(spark: SparkSession, glob: str, out: str | None = None, taxonomy_path: str | None = None) -> DataFrame:
    """Quality report of all parts as text lines; written if ``out`` is given."""
    prepare(spark)
    lines = report(read_tickets(spark, glob), taxonomy_of(spark, taxonomy_path))
    if out:
        write_report(lines, out)
    return lines


@dataclass(frozen=True)
class Looped:
    """The build before and after repair, and where the versions of the parts are."""

    before: Built
    after: Built
    store: str
    version: int


def fix_loop(
    spark: SparkSession, input_glob: str, out: str, taxonomy_path: str | None = None, profile: str = "code", compression: str = "gzip"
) -> Looped:
    """Build, repair what was rejected by rule, merge it into its parts and build again.

    Repaired rows stay with the part they were rejected in, so nothing is paired by
    name. Only parts with rejects are written anew, as a version in ``out``/parts. A
    rejected line without an id stays as it is, and its repaired row is a new one.

    A line is written up to five times, so files are compressed (``none``: they are not),
    and what only the merge reads is removed after it.
    """
    prepare(spark)
    store = f"{out}/parts"
    before = build(spark, input_glob, f"{out}/before", taxonomy_path, profile=profile, compression=compression)
    start(spark, store, listed(spark, input_glob))
    with staging(spark), shuffles_removed(spark):
        bad = stage(rejected(before.validated).select("source", "line", "raw"), "rejects")
        repaired = repair_lines(bad, taxonomy_of(spark, taxonomy_path), before.validated.select("ticket_id"))
        ticket = F.to_json(F.struct(*REQUIRED_KEYS), {"ignoreNullFields": "false"})
        fixes = repaired.select(F.col("source").alias("part"), "line", json_string(F.col("ticket_id")).alias("id_key"), ticket.alias("raw"))
        lines = before.validated.select(F.col("source").alias("part"), "line", "id_key", "raw")
        changed = stage(bad.select(F.col("source").alias("part")).distinct(), "changed")
        merged = merge_fixes(stage(lines.join(changed, "part", "left_semi"), "part-lines"), stage(fixes, "fixes"), ["raw"])
        version = replace_parts(spark, store, merged.select("part", "line", "raw"), compression)
    after = build_version(spark, store, f"{out}/after", taxonomy_path, profile, compression=compression)
    return Looped(before, after, store, version)


def repair_rejects(
    spark: SparkSession, rejects_glob: str, out: str, taxonomy_path: str | None = None, parts_glob: str | None = None
) -> None:
    """Repair rejected lines by rule and write them as a fixed part, in order.

    Ids made for lines without one differ from all in ``parts_glob``, if given.
    """
    prepare(spark)
    with staging(spark):
        lines = read_parts(spark, rejects_glob)
        taken = read_tickets(spark, parts_glob).select("ticket_id") if parts_glob else None
        fixed = stage(repair_lines(lines, taxonomy_of(spark, taxonomy_path), taken), "repaired")
        ordered = fixed.join(lines.select("source", "line", "pos"), ["source", "line"])
        write_jsonl(project(in_order(ordered)), out)
