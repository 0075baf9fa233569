"""Build: raw parts in, clean JSON lines, clean CSV and rejects out."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.fixed import REQUIRED_KEYS, SCALE_KEYS
from ticketloom.functions.fields import flatten_json, parse_json
from ticketloom.functions.rules import clean_tags, expected_priority
from ticketloom.functions.spans import patch_members
from ticketloom.operators.fixes import base_part, is_fix_part, merge_fixes, pair_fixes
from ticketloom.operators.validate import accepted_rows, check_json_rows, rejected_listing, resolve
from ticketloom.session import prepare, stage
from ticketloom.sources.lines import SPLIT, decoded_path, number_lines, position, scan_lines
from ticketloom.sources.tables import CSV_OPTIONS, flatten_nested, reject_text, write_ordered
from ticketloom.sources.taxonomy import built_in_taxonomy, load_taxonomy
from ticketloom.sources.versions import listed, manifest, paths_of, replace_parts, scan, start


@dataclass(frozen=True)
class Built:
    """Validated lines and where the outputs went."""

    validated: DataFrame
    clean_jsonl: str
    clean_csv: str
    rejected: str


def checked_lines(lines: DataFrame, taxonomy: DataFrame, profile: str) -> DataFrame:
    """Parse and check each line, once: provenance, text, typed columns, id and codes."""
    return check_json_rows(parse_json(lines), taxonomy, profile).drop("parsed", "keys")


def place(df: DataFrame) -> list[str]:
    return [c for c in ("pos", SPLIT) if c in df.columns]


def clean_json(validated: DataFrame) -> DataFrame:
    """``(pos, json)`` of accepted lines, ``split`` too if there is one.

    The line as it is, byte for byte, unless its priority was repaired or its
    tags need trimming; then only those two values are new.
    """
    accepted = validated.where(F.size("reason") == 0)
    priority = F.when(F.col("autofix"), expected_priority(F.col("impact"), F.col("urgency")).cast("string"))
    trimmed = F.when(~F.col("tags").eqNullSafe(clean_tags(F.col("tags"))), F.to_json(clean_tags(F.col("tags"))))
    rows = accepted.select(*place(validated), "raw", priority.alias("new_priority"), trimmed.alias("new_tags"))
    changed = patch_members(F.col("raw"), {"priority": F.col("new_priority"), "tags": F.col("new_tags")})
    same = F.col("new_priority").isNull() & F.col("new_tags").isNull()
    return rows.select(*place(validated), F.when(same, F.col("raw")).otherwise(changed).alias("json"))


def clean_rows(validated: DataFrame) -> DataFrame:
    """Typed columns of accepted lines as ``clean_json`` writes them, without reading it again."""
    scales = {k: F.col(k).cast("int") for k in SCALE_KEYS}
    return accepted_rows(validated.withColumns(scales)).select(*place(validated), *REQUIRED_KEYS)


def typed_lines(lines: DataFrame) -> DataFrame:
    """Typed ticket columns of JSON text lines ``raw``; ``pos`` stays if there is one."""
    kept = place(lines)
    return flatten_json(parse_json(lines), kept).select(*kept, *REQUIRED_KEYS)


def with_id_key(lines: DataFrame) -> DataFrame:
    """Add ``id_key``, the id as JSON text: null where a line has none to go by.

    A part's object without the key matches a null id; a fix without it is dropped.
    """
    parsed = parse_json(lines)
    written = F.expr("to_json(try_variant_get(parsed, '$.ticket_id', 'variant'))")
    in_part = F.when(F.col("keys").isNotNull(), F.coalesce(written, F.lit("null")))
    key = F.when(is_fix_part(F.col("part")), written).otherwise(in_part)
    return parsed.withColumn("id_key", key).drop("parsed", "keys", "parse_ok")


def scan_with_fixes(spark: SparkSession, inputs: str | list[str], fixes: str | list[str]) -> DataFrame:
    """Lines of both, each file once; ``in_input`` tells by which a file came."""
    by_input, by_fixes = listed(spark, inputs), listed(spark, fixes)
    only_fixes = by_fixes.join(by_input, "file", "left_anti")
    extra = scan_lines(spark, fixes).withColumn("file", decoded_path(F.col("source")))
    extra = extra.join(only_fixes, "file", "left_semi").drop("file")
    return (
        scan_lines(spark, inputs).withColumn("in_input", F.lit(True))
        .unionByName(extra.withColumn("in_input", F.lit(False)))
    )


def apply_fixes(lines: DataFrame) -> DataFrame:
    """Merge ``X_fixed.jsonl`` lines into ``X.jsonl``; returns the new version of all lines.

    The source files stay as they are. Fixed parts without an original remain
    parts if they came with the input.
    """
    keyed = stage(with_id_key(lines.withColumnRenamed("source", "part")), "fix-lines")
    is_fix = is_fix_part(F.col("part"))
    parts = keyed.where(~is_fix)
    paired, orphans = pair_fixes(parts, keyed.where(is_fix))
    merged = merge_fixes(parts, paired, ["raw"], ["file_no"])
    rest = orphans.where("in_input").select(
        "part", "file_no", "line", "raw", F.lit(False).alias("is_fix")
    )
    return (
        merged.unionByName(rest)
        .withColumnRenamed("part", "source")
        .withColumn("pos", position(F.col("file_no"), F.col("line")))
    )


def fixed_version(spark: SparkSession, store: str, input_glob: str, fixes_glob: str) -> int:
    """A new version of the input's parts in ``store``, with the fixes of ``fixes_glob`` merged.

    Only parts that have fixes are read and written. Fixes are files named
    ``X_fixed.jsonl``; those whose ``X.jsonl`` is no input are left out with a warning,
    or are plain parts if they belong to the input themselves.
    """
    inputs = stage(listed(spark, input_glob), "input-files")
    given = stage(listed(spark, fixes_glob).unionByName(inputs.where(is_fix_part(F.col("file")))).distinct(), "fix-files")
    fixes = given.where(is_fix_part(F.col("file"))).withColumn("base", base_part(F.col("file")))
    originals = inputs.where(~is_fix_part(F.col("file"))).select(F.col("file").alias("base"))
    paired = stage(fixes.join(originals, "base", "left_semi"), "paired-fixes")
    version = start(spark, store, inputs.join(paired, "file", "left_anti"))
    unused = given.join(paired, "file", "left_anti").join(inputs, "file", "left_anti").limit(20).collect()
    if unused:
        warnings.warn(f"fixes without a part to fix: {sorted(r.file for r in unused)}", stacklevel=2)
    changed = paths_of(paired.select(F.col("base").alias("file")))
    if not changed:
        return version
    scanned = stage(scan_with_fixes(spark, changed, paths_of(paired)), "lines")
    merged = apply_fixes(number_lines(scanned).where(F.col("raw") != ""))
    return replace_parts(spark, store, merged.select(F.col("source").alias("part"), "line", "raw"))


def checked_parts(
    spark: SparkSession,
    lines: DataFrame,
    taxonomy: DataFrame,
    files: DataFrame | None = None,
    profile: str = "code",
    moved: list[str] | None = None,
) -> DataFrame:
    """Every non-blank line with its place, typed columns and row codes, staged once.

    The text is parsed and checked in the scan itself, and line numbers are added
    to the staged rows.
    """
    staged = stage(checked_lines(lines, taxonomy, profile), "checked")
    return number_lines(staged, files, keep_split=True, moved=moved).where(F.col("raw") != "")


def build(
    spark: SparkSession,
    input_glob: str,
    out_dir: str,
    taxonomy_path: str | None = None,
    fixes_glob: str | None = None,
    profile: str = "code",
    compression: str = "none",
) -> Built:
    """Validate all parts and write the clean set and the rejects below ``out_dir``.

    ``fixes_glob`` names repaired parts to merge first; the merged version of the
    parts stays in ``out_dir``/parts. Outputs are in input order. Only (id, position)
    pairs for the duplicate check are shuffled: lines are written by the tasks that
    read them, a folder a split, as long as the repeated ids are few enough to send
    to every task. ``compression`` is a text writer's (none, gzip), for all outputs.
    """
    prepare(spark)
    if fixes_glob is None:
        return build_lines(spark, scan_lines(spark, input_glob), out_dir, taxonomy_path, profile, compression=compression)
    fixed_version(spark, f"{out_dir}/parts", input_glob, fixes_glob)
    return build_version(spark, f"{out_dir}/parts", out_dir, taxonomy_path, profile, compression=compression)


def build_version(
    spark: SparkSession, store: str, out_dir: str, taxonomy_path: str | None = None, profile: str = "code", version: int | None = None,
    compression: str = "none",
) -> Built:
    """``build`` over the parts of a version in ``store``, that in force unless named."""
    prepare(spark)
    files = manifest(spark, store, version)
    return build_lines(spark, scan(spark, files), out_dir, taxonomy_path, profile, files, compression)


def build_lines(
    spark: SparkSession, lines: DataFrame, out_dir: str, taxonomy_path: str | None, profile: str, files: DataFrame | None = None,
    compression: str = "none",
) -> Built:
    taxonomy = load_taxonomy(spark, taxonomy_path) if taxonomy_path else built_in_taxonomy(spark)
    moved: list[str] = []
    validated = resolve(checked_parts(spark, lines, taxonomy, files, profile, moved), moved)
    built = Built(validated, f"{out_dir}/clean_jsonl", f"{out_dir}/clean_csv", f"{out_dir}/rejected")
    write_ordered(clean_json(validated), built.clean_jsonl, ["json"], "text", bool(moved), compression=compression)
    csv = {**CSV_OPTIONS, "emptyValue": "", "compression": compression}
    write_ordered(flatten_nested(clean_rows(validated)), built.clean_csv, REQUIRED_KEYS, "csv", bool(moved), **csv)
    bad = rejected(validated)
    write_ordered(bad.select(*place(bad), reject_text().alias("json")), built.rejected, ["json"], "text", bool(moved), compression=compression)
    return built


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("reason") > 0)


def listing(built: Built) -> DataFrame:
    """Id (or place) and causes of every rejected line."""
    return rejected_listing(rejected(built.validated))
