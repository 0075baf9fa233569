"""Queries that write the given tables as files, run whole file plans on them, and read the result.

Rows come back with ``nth``, their number among all lines in file order, so that
order is compared too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.queries import flat, query
from checks.views import all_tickets, document_tickets, json_lines, table
from ticketloom.fixed import REQUIRED_KEYS
from ticketloom.functions.fields import flatten_json, parse_json
from ticketloom.functions.picks import whole_div
from ticketloom.operators import synth
from ticketloom.plans import build, curate
from ticketloom.session import shuffles_removed, stage_path
from ticketloom.sources import lines, tables, versions
from ticketloom.sources.taxonomy import built_in_taxonomy

PART_LINES = 200


def written_lines(rows: DataFrame, *order: Column) -> str:
    """The texts ``raw`` as files that are in order one after the other; gives their pattern."""
    path = stage_path(rows.sparkSession, "parts")
    keyed = rows.select("raw", *[c.alias(f"o{n}") for n, c in enumerate(order)])
    keys = [f"o{n}" for n in range(len(order))]
    keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("raw").write.text(path)
    return f"{path}/part-*"


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """``(nth, raw)``: lines of a written output, numbered over all its files from 1."""
    parts = lines.read_parts(spark, f"{path}/{lines.SPLIT}=*/*")
    # one row a file
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("file_no").agg(F.max("line").alias("n")).select(
        "file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    return parts.join(starts, "file_no").select((F.col("before") + F.col("line")).alias("nth"), "raw")


def typed(lines_in: DataFrame, *keep: str) -> DataFrame:
    return flatten_json(parse_json(lines_in), list(keep)).select(*keep, *REQUIRED_KEYS)


def built(spark: SparkSession, sf_dir: str) -> build.Built:
    pattern = written_lines(json_lines(spark, sf_dir), F.col("pos"))
    return build.build(spark, pattern, stage_path(spark, "built"))


@query
def build_clean_lines(spark, sf_dir):
    """Clean lines of a build over several files, in the order they were written."""
    return flat(typed(read_back(spark, built(spark, sf_dir).clean_jsonl), "nth"))


@query
def build_clean_csv(spark, sf_dir):
    """The CSV of a build, nested columns as JSON text."""
    return tables.read_csv(spark, built(spark, sf_dir).clean_csv)


@query
def build_reject_lines(spark, sf_dir):
    """Rejects of a build in order, with the line's own text."""
    parsed = parse_json(read_back(spark, built(spark, sf_dir).rejected))
    member = "try_variant_get(parsed, '$.{}', '{}')"
    return parsed.select(
        "nth",
        F.array_join(F.expr(member.format("reason", "array<string>")), ",").alias("reason"),
        F.expr(member.format("ticket.ticket_id", "string")).alias("ticket_id"),
        F.expr(member.format("ticket.description_ar", "string")).alias("description_ar"),
    )


def ticket_lines(spark: SparkSession, sf_dir: str) -> str:
    """All tickets as lines, documents first; every 97th document is followed by a broken line."""
    tickets = all_tickets(spark, sf_dir)
    late = (F.col("dialect") == "chat").cast("int")
    raw = F.to_json(F.struct(*REQUIRED_KEYS), {"ignoreNullFields": "false"})
    whole = tickets.select(late.alias("late"), "pos", F.lit(0).alias("broken"), raw.alias("raw"))
    broken = whole.where("late = 0 and pos % 97 = 0").withColumns({"broken": F.lit(1), "raw": F.concat(F.lit("{"), "raw")})
    return written_lines(whole.unionByName(broken), F.col("late"), F.col("pos"), F.col("broken"))


@query
def pass_postprocess_lines(spark, sf_dir):
    """Post-processing of files: every line that is a ticket, patched where it stands, in order."""
    out = stage_path(spark, "passed")
    curate.postprocess_parts(spark, ticket_lines(spark, sf_dir), out)
    return flat(typed(read_back(spark, out), "nth"))


@query
def pass_vary_lines(spark, sf_dir):
    """Repeated texts of files told apart, in order."""
    raw = F.to_json(F.struct(*REQUIRED_KEYS))
    pattern = written_lines(document_tickets(spark, sf_dir).select("pos", raw.alias("raw")), F.col("pos"))
    out = stage_path(spark, "passed")
    curate.vary_parts(spark, pattern, out)
    return typed(read_back(spark, out), "nth").select("nth", "ticket_id", "description_ar")


def lines_in_parts(spark: SparkSession, sf_dir: str) -> str:
    """Raw lines with their flaws as parts of ``PART_LINES`` documents, a file each."""
    path = stage_path(spark, "parts")
    part = F.lpad(whole_div(F.col("pos"), PART_LINES).cast("string"), 9, "0")
    numbered = json_lines(spark, sf_dir).select(part.alias("part"), "pos", "raw")
    ordered = numbered.repartition("part").sortWithinPartitions("part", "pos").select("part", "raw")
    with shuffles_removed(spark):
        ordered.write.partitionBy("part").text(path, compression="gzip")
    return f"{path}/part=*/*"


@query
def fix_loop(spark, sf_dir):
    """Reject, repair, merge into the parts and build again: every line with what became of it.

    Ids made for lines without one come from where the file lies, and are shown as "made".
    """
    done = curate.fix_loop(spark, lines_in_parts(spark, sf_dir), stage_path(spark, "loop"))
    rows = done.after.validated
    part = F.regexp_extract("source", r"part=(\d+)/", 1).cast("bigint")
    own = F.when(F.length("ticket_id") > 12, F.lit("made")).otherwise(F.col("ticket_id"))
    return rows.select(
        part.alias("part"), "line", own.alias("ticket_id"), F.array_join("reason", ",").alias("reason"),
        "parse_ok", "description_ar", "channel", "priority",
    )


@query
def fix_loop_versions(spark, sf_dir):
    """Lines of each part by the manifest of the version that the loop put in force, and files unchanged since."""
    done = curate.fix_loop(spark, lines_in_parts(spark, sf_dir), stage_path(spark, "loop"))
    files = versions.manifest(spark, done.store)
    part = F.regexp_extract("part", r"part=(\d+)/", 1).cast("bigint")
    return files.groupBy(part.alias("part")).agg(F.sum("rows").alias("n_lines"), F.max("version").alias("version"))


@query
def synthesize_file(spark, sf_dir):
    """As many tickets as there are documents, written as lines and read again."""
    path = stage_path(spark, "batch")
    synth.write_batch(spark, built_in_taxonomy(spark), path, table(spark, sf_dir, "documents").count())
    return flat(tables.read_jsonl(spark, path))
