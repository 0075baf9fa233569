"""Reading and writing ticket tables: JSON lines, CSV, rejects, report text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ticketloom.fixed import REQUIRED_KEYS, SCALE_KEYS
from ticketloom.functions.fields import LABELS_TYPE
from ticketloom.sources.lines import SPLIT, ordinal
from ticketloom.sources.records import records

CSV_SCHEMA = ", ".join(
    f"{key} {'int' if key in SCALE_KEYS else 'string'}" for key in REQUIRED_KEYS
)
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def project(df: DataFrame) -> DataFrame:
    """The canonical column order; columns the frame lacks are left out."""
    return df.select(*[c for c in REQUIRED_KEYS if c in df.columns])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A ticket CSV with header and quoted multi-line texts; tags and labels stay text.

    A file is read by as many tasks as it has splits, line ends in quotes or not.
    Quotes in a field must be doubled and the field quoted, as CSV writers do.
    """
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV_OPTIONS.items() if k != "header"}
    rows = records(spark, path).where("not is_header")
    # with multiLine the parser leaves line ends in quotes as they are
    return rows.select(F.from_csv("record", CSV_SCHEMA, {**options, "multiLine": "true"}).alias("row")).select("row.*")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Typed ticket rows of JSON lines that are known to be clean."""
    kinds = {**{k: "int" for k in SCALE_KEYS}, "tags": "array<string>", "labels_json": LABELS_TYPE}
    schema = ", ".join(f"{k} {kinds.get(k, 'string')}" for k in REQUIRED_KEYS)
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def flatten_nested(df: DataFrame) -> DataFrame:
    """``tags`` and ``labels_json`` as JSON text."""
    nested = {c: F.to_json(c) for c in ("tags", "labels_json") if c in df.columns}
    return df.withColumns(nested)


def in_order(df: DataFrame, pos: str = "pos") -> DataFrame:
    """Rows in the order of ``pos`` over all files that are written of them.

    Ranges are dealt by sampling ``df``, which is evaluated twice: stage costly ones.
    """
    return df.repartitionByRange(pos).sortWithinPartitions(pos)


def by_split(df: DataFrame, moved: bool) -> DataFrame:
    """Rows ready to be written in input order, a folder for each ``split``.

    A split's rows are in order already and in one task, so wide rows stay where they
    are. Only where a join ``moved`` them are they dealt into ranges, which are folders then.
    """
    if moved or SPLIT not in df.columns:
        dealt = df.drop(SPLIT).repartitionByRange("pos")
        df = dealt.withColumn("range", F.spark_partition_id()).withColumn(SPLIT, ordinal("range")).drop("range")
    # not nullable, or the writer sorts by folder once more and may lose the order within
    return df.withColumn(SPLIT, F.coalesce(SPLIT, F.lit(""))).sortWithinPartitions(SPLIT, "pos")


def write_ordered(df: DataFrame, path: str, columns: list[str], kind: str, moved: bool = False, **options) -> None:
    """Write columns of rows with ``pos`` so that the files, sorted by path, are in order.

    Below ``path`` there is a folder for each split that has rows, and in
    ``_manifest`` what each folder holds: rows, and first and last position.
    """
    ordered = by_split(df, moved).select(SPLIT, *columns)
    writer: DataFrameWriter = ordered.write.mode("overwrite").partitionBy(SPLIT).options(**options)
    writer.format(kind).save(path)
    if SPLIT in df.columns and not moved:
        held = df.groupBy(SPLIT).agg(
            F.count("*").alias("rows"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos")
        )
        held.write.mode("overwrite").json(f"{path}/_manifest")


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """Lines that ``write_ordered`` wrote as text, with the ``folder`` they stand in."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), f"/{SPLIT}=([^/]+)/", 1)
    return spark.read.option("recursiveFileLookup", True).text(path).select(folder.alias("folder"), F.col("value").alias("raw"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, UTF-8, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_text(df: DataFrame, path: str, text: str = "json") -> None:
    """Lines that are JSON text already."""
    df.select(text).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """The 18 columns in order, nested ones as JSON text."""
    flatten_nested(project(df)).write.mode("overwrite").csv(path, emptyValue="", **CSV_OPTIONS)


def write_version(lines: DataFrame, path: str) -> None:
    """A new version of parts ``(part, line, raw)``: one folder per part, lines in order.

    Range partitions keep the order across the files of a part, so a scan of
    ``path/*`` numbers the lines as they stand. A large part spans many tasks.
    """
    ordered = lines.repartitionByRange("part", "line").sortWithinPartitions("part", "line")
    ordered.select("part", "raw").write.mode("overwrite").partitionBy("part").text(path)


def reject_text() -> Column:
    """``{source, line, reason, ticket | raw}`` as one JSON text.

    The ticket is the original text, byte for byte. Needs ``raw``,
    ``parse_ok``, ``source``, ``line`` and ``reason``.
    """
    head = F.to_json(F.struct("source", "line", "reason"))
    opened = F.substring(head, F.lit(1), F.length(head) - 1)
    as_text = F.to_json(F.struct("raw"))
    return F.when(F.col("parse_ok"), F.concat(opened, F.lit(',"ticket":'), F.col("raw"), F.lit("}"))).otherwise(
        F.concat(opened, F.lit(","), F.substring(as_text, F.lit(2), F.length(as_text)))
    )


def reject_json(rejected: DataFrame) -> DataFrame:
    """One JSON text per rejected line."""
    return rejected.select(reject_text().alias("json"))


def write_rejects(rejected: DataFrame, path: str) -> None:
    """Write rejects; without any, a stale earlier listing is replaced by an empty one."""
    write_json_text(reject_json(rejected), path)


def write_report(report: DataFrame, path: str) -> None:
    """Report text in one file. A report holds some hundred lines whatever the data's size."""
    report.orderBy("ord").select("text").coalesce(1).write.mode("overwrite").text(path)
