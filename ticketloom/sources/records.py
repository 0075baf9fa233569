"""Quoted CSV cut into records by many tasks, line ends inside quotes included.

A line with an even number of quotes leaves "inside a quoted field" as it was, an odd
one turns it around; doubled quotes don't matter. So the quotes of each split, counted in
parallel and summed over the splits before it, tell whether a split starts inside a
field. Splits without odd lines that start outside hold a record a line and are done
where they are. The lines of others are dealt by split and numbered there; only the
pieces at split ends, two a split at most, are put together across splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.functions.joins import lookup_join
from ticketloom.functions.text import is_blank
from ticketloom.session import stage

SPLIT = ["source", "block"]


def scan_quoted(spark: SparkSession, path: str) -> DataFrame:
    """Lines as they stand between line feeds, and whether their quotes are odd; staged."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return stage(
        text.select(
            F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row_id"), (quotes % 2).alias("odd"), F.col("value").alias("raw"),
        ),
        "csv-lines",
    )


def split_table(lines: DataFrame) -> DataFrame:
    """One row a split: whether it starts inside a field, if it needs cutting, and its file's header line."""
    filled = F.when(~is_blank(F.col("raw")), F.col("row_id"))
    counts = stage(
        lines.groupBy(*SPLIT).agg(
            F.sum("odd").alias("odd"), F.count("*").alias("n"), F.min("row_id").alias("first_id"), F.min(filled).alias("first_filled")
        ),
        "csv-splits",
    )
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source")
    header_block = F.min(F.when(F.col("first_filled").isNotNull(), F.col("block"))).over(whole)
    return counts.select(
        *SPLIT,
        (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_id") + 1).alias("shift"),
        F.when(F.col("block") == header_block, F.col("first_filled")).alias("header_id"),
        "odd",
    ).withColumn("plain", (F.col("odd") == 0) & (F.col("inside") == 0)).withColumnRenamed("odd", "odd_lines")


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(source, line, record, is_header)``: non-blank records with the line they start on.

    Line feeds and carriage returns inside quotes stay; a carriage return before the
    line feed that ends a record goes. ``is_header`` marks each file's first record.
    """
    lines = scan_quoted(spark, path)
    splits = stage(split_table(lines), "csv-starts")
    placed = lookup_join(lines, splits, SPLIT, "inner", "csv-starts").withColumns(
        {"line": F.col("row_id") + F.col("shift"), "is_header": F.coalesce(F.col("row_id") == F.col("header_id"), F.lit(False))}
    )
    single = placed.where("plain").select("source", "line", "raw", "is_header")
    cut = cut_records(placed.where("not plain"))
    whole = single.unionByName(cut)
    record = F.regexp_replace("raw", r"\r$", "")
    return whole.select("source", "line", record.alias("record"), "is_header").where(~is_blank(F.col("record")))


def cut_records(lines: DataFrame) -> DataFrame:
    """Records of splits with fields that hold line ends: (source, line, raw, is_header)."""
    upto = Window.partitionBy(*SPLIT).orderBy("row_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = (F.col("inside") + F.sum("odd").over(upto) - F.col("odd")) % 2 == 0
    begun = F.max(F.when(F.col("starts"), F.col("line"))).over(upto)
    numbered = lines.withColumn("starts", starts).withColumn("begun", begun)
    # the dealing by split serves this grouping too
    pieces = numbered.groupBy(*SPLIT, "begun").agg(
        F.array_sort(F.collect_list(F.struct("line", "raw"))).alias("lines"), F.max("is_header").alias("is_header")
    )
    joined = F.array_join(F.transform("lines", lambda x: x["raw"]), "\n")
    pieces = stage(pieces.select(*SPLIT, "begun", joined.alias("raw"), "is_header"), "csv-pieces")
    # a split's last record may go on in the next ones, whose first piece has no start of its own
    last = pieces.groupBy(*SPLIT).agg(F.max("begun").alias("last_begun"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = last.withColumn("carried", F.max("last_begun").over(before))
    known = lookup_join(pieces, ends, SPLIT, "inner", "csv-ends")
    at_end = F.col("begun").isNull() | F.col("begun").eqNullSafe(F.col("last_begun"))
    inner = known.where(~at_end).select("source", F.col("begun").alias("line"), "raw", "is_header")
    parts = known.where(at_end).withColumn("line", F.coalesce("begun", "carried"))
    spanning = parts.groupBy("source", "line").agg(
        F.array_sort(F.collect_list(F.struct("block", "raw"))).alias("blocks"), F.max("is_header").alias("is_header")
    )
    put = F.array_join(F.transform("blocks", lambda x: x["raw"]), "\n")
    return inner.unionByName(spanning.select("source", "line", put.alias("raw"), "is_header"))
