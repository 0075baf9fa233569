"""Multi-file line scan with provenance: file, physical line number, total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ticketloom.functions.joins import lookup_join
from ticketloom.functions.text import strip_line
from ticketloom.session import stage, unstaged

# pos = file number * 2^37 + line: 2^26 files of 2^37 lines each fit a bigint
LINE_BITS = 37
RANGES = 64
SPLIT = "split"
#: So many files of fewer lines each, on average, are small: a folder for each would cost more than its lines.
MANY_FILES, FEW_LINES = 64, 1 << 14


def scan_lines(spark: SparkSession, glob: str | list[str]) -> DataFrame:
    """Stripped lines of all matching text files as ``(source, block, row_id, raw)``.

    ``row_id`` grows along each file split and is only meaningful once staged:
    add narrow columns if wanted, ``stage``, then ``number_lines``. ``source`` is
    the path as Spark writes it, with %-codes; numbered lines have it decoded.
    """
    return spark.read.text(glob).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
        strip_line(F.col("value")).alias("raw"),
    )


def decoded_path(path: Column) -> Column:
    """The path as a person writes it: ``_metadata.file_path`` has blanks and others as %-codes."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def position(file_no, line):
    return F.shiftleft(file_no, LINE_BITS) + line


def number_files(sources: DataFrame) -> DataFrame:
    """Give each ``source`` its number in the order of all paths, from 0 without gaps.

    Range partitions come sorted, so a file's number is its row in its partition
    plus the files of all partitions before: no task sees more than its range.
    """
    ranked = stage(
        sources.repartitionByRange(RANGES, "source")
        .sortWithinPartitions("source")
        .select("source", F.monotonically_increasing_id().alias("rank_id"))
        .select("source", F.shiftright("rank_id", 33).alias("range"), F.col("rank_id").bitwiseAND(2**33 - 1).alias("nth")),
        "ranked-files",
    )
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # one row a range
    before = ranked.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    return ranked.join(F.broadcast(before), "range").select("source", (F.col("before") + F.col("nth")).alias("file_no"))


def number_lines(
    staged: DataFrame, files: DataFrame | None = None, keep_split: bool = False, moved: list[str] | None = None
) -> DataFrame:
    """Turn ``(source, block, row_id)`` into ``source``, ``file_no``, ``line`` and ``pos``.

    Only per-split counts are shuffled; the rows themselves are joined to
    them (one row per 128 MB split, broadcast while that is proven small).
    ``files`` tells which part a file belongs to where a part has several:
    (file, part, ord), all paths decoded; else each file is a part.

    ``keep_split`` needs a staged table and adds ``split``: the place of a row's
    split, and of the piece of it that a task reads, among all of the input. It
    sorts like ``pos``, and a piece's rows come from one task in order. ``moved``
    gets a name if a join shuffled the rows, after which the latter no longer holds.
    Lines of many small files are dealt into ranges of ``pos`` first, which are splits then;
    that is a staged table of its own, and ``staged`` is deleted.
    """
    if keep_split and small_files(staged):
        dealt = in_ranges(number_lines(staged, files))
        unstaged(staged)
        return dealt
    if keep_split:
        staged = staged.select("*", F.col("_metadata.file_block_start").alias("piece"))
    splits = staged.groupBy("source", "block").agg(
        F.min("row_id").alias("first_id"), F.count("*").alias("n_lines")
    )
    splits = stage(splits.withColumn("file", decoded_path(F.col("source"))), "splits")
    if files is None:
        splits = splits.withColumns({"part": F.col("file"), "ord": F.lit(0)})
    else:
        splits = splits.join(files.select("file", "part", "ord"), "file")
    numbers = stage(number_files(splits.select(F.col("part").alias("source")).distinct()), "files")
    earlier = (
        Window.partitionBy("part").orderBy("ord", "block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        splits.withColumn("lines_before", F.coalesce(F.sum("n_lines").over(earlier), F.lit(0)))
        .join(numbers.withColumnRenamed("source", "part"), "part")
        .select(
            "source", "block", "part", "file_no",
            (F.col("lines_before") - F.col("first_id") + 1).alias("shift"),
            *([ordinal("file_no", "ord", "block").alias(SPLIT)] if keep_split else []),
        )
    )
    numbered = lookup_join(staged, offsets, ["source", "block"], "inner", "offsets", moved=moved)
    line = F.col("row_id") + F.col("shift")
    columns = {"line": line, "pos": position(F.col("file_no"), line), "source": F.col("part")}
    if keep_split:
        columns[SPLIT] = F.concat_ws("-", SPLIT, F.lpad(F.col("piece").cast("string"), 15, "0"))
    return numbered.withColumns(columns).drop("block", "row_id", "shift", "part", "piece")


def small_files(staged: DataFrame) -> bool:
    """Whether there are ``MANY_FILES`` or more with fewer than ``FEW_LINES`` lines on average."""
    n_files, n_lines = staged.agg(F.count_distinct("source"), F.count("*")).first()
    return n_files >= MANY_FILES and n_lines < n_files * FEW_LINES


def in_ranges(numbered: DataFrame) -> DataFrame:
    """Rows staged in ranges of ``pos``, with the place of the range and piece as ``split``."""
    ranged = numbered.repartitionByRange("pos").sortWithinPartitions("pos").withColumn("range", F.spark_partition_id())
    dealt = stage(ranged.withColumn(SPLIT, ordinal("range")).drop("range"), "in-ranges")
    piece = F.lpad(F.col("_metadata.file_block_start").cast("string"), 15, "0")
    return dealt.withColumn(SPLIT, F.concat_ws("-", SPLIT, piece))


def ordinal(*numbers: str) -> Column:
    """Numbers as one text that sorts as they do."""
    return F.concat_ws("-", *[F.lpad(F.col(n).cast("string"), 15, "0") for n in numbers])


def read_parts(spark: SparkSession, glob: str) -> DataFrame:
    """Non-blank lines of all parts as ``(source, raw, file_no, line, pos)``.

    Blank ones are dropped after numbering: numbers are physical.
    """
    return number_lines(stage(scan_lines(spark, glob), "lines")).where(F.col("raw") != "")
