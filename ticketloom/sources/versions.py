"""Versions of a set of parts: which files make up each part, and which version counts.

A store is a folder with a table of files for each version, the new files of that
version, and a pointer that is swapped last. Inputs are never changed and never copied:
a version lists the files of parts that did not change and new ones of those that did.
Readers open the listed files only. A run that dies before the swap leaves the version
before it in force.

    CURRENT                 the number of the version in force
    manifest-00000002/      (part, ord, file, rows, version), a row for each file
    lines-00000002/         the parts rewritten for version 2, a folder each
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.functions.joins import lookup_join
from ticketloom.session import stage
from ticketloom.sources.lines import decoded_path, scan_lines

MANIFEST = "part string, ord int, file string, rows bigint, version int"
POINTER = "CURRENT"
# fixed value: characters that Spark would take for a pattern in a path
PATTERN = "\\[]{}*?,"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def current(spark: SparkSession, store: str) -> int:
    """The version in force; 0 for a store that has none."""
    system, path = _files(spark, f"{store}/{POINTER}")
    if not system.exists(path):
        return 0
    stream = system.open(path)
    try:
        return int(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def point_to(spark: SparkSession, store: str, version: int) -> None:
    """Put a version in force by one rename over the pointer."""
    jvm = spark._jvm
    system, path = _files(spark, f"{store}/{POINTER}")
    _, fresh = _files(spark, f"{store}/{POINTER}-{uuid.uuid4().hex}")
    stream = system.create(fresh, True)
    try:
        stream.write(bytearray(str(version).encode()))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(fresh), system.makeQualified(path), options)


def manifest(spark: SparkSession, store: str, version: int | None = None) -> DataFrame:
    """The files of a version, that in force unless named."""
    number = current(spark, store) if version is None else version
    return spark.read.schema(MANIFEST).json(f"{store}/manifest-{number:08d}")


def _commit(spark: SparkSession, store: str, files: DataFrame, version: int) -> int:
    files.write.mode("overwrite").json(f"{store}/manifest-{version:08d}")
    point_to(spark, store, version)
    return version


def listed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The files that paths match as ``file``, decoded; their content is not read."""
    names = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("path"))
    return names.select(decoded_path(F.col("path")).alias("file")).distinct()


def start(spark: SparkSession, store: str, files: DataFrame) -> int:
    """A new version whose parts are ``file`` as they stand; rows are not counted yet (null)."""
    version = current(spark, store) + 1
    rows = files.select(
        F.col("file").alias("part"), F.lit(0).alias("ord"), "file",
        F.lit(None).cast("bigint").alias("rows"), F.lit(version).alias("version"),
    )
    return _commit(spark, store, rows, version)


def literal(path: str) -> str:
    """A path as one that no pattern is read into."""
    return "".join(f"\\{c}" if c in PATTERN else c for c in path)


def paths_of(files: DataFrame) -> list[str]:
    """File names, which any reader of them lists on the driver too."""
    return [literal(r.file) for r in files.select("file").distinct().collect()]


def scan(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Lines of the files of a manifest, as ``scan_lines``; number them with ``files``."""
    paths = paths_of(files)
    return scan_lines(spark, paths) if paths else spark.createDataFrame([], "source string, block bigint, row_id bigint, raw string")


def replace_parts(spark: SparkSession, store: str, lines: DataFrame, compression: str = "none") -> int:
    """A new version with other lines ``(part, line, raw)`` for some parts.

    Only these are written, in ranges of (part, line), so a large part spans many
    tasks and files, compressed or not. Parts are told apart by a number in folder names.
    """
    version = current(spark, store) + 1
    before = manifest(spark, store)
    changed = stage(lines.select("part").distinct().withColumn("part_no", F.monotonically_increasing_id()), "changed-parts")
    folder = f"{store}/lines-{version:08d}"
    numbered = lookup_join(lines, changed, "part", "inner", "part-numbers", fixed_width=False)
    ordered = numbered.repartitionByRange("part_no", "line").sortWithinPartitions("part_no", "line")
    ordered.select("part_no", "raw").write.mode("overwrite").partitionBy("part_no").text(folder, compression=compression)
    place = F.col("_metadata.file_path")
    counted = spark.read.text(folder).select(place.alias("path"), F.col("part_no").cast("bigint").alias("part_no"))
    # files of a part sort by the number of the range they hold
    within = Window.partitionBy("part_no").orderBy("path")
    new = (
        counted.groupBy("path", "part_no").agg(F.count("*").alias("rows"))
        .withColumn("ord", F.row_number().over(within) - 1)
        .join(changed, "part_no")
        .select("part", "ord", decoded_path(F.col("path")).alias("file"), "rows", F.lit(version).alias("version"))
    )
    kept = before.join(changed.select("part"), "part", "left_anti")
    return _commit(spark, store, stage(kept.unionByName(new), "manifest"), version)
