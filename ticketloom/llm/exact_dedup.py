"""Exact dedup by a tree-merge of sorted digest runs, in built-in expressions only.

Every scan partition starts a run of (digest, smallest id, rows): its entries
are combined before they are first shuffled, so a hot text leaves one entry a
run. Then come binomial rounds. In a round the runs whose numbers differ in one
digit (to the base ``FAN``) exchange entries: an entry goes to the run that has
the entry's own digest digit in that place. Entries are placed by run number, a
run a partition; there the arriving runs are sorted by digest and merged, and
each digest keeps its smallest id, without another exchange. After all digits
every digest lies in one run, and no run ever holds more than its share of the
digests: a hot text has ``FAN`` entries in an exchange of a run at most.

An entry is keyed by SHA-256, a second 64-bit hash and the length of the
normalised text, so every merge verifies that equal digests are equal texts.

Defined cases: a null text is empty; all empty and all-blank-free equal texts
are one group (blank runs are one space first). Among ids null comes last. Rows
that repeat an id with the same text are one document each: all count in
``group_size`` and ``dedup`` returns one of them. An empty table gives no rows.
Other columns are untouched whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.llm.common import BROADCAST_BYTES, narrow, ready
from ticketloom.session import stage

FAN = 4
KEY = ["digest", "second", "length"]


def normalised(text: str) -> Column:
    """Each run of ASCII white space is one space. Lone spaces need no change."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    rows = narrow(docs, id=id_col, norm=normalised(text))
    return rows.select(
        "id",
        F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest"),
        F.xxhash64("norm").alias("second"),
        F.octet_length("norm").alias("length"),
    )


def _digit(number: Column, place: int) -> Column:
    return F.floor(number / F.lit(FAN**place)) % FAN


def merged(entries: DataFrame) -> DataFrame:
    """Rows (id, digest, second, length) to one row for each text: ``keep``, ``rows``."""
    spark = entries.sparkSession
    places, runs = 1, FAN
    while runs < int(spark.conf.get("spark.sql.shuffle.partitions")):
        places, runs = places + 1, runs * FAN
    home = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("bigint") % runs
    merge = [F.min("keep").alias("keep"), F.sum("rows").alias("rows")]
    started = entries.select(
        *KEY,
        F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id")).alias("keep"),
        F.lit(1).cast("bigint").alias("rows"),
        (F.spark_partition_id() % runs).cast("bigint").alias("run"),
    )
    state = started.groupBy("run", *KEY).agg(*merge)
    for place in range(places):
        to = F.col("run") + (_digit(home, place) - _digit(F.col("run"), place)) * FAN**place
        placed = state.withColumn("run", to.cast("int")).repartitionById(runs, "run")
        state = placed.groupBy("run", *KEY).agg(*merge)
    return state.select(*KEY, F.col("keep.id").alias("keep_id"), F.col("rows").alias("group_size"))


def decide(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    ready(docs.sparkSession)
    entries = stage(digests(docs, id_col, text), "dedup-digests")
    groups = stage(merged(entries).where("group_size > 1"), "dedup-groups")
    return entries.join(groups, KEY, "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (F.col("group_size").isNull() | F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts one row, that of the smallest id.

    Texts never move: the losing (id, digest) pairs meet the rows in the scan as
    long as their counted size allows it, and shuffle beyond. Only rows whose id
    and text both repeat are dealt by id, to leave one of them.
    """
    ready(docs.sparkSession)
    entries = stage(digests(docs, id_col, text), "dedup-digests")
    groups = stage(merged(entries).where("group_size > 1"), "dedup-groups")
    members = entries.join(groups, KEY).select("id", "digest", "keep_id")
    losers = stage(members.where(~F.col("id").eqNullSafe(F.col("keep_id"))).select("id", "digest").distinct(), "dedup-losers")
    again = stage(members.groupBy("id", "digest").count().where("count > 1").select("id", "digest"), "dedup-again")
    digest = F.unhex(F.sha2(normalised(text).cast("binary"), 256))
    flagged = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), digest.alias("digest"))
    stays = _match(flagged, losers, "left_anti")
    if again.isEmpty():
        return stays.select("row.*")
    first = W.partitionBy("id", "digest").orderBy(F.lit(1))
    once = _match(stays, again, "left_anti")
    repeated = _match(stays, again, "left_semi").withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")
    return once.unionByName(repeated).select("row.*")


def _match(rows: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    marks = marks.select(F.col("id").alias("mark_id"), F.col("digest").alias("mark_digest"))
    if marks.count() * 64 <= BROADCAST_BYTES:
        marks = F.broadcast(marks)
    return rows.join(marks, F.col("id").eqNullSafe(F.col("mark_id")) & (F.col("digest") == F.col("mark_digest")), how)
