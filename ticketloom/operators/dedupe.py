"""Exact duplicates: find, drop all but the first, or tell copies apart by a sentence.

A row is a repeat if an earlier one has its key. That is decided against the
group's smallest position: no window, so a text that fills a third of the
table is one aggregated row and not one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.fixed import OPERATING_SYSTEMS, REPEAT_SENTENCES, REPEAT_STAMP
from ticketloom.functions.joins import lookup_join
from ticketloom.functions.picks import choose, digest_number, digit_picks, whole_div
from ticketloom.functions.text import (
    code_point_sum,
    end_with_dot,
    key_hash,
    strip,
    text_or_empty,
)
from ticketloom.session import stage

TEXT_KEYS = ["title_ar", "description_ar"]
KEY = "text_key"


def trimmed_key(cols: Sequence[str] = TEXT_KEYS) -> Column:
    return key_hash(*[strip(text_or_empty(F.col(c))) for c in cols])


def repeated_groups(keyed: DataFrame, pos: str = "pos") -> DataFrame:
    """``(text_key, first_pos, copies)`` of keys that occur more than once."""
    return (
        keyed.groupBy(KEY)
        .agg(F.min(pos).alias("first_pos"), F.count("*").alias("copies"))
        .where("copies > 1")
    )


def duplicate_groups(df: DataFrame, pos: str = "pos") -> DataFrame:
    """Size and first position of each repeated trimmed (title, description)."""
    return repeated_groups(df.withColumn(KEY, trimmed_key()), pos)


def mark_repeats(df: DataFrame, key: Column, pos: str = "pos", moved: list[str] | None = None) -> DataFrame:
    """Add ``is_repeat``: an earlier row has the same key. ``moved`` as in ``lookup_join``."""
    keyed = df.withColumn(KEY, key)
    joined = lookup_join(keyed, repeated_groups(keyed, pos), KEY, "left", "repeated-texts", moved=moved)
    late = F.coalesce(F.col(pos) > F.col("first_pos"), F.lit(False))
    return joined.withColumn("is_repeat", late).drop(KEY, "first_pos", "copies")


def drop_duplicates(df: DataFrame, cols: Sequence[str] = TEXT_KEYS, pos: str = "pos") -> DataFrame:
    """Keep the first row of each key, texts compared untrimmed; the same rows every run."""
    marked = mark_repeats(df, key_hash(*[F.col(c) for c in cols]), pos)
    return marked.where(~F.col("is_repeat")).drop("is_repeat")


def seed_digest(ticket_id: Column, mode: str) -> Column:
    """Hex digest the picks are read from.

    ``spread`` hashes the id. ``sum`` hashes the sum of its code points, so
    ids with the same digits in another order draw alike.
    """
    if mode == "spread":
        return F.md5(text_or_empty(ticket_id))
    if mode == "sum":
        return F.md5(code_point_sum(ticket_id).cast("string"))
    raise ValueError(f"unknown mode {mode!r}")


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def repeat_tail(ticket_id: Column, mode: str) -> Column:
    """A remark and a stamp (time of day, floor, system) drawn from the ticket id."""
    return tail_of(digest_number(seed_digest(ticket_id, mode)))


def tail_of(number: Column) -> Column:
    """The remark and stamp that a number's digits name."""
    remark, hour, minute, floor, system = digit_picks(
        number, [len(REPEAT_SENTENCES), 24, 60, 6, len(OPERATING_SYSTEMS)]
    )
    stamp = F.format_string(
        REPEAT_STAMP,
        two_digits(hour),
        two_digits(minute),
        floor + 1,
        choose(OPERATING_SYSTEMS, system),
    )
    return F.concat_ws(" ", choose(REPEAT_SENTENCES, remark), stamp)


#: Different remarks with a stamp; a copy with a higher number gets two or more of them.
TAILS = len(REPEAT_SENTENCES) * 24 * 60 * 6 * len(OPERATING_SYSTEMS)
#: Has no factor in common with ``TAILS``, so neighbours differ and none repeats.
STRIDE = 39_119
CHUNK = 1 << 16


def copy_numbers(df: DataFrame, key: Column, pos: str = "pos") -> DataFrame:
    """``(pos, copy_no)`` of the later copies of each key, numbered from 1 in input order.

    A key's rows are counted in chunks of positions and numbered inside a chunk, so
    neither counting nor numbering holds more than a chunk of a key in one task;
    the counts of a key's chunks, one row for ``CHUNK`` positions, are added up.
    """
    marked = stage(df.select(key.alias(KEY), F.col(pos).alias("pos")), "keys")
    groups = repeated_groups(marked, "pos").select(KEY, "first_pos")
    chunk = F.shiftright("pos", int(math.log2(CHUNK)))
    late = lookup_join(marked, groups, KEY, "inner", "repeated-texts").where("pos > first_pos").withColumn("chunk", chunk)
    late = stage(late.drop("first_pos"), "copies")
    before = Window.partitionBy(KEY).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = late.groupBy(KEY, "chunk").agg(F.count("*").alias("n"))
    starts = counts.select(KEY, "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = late.withColumn("nth", F.row_number().over(Window.partitionBy(KEY, "chunk").orderBy("pos")))
    return within.join(starts, [KEY, "chunk"]).select("pos", (F.col("start") + F.col("nth")).alias("copy_no"))


def numbered_tail(copy_no: Column) -> Column:
    """Remarks and stamps that no other copy number has."""
    number = copy_no - 1
    more = whole_div(number, TAILS)
    most = whole_div(more - 1, TAILS)
    return F.concat_ws(
        " ",
        tail_of(number % TAILS * STRIDE % TAILS),
        F.when(more > 0, tail_of((more - 1) % TAILS)),
        F.when(most > 0, tail_of((most - 1) % TAILS)),
    )


def vary_duplicates(df: DataFrame, mode: str = "spread", pos: str = "pos", moved: list[str] | None = None) -> DataFrame:
    """Append a sentence to every later copy of a (title, description).

    ``spread`` and ``sum`` draw it from the ticket id, so in a large group some copies
    draw alike. ``numbered`` gives each copy of a text its own: one sentence for the
    first ``TAILS`` copies, more beyond.
    """
    if mode == "numbered":
        tails = copy_numbers(df, trimmed_key(), pos).withColumnRenamed("pos", pos)
        told = lookup_join(df, tails, pos, "left", "copy-numbers", moved=moved)
        own = F.concat_ws(" ", end_with_dot(text_or_empty(F.col("description_ar"))), numbered_tail(F.col("copy_no")))
        changed = F.when(F.col("copy_no").isNotNull(), own).otherwise(F.col("description_ar"))
        return told.withColumn("description_ar", changed).drop("copy_no")
    varied = F.concat_ws(
        " ",
        end_with_dot(text_or_empty(F.col("description_ar"))),
        repeat_tail(F.col("ticket_id"), mode),
    )
    text = F.when(F.col("is_repeat"), varied).otherwise(F.col("description_ar"))
    marked = mark_repeats(df, trimmed_key(), pos, moved)
    return marked.withColumn("description_ar", text).drop("is_repeat")


def residual_duplicates(df: DataFrame) -> DataFrame:
    """Duplicates that are left: groups, rows beyond the first, their share of all rows."""
    sizes = df.groupBy(trimmed_key().alias(KEY)).agg(F.count("*").alias("n"))
    extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return sizes.agg(
        F.count_if(F.col("n") > 1).alias("dup_groups"),
        extra.alias("dup_records"),
        F.round(F.coalesce(F.try_divide(100.0 * extra, F.sum("n")), F.lit(0.0)), 4).alias("pct"),
    )
