"""Merging repaired rows back into their parts (an upsert by part and id)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.joins import lookup_join
from ticketloom.session import stage

FIXED_SUFFIX = r"_fixed(?=\.jsonl$)"


def is_fix_part(part: Column) -> Column:
    return part.rlike(FIXED_SUFFIX)


def base_part(part: Column) -> Column:
    """``X_fixed.jsonl`` belongs to ``X.jsonl``."""
    return F.regexp_replace(part, FIXED_SUFFIX, "")


def pair_fixes(parts: DataFrame, fixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(paired, orphans)``: fixes renamed to their part, and those without one."""
    known = stage(parts.select("part").distinct(), "part-names")
    named = fixes.withColumn("fix_part", F.col("part")).withColumn("part", base_part(F.col("part")))
    paired = named.join(known, "part", "left_semi").drop("fix_part")
    orphans = named.join(known, "part", "left_anti").drop("part").withColumnRenamed("fix_part", "part")
    return paired, orphans


def last_fixes(fixes: DataFrame) -> DataFrame:
    """The last fix of each (part, id), with ``first_line``, where the id came first.

    Only line numbers are aggregated; the texts follow by a join on the
    unique (part, line).
    """
    chosen = (
        fixes.where(F.col("id_key").isNotNull())
        .groupBy("part", "id_key")
        .agg(F.max("line").alias("line"), F.min("line").alias("first_line"))
        .drop("id_key")
    )
    return lookup_join(fixes, chosen, ["part", "line"], "inner", "last-fixes")


def merge_fixes(
    parts: DataFrame, fixes: DataFrame, payload: Sequence[str], per_part: Sequence[str] = ()
) -> DataFrame:
    """Replace the first row of each fixed id and append fixes whose id is new.

    Both frames hold ``part``, ``line``, ``id_key`` and the payload columns;
    rows without a usable ``id_key`` (null) pass unchanged. Appended rows come
    after their part's end in the order the fixes were first seen.
    ``per_part`` names columns that are constant within a part and that
    appended rows take over. Adds ``is_fix``.

    The large side is joined once, on its unique (part, line), to the rows to
    replace, so a hot id never gathers in one task.
    """
    keys = ["part", "id_key"]
    latest = stage(
        last_fixes(fixes).select(*keys, "first_line", *[F.col(c).alias(f"fix_{c}") for c in payload]),
        "latest-fixes",
    )
    # combined per id before the join, so a hot id is one row; with few fixes
    # Catalyst pushes the broadcast semi join below the aggregate
    first_rows = stage(
        parts.groupBy(*keys)
        .agg(F.min("line").alias("line"))
        .join(latest.select(*keys), keys, "left_semi"),
        "rows-to-replace",
    )
    fix_columns = [f"fix_{c}" for c in payload]
    replacing = first_rows.join(latest, keys).select(
        "part", "line", F.lit(True).alias("is_fix"), *fix_columns
    )
    merged = lookup_join(parts, replacing, ["part", "line"], "left", "replacing", fixed_width=False)
    replaced = F.coalesce("is_fix", F.lit(False))
    kept = merged.select(
        "part",
        *per_part,
        "line",
        *[F.when(replaced, F.col(f"fix_{c}")).otherwise(F.col(c)).alias(c) for c in payload],
        replaced.alias("is_fix"),
    )
    ends = parts.groupBy("part").agg(
        F.max("line").alias("last_line"), *[F.first(c).alias(c) for c in per_part]
    )
    new = latest.join(first_rows, keys, "left_anti")
    appended = lookup_join(new, ends, "part", "inner", "part-ends").select(
        "part",
        *per_part,
        (F.col("last_line") + F.col("first_line")).alias("line"),
        *[F.col(f"fix_{c}").alias(c) for c in payload],
        F.lit(True).alias("is_fix"),
    )
    return kept.unionByName(appended)
