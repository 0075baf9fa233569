"""Profile tables: overview, gaps, frequencies, balance, crosstabs, duplicates, tags.

Nulls are left out of frequencies here; the quality report counts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.operators import lengths
from ticketloom.operators.facts import PREFIX, gathered, hash_of, length_of
from ticketloom.session import stage

LEVELS = ["category_level_1", "category_level_2", "category_level_3"]


def overview(df: DataFrame, id_col: str = "ticket_id", classes: Sequence[str] = LEVELS) -> DataFrame:
    """``(metric, value)``: rows, columns, ids, repeated ids, distinct classes.

    Distinct values come from plain group counts, so nothing is expanded once
    per distinct aggregate.
    """
    ids = df.groupBy(id_col).agg(F.count("*").alias("n"))
    totals = ids.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        F.count(id_col).alias("unique_ids"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_ids"),
    )
    combos = df.select(*classes).distinct()
    distinct = combos.agg(*[F.count_distinct(c).alias(f"classes_{c}") for c in classes])
    return long_table(totals).unionByName(long_table(distinct))


def long_table(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "metric", "value")


def missing_by_column(df: DataFrame) -> DataFrame:
    """Null count and percent of every column, worst first; one aggregate for all."""
    gaps = df.agg(
        F.count("*").alias("__total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    share = F.coalesce(F.try_divide(100.0 * F.col("n_missing"), F.col("__total")), F.lit(0.0))
    return (
        gaps.unpivot(["__total"], df.columns, "column", "n_missing")
        .select("column", "n_missing", F.round(share, 2).alias("pct_missing"))
        .orderBy(F.desc("n_missing"), "column")
    )


def class_counts(df: DataFrame, col: str) -> DataFrame:
    return (
        df.select(F.col(col).alias("value")).where("value is not null")
        .groupBy("value").agg(F.count("*").alias("n"))
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return class_counts(df, col).orderBy(F.desc("n"), "value")


def value_counts_by_key(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, in value order."""
    return class_counts(df, col).orderBy("value")


def class_shares(df: DataFrame, col: str) -> DataFrame:
    """Rows per value with the share of all, in percent to one place.

    The total is a scalar subquery over the grouped counts, not a window over
    all of them.
    """
    counts = class_counts(df, col)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(100.0 * F.col("n") / total, 1)).orderBy(
        F.desc("n"), "value"
    )


def class_balance(df: DataFrame, classes: Sequence[str] = LEVELS) -> DataFrame:
    """Per class column: classes, smallest, largest, mean and std of sizes, imbalance ratio."""
    combos = df.groupBy(*classes).agg(F.count("*").alias("n"))
    levels = F.array(
        *[F.struct(F.lit(c).alias("level"), F.col(c).cast("string").alias("value")) for c in classes]
    )
    sizes = (
        combos.select(F.inline(levels), "n")
        .where("value is not null")
        .groupBy("level", "value")
        .agg(F.sum("n").alias("n"))
    )
    return sizes.groupBy("level").agg(
        F.count("*").alias("classes"),
        F.min("n").alias("min_size"),
        F.max("n").alias("max_size"),
        F.avg("n").alias("mean_size"),
        F.stddev_samp("n").alias("std_size"),
        (F.max("n") / F.min("n")).alias("imbalance_ratio"),
    )


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts of ``row`` by ``col``, absent pairs 0; ``values`` fixes the columns if known.

    Rows are counted per pair first; finding the columns then reads the staged
    counts and not the table.
    """
    pairs = (
        df.select(row, col).where(F.col(row).isNotNull() & F.col(col).isNotNull())
        .groupBy(row, col).agg(F.count("*").alias("n"))
    )
    if values is None:
        wide = stage(pairs, "pairs").groupBy(row).pivot(col)
    else:
        wide = pairs.groupBy(row).pivot(col, list(values))
    return wide.agg(F.sum("n")).na.fill(0)


def duplicate_membership(
    df: DataFrame, texts: Sequence[str] = ("description_ar", "title_ar"), id_col: str = "ticket_id"
) -> DataFrame:
    """``(check, n, pct)``: rows that share a text (all copies), and ids beyond the first.

    Nulls count as equal to each other. Groups are formed on text hashes.
    """
    parts = [group_sizes(df, t, F.sum(F.when(F.col("n") > 1, F.col("n")))) for t in texts]
    parts.append(group_sizes(df, id_col, F.sum(F.col("n") - 1)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def group_sizes(df: DataFrame, col: str, count: Column) -> DataFrame:
    groups = df.groupBy(hash_of(df, col).alias("key")).agg(F.count("*").alias("n"))
    n = F.coalesce(count, F.lit(0))
    pct = F.round(F.coalesce(F.try_divide(100.0 * n, F.sum("n")), F.lit(0.0)), 2)
    return groups.agg(F.lit(col).alias("check"), n.alias("n"), pct.alias("pct"))


def parse_tags(df: DataFrame, col: str = "tags") -> Column:
    """Tags as a list: lists pass, list-like texts are read, anything else gives []."""
    empty = F.array().cast("array<string>")
    if isinstance(df.schema[col].dataType, T.ArrayType):
        return F.coalesce(F.col(col).cast("array<string>"), empty)
    return F.coalesce(F.from_json(col, "array<string>"), empty)


def top_tags(df: DataFrame, col: str = "tags", k: int = 20) -> DataFrame:
    """The ``k`` most frequent tags."""
    tags = df.select(F.explode(parse_tags(df, col)).alias("tag")).where("tag is not null")
    counts = tags.groupBy("tag").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "tag").limit(k)


SAMPLE_COLUMNS = ["ticket_id", "title_ar", *LEVELS, "sentiment"]


def sample_rows(
    df: DataFrame, k: int = 8, seed: int = 42, columns: Sequence[str] = SAMPLE_COLUMNS, pos: str = "pos"
) -> DataFrame:
    """``k`` rows drawn by hash order: the same ones whatever the partitioning."""
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.col(pos)))
    return df.orderBy(draw, pos).limit(k).select(*columns)


def preview(df: DataFrame, k: int = 5, pos: str = "pos") -> DataFrame:
    """The first rows in input order."""
    return df.orderBy(pos).limit(k)


COUNTED = {"sentiment": "sentiment", "channel": "channel", "dialect": "dialect", **{f"l{n}": c for n, c in enumerate(LEVELS, 1)}}
KEYED = ["priority", "urgency", "impact"]
TEXTS = ["title_ar", "description_ar"]


def missing_in_facts(facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``missing_by_column`` of the table that the facts were gathered from."""
    gaps = F.col(f"{PREFIX}gaps")
    flags = facts.select(*[gaps[n].alias(c) for n, c in enumerate(columns)])
    return missing_by_column(flags.select(*[F.when(~F.col(c), F.lit(1)).alias(c) for c in columns]))


def rows_at(df: DataFrame, places: DataFrame, pos: str) -> DataFrame:
    """Whole rows at a few positions."""
    return df.join(F.broadcast(places.select(pos)), pos, "left_semi")


def profile(df: DataFrame, id_col: str = "ticket_id", pos: str = "pos") -> dict[str, DataFrame]:
    """All tables of a profile by name.

    ``df`` is read once, into a narrow table of short columns, lengths and hashes
    that every table is folded from; only ``preview`` and ``sample`` fetch their
    few rows by position.
    """
    keep = [pos, id_col, *LEVELS, *COUNTED, *KEYED, "tags"]
    facts = gathered(df, list(dict.fromkeys(keep)), TEXTS, [*TEXTS, id_col])
    named = facts.select(pos, id_col, *LEVELS)
    sizes = overview(named, id_col).where("metric <> 'total_columns'")
    width = df.sparkSession.range(1).select(F.lit("total_columns").alias("metric"), F.lit(len(df.columns)).cast("bigint").alias("value"))
    tables = {"overview": sizes.unionByName(width), "missing": missing_in_facts(facts, df.columns)}
    tables |= {f"counts_{name}": value_counts(facts, column) for name, column in COUNTED.items()}
    tables |= {f"counts_{name}": value_counts_by_key(facts, name) for name in KEYED}
    tables |= {f"shares_{name}": class_shares(facts, column) for name, column in (("l1", LEVELS[0]), ("sentiment", "sentiment"))}
    tables["balance"] = class_balance(facts)
    tables |= {f"crosstab_{name}": crosstab(facts, LEVELS[0], name) for name in ("sentiment", "dialect")}
    by_field = lengths.pinned(lengths.text_lengths(facts, TEXTS))
    by_class = lengths.pinned(lengths.value_frequencies(facts, length_of(facts, "description_ar"), [LEVELS[0]]))
    tables |= {
        "length_stats": lengths.length_stats(facts, TEXTS),
        "length_histogram": lengths.histogram(by_field, ["field"]),
        "length_density": lengths.density_curve(by_field, ["field"]),
        "length_medians": lengths.medians(by_class, LEVELS[0]),
        "length_boxes": lengths.box_stats(by_class, LEVELS[0]),
        "duplicates": duplicate_membership(facts, id_col=id_col),
        "tags": top_tags(facts),
        "preview": preview(rows_at(df, stage(preview(facts, pos=pos).select(pos), "preview"), pos), pos=pos),
        "sample": sample_rows(rows_at(df, stage(sample_rows(facts, columns=[pos], pos=pos), "sample"), pos), pos=pos),
    }
    return tables
