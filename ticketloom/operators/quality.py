"""Data-quality report: violations, first offenders, lengths, frequencies, duplicates.

Works on typed tickets or on ``flatten_json`` output. Nothing is
short-circuited and nulls are counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions.rules import (
    channel_ok,
    expected_priority,
    joined_path,
    sentiment_ok,
)
from ticketloom.operators.facts import gathered, path_ok_of, text_key_of
from ticketloom.operators.lengths import summary, text_lengths

LEVELS = ["category_level_1", "category_level_2", "category_level_3"]
SCALARS = ["channel", "sentiment", "impact", "urgency", "priority"]
TITLE, DESCRIPTION = "title_ar", "description_ar"


def or_true(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(True)


def records(df: DataFrame) -> DataFrame:
    """Rows that parsed; all rows of a typed table."""
    return df.where("is_record") if "is_record" in df.columns else df


def zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def computed_priority() -> Column:
    return expected_priority(zero_if_null("impact"), zero_if_null("urgency"))


def priority_differs(df: DataFrame) -> Column:
    given = "priority_number" if "priority_number" in df.columns else "priority"
    return ~F.col(given).eqNullSafe(computed_priority())


def mark_unknown_leaves(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Add ``unknown_leaf``: the level triple is not in the taxonomy."""
    leaves = taxonomy.select(
        F.col("l1").alias("category_level_1"),
        F.col("l2").alias("category_level_2"),
        F.col("l3").alias("category_level_3"),
        F.lit(True).alias("known_leaf"),
    )
    return (
        df.join(leaves, LEVELS, "left")
        .withColumn("unknown_leaf", F.col("known_leaf").isNull())
        .drop("known_leaf")
    )


def violations(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """``(metric, n, pct)``: the row total and each kind of violation, in one pass."""
    marked = mark_unknown_leaves(df, taxonomy)
    record = or_true(df, "is_record")
    missing = F.size("missing") > 0 if "missing" in df.columns else F.lit(False)
    kinds = {
        "missing_keys": missing,
        "bad_channel": ~channel_ok(F.col("channel")),
        "bad_sentiment": ~sentiment_ok(F.col("sentiment")),
        "bad_priority": priority_differs(df),
        "bad_taxonomy": F.col("unknown_leaf"),
        "bad_category_path": ~path_ok_of(df),
    }
    counted = marked.agg(
        F.count("*").alias("total"),
        *[F.count_if(record & broken).alias(name) for name, broken in kinds.items()],
    )
    share = F.coalesce(F.try_divide(100.0 * F.col("n"), F.col("rows")), F.lit(0.0))
    return (
        counted.withColumn("rows", F.col("total"))
        .unpivot(["rows"], ["total", *kinds], "metric", "n")
        .select("metric", "n", F.round(share, 2).alias("pct"))
    )


def first_priority_mismatches(df: DataFrame, k: int = 10) -> DataFrame:
    """The first rows in input order whose priority breaks the rule."""
    return (
        records(df).where(priority_differs(df))
        .orderBy("pos").limit(k)
        .select("pos", "ticket_id", "impact", "urgency", "priority", computed_priority().alias("expected"))
    )


def first_taxonomy_violations(df: DataFrame, taxonomy: DataFrame, k: int = 10) -> DataFrame:
    """The first rows in input order whose category is not allowed."""
    return (
        mark_unknown_leaves(records(df), taxonomy).where("unknown_leaf")
        .orderBy("pos").limit(k)
        .select("pos", "ticket_id", *LEVELS)
    )


def lengths(df: DataFrame) -> DataFrame:
    """Mean, median, min and max characters of title and description (null as empty)."""
    freq = text_lengths(records(df), [TITLE, DESCRIPTION], null_as_empty=True)
    return summary(freq.drop("n_blank"), ["field"])


def hierarchy_counts(df: DataFrame) -> DataFrame:
    """``(table_name, key, n)`` for L1, (L1, L2) and (L1, L2, L3).

    Rows are counted per full triple once; the rollup runs over those counts.
    """
    triples = records(df).groupBy(*LEVELS).agg(F.count("*").alias("n"))
    rolled = (
        triples.rollup(*LEVELS)
        .agg(F.sum("n").alias("n"), F.grouping_id().alias("depth"))
        .where("depth < 7")
    )
    l1, l2, l3 = (F.col(c) for c in LEVELS)
    none = F.lit("None")
    two = F.concat_ws(" > ", F.coalesce(l1, none), F.coalesce(l2, none))
    return rolled.select(
        F.when(F.col("depth") == 3, "l1").when(F.col("depth") == 1, "l2").otherwise("l3").alias("table_name"),
        F.when(F.col("depth") == 3, F.coalesce(l1, none))
        .when(F.col("depth") == 1, two)
        .otherwise(joined_path(l1, l2, l3))
        .alias("key"),
        "n",
    )


def scalar_counts(df: DataFrame) -> DataFrame:
    """``(table_name, key, n)`` for channel, sentiment, impact, urgency and priority.

    One row per combination is left by the first aggregate; only those are
    spread over the five tables.
    """
    as_text = {c: F.coalesce(F.col(c), F.lit("None")) for c in SCALARS[:2]}
    as_text |= {c: zero_if_null(c).cast("string") for c in SCALARS[2:]}
    combos = (
        records(df).select(*[as_text[c].alias(c) for c in SCALARS])
        .groupBy(*SCALARS).agg(F.count("*").alias("n"))
    )
    return (
        combos.unpivot(["n"], SCALARS, "table_name", "key")
        .groupBy("table_name", "key")
        .agg(F.sum("n").alias("n"))
    )


def top_keys(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent keys of each table.

    The rank filter lets Spark keep only ``k`` rows per table and task before
    the shuffle.
    """
    order = Window.partitionBy("table_name").orderBy(F.desc("n"), "key")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def text_groups(df: DataFrame) -> DataFrame:
    """Rows per trimmed (title, description), keyed by hash."""
    return records(df).groupBy(text_key_of(df).alias("key")).agg(F.count("*").alias("n"))


def duplicates(df: DataFrame) -> DataFrame:
    """Groups of equal (title, description) and rows beyond the first of each."""
    return text_groups(df).agg(
        F.count_if(F.col("n") > 1).alias("dup_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dup_records"),
    )


# --- report text ------------------------------------------------------------
# fixed values: headings and patterns of the text report

VIOLATION_LINES = {
    "missing_keys": "Missing required keys",
    "bad_channel": "Bad channel",
    "bad_sentiment": "Bad sentiment",
    "bad_priority": "Priority rule mismatches",
    "bad_taxonomy": "Taxonomy (L1/L2/L3) not allowed",
    "bad_category_path": "category_path mismatch",
}
FIRST_PRIORITY = "First 10 priority mismatches (ticket, impact, urgency, priority, expected):"
FIRST_TAXONOMY = "First 10 taxonomy violations (ticket, L1,L2,L3):"
LENGTH_LINES = {DESCRIPTION: "Description len", TITLE: "Title len"}
TABLE_LINES = {
    "l1": "Top L1:",
    "l2": "Top L2 (by L1,L2):",
    "l3": "Top L3 (by L1,L2,L3):",
    "channel": "Channels:",
    "sentiment": "Sentiment:",
    "impact": "Impact:",
    "urgency": "Urgency:",
    "priority": "Priority:",
}
LENGTH_PATTERN = "%s: mean %.1f, median %.1f, min %d, max %d"


def report(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """The whole report as ``(ord, text)`` lines; some hundred rows at any data size.

    ``df`` is read once, into a narrow table that every section is worked out from.
    """
    spark = df.sparkSession
    df = gathered(df, ["pos", "ticket_id", *LEVELS, *SCALARS, "priority_number", "is_record", "missing"])

    def fixed_lines(lines: dict[int, str]) -> DataFrame:
        pairs = [F.struct(F.lit(o).alias("ord"), F.lit(t).alias("text")) for o, t in lines.items()]
        return spark.range(1).select(F.inline(F.array(*pairs)))

    def number(name: str, order: list[str], base: int, step: int = 1) -> Column:
        return F.array_position(F.array(*[F.lit(o) for o in order]), F.col(name)).cast("int") * step + base

    tables = list(TABLE_LINES)
    headings = {100: "== Violations ==", 150: "", 200: FIRST_PRIORITY, 300: FIRST_TAXONOMY,
                350: "", 400: "== Lengths (chars) ==", 450: "", 500: "== Distributions ==",
                2000: "", 2001: "== Duplicates =="}
    headings |= {(i + 6) * 100: TABLE_LINES[t] for i, t in enumerate(tables)}

    counts = violations(df, taxonomy)
    label = F.element_at(F.create_map(*[F.lit(x) for kv in VIOLATION_LINES.items() for x in kv]), F.col("metric"))
    total = counts.where("metric = 'total'").select(
        F.lit(0).alias("ord"), F.format_string("Total: %d", "n").alias("text")
    )
    broken = counts.where("metric <> 'total'").select(
        number("metric", list(VIOLATION_LINES), 100).alias("ord"),
        F.format_string("%s: %d (%.2f%%)", label, "n", "pct").alias("text"),
    )
    # at most ten rows each: the lists are limited before they are numbered
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("pos"))
    mismatches = first_priority_mismatches(df).select(
        (place + 200).alias("ord"),
        F.format_string("('%s', %s, %s, %s, %s)", "ticket_id", "impact", "urgency", "priority", "expected").alias("text"),
    )
    unknown = first_taxonomy_violations(df, taxonomy).select(
        (place + 300).alias("ord"),
        F.format_string("('%s', '%s', '%s', '%s')", "ticket_id", *LEVELS).alias("text"),
    )
    length_label = F.element_at(F.create_map(*[F.lit(x) for kv in LENGTH_LINES.items() for x in kv]), F.col("field"))
    sizes = lengths(df).select(
        number("field", list(LENGTH_LINES), 400).alias("ord"),
        F.format_string(LENGTH_PATTERN, length_label, "mean", "median", "min", "max").alias("text"),
    )
    top = top_keys(hierarchy_counts(df).unionByName(scalar_counts(df))).select(
        (number("table_name", tables, 500, 100) + F.col("rank")).alias("ord"),
        F.format_string("%s: %d", "key", "n").alias("text"),
    )
    copies = duplicates(df).select(
        F.inline(
            F.array(
                F.struct(F.lit(2002).alias("ord"),
                         F.format_string("Duplicate (exact title+description) pairs: %d", "dup_groups").alias("text")),
                F.struct(F.lit(2003).alias("ord"),
                         F.format_string("Duplicate extra records (beyond first): %d", "dup_records").alias("text")),
            )
        )
    )
    parts = [fixed_lines(headings), total, broken, mismatches, unknown, sizes, top, copies]
    return reduce(DataFrame.unionByName, parts)
