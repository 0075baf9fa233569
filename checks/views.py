"""Ticket-shaped frames derived from the given tables by integer arithmetic.

Every row of the source table becomes one ticket with its whole text; flaws
are planted by arithmetic on the row's number, so that SQL can do the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.picks import whole_div
from ticketloom.sources.taxonomy import built_in_taxonomy


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded(number: Column, width: int) -> Column:
    """Zero-padded decimal text that grows past ``width`` instead of being cut."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def cycle(number: Column, items: list[str]) -> Column:
    return F.element_at(
        F.array(*[F.lit(i) for i in items]), (number % len(items) + 1).cast("int")
    )


def as_tickets(numbered: DataFrame) -> DataFrame:
    """``(i, text, lang, source)`` rows as tickets with planted flaws."""
    i = F.col("i")
    leaves = built_in_taxonomy(numbered.sparkSession).select("k", "l1", "l2", "l3")
    joined = numbered.withColumn("k", (i % 48).cast("int")).join(leaves, "k")
    l3 = F.when(i % 31 == 0, F.lit("Excel Crash")).otherwise(F.col("l3"))
    tags = F.array(
        F.lower("l2"), F.concat(F.lit(" "), "lang", F.lit(" ")), F.col("source"), F.lit("")
    )
    impact = (1 + i % 5).cast("int")
    urgency = (1 + whole_div(i, 5) % 5).cast("int")
    priority = whole_div(impact + urgency + 1, 2).cast("int")
    created = F.concat(
        F.lit("2026-02-"), padded(1 + i % 20, 2), F.lit("T"), padded(i % 24, 2),
        F.lit(":"), padded(i % 60, 2), F.lit(":00+02:00"),
    )
    updated = (
        F.when(i % 41 == 0, F.lit("not-a-time"))
        .when(i % 37 == 0, F.lit("2026-01-31T00:00:00+02:00"))
        .otherwise(F.concat(F.lit("2026-02-"), padded(2 + i % 20, 2), F.lit("T12:00:00+02:00")))
    )
    return joined.select(
        i.alias("pos"),
        F.concat(
            F.lit("TCKT-"), padded(F.when(i % 50 == 49, i - 1).otherwise(i), 6)
        ).alias("ticket_id"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        F.when(i % 29 == 0, F.lit("fax"))
        .otherwise(cycle(i, ["email", "portal", "chatbot", "phone"]))
        .alias("channel"),
        F.col("source").alias("model"),
        F.col("lang").alias("dialect"),
        F.substring_index("text", "\n", 1).alias("title_ar"),
        F.col("text").alias("description_ar"),
        F.col("l1").alias("category_level_1"),
        F.col("l2").alias("category_level_2"),
        l3.alias("category_level_3"),
        F.concat_ws(" > ", "l1", "l2", l3).alias("category_path"),
        tags.alias("tags"),
        F.struct(
            F.col("l1").alias("l1"), F.col("l2").alias("l2"), l3.alias("l3"), tags.alias("tags")
        ).alias("labels_json"),
        impact.alias("impact"),
        urgency.alias("urgency"),
        F.when(i % 23 == 0, F.lit(9))
        .when(i % 19 == 0, priority % 5 + 1)
        .otherwise(priority)
        .cast("int")
        .alias("priority"),
        F.when(i % 43 == 0, F.lit("angry"))
        .otherwise(cycle(whole_div(i, 4), ["positive", "neutral", "negative", "mixed"]))
        .alias("sentiment"),
    )


def document_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return as_tickets(docs.select(F.col("doc_id").alias("i"), "text", "lang", "source"))


def turn_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticket per conversation turn; many of the texts are short."""
    turns = table(spark, sf_dir, "conversations")
    return as_tickets(
        turns.select(
            (F.col("conv_id") * 1000 + F.col("turn")).alias("i"),
            "text",
            F.lit("chat").alias("lang"),
            F.col("role").alias("source"),
        )
    )


def all_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_tickets(spark, sf_dir).unionByName(turn_tickets(spark, sf_dir))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document tickets as raw JSON lines ``(source, line, pos, raw)`` with planted JSON flaws."""
    i = F.col("pos")
    t = document_tickets(spark, sf_dir).withColumns(
        {
            "category_path": F.when(i % 83 == 0, F.lit("Service > Incident > Outage")).otherwise(F.col("category_path")),
            "urgency": F.when(i % 89 == 0, F.lit(7)).otherwise(F.col("urgency")),
        }
    )
    labels = F.col("labels_json")

    def members(*cols: Column | str) -> Column:
        text = F.to_json(F.struct(*cols))
        return F.substring(text, F.lit(2), F.length(text) - 2)

    texts = [
        c
        for c, kind in t.dtypes
        if kind == "string" and c not in ("model", "sentiment")
    ]
    raw = F.concat_ws(
        ",",
        members(*texts),
        F.when(i % 53 != 0, members("model")),
        F.when(i % 59 == 0, F.lit('"tags":["a",1]')).otherwise(members("tags")),
        F.when(i % 61 == 0, F.lit('"labels_json":"x"'))
        .when(
            i % 67 == 0,
            members(
                F.struct(
                    labels["l1"].alias("l1"), labels["l2"].alias("l2"), labels["tags"].alias("tags")
                ).alias("labels_json")
            ),
        )
        .otherwise(members("labels_json")),
        F.when(i % 47 == 0, F.lit('"impact":"3"'))
        .when(i % 79 == 0, F.lit('"impact":3.0'))
        .otherwise(members("impact")),
        members("urgency", "priority", "sentiment"),
    )
    whole = F.concat(F.lit("{"), raw, F.lit("}"))
    return t.select(
        F.lit("documents").alias("source"),
        i.alias("line"),
        i.alias("pos"),
        F.when(i % 71 == 0, F.concat(F.lit("{bad"), whole))
        .when(i % 73 == 0, F.lit("[1]"))
        .otherwise(whole)
        .alias("raw"),
    )


def fix_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as part rows, one part per language; ids repeat, and some rows have none to go by."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.concat(F.lit("part_"), "lang", F.lit(".jsonl")).alias("part"),
        F.col("doc_id").alias("line"),
        F.when(F.col("doc_id") % 13 != 0, F.concat(F.lit("TCKT-"), padded(F.col("doc_id") - F.col("doc_id") % 12, 6))).alias("id_key"),
        "text",
        F.col("source").alias("origin"),
    )


def fix_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as fixes: several per id, some without an id, some ids new, system turns without a part."""
    turns = table(spark, sf_dir, "conversations")
    part = (
        F.when(F.col("role") == "user", "part_en_fixed.jsonl")
        .when(F.col("role") == "assistant", "part_fr_fixed.jsonl")
        .otherwise("part_other_fixed.jsonl")
    )
    return turns.select(
        part.alias("part"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("line"),
        F.when(F.col("turn") != 3, F.concat(F.lit("TCKT-"), padded(F.col("conv_id"), 6))).alias("id_key"),
        "text",
        F.col("role").alias("origin"),
    )
