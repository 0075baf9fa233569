"""Synthetic tickets: every value a pure function of (seed, seq)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import fixed
from ticketloom.functions.picks import choose, digest_number, digit_picks
from ticketloom.functions.rules import expected_priority
from ticketloom.sources.tables import in_order, project, write_jsonl
from ticketloom.sources.taxonomy import renumbered

TRIPLE = ["l1", "l2", "l3"]
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ZONE = "+02:00"


def built_in_texts(spark) -> DataFrame:
    """Titles and descriptions per leaf: ``(l1, l2, l3, titles, descs)``."""
    descs = {row[:3]: row[3] for row in fixed.DESCRIPTIONS}
    rows = [(*row[:3], row[3], descs.get(row[:3])) for row in fixed.TITLES]
    table = pa.table([list(c) for c in zip(*rows)], names=[*TRIPLE, "titles", "descs"])
    return spark.createDataFrame(table)


def pick_from(items: Column, number: Column) -> Column:
    return F.element_at(items, (number % F.size(items) + 1).cast("int"))


def draw_tags(pool: Column, digest: Column, wanted: Column) -> Column:
    """Sample without replacement: order the pool by hash, take the first ones.

    A pool of fewer than two tags gives way to two tags of the general list.
    """
    general = F.array(*[F.lit(t) for t in fixed.FALLBACK_TAGS])
    usable = F.coalesce(F.size(pool) >= 2, F.lit(False))
    source = F.when(usable, pool).otherwise(general)
    count = F.when(usable, F.least(F.size(pool), wanted)).otherwise(2).cast("int")
    shuffled = F.array_sort(F.transform(source, lambda t: F.concat(F.md5(F.concat(digest, t)), t)))
    return F.transform(F.slice(shuffled, 1, count), lambda t: F.substring(t, 33, 1000))


def synthesize(
    seqs: DataFrame,
    taxonomy: DataFrame,
    texts: DataFrame | None = None,
    seed: int = 42,
    index: str = "001",
    model: str = "template",
    dialect: str = "Egyptian",
) -> DataFrame:
    """One ticket per ``seq`` of the given frame, in the canonical columns plus ``pos``.

    ``k`` orders the leaves of ``taxonomy``; gaps in it are closed. Reruns, retries and other
    partition counts give the same rows.
    """
    spark = seqs.sparkSession
    texts = built_in_texts(spark) if texts is None else texts
    taxonomy = renumbered(taxonomy)
    n_leaves = taxonomy.count()
    digest = F.col("digest")
    leaf, day, hour, minute, add_hours, add_minutes = digit_picks(
        digest_number(digest, 0), [n_leaves, 20, 24, 60, 73, 60]
    )
    impact, urgency, channel, sentiment, n_tags = digit_picks(
        digest_number(digest, 1), [5, 5, len(fixed.CHANNELS), len(fixed.SENTIMENTS), 5]
    )
    drawn = (
        seqs.select("seq")
        .withColumn("digest", F.sha2(F.concat_ws(":", F.lit(seed), "seq"), 256))
        .withColumn("k", leaf.cast("int"))
        .join(taxonomy.select("k", *TRIPLE, F.col("path"), F.col("tags").alias("pool")), "k")
        .join(texts, TRIPLE, "left")
    )
    l1, l2, l3 = (F.col(c) for c in TRIPLE)
    any_title = F.array(
        F.format_string(fixed.GENERIC_TITLE_ISSUE, l3),
        F.format_string(fixed.GENERIC_TITLE_REQUEST, l2),
    )
    any_desc = F.array(
        F.format_string(fixed.GENERIC_DESCRIPTION_CATEGORY, l1, l2, l3),
        F.lit(fixed.GENERIC_DESCRIPTION_AGE),
    )
    created = F.make_timestamp_ntz(
        F.lit(2026), F.lit(2), (day + 1).cast("int"), hour.cast("int"), minute.cast("int"), F.lit(0)
    )
    updated = created + F.make_dt_interval(F.lit(0), add_hours.cast("int"), add_minutes.cast("int"))
    seq_text = F.col("seq").cast("string")
    tags = draw_tags(F.col("pool"), digest, n_tags + 2)
    columns = {
        "ticket_id": F.concat(
            F.lit(f"TCKT-{index}-"), F.lpad(seq_text, F.greatest(F.lit(3), F.length(seq_text)), F.lit("0"))
        ),
        "created_at": F.concat(F.date_format(created, ISO_SECONDS), F.lit(ZONE)),
        "updated_at": F.concat(F.date_format(updated, ISO_SECONDS), F.lit(ZONE)),
        "channel": choose(fixed.CHANNELS, channel),
        "model": F.lit(model),
        "dialect": F.lit(dialect),
        "title_ar": pick_from(F.coalesce("titles", any_title), digest_number(digest, 2)),
        "description_ar": pick_from(F.coalesce("descs", any_desc), digest_number(digest, 3)),
        "category_level_1": l1,
        "category_level_2": l2,
        "category_level_3": l3,
        "category_path": F.col("path"),
        "tags": tags,
        "impact": (impact + 1).cast("int"),
        "urgency": (urgency + 1).cast("int"),
        "sentiment": choose(fixed.SENTIMENTS, sentiment),
    }
    made = drawn.select(F.col("seq").alias("pos"), *[c.alias(name) for name, c in columns.items()])
    whole = made.withColumns(
        {
            "labels_json": F.struct(
                F.col("category_level_1").alias("l1"),
                F.col("category_level_2").alias("l2"),
                F.col("category_level_3").alias("l3"),
                F.col("tags").alias("tags"),
            ),
            "priority": expected_priority(F.col("impact"), F.col("urgency")),
        }
    )
    return whole.select("pos", *project(whole).columns)


def synthesize_batch(spark, taxonomy: DataFrame, n: int = 500, **options) -> DataFrame:
    """``n`` tickets numbered from 1."""
    return synthesize(spark.range(1, n + 1).withColumnRenamed("id", "seq"), taxonomy, **options)


def write_batch(spark, taxonomy: DataFrame, path: str, n: int = 500, **options) -> None:
    """``n`` tickets as JSON lines, in the order of their numbers."""
    write_jsonl(project(in_order(synthesize_batch(spark, taxonomy, n, **options))), path)
