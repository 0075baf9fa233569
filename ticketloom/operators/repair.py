"""Rule-based repair of rejected tickets: one repaired row per input row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.fixed import CHANNELS, SENTIMENTS
from ticketloom.functions.fields import flatten_json, json_value, parse_json, PARSED
from ticketloom.functions.joins import lookup_join
from ticketloom.functions.nearest import nearest
from ticketloom.functions.rules import clean_tags, expected_priority, has_zone, instant
from ticketloom.functions.spans import let
from ticketloom.functions.text import strip, text_or_empty
from ticketloom.session import stage
from ticketloom.sources.tables import project

LEVELS = ["category_level_1", "category_level_2", "category_level_3"]

# fixed values: what a missing field becomes
DEFAULT_TIME = "2026-02-01T00:00:00+00:00"
DEFAULT_SCALE = 3
DEFAULT_TEXT = {"model": "unknown", "dialect": "Egyptian", "channel": "portal", "sentiment": "neutral"}
MIN_TAGS, MAX_TAGS = 2, 6


def closest(value: Column, allowed: list[str]) -> Column:
    """The allowed value with the fewest edits, ties by name."""
    found = let(F.lower(strip(value)), lambda given: nearest(given, F.array(*[F.lit(a) for a in allowed])))
    return F.when(value.isin(*allowed), value).otherwise(found)


def repaired_enum(name: str, allowed: list[str]) -> Column:
    value = F.col(name)
    return F.when(value.isNull(), F.lit(DEFAULT_TEXT[name])).otherwise(closest(value, allowed))


def repaired_scale(name: str) -> Column:
    value = F.coalesce(F.col(name), F.lit(DEFAULT_SCALE))
    return F.greatest(F.lit(1), F.least(F.lit(5), value)).cast("int")


def zoned(text: Column) -> Column:
    """An accepted timestamp with a zone (UTC where it had none), else null."""
    full = F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00"))).otherwise(text)
    return F.when(
        instant(text).isNotNull(),
        F.when(has_zone(text), text).otherwise(F.concat(full, F.lit("+00:00"))),
    )


def repaired_times() -> dict[str, Column]:
    """A bad time takes the other's value; an update before creation moves up to it."""
    created, updated = zoned(F.col("created_at")), zoned(F.col("updated_at"))
    start = F.coalesce(created, updated, F.lit(DEFAULT_TIME))
    in_order = updated.isNotNull() & (instant(updated) >= instant(start))
    return {"created_at": start, "updated_at": F.when(in_order, updated).otherwise(start)}


def repair_category(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Make levels and path one allowed leaf; adds its ``pool`` of tags.

    Allowed levels win over the path. Otherwise the allowed path with the
    fewest edits to the given one is taken; that is worked out once per
    distinct bad path, and a frequent one does not gather its rows.
    """
    leaves = taxonomy.select("l1", "l2", "l3", "path", F.col("tags").alias("pool"))
    by_levels = leaves.select(
        *[F.col(f"l{n}").alias(LEVELS[n - 1]) for n in (1, 2, 3)], F.col("path").alias("level_path")
    )
    given = F.coalesce("category_path", F.concat_ws(" > ", *LEVELS))
    marked = df.join(by_levels, LEVELS, "left").withColumn(
        "bad_path", F.when(F.col("level_path").isNull(), given)
    )
    # the allowed paths as one list: the taxonomy is a small dimension
    paths = taxonomy.agg(F.collect_list("path")).scalar()
    near = (
        marked.select("bad_path").where("bad_path is not null").distinct()
        .withColumn("paths", paths)
        .select("bad_path", nearest(F.col("bad_path"), F.col("paths")).alias("near_path"))
    )
    joined = lookup_join(marked, near, "bad_path", "left", "near-paths", fixed_width=False)
    chosen = joined.withColumn("path", F.coalesce("level_path", "near_path"))
    return (
        chosen.drop(*LEVELS, "category_path", "level_path", "near_path", "bad_path")
        .join(leaves, "path", "left")
        .withColumnsRenamed(
            {"l1": LEVELS[0], "l2": LEVELS[1], "l3": LEVELS[2], "path": "category_path"}
        )
    )


def repaired_tags() -> Column:
    """Trimmed, without blanks, at most six, filled up to two from the leaf's pool."""
    given = F.slice(F.coalesce(clean_tags(F.col("tags")), F.array().cast("array<string>")), 1, MAX_TAGS)
    filled = F.slice(F.array_union(given, F.col("pool")), 1, MIN_TAGS)
    return F.when(F.size(given) >= MIN_TAGS, given).otherwise(filled)


def has_id() -> Column:
    return strip(text_or_empty(F.col("ticket_id"))) != ""


def made_id(attempt: int) -> Column:
    """An id of 60 bits of a digest of where the ticket first stood; another one for each attempt."""
    place = F.col("place") if attempt == 0 else F.concat("place", F.lit(f"#{attempt}"))
    number = F.conv(F.substring(F.sha2(place, 256), 1, 15), 16, 10)
    return F.concat(F.lit("TCKT-"), F.lpad(number, F.greatest(F.lit(6), F.length(number)), F.lit("0")))


def free_ids(rows: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """``(row_id, new_id)`` for staged rows without an id: made-up ids that no row has.

    The place is the reject's own ``source`` and ``line`` where it has them: the
    file it was found in is named anew in every run. A round makes one id for each
    row left, takes out those in use, and of rows that made the same one leaves it to
    the first by place; the rest try again. So ids are the same in every run, and
    one round does unless ids collide.
    """
    place = F.concat_ws(":", F.coalesce("told_source", "source"), F.coalesce("told_line", "line"))
    used = rows.where(has_id()).select("ticket_id")
    if taken is not None:
        used = used.unionByName(taken.select("ticket_id").where(has_id()))
    left = stage(rows.where(~has_id()).select("row_id", place.alias("place"), "source", "line"), "without-id")
    found: list[DataFrame] = []
    attempt = 0
    while not left.isEmpty():
        tried = left.withColumn("ticket_id", made_id(attempt))
        free = tried.join(used, "ticket_id", "left_anti")
        for earlier in found:
            free = free.join(earlier.select(F.col("new_id").alias("ticket_id")), "ticket_id", "left_anti")
        first = F.min(F.struct("place", "source", "line", "row_id"))
        won = free.groupBy("ticket_id").agg(first.alias("first")).select(F.col("first.row_id").alias("row_id"), F.col("ticket_id").alias("new_id"))
        found.append(stage(won, "made-ids"))
        left = stage(left.join(found[-1], "row_id", "left_anti"), "without-id")
        attempt += 1
    none = rows.sparkSession.createDataFrame([], "row_id bigint, new_id string")
    return reduce(DataFrame.unionByName, found, none)


def repair(rejects: DataFrame, taxonomy: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """Repair typed rows ``(source, line, ticket columns)``; every row gives one row.

    Ids made for rows without one are neither another row's nor in ``taken`` (ticket_id).
    """
    told = {c: F.lit(None).cast(k) for c, k in (("told_source", "string"), ("told_line", "bigint")) if c not in rejects.columns}
    rows = stage(rejects.withColumns({**told, "row_id": F.monotonically_increasing_id()}), "rejects")
    named = lookup_join(repair_category(rows, taxonomy), free_ids(rows, taken), "row_id", "left", "free-ids")
    columns = {
        "ticket_id": F.coalesce("new_id", "ticket_id"),
        **repaired_times(),
        "channel": repaired_enum("channel", CHANNELS),
        "sentiment": repaired_enum("sentiment", SENTIMENTS),
        "model": F.coalesce("model", F.lit(DEFAULT_TEXT["model"])),
        "dialect": F.coalesce("dialect", F.lit(DEFAULT_TEXT["dialect"])),
        "title_ar": text_or_empty(F.col("title_ar")),
        "description_ar": text_or_empty(F.col("description_ar")),
        "impact": repaired_scale("impact"),
        "urgency": repaired_scale("urgency"),
        "tags": repaired_tags(),
    }
    fixed_rows = named.withColumns(columns)
    whole = fixed_rows.withColumns(
        {
            "priority": expected_priority(F.col("impact"), F.col("urgency")),
            "labels_json": F.struct(
                *[F.col(c).alias(f"l{n}") for n, c in enumerate(LEVELS, 1)], F.col("tags").alias("tags")
            ),
        }
    )
    return whole.select("source", "line", *project(whole).columns)


def unwrap(lines: DataFrame) -> DataFrame:
    """Typed columns of reject lines: a wrapper's ``ticket``, or the bare ticket.

    Lines that are no JSON at all keep one row too, with every field missing.
    """
    parsed = parse_json(lines)
    keys = F.expr(f"map_keys(try_variant_get({PARSED}, '$', 'map<string,variant>'))")
    told = {"told_source": json_value("source", "string"), "told_line": json_value("line", "bigint")}
    wrapped = parsed.withColumns(told).withColumn(PARSED, F.coalesce(json_value("ticket", "variant"), F.col(PARSED)))
    return flatten_json(wrapped.withColumn("keys", keys), ["source", "line", *told])


def repair_lines(lines: DataFrame, taxonomy: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """Repair reject lines ``(source, line, raw)``, wrapped or bare; ``taken`` as in ``repair``."""
    return repair(unwrap(lines), taxonomy, taken)
