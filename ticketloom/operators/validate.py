"""Row validation, duplicate ids, safe repair and the clean/rejected split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.fixed import REQUIRED_KEYS
from ticketloom.functions.fields import (
    TicketFields,
    json_fields,
    read_json_fields,
    typed_fields,
)
from ticketloom.functions.joins import lookup_join
from ticketloom.functions.rules import (
    DUPLICATE_ID,
    NOT_OBJECT,
    PRIORITY_RULE,
    UNPARSEABLE,
    clean_tags,
    code_list,
    expected_priority,
    instant,
    join_codes,
    row_codes,
    strict_codes,
)

CODES = "codes"
REASON = "reason"


def check_rows(
    df: DataFrame, taxonomy: DataFrame, fields: TicketFields, profile: str = "code"
) -> DataFrame:
    """Add ``codes`` (ordered row errors as text) and ``id_key``. Narrow: no shuffle."""
    if profile not in ("code", "strict"):
        raise ValueError(f"unknown profile {profile!r}")
    paths = taxonomy.select(F.col("path").alias("known_path"))
    # instants are columns of their own: each text is parsed once, not per rule
    joined = df.withColumns(
        {
            "given_path": fields.text["category_path"],
            "start_at": instant(fields.text["created_at"]),
            "end_at": instant(fields.text["updated_at"]),
        }
    ).join(paths, F.col("given_path") == F.col("known_path"), "left")
    codes = row_codes(fields, F.col("known_path").isNotNull(), F.col("start_at"), F.col("end_at"))
    if profile == "strict":
        extra = F.when(F.size(fields.missing) == 0, F.nullif(strict_codes(fields), F.lit("")))
        codes = join_codes(F.nullif(codes, F.lit("")), extra)
    return joined.withColumns(
        {
            CODES: F.when(fields.is_record, codes),
            "id_key": fields.id_key,
        }
    ).drop("given_path", "known_path", "start_at", "end_at")


def check_json_rows(parsed: DataFrame, taxonomy: DataFrame, profile: str = "code") -> DataFrame:
    """Codes of rows that went through ``parse_json``; keeps their columns and adds the ticket's."""
    checked = check_rows(read_json_fields(parsed), taxonomy, json_fields(), profile)
    kept = checked.select(*parsed.columns, *REQUIRED_KEYS, "id_key", CODES)
    return kept.withColumn(
        CODES,
        F.when(~F.col("parse_ok"), F.lit(UNPARSEABLE))
        .when(F.col("keys").isNull(), F.lit(NOT_OBJECT))
        .otherwise(F.col(CODES)),
    )


def acceptable(codes):
    """No error, or only the one that is repaired automatically."""
    return codes.isin("", PRIORITY_RULE)


def first_accepted(checked: DataFrame) -> DataFrame:
    """Per id that occurs more than once: where it is first accepted.

    Grouping moves (id, pos) only, combined before the shuffle. The first
    acceptable row of an id is always accepted, so its position decides.
    """
    return (
        checked.where(F.col("id_key").isNotNull())
        .groupBy("id_key")
        .agg(
            F.min(F.when(acceptable(F.col(CODES)), F.col("pos"))).alias("accepted_pos"),
            F.count("*").alias("copies"),
        )
        .where("copies > 1 and accepted_pos is not null")
        .select("id_key", "accepted_pos")
    )


def resolve(checked: DataFrame, moved: list[str] | None = None) -> DataFrame:
    """Duplicate ids and automatic priority repair: adds ``reason`` and ``autofix``.

    ``reason`` is what remains; an empty one means accepted. ``checked`` is
    evaluated twice, so a costly or unstable one should be staged. ``moved`` gets
    a name if there were too many repeated ids to leave the rows where they are.
    """
    known = lookup_join(checked, first_accepted(checked), "id_key", "left", "accepted-ids", fixed_width=True, moved=moved)
    late = F.coalesce(F.col("pos") > F.col("accepted_pos"), F.lit(False))
    codes = join_codes(F.nullif(F.col(CODES), F.lit("")), F.when(late, F.lit(DUPLICATE_ID)))
    autofix = codes == PRIORITY_RULE
    reason = code_list(F.when(autofix, F.lit("")).otherwise(codes))
    return known.withColumns({"autofix": autofix, REASON: reason}).drop("accepted_pos", CODES)


def validate(df: DataFrame, taxonomy: DataFrame, profile: str = "code") -> DataFrame:
    """Validate typed ticket rows with a ``pos`` column; adds ``reason`` and ``autofix``."""
    return resolve(check_rows(df, taxonomy, typed_fields(), profile)).drop("id_key")


def accepted_rows(validated: DataFrame) -> DataFrame:
    """Clean typed rows: priority repaired, tags trimmed and emptied of blanks."""
    priority = F.when(
        F.col("autofix"), expected_priority(F.col("impact"), F.col("urgency"))
    ).otherwise(F.col("priority"))
    return (
        validated.where(F.size(REASON) == 0)
        .withColumns({"priority": priority, "tags": clean_tags(F.col("tags"))})
        .drop(REASON, "autofix")
    )


def rejected_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.size(REASON) > 0).drop("autofix")


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return accepted_rows(validated), rejected_rows(validated)


def code_counts(checked: DataFrame) -> DataFrame:
    """Rows per error code of checked rows."""
    return checked.select(F.explode(code_list(F.col(CODES))).alias("code")).groupBy("code").agg(
        F.count("*").alias("n")
    )


def run_summary(validated: DataFrame) -> DataFrame:
    """Counts of accepted, rejected and automatically repaired rows in one pass."""
    empty = F.size(REASON) == 0
    return validated.agg(
        F.count("*").alias("n_rows"),
        F.count_if(empty).alias("n_clean"),
        F.count_if(~empty).alias("n_rejected"),
        F.count_if(F.col("autofix")).alias("n_autofixed"),
    )


def rejected_listing(rejected: DataFrame) -> DataFrame:
    """``(row_id, causes)``: the ticket id or else source:line, and the codes as text."""
    row_id = F.coalesce(
        F.nullif(F.col("ticket_id"), F.lit("")), F.concat_ws(":", "source", "line")
    )
    return rejected.select(row_id.alias("row_id"), F.array_join(REASON, ", ").alias("causes"))
