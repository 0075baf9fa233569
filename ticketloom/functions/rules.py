"""Validation rules: each is a column giving an error code, or null if fine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom.fixed import CHANNELS, SCALE_KEYS, SENTIMENTS
from ticketloom.functions.fields import TicketFields
from ticketloom.functions.picks import whole_div
from ticketloom.functions.text import strip

PATH_SEPARATOR = " > "
CODE_SEPARATOR = ","
PRIORITY_RULE = "bad:priority_rule"
DUPLICATE_ID = "bad:duplicate_ticket_id"
UNPARSEABLE = "bad:json_parse"
NOT_OBJECT = "bad:not_object"

# fixed value: accepted timestamp spelling (date, then optional time, fraction, zone)
TIMESTAMP_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
# a date alone ends in a minus and four digits of no zone, so the time must be there
ZONE_PATTERN = r":\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:?\d{2})$"
BARE_ZONE = r"([+-]\d{2})(\d{2})$"

# fixed value: both spellings of a ticket id, TCKT-000001 and TCKT-001-001
TICKET_ID_PATTERN = r"^TCKT-\d+(-\d+)?$"


def code_unless(ok: Column, code: str) -> Column:
    """The code where ``ok`` is false or unknown."""
    return F.when(~F.coalesce(ok, F.lit(False)), F.lit(code))


def is_one_of(value: Column, allowed: list[str]) -> Column:
    """Membership in a short list as one call; null is no member.

    The generated code of a row check has to stay small enough for the JIT
    compiler, and this is much shorter than a comparison per value.
    """
    return F.coalesce(F.find_in_set(value, F.lit(",".join(allowed))) > 0, F.lit(False))


def channel_ok(channel: Column) -> Column:
    return is_one_of(channel, CHANNELS)


def sentiment_ok(sentiment: Column) -> Column:
    return is_one_of(sentiment, SENTIMENTS)


def expected_priority(impact: Column, urgency: Column) -> Column:
    """Mean of both, rounded half up, within 1..5."""
    return F.greatest(F.lit(1), F.least(F.lit(5), whole_div(impact + urgency + 1, 2))).cast("int")


def instant(text: Column) -> Column:
    """The timestamp of an accepted spelling, else null; offset-less means UTC."""
    bare = F.when(text.contains("T") | text.contains(" "), F.regexp_replace(text, BARE_ZONE, "$1:$2")).otherwise(text)
    return F.when(text.rlike(TIMESTAMP_PATTERN), bare.try_cast("timestamp"))


def has_zone(text: Column) -> Column:
    return text.rlike(ZONE_PATTERN)


def timestamp_code(created: Column, updated: Column, start: Column, end: Column) -> Column:
    """``start`` and ``end`` are the instants of the two texts."""
    usable = start.isNotNull() & end.isNotNull() & (has_zone(created) == has_zone(updated))
    return F.when(~F.coalesce(usable, F.lit(False)), F.lit("bad:timestamp")).when(
        end < start, F.lit("bad:updated_at<created_at")
    )


def joined_path(l1: Column, l2: Column, l3: Column) -> Column:
    """Path text of three levels; an empty level reads 'None', as in the data contract."""
    return F.concat_ws(PATH_SEPARATOR, *[F.coalesce(level, F.lit("None")) for level in (l1, l2, l3)])


def path_matches(text: dict[str, Column]) -> Column:
    expected = joined_path(*[text[f"category_level_{n}"] for n in (1, 2, 3)])
    return text["category_path"].eqNullSafe(expected)


def scale_code(fields: TicketFields, key: str) -> Column:
    scale = fields.scales[key]
    return F.when(~scale.is_int, F.lit(f"bad:type:{key}")).when(
        ~scale.value.between(1, 5), F.lit(f"bad:range:{key}")
    )


def priority_code(fields: TicketFields) -> Column:
    impact, urgency, priority = (fields.scales[k] for k in SCALE_KEYS)
    # Out-of-range values may be huge; clipping keeps their sum inside a bigint
    # and does not change the clamped result.
    low, high = F.lit(-100), F.lit(100)
    clipped = [F.greatest(low, F.least(high, s.value)) for s in (impact, urgency)]
    all_ints = impact.is_int & urgency.is_int & priority.is_int
    return F.when(
        all_ints & (priority.value != expected_priority(*clipped)), F.lit(PRIORITY_RULE)
    )


def join_codes(*codes: Column) -> Column:
    """Codes that apply as one text, '' if none.

    Text instead of an array keeps the whole check inside generated code:
    higher-order array functions would fall back to interpretation.
    """
    return F.concat_ws(CODE_SEPARATOR, *codes)


def code_list(codes: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.when(codes == "", empty).otherwise(F.split(codes, CODE_SEPARATOR))


def prefixed(names: Column, prefix: str) -> Column:
    """One code per name as a joined text; null if there are none."""
    listed = F.array_join(names, CODE_SEPARATOR + prefix)
    return F.when(F.size(names) > 0, F.concat(F.lit(prefix), listed))


def row_codes(
    fields: TicketFields, category_known: Column, start: Column, end: Column
) -> Column:
    """All codes of one row in contract order (before the duplicate check).

    A missing key hides every other code.
    """
    text = fields.text
    found = join_codes(
        code_unless(channel_ok(text["channel"]), "bad:channel"),
        code_unless(sentiment_ok(text["sentiment"]), "bad:sentiment"),
        *[scale_code(fields, k) for k in SCALE_KEYS],
        timestamp_code(text["created_at"], text["updated_at"], start, end),
        code_unless(path_matches(text), "bad:category_path_mismatch"),
        code_unless(category_known, "bad:category_not_allowed"),
        code_unless(fields.tags_ok, "bad:tags"),
        code_unless(fields.labels_missing.isNotNull(), "bad:labels_json_type"),
        prefixed(fields.labels_missing, "bad:labels_json_missing:"),
        priority_code(fields),
    )
    return F.coalesce(prefixed(fields.missing, "missing:"), found)


def strict_codes(fields: TicketFields) -> Column:
    """Rules the data contract states on top of the enforced ones."""
    text, labels = fields.text, fields.labels
    zoned = has_zone(text["created_at"]) & has_zone(text["updated_at"])
    same_labels = (
        labels["l1"].eqNullSafe(text["category_level_1"])
        & labels["l2"].eqNullSafe(text["category_level_2"])
        & labels["l3"].eqNullSafe(text["category_level_3"])
        & labels["tags"].eqNullSafe(fields.tags)
    )
    return join_codes(
        code_unless(F.size(fields.tags).between(2, 6), "strict:tag_count"),
        code_unless(text["ticket_id"].rlike(TICKET_ID_PATTERN), "strict:ticket_id_format"),
        code_unless(zoned, "strict:timestamp_zone"),
        code_unless(same_labels, "strict:labels_differ"),
    )


def clean_tags(tags: Column) -> Column:
    return F.filter(F.transform(tags, strip), lambda t: t != "")
