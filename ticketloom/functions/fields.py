"""Where each ticket field comes from: typed columns or parsed JSON.

Rules are written once against ``TicketFields``; the two constructors say how
a field is read and how well its type is known.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.fixed import LABEL_KEYS, REQUIRED_KEYS, SCALE_KEYS
from ticketloom.functions.spans import json_string, patch_members  # noqa: F401  part of this interface

LABELS_TYPE = "struct<l1:string,l2:string,l3:string,tags:array<string>>"


@dataclass(frozen=True)
class Scale:
    """A 1..5 field: whether it is an integer, and its value where it fits."""

    is_int: Column
    value: Column


@dataclass(frozen=True)
class TicketFields:
    is_record: Column
    missing: Column
    id_key: Column
    text: dict[str, Column]
    scales: dict[str, Scale]
    tags: Column
    tags_ok: Column
    labels: Column
    labels_missing: Column


def string_array(items: list[str]) -> Column:
    return F.array(*[F.lit(item) for item in items])


TEXT_KEYS = [k for k in REQUIRED_KEYS if k not in SCALE_KEYS + ["tags", "labels_json"]]


def no_nulls(items: Column) -> Column:
    """False if an element is null: joined texts then differ with and without a stand-in."""
    return F.length(F.array_join(items, "-", "-")) == F.length(F.array_join(items, "-"))


def typed_fields() -> TicketFields:
    """Fields of a table that already has the declared column types.

    Nothing can be missing or mistyped there, only null.
    """
    labels = F.col("labels_json")
    return TicketFields(
        is_record=F.lit(True),
        missing=F.array().cast("array<string>"),
        id_key=F.coalesce(F.concat(F.lit('"'), F.col("ticket_id"), F.lit('"')), F.lit("null")),
        text={k: F.col(k) for k in TEXT_KEYS},
        scales={
            k: Scale(F.col(k).isNotNull(), F.col(k).cast("bigint")) for k in SCALE_KEYS
        },
        tags=F.col("tags"),
        tags_ok=no_nulls(F.col("tags")),
        labels=labels,
        labels_missing=F.when(labels.isNotNull(), F.array().cast("array<string>")),
    )


WRAPPED = "wrapped"
PARSED = "parsed"
PARSE_OK = "parse_ok"
KEYS = "keys"
END_MARK = "end of line"


def parse_json(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``parsed`` (VARIANT), ``parse_ok`` and ``keys`` (null for non-objects).

    The parser stops after the first complete value and would let trailing
    characters pass. So the text is parsed inside a frame that only closes
    properly, with its mark in place, around exactly one value.
    """
    framed = F.concat(F.lit("[["), F.col(raw), F.lit(f'],"{END_MARK}"]'))

    def inside(path: str, kind: str) -> Column:
        return F.expr(f"try_variant_get({WRAPPED}, '{path}', '{kind}')")

    closed = inside("$[1]", "string").eqNullSafe(END_MARK)
    one_value = F.col(PARSED).isNotNull() & inside("$[0][1]", "variant").isNull()
    return (
        lines.withColumn(WRAPPED, F.try_parse_json(framed))
        .withColumn(PARSED, F.when(closed, inside("$[0][0]", "variant")))
        .withColumn(PARSE_OK, one_value)
        .drop(WRAPPED)
        .withColumn(PARSED, F.when(F.col(PARSE_OK), F.col(PARSED)))
        .withColumn(KEYS, F.expr(f"map_keys(try_variant_get({PARSED}, '$', 'map<string,variant>'))"))
    )


def json_value(key: str, kind: str, root: str = PARSED) -> Column:
    return F.expr(f"try_variant_get({root}, '$.{key}', '{kind}')")


def json_type(key: str, root: str = PARSED) -> Column:
    """Type name of a JSON member; null if absent."""
    return F.expr(f"schema_of_variant(try_variant_get({root}, '$.{key}', 'variant'))")


def json_key_text(key: str, root: str = PARSED) -> Column:
    """The member as JSON text, so that 5, "5" and null stay apart; null if absent."""
    return F.to_json(json_value(key, "variant", root))


def integer_of(value: Column, kind: Column) -> Column:
    """The value of a JSON integer; null for anything else.

    Booleans count as 0 and 1; ``3.0`` and ``"3"`` are no integers. Integers
    beyond 64 bits arrive as DECIMAL(p,0) with 19 digits or more; a stand-in
    keeps them out of range.
    """
    text = F.try_variant_get(value, "$", "string")
    huge = kind.startswith("DECIMAL") & kind.endswith(",0)") & (F.length(text) >= 19)
    return (
        F.when(kind.isin("BIGINT", "BOOLEAN"), F.try_variant_get(value, "$", "bigint"))
        .when(huge, F.when(text.startswith("-"), F.lit(-(2**62))).otherwise(F.lit(2**62)))
    )


def read_json_fields(parsed: DataFrame) -> DataFrame:
    """Strictly typed columns of parsed rows, as ``json_fields`` expects them.

    Kinds and values are columns of their own, so each is worked out once per
    row however many rules look at it.
    """
    kinds = {f"{k}_kind": json_type(k) for k in SCALE_KEYS}
    label_keys = F.expr(
        f"map_keys(try_variant_get({PARSED}, '$.labels_json', 'map<string,variant>'))"
    )
    elements = json_value("tags", "array<variant>")
    values = {k: json_value(k, "string") for k in TEXT_KEYS}
    values |= {k: integer_of(json_value(k, "variant"), F.col(f"{k}_kind")) for k in SCALE_KEYS}
    values |= {
        "tags": json_value("tags", "array<string>"),
        # A higher-order function also keeps this projection out of the span of
        # generated code around it: reading and checking in one method would be
        # too long for the JIT compiler.
        "tags_ok": F.coalesce(
            F.forall(elements, lambda e: F.schema_of_variant(e) == "STRING"), F.lit(False)
        ),
        "labels_json": json_value("labels_json", LABELS_TYPE),
        "labels_missing": F.array_except(string_array(LABEL_KEYS), label_keys),
        "missing": F.array_except(string_array(REQUIRED_KEYS), F.col(KEYS)),
        "id_key": F.when(
            F.col(KEYS).isNotNull(), F.coalesce(json_key_text("ticket_id"), F.lit("null"))
        ),
    }
    return parsed.withColumns(kinds).withColumns(values).drop(*kinds)


def json_fields() -> TicketFields:
    """Fields of rows that went through ``read_json_fields``."""
    return TicketFields(
        is_record=F.col(KEYS).isNotNull(),
        missing=F.col("missing"),
        id_key=F.col("id_key"),
        text={k: F.col(k) for k in TEXT_KEYS},
        scales={k: Scale(F.col(k).isNotNull(), F.col(k)) for k in SCALE_KEYS},
        tags=F.col("tags"),
        tags_ok=F.col("tags_ok"),
        labels=F.col("labels_json"),
        labels_missing=F.col("labels_missing"),
    )


def flatten_json(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """Typed ticket columns of parsed rows, read leniently.

    Numbers are truncated and numeric texts converted, a lone text serves as a
    one-tag list. Alongside: ``is_record``, ``missing`` keys, and
    ``priority_number``, the priority as written (null for a text).
    """
    tags = json_value("tags", "array<string>")
    lone_tag = F.when(json_type("tags") == "STRING", F.array(json_value("tags", "string")))
    written = F.when(json_type("priority") != "STRING", json_value("priority", "double"))
    columns = {key: json_value(key, "string") for key in TEXT_KEYS}
    columns |= {key: json_value(key, "int") for key in SCALE_KEYS}
    columns |= {"tags": F.coalesce(tags, lone_tag)}
    columns |= {"labels_json": json_value("labels_json", LABELS_TYPE)}
    return parsed.select(
        *keep,
        F.col(KEYS).isNotNull().alias("is_record"),
        F.array_except(string_array(REQUIRED_KEYS), F.col(KEYS)).alias("missing"),
        written.alias("priority_number"),
        *[columns[key].alias(key) for key in REQUIRED_KEYS],
    )
