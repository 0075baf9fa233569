"""Where the members of a JSON object stand in its text, and replacing some of them there.

One pass over the tokens of a line: the text is cut into strings, flat arrays,
brackets, commas, blanks and scalars, and a fold over these keeps the depth, the
offset and the member it is in. All quantifiers are possessive, so the pattern
neither backtracks nor recurses on long texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: JSON white space; a string; its tokens, where a key takes its colon along
JSON_BLANKS = " \t\r\n"
STRING = r'"(?:[^"\\]++|\\.)*+"'
TOKEN = rf'{STRING}(?:\s*+:)?+|\[(?:[^\[\]{{}}"]++|{STRING})*+\]|[\[\]{{}},]|\s++|[^"\[\]{{}},:\s]++'
EMPTY_OBJECT = r"^\{\s*+\}\s*+$"
SPAN = "array<struct<key:string,first:int,last:int>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, also where ``use`` names it often."""
    return F.element_at(F.transform(F.array(value), use), 1)


def key_name(token: Column) -> Column:
    """The name in a key token, which ends in its colon."""
    quoted = F.rtrim(token, F.lit(JSON_BLANKS + ":"))
    plain = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    decoded = F.from_json(F.concat(F.lit("["), quoted, F.lit("]")), "array<string>")[0]
    return F.when(plain.contains("\\"), decoded).otherwise(plain)


def member_spans(raw: Column, keys: list[str] | None = None) -> Column:
    """``(key, first, last)`` of the top-level members of a JSON object, in their order.

    ``raw`` from character ``first`` (from 0) up to but not including ``last`` is the
    member's value as written. ``keys`` limits the table to these names; a repeated
    key has a row for each time. The text must be valid JSON.
    """
    start = F.struct(
        F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(None).cast("string").alias("key"),
        F.lit(-1).alias("first"), F.lit(-1).alias("last"), F.array().cast(SPAN).alias("spans"),
    )

    def step(seen: Column, token: Column) -> Column:
        depth, at, key, first = seen["depth"], seen["at"], seen["key"], seen["first"]
        size, on_top = F.length(token), seen["depth"] == 1
        is_key = on_top & token.endswith(":")
        ends = on_top & token.isin(",", "}")
        is_value = (depth > 0) & ~is_key & ~ends & (F.trim(token, F.lit(JSON_BLANKS)) != "")
        name = key_name(token)
        if keys is not None:
            name = let(name, lambda n: F.when(n.isin(*keys), n))
        found = F.array(F.struct(key.alias("key"), first.alias("first"), seen["last"].alias("last")))
        return F.struct(
            (depth + F.when(token.isin("{", "["), 1).when(token.isin("}", "]"), -1).otherwise(0)).alias("depth"),
            (at + size).alias("at"),
            F.when(is_key, name).when(~ends, key).alias("key"),
            F.when(is_key, -1).when(is_value & (first < 0), at).otherwise(first).alias("first"),
            F.when(is_value, at + size).otherwise(seen["last"]).alias("last"),
            F.when(ends & key.isNotNull(), F.concat(seen["spans"], found)).otherwise(seen["spans"]).alias("spans"),
        )

    return F.aggregate(F.regexp_extract_all(raw, F.lit(TOKEN), F.lit(0)), start, step)["spans"]


def patch_members(raw: Column, new: dict[str, Column]) -> Column:
    """The JSON object ``raw`` with other values for some members, all else byte for byte.

    ``new`` gives JSON text by key; a null keeps what is there. Members nobody knows,
    key order, blanks, numbers as they are written and repeated keys stay. A repeated
    key gets the new value wherever it stands; a key that ``raw`` lacks is added at the end.
    """
    given = F.filter(
        F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in new.items()]),
        lambda member: member["value"].isNotNull(),
    )

    def spliced(spans: Column, values: Column) -> Column:
        def value_of(key: Column) -> Column:
            return F.filter(values, lambda member: member["key"] == key)[0]["value"]

        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

        def step(done: Column, span: Column) -> Column:
            kept = F.substring(raw, done["at"] + 1, span["first"] - done["at"])
            return F.struct(F.concat(done["out"], kept, value_of(span["key"])).alias("out"), span["last"].alias("at"))

        changed = F.filter(spans, lambda span: F.exists(values, lambda member: member["key"] == span["key"]))
        head = F.aggregate(changed, start, step)
        added = F.filter(values, lambda member: ~F.exists(spans, lambda span: span["key"] == member["key"]))
        names = F.transform(added, lambda member: F.concat(json_string(member["key"]), F.lit(":"), member["value"]))
        comma = F.when((F.size(names) > 0) & ~raw.rlike(EMPTY_OBJECT), F.lit(",")).otherwise(F.lit(""))

        def whole(cut: Column) -> Column:
            rest = F.rtrim(F.substring(raw, cut["at"] + 1, F.length(raw)), F.lit(JSON_BLANKS))
            return F.concat(cut["out"], F.substring(rest, F.lit(1), F.length(rest) - 1), comma, F.array_join(names, ","), F.lit("}"))

        return let(head, whole)

    return let(given, lambda values: let(member_spans(raw, list(new)), lambda spans: spliced(spans, values)))


def json_string(text: Column) -> Column:
    """The text as a JSON string, quotes and all."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)
