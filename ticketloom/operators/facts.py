"""What reports and profiles need to know of a row, kept in a narrow table.

Texts are read once: their lengths, blankness and hashes, the outcome of the rules
that need whole texts, and the short columns are staged, and every table of a
report or a profile is a fold over these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.fields import TEXT_KEYS
from ticketloom.functions.rules import path_matches
from ticketloom.functions.text import is_blank, key_hash, strip, text_or_empty
from ticketloom.session import stage

PREFIX = "fact_"
TEXTS = ["title_ar", "description_ar"]


def told(df: DataFrame, kind: str, name: str, work_out: Column) -> Column:
    """A fact if ``df`` is a table of facts, else what it is worked out from."""
    fact = f"{PREFIX}{kind}_{name}"
    return F.col(fact) if fact in df.columns else work_out


def length_of(df: DataFrame, name: str) -> Column:
    """Characters, null for a null text."""
    return told(df, "length", name, F.length(name))


def blank_of(df: DataFrame, name: str) -> Column:
    return told(df, "blank", name, is_blank(F.col(name)))


def hash_of(df: DataFrame, name: str) -> Column:
    """A hash of a value as it stands; null has its own."""
    return told(df, "hash", name, key_hash(F.col(name)))


def text_key_of(df: DataFrame) -> Column:
    """A hash of the trimmed (title, description)."""
    return told(df, "key", "text", key_hash(*[strip(text_or_empty(F.col(c))) for c in TEXTS]))


def path_ok_of(df: DataFrame) -> Column:
    return told(df, "rule", "path", path_matches({key: F.col(key) for key in TEXT_KEYS}))


def gathered(df: DataFrame, keep: Sequence[str], texts: Sequence[str] = TEXTS, hashes: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep`` that ``df`` has and the facts, staged; one pass over ``df``.

    ``gaps`` says for every column of ``df`` whether it is null.
    """
    facts: dict[str, Column] = {}
    for name in texts:
        facts |= {f"length_{name}": F.length(name), f"blank_{name}": is_blank(F.col(name))}
    facts |= {f"hash_{name}": key_hash(F.col(name)) for name in hashes}
    if set(TEXTS) <= set(df.columns):
        facts["key_text"] = text_key_of(df)
    if "category_path" in df.columns:
        facts["rule_path"] = path_ok_of(df)
    facts["gaps"] = F.array(*[F.col(c).isNull() for c in df.columns])
    kept = [F.col(c) for c in keep if c in df.columns]
    return stage(df.select(*kept, *[c.alias(PREFIX + name) for name, c in facts.items()]), "facts")
