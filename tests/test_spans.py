"""Member spans and patches against a scan with Python's own JSON decoder."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from ticketloom.functions.spans import member_spans, patch_members

KEYS = ["a", "b", "priority", "tags", "é", 'q"uote', "back\\slash", "", "a:b", "{", "nested"]
SCALARS = [0, -1, 3.0, 10**40, True, False, None, "", "x", "com,ma", "br{ace]", 'qu"ote', "back\\", "\\\"", "tab\t\n", "اختبار", "😀", "a" * 300, " "]
GAPS = ["", "", " ", "  ", "\t", "\r"]


def written(rng, value) -> str:
    """JSON text with random blanks and now and then an escaped letter."""
    gap = rng.choice(GAPS)
    if isinstance(value, dict):
        return member_text(rng, list(value.items()))
    if isinstance(value, list):
        return "[" + ",".join(gap + written(rng, v) + rng.choice(GAPS) for v in value) + "]" if value else f"[{gap}]"
    if value == 3.0 and isinstance(value, float):
        return rng.choice(["3.0", "3e0", "3.000E+00"])
    return json.dumps(value, ensure_ascii=rng.random() < 0.5)


def member_text(rng, members) -> str:
    def key(k):
        return '"\\u0061"' if k == "a" and rng.random() < 0.3 else json.dumps(k, ensure_ascii=rng.random() < 0.5)

    inner = ",".join(f"{rng.choice(GAPS)}{key(k)}{rng.choice(GAPS)}:{rng.choice(GAPS)}{written(rng, v)}{rng.choice(GAPS)}" for k, v in members)
    return "{" + (inner or rng.choice(GAPS)) + "}"


def any_value(rng, depth):
    kind = rng.random()
    if depth < 4 and kind < 0.2:
        return [any_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    if depth < 4 and kind < 0.4:
        return {k: any_value(rng, depth + 1) for k in rng.sample(KEYS, rng.randrange(4))}
    return rng.choice(SCALARS)


def lines(n: int) -> list[str]:
    rng = random.Random(7)
    return [member_text(rng, [(rng.choice(KEYS), any_value(rng, 0)) for _ in range(rng.randrange(9))]) for _ in range(n)]


def brute_spans(raw: str):
    decoder, at, found = json.JSONDecoder(), 1, []

    def blanks(i):
        while raw[i] in " \t\r\n":
            i += 1
        return i

    at = blanks(at)
    while raw[at] != "}":
        key, at = decoder.raw_decode(raw, blanks(at))
        first = blanks(blanks(at) + 1)
        _, at = decoder.raw_decode(raw, first)
        found.append((key, first, at))
        at = blanks(at)
        at = blanks(at + 1) if raw[at] == "," else at
    return found


def brute_patch(raw: str, new: dict) -> str:
    new = {k: v for k, v in new.items() if v is not None}
    spans, out, at = brute_spans(raw), "", 0
    for key, first, last in spans:
        if key in new:
            out, at = out + raw[at:first] + new[key], last
    rest = raw[at:].rstrip(" \t\r\n")[:-1]
    fresh = [f"{json.dumps(k, ensure_ascii=False)}:{v}" for k, v in new.items() if k not in {s[0] for s in spans}]
    return out + rest + ("," if fresh and spans else "") + ",".join(fresh) + "}"


@pytest.fixture(scope="module")
def raws():
    return [*lines(600), "{}", "{ }", ' {"a" : 1 } '.strip(), '{"a":{"a":{"a":[[[]]]}},"b":[]}', '{"a":1,"a":2,"b":3,"a":[4]}']


def test_spans(spark, raws):
    df = spark.createDataFrame(list(enumerate(raws)), "n int, raw string")
    rows = df.select("n", member_spans(F.col("raw")).alias("all"), member_spans(F.col("raw"), ["a", "é", ""]).alias("some")).collect()
    for row in rows:
        expected = brute_spans(raws[row.n])
        assert [tuple(s) for s in row["all"]] == expected, raws[row.n]
        assert [tuple(s) for s in row.some] == [s for s in expected if s[0] in ("a", "é", "")]


@pytest.mark.parametrize("new", [{"a": "7"}, {"priority": "[1, 2]", "zz": '"new"'}, {"é": '{"k":null}', "a": None, "": "0"}, {"none": None}])
def test_patches(spark, raws, new):
    df = spark.createDataFrame(list(enumerate(raws)), "n int, raw string")
    values = {k: F.lit(v).cast("string") for k, v in new.items()}
    for row in df.select("n", patch_members(F.col("raw"), values).alias("out")).collect():
        assert row.out == brute_patch(raws[row.n], new), raws[row.n]


def test_numbers_and_blanks_stay(spark):
    raw = '{ "x" : 1e2,\t"priority":3 , "y":[ 1.50, {"z" : 00 } ],"big":' + "9" * 60 + " }"
    got = spark.range(1).select(patch_members(F.lit(raw), {"priority": F.lit("5")})).first()[0]
    assert got == raw.replace('"priority":3 ,', '"priority":5 ,')


def test_long_lines_take_linear_time(spark):
    """Long texts, thousands of escapes and brackets: no recursion, and ten times the text about ten times the time."""

    def seconds(n):
        raw = json.dumps({"t": 'a"\n\\' * n, "list": [{"k": [k]} for k in range(n // 20)], "deep": "x" * n, "priority": 1})
        df = spark.createDataFrame([(raw,)], "raw string").coalesce(1)
        begun = time.perf_counter()
        out = df.select(patch_members(F.col("raw"), {"priority": F.lit("2")})).first()[0]
        assert out == raw[:-2] + "2}"
        return time.perf_counter() - begun

    seconds(100)
    small, large = seconds(20_000), seconds(200_000)
    assert large < 40 * max(small, 0.2)
