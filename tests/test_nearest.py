"""The nearest text of a list against all edit distances."""

import random
import time

from pyspark.sql import functions as F

from ticketloom.fixed import CHANNELS, TAXONOMY
from ticketloom.functions import nearest as module
from ticketloom.functions.nearest import nearest

PATHS = [f"{l1} > {l2} > {l3}" for l1, l2, names, _ in TAXONOMY for l3 in names]


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def texts(rng):
    letters = sorted(set("".join(PATHS)))
    for n in range(160):
        kind, size = n % 8, rng.choice([0, 1, 20, 45, 60, 90, 150])
        path = rng.choice(PATHS)
        yield {
            0: "".join(rng.choice(letters) for _ in range(size)),
            1: "".join(rng.choice("ابتثجح ") for _ in range(size)),
            2: "".join(rng.choice(" >") for _ in range(size)),
            3: path[: rng.randrange(len(path))] + "x" * size,
            4: "y" * size + path,
            5: path[::-1] * 2,
            6: "".join(sorted(path)) + "z" * rng.randrange(60),
            7: "".join(c + "é" * rng.randrange(3) for c in path[: rng.randrange(len(path))]),
        }[kind]


def test_same_answers_as_all_distances(spark, monkeypatch):
    given = list(texts(random.Random(2)))
    df = spark.createDataFrame(list(enumerate(given)), "n int, t string")
    for options in (PATHS, CHANNELS, ["", "a", "ab"]):
        listed = F.array(*[F.lit(o) for o in options])
        expected = [min((edits(t, o), o) for o in options)[1] for t in given]
        for short in (400, 0, -1):
            monkeypatch.setattr(module, "SHORT", short)
            got = {r.n: r.v for r in df.select("n", nearest(F.col("t"), listed).alias("v")).collect()}
            assert [got[n] for n in range(len(given))] == expected
    assert spark.range(1).select(nearest(F.lit(None).cast("string"), listed)).first()[0] is None


def test_five_megabytes(spark):
    """Long texts, Latin or not, are compared within seconds."""
    listed = F.array(*[F.lit(o) for o in PATHS])
    latin, other = "The quick brown fox > jumps/over " * 160_000, "نص عربي طويل جدا " * 300_000
    for text in (latin, other):
        df = spark.createDataFrame([(text,)], "t string")
        df.select(nearest(F.substring("t", 1, 2000), listed)).first()
        begun = time.perf_counter()
        found = df.select(nearest(F.col("t"), listed)).first()[0]
        assert time.perf_counter() - begun < 10
        best = min((len(text) - sum(c in text for c in p), p) for p in PATHS)
        assert found == best[1]
