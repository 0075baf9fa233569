"""The text of a short list with the fewest edits, at a cost that grows with the given text's length only.

An alignment of a text of L characters with a shorter option that matches m of the option's
characters and leaves a out costs L - m + a edits. No more can match than those whose
character occurs in the text at all: u of them. Reading the option left to right, each
such character taken where it next occurs and each other one set against the next
character, either ends within the text, and then the distance is L - u exactly, or
leaves L - u as a bound. The full distance is worked out only for options whose bound is
better than the best exact one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom.functions.spans import let

#: Up to so many characters the full distance to every option is cheap.
SHORT = 400


def nearest(text: Column, options: Column) -> Column:
    """The option (of an array of texts) with the fewest edits to ``text``, ties by name; null for null."""

    def ranked(distance) -> Column:
        pairs = F.transform(options, lambda o: F.struct(distance(o).alias("d"), o.alias("v")))
        return F.array_min(F.filter(pairs, lambda p: p["d"].isNotNull()))

    plain = ranked(lambda o: F.levenshtein(text, o))["v"]
    by_size = F.when(F.length(text) <= SHORT, plain).otherwise(nearest_to_long(text, options, ranked))
    return F.when(text.isNotNull(), by_size)


def nearest_to_long(text: Column, options: Column, ranked) -> Column:
    letters = F.array_distinct(F.flatten(F.transform(options, lambda o: F.filter(F.split(o, ""), lambda c: c != ""))))

    def decided(held: Column, size: Column) -> Column:
        def bound(option: Column) -> Column:
            """(d, exact): the bound of the distance, and whether it is the distance."""
            start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("hits"), F.lit(True).alias("fits"))

            def step(seen: Column, letter: Column) -> Column:
                occurs = F.array_contains(held, letter)
                found = F.when(occurs, F.call_function("locate", letter, text, seen["at"] + 1)).otherwise(seen["at"] + 1)
                at = F.when(seen["fits"], found).otherwise(F.lit(0))
                return F.struct(
                    at.alias("at"), (seen["hits"] + occurs.cast("int")).alias("hits"),
                    (seen["fits"] & (at > 0) & (at <= size)).alias("fits"),
                )

            read = F.aggregate(F.filter(F.split(option, ""), lambda c: c != ""), start, step)
            return let(read, lambda r: F.struct((size - r["hits"]).alias("d"), (r["fits"] & (size >= F.length(option))).alias("exact")))

        bounds = F.transform(options, lambda o: F.struct(bound(o).alias("b"), o.alias("v")))

        def chosen(told: Column) -> Column:
            pairs = F.transform(F.filter(told, lambda t: t["b"]["exact"]), lambda t: F.struct(t["b"]["d"].alias("d"), t["v"].alias("v")))
            best = F.array_min(pairs)

            def rest(known: Column) -> Column:
                open_ones = F.filter(
                    told,
                    lambda t: ~t["b"]["exact"] & F.coalesce(F.struct(t["b"]["d"].alias("d"), t["v"].alias("v")) < known, F.lit(True)),
                )
                worked = F.transform(open_ones, lambda t: F.struct(F.levenshtein(text, t["v"]).alias("d"), t["v"].alias("v")))
                return F.array_min(F.concat(worked, F.filter(F.array(known), lambda k: k.isNotNull())))["v"]

            return let(best, rest)

        return let(bounds, chosen)

    occurring = F.filter(letters, lambda c: text.contains(c))
    return let(occurring, lambda held: let(F.length(text), lambda size: decided(held, size)))
