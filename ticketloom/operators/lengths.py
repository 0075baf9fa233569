"""Statistics of lengths and other numbers, all computed from one narrow frequency table.

The heavy pass counts rows per (field, class, value): partial aggregation
leaves at most one row per distinct value and task, whatever the skew. Every
statistic below is exact and reads only those counts, of which a continuous
column may have as many as rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.operators.facts import blank_of, length_of
from ticketloom.session import stage

KDE_POINTS = 200
#: Distinct values of all groups up to which quantiles are gathered by group; exact on both sides.
SMALL = 10_000


def value_frequencies(df: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., x, n)``: rows per distinct value; null values and null classes are left out."""
    wanted = df.select(*by, value.alias("x")).dropna(subset=[*by, "x"])
    return wanted.groupBy(*by, "x").agg(F.count("*").alias("n"))


def text_lengths(df: DataFrame, fields: Sequence[str], null_as_empty: bool = False) -> DataFrame:
    """``(field, x, n, n_blank)``: rows per length in code points of each text field.

    ``n_blank`` counts null and white-space-only texts. Nulls have a length of
    their own, null, or count as empty texts.
    """
    def entry(name: str) -> Column:
        length = length_of(df, name)
        return F.struct(
            F.lit(name).alias("field"),
            (F.coalesce(length, F.lit(0)) if null_as_empty else length).alias("x"),
            blank_of(df, name).alias("blank"),
        )

    pairs = df.select(F.inline(F.array(*[entry(f) for f in fields])))
    return pairs.groupBy("field", "x").agg(
        F.count("*").alias("n"), F.count_if("blank").alias("n_blank")
    )


def summary(freq: DataFrame, by: Sequence[str]) -> DataFrame:
    """min, max, mean and exact median per group of a frequency table."""
    freq = stage(freq, "frequencies")
    weight = F.when(F.col("x").isNotNull(), F.col("n"))
    blank = [F.sum("n_blank").alias("n_blank")] if "n_blank" in freq.columns else []
    told = freq.groupBy(*by).agg(
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        (F.sum(F.col("x") * weight) / F.sum(weight)).alias("mean"),
        *blank,
    )
    middle = quantiles(freq, by, [0.5]).select(*by, F.col("q")[0].alias("median"))
    return told.join(middle, list(by), "left").select(*by, "min", "max", "mean", "median", *(["n_blank"] if blank else []))


def quantiles(freq: DataFrame, by: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``(by..., q)``: exact quantiles of each group of a staged table of (by..., x, n), interpolated.

    Few distinct values are gathered by group. Beyond ``SMALL`` rows the table is dealt
    into ranges of (by, x); the counts of these, added up, tell which range holds a
    rank, and only rows of such ranges are counted through. A range is one task,
    a group never is.
    """
    freq = freq.where("x is not null").select(*by, F.col("x").cast("double").alias("x"), "n")
    if freq.count() <= SMALL:
        return freq.groupBy(*by).agg(F.percentile("x", list(shares), F.col("n")).alias("q"))
    ranged = freq.repartitionByRange(*by, "x").withColumn("range", F.spark_partition_id())
    ranged = stage(ranged, "quantile-ranges")
    before = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each group and range
    counts = ranged.groupBy(*by, "range").agg(F.sum("n").alias("held"))
    starts = stage(counts.withColumn("start", F.coalesce(F.sum("held").over(before), F.lit(0))), "range-starts")
    totals = starts.groupBy(*by).agg(F.sum("held").alias("total"))
    wanted = totals.select(*by, "total", F.posexplode(F.array(*[F.lit(float(s)) for s in shares])).alias("k", "share"))
    place = (F.col("total") - 1) * F.col("share")
    wanted = wanted.withColumns({"low": F.floor(place), "part": place - F.floor(place)})
    ranks = wanted.select(*by, "k", "part", F.explode(F.array("low", F.least(F.col("low") + 1, F.col("total") - 1))).alias("rank"), "low")
    ranks = ranks.withColumn("is_low", F.col("rank") == F.col("low"))
    held = ranks.join(starts, list(by)).where("rank >= start and rank < start + held").distinct()
    held = stage(held.select(*by, "range", "start", "k", "part", "rank", "is_low"), "ranks")
    upto = Window.partitionBy(*by, "range").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.join(F.broadcast(held.select(*by, "range", "start").distinct()), [*by, "range"])
    inside = inside.withColumn("first", F.col("start") + F.coalesce(F.sum("n").over(upto), F.lit(0))).drop("start")
    found = inside.join(F.broadcast(held.drop("start")), [*by, "range"]).where("rank >= first and rank < first + n")
    # of two ranks that are one, as at the end, both ends are that value
    low, high = F.max(F.when(F.col("is_low"), F.col("x"))), F.max("x")
    values = found.groupBy(*by, "k").agg(low.alias("low"), high.alias("high"), F.first("part").alias("part"))
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    listed = values.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("k", value.alias("v")))).alias("q"))
    return listed.withColumn("q", F.transform("q", lambda x: x["v"]))


def length_stats(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per text field: min, max, mean, median length and blank rows, from one pass."""
    return summary(text_lengths(df, fields), ["field"])


def pinned(freq: DataFrame) -> DataFrame:
    """The frequencies on shared storage: steps that use them repeatedly scan the source once."""
    return stage(freq.where("x is not null"), "frequencies")


def medians(freq: DataFrame, by: str) -> DataFrame:
    """Exact median per class, largest first."""
    middle = quantiles(pinned(freq), [by], [0.5])
    return middle.select(by, F.col("q")[0].alias("median")).orderBy(F.desc("median"), by)


def box_stats(freq: DataFrame, by: str) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 IQR, and outlier rows, per class."""
    freq = pinned(freq)
    quartiles = quantiles(freq, [by], [0.25, 0.5, 0.75])
    spread = F.col("q")[2] - F.col("q")[0]
    low, high = F.col("q")[0] - 1.5 * spread, F.col("q")[2] + 1.5 * spread
    inside = F.col("x").between(low, high)
    return (
        freq.join(quartiles, by)
        .groupBy(by, "q")
        .agg(
            F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_outliers"),
        )
        .select(
            by,
            "whisker_low",
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
            "whisker_high",
            "n_outliers",
        )
    )


def ranges(freq: DataFrame, by: Sequence[str]) -> DataFrame:
    """Histogram range per group; a single value gets half a unit on either side."""
    flat = F.col("low") == F.col("high")
    return (
        freq.groupBy(*by)
        .agg(
            F.min("x").cast("double").alias("low"),
            F.max("x").cast("double").alias("high"),
            F.sum("n").alias("total"),
            F.sum(F.col("x") * F.col("n")).cast("double").alias("sum_x"),
        )
        .withColumns(
            {
                "low": F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")),
                "high": F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")),
            }
        )
    )


def histogram(freq: DataFrame, by: Sequence[str], bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins included."""
    freq = pinned(freq)
    edges = ranges(freq, by).select(*by, "low", "high")
    bucket = F.least(F.width_bucket(F.col("x").cast("double"), "low", "high", F.lit(bins)), F.lit(bins))
    filled = freq.join(edges, list(by)).groupBy(*by, bucket.alias("bin")).agg(F.sum("n").alias("n"))
    frame = edges.withColumn("bin", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))))
    width = (F.col("high") - F.col("low")) / bins
    return frame.join(filled, [*by, "bin"], "left").select(
        *by,
        "bin",
        (F.col("low") + (F.col("bin") - 1) * width).alias("bin_low"),
        (F.col("low") + F.col("bin") * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def density_curve(freq: DataFrame, by: Sequence[str], bins: int = 40) -> DataFrame:
    """Gaussian kernel density on 200 points over [min, max], scaled to histogram counts.

    Scott's bandwidth, ``std * n ** (-1/5)``. Each distinct value is spread
    over the fixed grid, so the work is distinct values times 200, and
    partial aggregation brings it back to 200 rows per group and task.
    """
    freq = pinned(freq)
    centred = F.col("x") - F.col("sum_x") / F.col("total")
    stats = ranges(freq, by)
    spread = (
        freq.join(stats, list(by))
        .groupBy(*by)
        .agg(F.sqrt(F.try_divide(F.sum(F.col("n") * centred * centred), F.first("total") - 1)).alias("std"))
    )
    shape = stats.join(spread, list(by)).select(
        *by,
        "low",
        "high",
        (F.col("std") * F.pow(F.col("total").cast("double"), F.lit(-0.2))).alias("bw"),
        ((F.col("high") - F.col("low")) / bins).alias("bin_width"),
    )
    point = F.col("low") + F.col("j") * ((F.col("high") - F.col("low")) / (KDE_POINTS - 1))
    z = (F.col("point") - F.col("x")) / F.col("bw")
    weight = F.col("n") * F.exp(-0.5 * z * z) * F.col("bin_width") / (
        F.col("bw") * math.sqrt(2 * math.pi)
    )
    return (
        freq.join(shape.where("bw > 0"), list(by))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(KDE_POINTS - 1))))
        .withColumn("point", point)
        .groupBy(*by, "j", "point")
        .agg(F.sum(weight).alias("height"))
    )
