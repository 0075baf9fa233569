"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of the output over its share of
the input. Each document gets a number of copies from the Poisson distribution
with that mean, by inverting it at a number in [0, 1) hashed from seed and id;
the copies are exploded and put in a global order hashed from seed, id and copy.
A rate above ``STEP`` is a sum of independent draws with rates of at most
``STEP``, so the inversion never underflows and no rate is capped.

Defined cases: a null source is a source of its own; sources that ``weights``
does not name weigh 0 and go; rows that repeat an id get the same count each; a
null id draws as the empty text; an empty table gives no rows. Columns of the
input keep their names; ``copy_no`` and ``rate`` are added by ``replicate`` only
under names the caller may change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import ready
from ticketloom.session import stage

STEP = 16.0
#: Beyond so many terms the tail of a Poisson distribution with mean STEP is below 2**-53.
TERMS = 90


def unit(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, hashed from the parts as texts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def distribution(rate: Column) -> Column:
    """The values of the distribution function at 0, 1, ..., TERMS - 1."""
    start = F.struct(F.exp(-rate).alias("term"), F.array(F.exp(-rate)).alias("sums"))

    def more(state: Column, k: Column) -> Column:
        term = state["term"] * rate / k
        return F.struct(term.alias("term"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + term)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), start, more, lambda s: s["sums"])


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.5, size: float = 1.0, source: str = "source") -> DataFrame:
    """One row for each source: rows, rate, number of draws, distribution of a draw.

    ``weights`` gives target weights by source; without it a source weighs its
    number of rows to the ``power``. The output has ``size`` times the input's
    rows on average.
    """
    spark = docs.sparkSession
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, weight double")
        weighed = counts.join(given, F.col("source").eqNullSafe(F.col("name")), "left").drop("name").fillna(0.0, ["weight"])
    # keyed by source: what is summed here is a row for each source
    total = weighed.agg(F.sum("n").alias("all_n"), F.sum("weight").alias("all_weight"))
    rate = F.when(F.col("all_weight") > 0, F.lit(size) * F.col("all_n") * F.col("weight") / F.col("all_weight") / F.col("n")).otherwise(F.lit(0.0))
    out = weighed.join(F.broadcast(total)).select("source", "n", rate.alias("rate"))
    draws = F.greatest(F.ceil(F.col("rate") / STEP), F.lit(1)).cast("int")
    out = out.withColumn("draws", draws).withColumn("sums", distribution(F.col("rate") / F.col("draws")))
    return stage(out, "mix-rates")


def counted(docs: DataFrame, table: DataFrame, seed: int, id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """``row`` (the row of docs), ``rate`` and ``copies`` for each row."""
    table = table.select(F.col("source").alias("mix_source"), "rate", "draws", "sums")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("mix_id"), F.col(source).alias("mix_from"))
    joined = rows.join(table, F.col("mix_from").eqNullSafe(F.col("mix_source")))

    def draw(k: Column) -> Column:
        u = unit(F.lit(seed), F.col("mix_id"), k)
        return F.size(F.filter("sums", lambda x: x <= u))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("draws")), F.lit(0), lambda acc, k: acc + draw(k))
    return joined.select("row", "mix_id", "rate", copies.alias("copies"))


def replicate(docs: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.5, size: float = 1.0, seed: int = 17,
              id_col: str = "doc_id", source: str = "source", copy_as: str | None = "copy_no", rate_as: str | None = None) -> DataFrame:
    """Copies of the rows of ``docs`` in a global shuffled order.

    Partitions are ranges of the order's key and sorted inside, so files written
    from the result read as one random permutation. An added column whose name
    ``docs`` has already gets underscores until it is free.
    """
    spark = ready(docs.sparkSession)
    rows = counted(docs, rates(docs, weights, power, size, source), seed, id_col, source).where("copies > 0")
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    keyed = copies.withColumn("order_key", unit(F.lit(seed), F.lit("order"), F.col("mix_id"), F.col("copy")))
    # the key is uniform by construction, so its ranges are known without sampling the data
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartitionById(parts, F.floor(F.col("order_key") * parts).cast("int")).sortWithinPartitions("order_key", "mix_id", "copy")
    extra, used = [], {c.lower() for c in docs.columns}
    for column, name in (("copy", copy_as), ("rate", rate_as)):
        while name and name.lower() in used:
            name += "_"
        if name:
            extra.append(F.col(column).alias(name))
            used.add(name.lower())
    return dealt.select("row.*", *extra)
