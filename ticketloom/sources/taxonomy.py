"""The category table: one row per leaf."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.fixed import LEAF_REMAP, TAXONOMY
from ticketloom.functions.rules import joined_path

FILE_SCHEMA = "taxonomy array<struct<l1:string,l2:string,l3:array<string>,tags:array<string>>>"


def built_in_taxonomy(spark: SparkSession) -> DataFrame:
    """The standard table as literal rows ``(k, l1, l2, l3, path, tags)``.

    A local relation: Catalyst knows its size and broadcasts it unasked.
    """
    leaves = [(l1, l2, l3, tags) for l1, l2, names, tags in TAXONOMY for l3 in names]
    table = pa.table(
        {
            "k": pa.array(range(len(leaves)), pa.int32()),
            "l1": [leaf[0] for leaf in leaves],
            "l2": [leaf[1] for leaf in leaves],
            "l3": [leaf[2] for leaf in leaves],
            "path": [" > ".join(leaf[:3]) for leaf in leaves],
            "tags": [leaf[3] for leaf in leaves],
        }
    )
    return spark.createDataFrame(table)


def load_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Read a taxonomy JSON file: ``{"taxonomy": [{l1, l2, l3: [...], tags: [...]}]}``."""
    leaves = F.flatten(
        F.transform(
            "taxonomy",
            lambda node: F.transform(
                node["l3"],
                lambda leaf: F.struct(
                    node["l1"].alias("l1"),
                    node["l2"].alias("l2"),
                    leaf.alias("l3"),
                    node["tags"].alias("tags"),
                ),
            ),
        )
    )
    rows = (
        spark.read.schema(FILE_SCHEMA)
        .json(path, multiLine=True)
        .select(F.posexplode(leaves).alias("k", "leaf"))
        .select("k", "leaf.*")
        .withColumn("path", joined_path(F.col("l1"), F.col("l2"), F.col("l3")))
    )
    # one row per path, as joins on it expect: a repeated leaf keeps its first place
    first = F.min(F.struct("k", "l1", "l2", "l3", "path", "tags")).alias("leaf")
    leaves = rows.groupBy("path").agg(first).select("leaf.*")
    return renumbered(leaves)


def renumbered(taxonomy: DataFrame) -> DataFrame:
    """``k`` without gaps, in its order. A taxonomy is a small dimension: one list sorts it."""
    rows = F.array_sort(F.collect_list(F.struct("k", "l1", "l2", "l3", "path", "tags")))
    numbered = taxonomy.agg(rows.alias("leaves")).select(F.posexplode("leaves").alias("n", "leaf"))
    return numbered.select(F.col("n").alias("k"), *[f"leaf.{c}" for c in ("l1", "l2", "l3", "path", "tags")])


def built_in_remap(spark: SparkSession) -> DataFrame:
    """Renamed leaves ``(l1, l2, l3, new_l1, new_l2, new_l3)``."""
    names = ["l1", "l2", "l3", "new_l1", "new_l2", "new_l3"]
    rows = [old + new for old, new in LEAF_REMAP]
    return spark.createDataFrame(pa.table([list(c) for c in zip(*rows)], names=names))


def allowed_paths(taxonomy: DataFrame) -> DataFrame:
    """Sorted category paths, for pasting into instructions."""
    return taxonomy.select("path").distinct().orderBy("path")
