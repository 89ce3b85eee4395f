"""Connected components of a graph kept in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import drop_aside, materialize, read_aside, write_aside


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, label): every vertex of `links` with the smallest vertex it can reach.

    Labels spread along the links, then jump to the label of their label, until nothing
    changes, so a path of n links takes about log n rounds. Each round is written to the
    shared folder. All steps are joins and map-side combined minima over the links; a vertex
    with very many links is a skewed join key that adaptive execution splits.
    """
    spark = links.sparkSession
    both = links.select(F.col(a).alias("vertex"), F.col(b).alias("near")).union(links.select(F.col(b), F.col(a)))
    path = write_aside(both.where("vertex != near").distinct(), "links")
    near = spark.read.parquet(path)
    labels_path = write_aside(near.groupBy("vertex").agg(F.least(F.col("vertex"), F.min("near")).alias("label")), "labels")
    schema = spark.read.parquet(labels_path).schema
    while True:
        labels = read_aside(spark, labels_path, schema)
        heard = (
            near.join(labels.withColumnRenamed("vertex", "near"), "near")
            .groupBy("vertex")
            .agg(F.min("label").alias("heard"))
        )
        spread = labels.join(heard, "vertex").select("vertex", F.col("label").alias("was"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("vertex").alias("label"), F.col("label").alias("jumped"))
        step = spread.join(jump, "label").select("vertex", "was", F.least("label", "jumped").alias("label"))
        next_path = write_aside(step, "labels")
        moved = spark.read.parquet(next_path)
        done = moved.where("label != was").isEmpty()
        drop_aside(spark, labels_path)
        labels_path = next_path
        if done:
            drop_aside(spark, path)
            return read_aside(spark, labels_path, schema)


def extended(labels: DataFrame, links: DataFrame, a: str, b: str) -> DataFrame:
    """`labels` of a graph after `links` are added: only the components they touch are worked on."""

    def lifted(side: str) -> DataFrame:
        return labels.select(F.col("vertex").alias(side), F.col("label").alias(f"{side}_label"))

    named = links.join(lifted(a), a, "left").join(lifted(b), b, "left")
    named = named.select(a, b, F.coalesce(f"{a}_label", a).alias("la"), F.coalesce(f"{b}_label", b).alias("lb"))
    joined = components(named, "la", "lb").select(F.col("vertex").alias("label"), F.col("label").alias("now"))
    fresh = links.select(F.col(a).alias("vertex")).union(links.select(b)).distinct()
    fresh = fresh.join(labels, "vertex", "left_anti").select("vertex", F.col("vertex").alias("label"))
    changed = labels.unionByName(fresh).join(joined, "label", "left")
    return materialize(changed.select("vertex", F.coalesce("now", "label").alias("label")), "labels")
