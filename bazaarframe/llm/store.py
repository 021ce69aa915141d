"""Intermediate tables in the shared folder, and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a temporary one for a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set; name a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/corpus-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove all intermediate tables of this session, once their results have been read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unnamed(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """The frame with columns c0, c1, ..., and what ``names`` are called there: no column clashes with those an operator adds.

    ``toDF(*df.columns)`` gives the names back.
    """
    places = {c.lower(): f"c{i}" for i, c in reversed(list(enumerate(df.columns)))}
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), [places[n.lower()] for n in names]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) links: rows (node, component) with the smallest node of each.

    Large-star and small-star steps alternate until nothing changes; each step is written to the shared
    folder. Hubs meet only in aggregations with partial sums and in joins that adaptive execution splits.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    links = stored(links, "links")
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(small.union(least).where("u <> v").distinct(), "links")
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
