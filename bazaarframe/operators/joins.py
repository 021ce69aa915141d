"""Equi-joins that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def require_exact_sizes(spark: SparkSession, partitions: int) -> None:
    """Raise if adaptive execution would miss a hot key at this number of shuffle partitions.

    Above ``spark.shuffle.minNumPartitionsToHighlyCompress`` Spark keeps only the average size of a map output's
    blocks, and a hot key's block counts as average too unless ``spark.shuffle.accurateBlockSkewedFactor`` is set. That
    setting belongs to the application and cannot be changed from a running session.
    """
    conf = spark.sparkContext.getConf()
    exact_up_to = int(conf.get("spark.shuffle.minNumPartitionsToHighlyCompress", "2000"))
    if partitions > exact_up_to and float(conf.get("spark.shuffle.accurateBlockSkewedFactor", "-1")) <= 0:
        raise ValueError(
            f"{partitions} shuffle partitions hide hot keys from adaptive execution; "
            "start the application with spark.shuffle.accurateBlockSkewedFactor=5"
        )


def unique_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join a large left side to a right side that is unique on ``key``.

    Spark broadcasts a small right side, and adaptive execution splits a hot key's partition: the rows of the left side
    by the map tasks that wrote them, each part with all of the right side's partition. ``require_exact_sizes`` sees to it
    that hot keys show at every number of partitions.
    """
    return left.join(right, key, how)
