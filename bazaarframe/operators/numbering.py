"""Dense numbers for the rows of a table, without a window over all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bazaarframe.session import new_folder

_PLACE_BITS = 33  # monotonically_increasing_id: the place in the partition, below the partition's number


def numbered(df: DataFrame, column: str, *order: str, folder: str | None = None) -> DataFrame:
    """The rows with numbers 1, 2, 3, ... in the order of the given columns.

    The sorted rows are written once to the folder, by default one in the shared folder, with their place in their partition; a
    partition's first number is one more than the rows of the partitions before it, one row per partition.
    """
    spark = df.sparkSession
    path = folder or new_folder(spark, "numbered")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", _PLACE_BITS))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    starts = sizes.select("_part", before.alias("_before"))
    return rows.join(starts, "_part").withColumn(column, F.col("_before") + place + 1).drop("_at", "_part", "_before")
