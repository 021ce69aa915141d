"""Profiling of arbitrary tables: size, missing values, repeated rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarframe.session import new_folder


def profile_shape(df: DataFrame, name: str) -> DataFrame:
    """One row (table_name, row_count, column_count)."""
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
    )


def profile_columns(df: DataFrame, name: str) -> DataFrame:
    """One row per column (table_name, position, column_name, nulls), counted in one scan."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(i + 1).alias("position"),
            F.lit(c).alias("column_name"),
            F.col(f"n{i}").alias("nulls"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def profile_nulls(df: DataFrame, name: str) -> DataFrame:
    """Columns that hold NULLs and how many."""
    return profile_columns(df, name).where("nulls > 0").select("table_name", "column_name", "nulls")


def row_hashes(columns: list[Column]) -> list[Column]:
    """Two hashes of 64 bits over all columns of a row, NULLs marked: without that a NULL would leave no trace."""
    marked = [part for c in columns for part in (c.isNull(), c)]
    return [F.xxhash64(F.lit(seed), *marked).alias(f"hash_{seed}") for seed in (1, 2)]


def all_duplicates(
    frames: dict[str, DataFrame], hashes: Callable[[list[Column]], list[Column]] = row_hashes
) -> DataFrame:
    """Per table the rows (table_name, duplicated_rows) that repeat an earlier row in full; NULL equals NULL.

    Rows are grouped by hashes first, all tables in one job. Only rows whose hashes come again are then grouped in full, so wide
    rows that are alone are never shuffled, and rows that merely share hashes are told apart. The repeated hashes are
    written to the shared folder once.
    """
    hashed = {}
    for name, df in frames.items():
        plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
        columns = [F.col(c) for c in plain.columns]
        hashed[name] = plain.select(*columns, F.struct(*hashes(columns)).alias("hashes"))
    spark = df.sparkSession
    keys = reduce(DataFrame.union, [h.select(F.lit(name).alias("name"), "hashes") for name, h in hashed.items()])
    again = keys.groupBy("name", "hashes").agg(F.count("*").alias("n")).where("n > 1").select("name", "hashes")
    path = new_folder(spark, "repeated_hashes")
    again.write.parquet(path)
    again = spark.read.schema(again.schema).parquet(path)
    found = []
    for name, rows in hashed.items():
        met = rows.join(again.where(F.col("name") == name).select("hashes"), "hashes", "left_semi")
        copies = met.groupBy(*[c for c in rows.columns if c != "hashes"]).agg(F.count("*").alias("n"))
        found.append(copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d")).select(F.lit(name).alias("table_name"), F.col("d").alias("duplicated_rows")))
    return reduce(DataFrame.union, found)


def profile_duplicates(df: DataFrame, name: str) -> DataFrame:
    """Rows of one table that repeat an earlier row in full, as all_duplicates counts them."""
    return all_duplicates({name: df})
