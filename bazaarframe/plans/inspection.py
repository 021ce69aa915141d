"""Inspection of a folder of raw CSV files before anything is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaarframe.operators.checks import union_all
from bazaarframe.operators.profile import all_duplicates, profile_columns, profile_shape
from bazaarframe.sources.csv_source import read_csv_folder


def inspect_folder(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """Size, columns with their missing values, and repeated rows of every ``*.csv`` in a folder.

    Results are stacked over the files and carry the file name as ``table_name``.
    """
    frames = read_csv_folder(spark, raw_dir)
    found = {
        kind: union_all([profile(df, name) for name, df in frames.items()])
        for kind, profile in (("shape", profile_shape), ("columns", profile_columns))
    }
    return {**found, "duplicates": all_duplicates(frames)}
