"""Repeated rows by hash, and told apart in full where hashes agree."""

from pyspark.sql import functions as F

from bazaarframe.operators.profile import all_duplicates, profile_duplicates

ROWS = [(1, "a", None), (1, "a", None), (1, None, "a"), (None, "a", None), (None, "a", None), (None, "a", None), (2, "b", "c")]


def counts(df):
    return {r["table_name"]: r["duplicated_rows"] for r in df.collect()}


def test_duplicates_of_several_tables(spark):
    x = spark.createDataFrame(ROWS, "a int, `b.c` string, hashes string")
    y = spark.createDataFrame(ROWS[2:], "a int, b string, n string")
    assert counts(all_duplicates({"x": x, "y": y, "z": x.limit(0)})) == {"x": 3, "y": 2, "z": 0}
    assert counts(profile_duplicates(x, "x")) == {"x": 3}


def test_rows_that_share_hashes_are_told_apart(spark):
    def same(columns):
        return [F.lit(1).alias("hash_1"), F.lit(2).alias("hash_2")]

    x = spark.createDataFrame(ROWS, "a int, b string, c string")
    assert counts(all_duplicates({"x": x}, same)) == {"x": 3}


def test_only_hashes_of_single_rows_are_shuffled(spark, tmp_path):
    wide = spark.range(2000).withColumn("text", F.repeat(F.sha2(F.col("id").cast("string"), 256), 10))
    found = all_duplicates({"wide": wide})
    assert counts(found) == {"wide": 0}
    joined = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in joined and "hashpartitioning(hashes" not in joined
