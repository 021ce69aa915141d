"""Exact duplicates by content sort: equal texts come to stand side by side and are compared in full.

Sampled splitters range-partition the rows by the head of their normalised text and its digest, each partition is sorted externally, and a window
over equal neighbours (Spark compares the whole keys) finds each text's best row. A text with more rows than a partition
should hold is dealt over several runs by a salt that is part of the sort key; the runs' best rows, at most a few
per partition, are compared in full once more. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarframe.llm.store import stored

BLANKS = r"[\x20\x09-\x0D]+"
#: Characters of a text that decide its range.
HEAD = 64


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``<id_col>``, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical after every character of 0x20 and 0x09-0x0D is deleted; null counts as
    empty, and empty texts equal each other. Of equal texts the row with the most code points stays, then the one with the
    smallest id; a row without an id comes last, and of rows that agree in both one stays. An empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.regexp_replace(text, BLANKS, "").alias("norm"), F.char_length(text).alias("n_chars")
    ).withColumns({"digest": F.xxhash64("norm"), "head": F.left("norm", F.lit(HEAD))})

    # A text with more rows than an even share: there are fewer such texts than partitions, so the table is small.
    share = docs.count() // parts + 1
    hot = stored(
        rows.groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > share), "hot"
    ).select("digest", F.ceil(F.col("n") / share).alias("runs"))
    salted = rows.join(F.broadcast(hot), "digest", "left").withColumn(
        "salt", F.when(F.col("runs").isNull(), 0).otherwise(F.pmod(F.monotonically_increasing_id(), F.col("runs"))).cast("int")
    )

    # The splitters are sampled to the driver, so they hold a text's head and digest only; the sort goes on to the whole text.
    run = Window.partitionBy("head", "digest", "salt", "norm")
    best_first = run.orderBy(F.desc("n_chars"), F.asc_nulls_last("id"))
    sorted_rows = salted.repartitionByRange(parts, "head", "digest", "salt").select(
        "id",
        F.sha2("norm", 256).alias("sha"),
        "salt",
        F.row_number().over(best_first).alias("place"),
        F.first("id").over(best_first).alias("run_id"),
        F.first("n_chars").over(best_first).alias("run_chars"),
        F.count("*").over(run).alias("run_size"),
        F.col("runs").isNotNull().alias("split"),
        "norm",
    )
    marked = stored(
        sorted_rows.withColumn("norm", F.when(F.col("split") & (F.col("place") == 1), F.col("norm"))), "content_sort"
    )

    # Texts that were dealt over several runs, one row a run: fewer than three per partition.
    heads = marked.where("split and place = 1")
    order = F.struct((-F.col("run_chars")).alias("c"), F.col("run_id").isNull().alias("no_id"), "run_id", "salt")
    whole = heads.groupBy("norm", "sha").agg(F.min(order).alias("best"), F.sum("run_size").alias("size"))
    whole = whole.select("sha", "best", "size", F.lit(True).alias("merged"))
    out = marked.drop("norm").join(F.broadcast(whole), "sha", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("merged"), F.col("best.run_id")).otherwise(F.col("run_id")).alias("keep_id"),
        F.coalesce("size", "run_size").alias("group_size"),
        ((F.col("place") == 1) & (F.col("merged").isNull() | (F.col("salt") == F.col("best.salt")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
