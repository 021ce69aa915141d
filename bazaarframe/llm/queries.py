"""The registered queries of the package, with the parameters of production."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarframe.llm import (
    decontaminate,
    exact_dups,
    language,
    line_dups,
    maxent_lm,
    merkle,
    mixing,
    near_dups,
    packing,
    passages,
    periodic_runs,
    pii,
    token_counts,
)

from bazaarframe.llm.store import scratch


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tune(spark: SparkSession) -> None:
    """Arrow batches of a bounded size, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def op1_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(documents(spark, sf_dir), shingle=3, part=85, whole=100)


def op2_exact_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dups.exact_duplicates(documents(spark, sf_dir))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", language.held_out("doc_id", 3))
    return language.predict(docs, language.fit(docs.where("not held_out")), keep=("doc_id", "held_out"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table has a cache of its own, so that its first count encodes all its distinct texts, whatever ran before."""
    cache = f"{scratch(spark)}/token-cache-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), cache)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op6_line_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dups.duplicate_lines(documents(spark, sf_dir))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf_dir), size=35)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", language.held_out("doc_id", 5))
    return maxent_lm.score(docs, docs.where("not held_out"), keep=("doc_id", "held_out"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack(documents(spark, sf_dir), path, length=2048, end_id=50256, pad_id=50256)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = merkle.manifest(documents(spark, sf_dir), altered={"text": F.when(changed, lower).otherwise(F.col("text"))})
    seen = merkle.folded(F.coalesce("altered_leaf", "leaf"), F.col("proof"))
    out = rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), seen.alias("folded_root")
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.personal_data(docs, pii.fit(docs))


def looped_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; in one document of ten, by the checksum of its id, the text's words repeat from some word on."""
    check = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    rows = docs.select("doc_id", "text", F.floor(check / 10).alias("g"), F.when(check % 10 == 0, words).alias("words"))
    n = F.size("words")
    rows = rows.withColumn("from", F.when(n > 0, F.col("g") % n).cast("int"))
    rows = rows.withColumn("period", (1 + F.floor((n - F.col("from")) / (3 + F.col("g") % 8))).cast("int"))
    rest = n - F.col("from")
    block = F.slice("words", F.col("from") + 1, F.col("period"))
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil(rest / F.col("period")).cast("int"))), F.lit(1), rest)
    looped = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("from")), tail), " ")
    return rows.select("doc_id", F.when(F.col("from").isNotNull(), looped).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(looped_tails(documents(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_dups,
        op2_exact_dups,
        op3_language,
        op4_token_counts,
        op5_mixing,
        op6_line_dups,
        op7_passages,
        op8_decontaminate,
        op9_maxent_lm,
        op10_packing,
        op11_merkle,
        op12_pii,
        op13_periodic_runs,
    )
}
