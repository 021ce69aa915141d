"""Token counts through a digest cache.

A text's count depends on its bytes and on the tokenizer alone. So the cache is a Parquet table of counts under the digest
of the tokenizer's file and library version, keyed by the SHA-256 of the text (null as empty). Only distinct texts that
the cache lacks are encoded, and their counts are appended before the result is joined together from the cache. Without a
folder of its own the cache is one in the session's shared folder, the same for all calls of the session.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import json
import re
import threading
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarframe.llm.store import scratch

#: A blank between two characters that are no white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Encoded word runs remembered by a task.
MEMO = 300_000
BATCH = 512
#: Of calls at once, one appends at a time: Spark's writers into one folder share its temporary files.
_APPEND = threading.Lock()
_COUNTS = "digest binary, n_tokens long"


def splits_at_blanks(spec: dict) -> bool:
    """Whether a tokenizer never joins what a single blank between non-blanks divides: byte-level pre-tokenizing,
    no normalizer, and added tokens that neither hold white space nor take any from their sides."""
    before = spec.get("pre_tokenizer") or {}
    plain = all(
        not re.search(r"\s", t["content"]) and not t.get("lstrip") and not t.get("rstrip") and not t.get("single_word")
        for t in spec.get("added_tokens", [])
    )
    return before.get("type") == "ByteLevel" and before.get("use_regex", True) and not spec.get("normalizer") and plain


def _json_counter(content: bytes) -> Callable[[list[str]], list[int]]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encoded(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    if not splits_at_blanks(json.loads(content)):
        return lambda texts: [n for i in range(0, len(texts), BATCH) for n in encoded(texts[i : i + BATCH])]
    memo: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        counts = []
        for text in texts:
            first, *rest = _CUT.split(text)
            runs = [first, *[" " + r for r in rest]]
            new = list({r for r in runs if r not in memo})
            if len(memo) + len(new) > MEMO:
                memo.clear()
                new = list(set(runs))
            for i in range(0, len(new), BATCH):
                memo.update(zip(new[i : i + BATCH], encoded(new[i : i + BATCH])))
            counts.append(sum(map(memo.__getitem__, runs)))
        return counts

    return count


def _piece_counter(content: bytes) -> Callable[[list[str]], list[int]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def counter(path: str, content: bytes) -> Callable[[list[str]], list[int]]:
    """Function that counts the tokens of texts, for a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file."""
    return _piece_counter(content) if path.endswith(".model") else _json_counter(content)


def version(path: str, content: bytes) -> str:
    """Digest of the tokenizer: its file and the library that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    return hashlib.sha256(content + f"{library} {importlib.metadata.version(library)}".encode()).hexdigest()


def _encode(path: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or counter(path, shared.value)
            for i in range(0, len(batch), BATCH):
                part = batch.slice(i, BATCH)
                counts = count(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return run


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
) -> DataFrame:
    """One row per input row: ``<id_col>``, n_bytes, n_tokens, over_limit (n_tokens above ``limit``).

    ``tokenizer`` names a file on the driver; its bytes are sent to the executors. ``cache`` is a folder that all machines
    reach; without one the counts live in the session's shared folder until ``store.clear``, and later calls find them. Counts are those of the library's default call
    without added special tokens, truncation or padding. A null text counts as empty: 0 bytes, 0 tokens (or what the
    tokenizer gives for an empty text). Repeated texts are encoded once. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as file:
        content = file.read()
    name = version(tokenizer, content)
    folder = f"{(cache or f'{scratch(spark)}/token-cache').rstrip('/')}/tokenizer={name}"
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")

    misses = rows.select(digest, "text").dropDuplicates(["digest"])
    shared = spark.sparkContext.broadcast(content)
    with _APPEND:
        if _exists(spark, folder):
            misses = misses.join(spark.read.schema(_COUNTS).parquet(folder).select("digest"), "digest", "left_anti")
        misses.mapInArrow(_encode(tokenizer, shared), _COUNTS).write.mode("append").parquet(folder)

    known = spark.read.schema(_COUNTS).parquet(folder)
    counts = known.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    found = rows.select("id", F.octet_length("text").cast("long").alias("n_bytes"), digest).join(counts, "digest", "left")
    return found.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
