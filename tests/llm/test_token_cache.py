"""The cache of token counts that calls without a folder share."""

import hashlib

import public_tokenizers

from bazaarframe.llm import store, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_later_calls_find_the_counts_of_earlier_ones(spark):
    docs = spark.createDataFrame([(i, f"cached text {i % 4}") for i in range(8)], "doc_id long, text string")
    first = token_counts.count_tokens(docs, BPE).collect()
    with open(BPE, "rb") as file:
        folder = f"{store.scratch(spark)}/token-cache/tokenizer={token_counts.version(BPE, file.read())}"
    own = {hashlib.sha256(f"cached text {i}".encode()).digest() for i in range(5)}

    def stored():
        return sorted(bytes(r["digest"]) for r in spark.read.parquet(folder).collect() if bytes(r["digest"]) in own)

    assert len(stored()) == 4
    more = docs.union(spark.createDataFrame([(8, "cached text 4")], docs.schema))
    second = token_counts.count_tokens(more, BPE).collect()
    assert len(stored()) == 5 and stored() == sorted(own)
    assert sorted(map(tuple, first)) == sorted(tuple(r) for r in second if r["doc_id"] < 8)
    # What the cache says is taken, so nothing known was encoded again.
    known = spark.createDataFrame([(bytearray(hashlib.sha256(b"cached text 0").digest()), 1000)], "digest binary, n_tokens long")
    known.write.mode("append").parquet(folder)
    third = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, BPE).collect()}
    assert third[0] == third[4] == 1000 and max(third[1], third[2], third[3]) < 20
