"""Every operator on texts longer than the megabyte in which texts are taken up, and the pipeline on empty tables."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from bazaarframe.llm import (
    decontaminate,
    exact_dups,
    language,
    line_dups,
    maxent_lm,
    mixing,
    near_dups,
    packing,
    passages,
    token_counts,
)
from bazaarframe.llm.words import PIECE_BYTES

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my"
BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def long_text():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(20_000)]
    lines = [" ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(15_000)]
    return "\n".join(lines) + f"\n{ITEM} end"


@pytest.fixture(scope="module")
def docs(spark, long_text):
    assert len(long_text) > PIECE_BYTES
    rows = [(1, long_text, "en", "a", 0), (2, long_text.replace("\n", " \n"), "en", "b", 0), (3, "short one", "de", "a", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_duplicates_of_long_texts(docs, long_text):
    near = by_id(near_dups.near_duplicates(docs))
    assert [near[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 3]
    assert near[1]["n_shingles"] == len(set(zip(*[long_text.split()[i:] for i in range(5)])))
    exact = by_id(exact_dups.exact_duplicates(docs))
    assert [exact[i]["keep_id"] for i in (1, 2, 3)] == [2, 2, 3]
    lines = by_id(line_dups.duplicate_lines(docs))
    assert lines[1]["n_removed"] == 0 and lines[2]["n_removed"] == lines[2]["n_lines"] == 15_001
    gone = by_id(passages.repeated_passages(docs))
    assert gone[1]["n_words"] == gone[1]["n_removed"] == gone[2]["n_removed"] == 180_000 + 13 and gone[3]["n_removed"] == 0


def test_searches_and_counts_in_long_texts(spark, docs, long_text):
    bench = spark.createDataFrame([(9, ITEM)], "item_id long, text string")
    assert {i for i, r in by_id(decontaminate.contaminated(docs, bench)).items() if r["contaminated"]} == {1, 2}
    tokens = by_id(token_counts.count_tokens(docs, BPE))
    assert tokens[1]["n_tokens"] == len(Tokenizer.from_file(BPE).encode(long_text, add_special_tokens=False).ids)
    sizes = by_id(mixing.mix(docs))
    assert [sizes[i]["size"] for i in (1, 2, 3)] == [180_013, 180_013, 2]
    scored = by_id(maxent_lm.score(docs, docs))
    assert scored[1]["n_tokens"] == 180_014 and scored[1]["score"] == pytest.approx(scored[2]["score"])
    known = by_id(language.predict(docs, language.fit(docs)))
    assert known[1]["lang_pred"] == "en" and known[3]["lang_pred"] == "de"
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), length=2048, end_id=50256, pad_id=50256).collect()
    assert {d for r in rows for d in r["doc_ids"]} == {1, 2, 3} and all(r["n_tokens"] <= 2048 for r in rows)


def test_pipeline_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and "ids" in out.columns
