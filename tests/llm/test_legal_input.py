"""Inputs that are legal but unkind: equal short keys, self-similar words, repeated rows, one id for many texts, clashing names."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bazaarframe.llm import decontaminate, language, line_dups, maxent_lm, mixing, near_dups, passages, periodic_runs, words

SCHEMA = "doc_id long, text string"
ITEM = "one two three four five six seven eight nine ten eleven twelve"


def parity_words(n=1024):
    """Two words whose letters follow the parity of binary digits, one the complement of the other."""
    first = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return first, first.translate(str.maketrans("ab", "ba"))


def test_words_of_the_parity_sequence_differ():
    texts = [w for n in (64, 1024, 4096) for w in parity_words(n)]
    (piece,) = words.pieces(pa.array([" ".join(texts)]), lower=False)
    assert len(set(piece.hashes.tolist())) == len(texts)


def test_windows_over_the_parity_sequence_differ():
    for n in (32, 1024):
        first, second = (" ".join(w) for w in parity_words(n))
        (piece,) = words.pieces(pa.array([first, second]), lower=False)
        found = piece.windows(n)
        assert found[0] != found[n]


def test_word_and_window_hashes_do_not_depend_on_the_place():
    rng = np.random.default_rng(3)
    own = [bytes(rng.integers(97, 100, rng.integers(1, 150)).astype(np.uint8)).decode() for _ in range(300)]
    (piece,) = words.pieces(pa.array([" ".join(own), "  é " + "\n".join(own)]), lower=False)
    assert (piece.hashes[:300] == piece.hashes[301:]).all() and len(set(piece.hashes[:300].tolist())) == len(set(own))
    assert (piece.windows(35)[:266] == piece.windows(35)[301:567]).all()


def test_passages_with_words_that_are_complements(spark):
    first, second = parity_words()
    rest = " ".join(f"w{i}" for i in range(34))
    docs = spark.createDataFrame([(1, f"{first} {rest}"), (2, f"{second} {rest}")], SCHEMA)
    assert {r["n_removed"] for r in passages.repeated_passages(docs).collect()} == {0}
    linked = near_dups.near_duplicates(spark.createDataFrame([(1, first), (2, second)], SCHEMA)).collect()
    assert {r["component_id"] for r in linked} == {1, 2}


def test_passages_of_rows_with_equal_short_keys(spark):
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(45)), lambda x: F.concat(F.lit("t"), "id", F.lit("x"), x)))
    made = spark.range(250_000).select(text.alias("text"))
    key = F.xxhash64(F.lit(None).cast("long"), "text").bitwiseAND(F.lit(0xFFFFFFFF))
    pair = made.groupBy(key).agg(F.collect_list("text").alias("texts")).where(F.size("texts") > 1).first()
    if pair is None:
        pytest.skip("no two texts with equal keys")
    repeated, clean = sorted(pair["texts"])[:2]
    docs = spark.createDataFrame([(None, repeated), (None, clean), (7, repeated), (None, repeated + " more")], SCHEMA)
    found = passages.repeated_passages(docs, with_text=True).collect()
    assert sorted(r["n_removed"] for r in found) == [0, 46, 46, 46]
    assert clean in {r["kept_text"] for r in found}


def test_repeated_rows_are_compared_once(spark, monkeypatch):
    base = [f"w{i}" for i in range(60)]
    near = [*base[:-1], "other"]
    rows = [(1, " ".join(base))] * 40 + [(2, " ".join(near))] * 40 + [(3, "something else")]
    sizes = {}

    def counted(df, name, own=near_dups.stored):
        out = own(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(near_dups, "stored", counted)
    found = near_dups.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sizes["confirmed"] <= 1 and sizes["texts"] == 2
    assert len(found) == 81 and {(r["doc_id"], r["component_id"]) for r in found} == {(1, 1), (2, 1), (3, 3)}


def test_leaked_rows_go_by_their_own_text(spark):
    rows = [(1, f"so {ITEM} it is"), (1, "a clean text under the same id"), (None, f"leaked {ITEM}"), (None, "clean"), (2, None), (3, "")]
    bench = spark.createDataFrame([(9, ITEM)], "item_id long, text string")
    docs = spark.createDataFrame(rows, SCHEMA)
    for spare, gone in ((True, {rows[0]}), (False, {rows[0], rows[2]})):
        kept = decontaminate.clean_documents(docs, bench, spare_without_id=spare).collect()
        assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(set(rows) - gone, key=str)


def test_rows_of_one_id_lose_their_own_lines(spark):
    line = "a line that stands in several of the rows"
    rows = [(1, line), (5, f"first\n{line}"), (5, "second\nthird")]
    kept = line_dups.without_duplicate_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, line), (5, "first"), (5, "second\nthird")]


CLASHING = [
    "_drop", "drop_id", "_row", "row", "_copies", "copies", "copy", "_id", "_gone", "gone", "_text", "score", "lang_pred", "ambiguous",
    "id", "text_key", "h_id", "h_key", "item_ids", "r_id", "r_key", "size", "place", "src", "start", "ends", "c0", "c1", "n_tokens", "base_score",
]


@pytest.fixture(scope="module")
def crowded(spark):
    rows = [(1, f"A text with {ITEM} in it", "en", "a"), (2, "Ein Satz\nund noch ein Satz", "de", "b"), (3, None, "en", None), (4, "12", None, "a")]
    columns = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *[f"{c} {r[0]}" for c in CLASHING]) for r in rows], columns)


def test_columns_with_clashing_names(spark, crowded):
    bench = spark.createDataFrame([(9, ITEM)], "item_id long, text string")
    model = language.fit(crowded)
    wanted = {
        "keep_one": (near_dups.keep_one(crowded), {1, 2, 3, 4}),
        "clean": (decontaminate.clean_documents(crowded, bench), {2, 3, 4}),
        "mixed": (mixing.mixed_documents(crowded), None),
        "lines": (line_dups.without_duplicate_lines(crowded), {1, 2, 3, 4}),
        "language": (language.with_language(crowded, model), {1, 2}),
    }
    for name, (df, ids) in wanted.items():
        assert df.columns == crowded.columns, name
        rows = df.collect()
        assert all(r[c] == f"{c} {r['doc_id']}" for r in rows for c in CLASHING), name
        assert ids is None or {r["doc_id"] for r in rows} == ids, name
    keep = ("doc_id", "score", "text_key", "c0")
    assert language.predict(crowded, model, keep=keep).columns == ["doc_id", "text_key", "c0", "lang_pred", "score", "ambiguous"]
    scored = maxent_lm.score(crowded, crowded, keep=keep)
    assert scored.columns == ["doc_id", "text_key", "c0", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert {r["text_key"] for r in scored.collect()} == {f"text_key {i}" for i in range(1, 5)}
    assert periodic_runs.run_report(crowded).count() == 4


def test_pipeline_stages_with_clashing_names(spark, crowded, tmp_path):
    crowded.withColumn("n_chars", F.lit(1).cast("long")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(9, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert all(r["score"] == f"score {r['doc_id']}" for r in out.collect())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1


def test_many_repeated_rows_are_mixed(spark):
    rows = [(7, "one two three", "en", "a")] * 3000 + [(i, "four five", "en", "a") for i in range(10, 40)] + [(None, "six", None, None)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    taken = {}
    for r in found:
        assert r["taken"] <= 3 * r["size"]
        key = (r["source_size"], r["target"], r["quota"])
        taken[key] = taken.get(key, 0) + r["taken"]
    assert len(taken) == 2
    for (source_size, target, _), words in taken.items():
        assert abs(words - target) <= 1 + 0.001 * target
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    copies = mixing.mixed_documents(docs).groupBy("source").count().collect()
    assert {r["source"] for r in copies} == {"a", None}
