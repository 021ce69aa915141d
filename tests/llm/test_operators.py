"""Every operator against brute force on small tables, and its edge cases."""

import base64
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

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

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, label string, size long"
BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def words_of(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def texts():
    """Random prose, near copies of copies, equal texts, blank, null and very long texts, a null id, a repeated row."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(90):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        if i % 9 == 0:
            words[10:10] = passage
        rows.append(" ".join(words) + ("\n" + rows[-1][0] if i % 10 == 9 else ""))
        rows[-1] = (rows[-1], ["en", "de"][i % 2])
    copy = rows[5][0].split() + [rng.choice(vocabulary) for _ in range(100)]
    for i in range(40):
        copy = list(copy)
        copy[rng.randrange(len(copy))] = f"w{i}"
        rows.append((" ".join(copy), "en"))
    rows += [(rows[3][0] + " ", "en"), (rows[3][0].replace(" ", "\n"), "en"), (rows[3][0].upper(), None)]
    rows += [(None, "en"), ("", "de"), (" \t\n", None), ("12 345", "en"), ("été", "fr"), ("x " * 20_000, "en")]
    rows += [("la la la la " * 30, None), ("The quick line one here\nthe quick line one here!\nThe quick lime one here", "en")]
    out = [(i, text, lang, [None, "b", "a", "é"][i % 4], 0, "n", "l", 1) for i, (text, lang) in enumerate(rows)]
    return out + [(None, rows[0][0], None, "a", 0, None, None, None), out[0]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_near_duplicates(docs, texts):
    sets = {}
    for i, text, *_ in texts:
        w = words_of((text or "").translate({c: c + 32 for c in range(65, 91)}))
        if i is not None:
            sets[i] = frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    result = near_dups.near_duplicates(docs, shingle=3, part=85).collect()
    assert len(result) == len(texts)
    for row in result:
        if row["doc_id"] is None:
            assert row["kept"] and row["component_id"] == 0
        else:
            assert row["n_shingles"] == len(sets[row["doc_id"]])
            assert row["component_id"] == root(row["doc_id"])
            assert row["kept"] == (row["component_id"] == row["doc_id"])


def test_exact_duplicates(docs, texts):
    groups = collections.defaultdict(list)
    for i, text, *_ in texts:
        groups["".join((text or "").split())].append((-len(text or ""), i is None, i))
    result = exact_dups.exact_duplicates(docs).collect()
    assert len(result) == len(texts) and sum(r["kept"] for r in result) == len(groups)
    own = {hashlib.sha256(k.encode()).hexdigest(): sorted(v) for k, v in groups.items()}
    for row in result:
        group = own[row["text_sha256"]]
        assert row["group_size"] == len(group) and row["keep_id"] == group[0][2]
        assert not row["kept"] or row["doc_id"] == row["keep_id"]


def test_exact_duplicates_of_a_hot_text(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    result = exact_dups.exact_duplicates(df).collect()
    assert {r["group_size"] for r in result} == {1, 2000} and sum(r["kept"] for r in result) == 1001
    assert {r["keep_id"] for r in result if r["group_size"] > 1} == {1}


def test_language(docs, texts, empty):
    model = language.fit(docs.where("lang is not null"))
    assert model.languages == ["de", "en", "fr"]
    found = by_id(language.predict(docs, model))
    for i, text, *_ in texts:
        has_letter = any(c.isalpha() for c in text or "")
        if i is not None:
            assert (found[i]["lang_pred"] == "und") == (not has_letter)
            assert 0 <= found[i]["score"] <= 1
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(empty)).collect()} == {"und"}


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("out", language.held_out("doc_id", 3))
    found = language.predict(docs, language.fit(docs.where("not out")), keep=("lang", "out")).where("out").collect()
    assert len(found) > 300 and sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(found)


def test_codewords_differ():
    for n in (2, 4, 6, 7, 40):
        code = language.codewords(n)
        assert len({tuple(w) for w in code.tolist()}) == n


def test_token_counts(docs, texts, tmp_path):
    tokenizer = Tokenizer.from_file(BPE)
    for _ in range(2):  # the second time from the cache
        found = token_counts.count_tokens(docs, BPE, cache=str(tmp_path)).collect()
        assert len(found) == len(texts)
    found = {r["doc_id"]: r for r in found}
    for i, text, *_ in texts:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert found[i]["n_tokens"] == n and found[i]["over_limit"] == (n > 512)
        assert found[i]["n_bytes"] == len((text or "").encode())


def test_counts_by_runs_are_those_of_whole_texts():
    rng = random.Random(1)
    with open(BPE, "rb") as file:
        count = token_counts.counter(BPE, file.read())
    tokenizer = Tokenizer.from_file(BPE)
    parts = [" ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "a", "B7", "'s", "é", "<|endoftext|>", "!?", "123", "漢字"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    assert count(texts) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_mix(docs, texts):
    found = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    sizes, source = collections.Counter(), {}
    for i, text, _, s, *_ in texts:
        sizes[s] += len(words_of(text))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, free, rest = {}, set(order), sum(sizes.values())
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * sizes[s]}
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = 3 * sizes[s]
            rest -= target[s]
        free -= full
    source = {i: s for i, _, _, s, *_ in texts}
    taken = collections.Counter()
    for row in found:
        s = source[row["doc_id"]]
        assert row["source_size"] == sizes[s] and row["target"] == pytest.approx(target[s])
        assert 0 <= row["taken"] <= 3 * row["size"]
        taken[s] += row["taken"]
    for s in order:
        assert abs(taken[s] - target[s]) <= 1


def test_quotas_follow_highest_quotients(spark):
    targets = spark.createDataFrame([("a", 53.0), ("b", 24.0), ("c", 23.0), ("d", 0.5)], "src string, target double")
    for house, shards in ((1, 1), (10, 3), (37, 5)):
        quotas = mixing.apportion(targets, 100, house, shards).collect()
        seats = collections.Counter()
        for _ in range(house):
            best = max(targets.collect(), key=lambda r: (r["target"] / (2 * seats[r["src"]] + 1), r["src"] == "a"))
            seats[best["src"]] += 1
        total = collections.Counter()
        for q in quotas:
            assert q["quota"] >= 0
            total[q["src"]] += q["quota"]
        assert {k: v for k, v in total.items() if v} == dict(seats)
        for j in range(shards):
            assert sum(q["quota"] for q in quotas if q["shard"] == j) == house * (j + 1) // shards - house * j // shards


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def test_duplicate_lines(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abc é") for _ in range(rng.choice([5, 15, 16, 17, 40, 300, 700]))) for _ in range(40)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(base)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(line) + 1)
                line = rng.choice([line[:at] + line[at + 1 :], line[:at] + "x" + line[at:], line[:at] + "y" + line[at + 1 :]])
            lines.append(rng.choice(["", " "]) + line)
        rows.append((i, "\n".join(lines) if i else None))
    firsts, expected = {}, {}
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            firsts.setdefault(line.strip(" \t\r\x0b\x0c"), (i, k))
    for i, text in rows:
        gone = []
        for k, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\r\x0b\x0c")
            close = len(line) >= 16 and any(p < firsts[line] and len(o) >= 16 and near(o, line) for o, p in firsts.items())
            if line and (firsts[line] != (i, k) or close):
                gone.append(str(k))
        expected[i] = ",".join(gone)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = by_id(line_dups.duplicate_lines(df))
    assert {i: r["removed_lines"] for i, r in found.items()} == expected
    cleaned = {r["doc_id"]: r["text"] for r in line_dups.without_duplicate_lines(df).collect()}
    for i, text in rows:
        gone = set(expected[i].split(","))
        left = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if str(k) not in gone)
        assert cleaned[i] == left


def test_repeated_passages(docs, texts):
    size = 35
    seen = collections.Counter(tuple(w[k : k + size]) for _, t, *_ in texts for w in [words_of(t)] for k in range(len(w) - size + 1))
    expected = collections.Counter()
    for i, text, *_ in texts:
        w = words_of(text)
        covered = {p for k in range(len(w) - size + 1) if seen[tuple(w[k : k + size])] > 1 for p in range(k, k + size)}
        rest = b" ".join(x for p, x in enumerate(w) if p not in covered)
        expected[i, len(w), len(covered), hashlib.sha256(rest).hexdigest()] += 1
    found = collections.Counter(tuple(r) for r in passages.repeated_passages(docs, size).collect())
    assert found == expected


def test_contaminated(spark):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(8, 60)))) for k in range(60)]
    items += [(100, "too short"), (101, None), (None, items[0][1])]
    rows, expected = [], {}
    for i in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if i % 2:
            k, text = items[rng.randrange(60)]
            leak = text.upper().split() if i % 4 == 1 else text.split()
            for _ in range(int(len(leak) * 0.1)):
                leak[rng.randrange(len(leak))] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = leak
            expected[i] = [k]
        rows.append((i, " ".join(words), "x"))
    rows += [(1000, None, "x"), (1001, "", "x"), (None, items[5][1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = by_id(decontaminate.contaminated(df, bench))
    assert len(found) == len(rows)
    caught = sum(found[i]["item_ids"] == k for i, k in expected.items())
    assert caught >= 0.98 * len(expected)
    assert found[None]["item_ids"] == [5]
    assert not any(found[i]["contaminated"] for i in found if i is not None and i not in expected)
    assert {r["doc_id"] for r in decontaminate.clean_documents(df, bench).collect()} == {
        i for i in found if i is None or not found[i]["contaminated"]
    }
    assert not any(r["contaminated"] for r in decontaminate.contaminated(df, bench.limit(0)).collect())


def test_passage_distance():
    a = np.arange(1, 9, dtype=np.uint64)
    assert decontaminate.passage_distance(a, np.arange(0, 20, dtype=np.uint64)) == 0
    assert decontaminate.passage_distance(a, np.array([5, 1, 2, 9, 4, 5, 6, 8], np.uint64)) == 2
    assert decontaminate.passage_distance(a, np.zeros(0, np.uint64)) == 8


def test_language_model(docs, texts, empty):
    train = docs.where("doc_id % 5 <> 1")
    counts = collections.Counter()
    tokens = lambda t: words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + [None]
    for i, text, *_ in texts:
        if i is not None and i % 5 != 1:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    found = maxent_lm.score(docs, train).collect()
    assert len(found) == len(texts)
    rows = by_id(maxent_lm.score(docs, train))
    for i, text, *_ in texts:
        t = tokens(text)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t)
        assert rows[i]["base_score"] == pytest.approx(base)
        assert (rows[i]["n_tokens"], rows[i]["n_known"]) == (len(t), sum(counts[w] > 0 for w in t))
        assert rows[i]["train_tokens"] == total and rows[i]["score"] <= 0
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)
    assert {r["n_known"] for r in maxent_lm.score(docs, empty).collect()} == {0}


def test_class_softmax_is_a_distribution():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(maxent_lm.FEATURE_ROWS, maxent_lm.CLASSES)).astype(np.float32)
    scores = maxent_lm.log_softmax(np.arange(50), weights)
    assert np.allclose(np.exp(scores).sum(axis=1), 1, atol=1e-4)


@pytest.mark.parametrize("length", [7, 64, 2048])
def test_packing_round_trip(docs, texts, length):
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    found = collections.defaultdict(dict)
    for row in packing.pack(unique, RANKS, length=length, end_id=50256, pad_id=50256).collect():
        ids, places, cuts = np.frombuffer(row["ids"], "<u2"), np.frombuffer(row["positions"], "<u2"), row["cu_seqlens"]
        assert len(ids) == len(places) == length and cuts[0] == 0 and cuts[-1] == row["n_tokens"] <= length
        for doc, part, a, b in zip(row["doc_ids"], row["parts"], cuts, cuts[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            found[doc][part] = ids[a:b].tolist()
    for i, text, *_ in texts:
        if i is not None:
            assert sum((found[i][k] for k in sorted(found[i])), []) == [*encoding.encode_ordinary(text or ""), 50256]


def test_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(50):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(0, 60))]
        rows = packing.best_fit_decreasing(lengths, 20)
        assert sorted(i for row in rows for i in row) == list(range(len(lengths)))
        room = []  # the same by looking at all rows
        for n in sorted(lengths, reverse=True):
            fit = [r for r in room if r >= n]
            if fit:
                room.remove(min(fit))
            room.append((min(fit) if fit else 20) - n)
        assert sorted(20 - sum(lengths[i] for i in row) for row in rows) == sorted(room)


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string")
    results = [
        near_dups.near_duplicates(empty),
        near_dups.keep_one(empty),
        exact_dups.exact_duplicates(empty),
        language.predict(empty, language.fit(empty)),
        token_counts.count_tokens(empty, BPE),
        mixing.mix(empty),
        mixing.mixed_documents(empty),
        line_dups.duplicate_lines(empty),
        passages.repeated_passages(empty),
        decontaminate.contaminated(empty, bench),
        maxent_lm.score(empty, empty),
        packing.pack(empty, RANKS),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_held_out(spark):
    df = spark.range(50).select(F.col("id").alias("doc_id"), language.held_out("doc_id", 3).alias("out"))
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in df.collect())
