"""The pipeline as a whole, every stage against brute force on what the stage before kept."""

import base64
import collections
import random

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from bazaarframe.llm import store

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, size=5):
    words = text.lower().split()
    return frozenset(zip(*[words[i:] for i in range(size)])) if len(words) >= size else frozenset([tuple(words)])


def kept_of_groups(texts):
    """Smallest ids of the groups linked by a similarity of 0.8 or more."""
    label = {i: i for i in texts}
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {i for i in label if label[i] == i}


def inputs():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(600)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(k, prose(14)) for k in range(8)] + [(50, None), (51, "")]
    rows, leaked = [], set()
    for i in range(60):
        text = prose(rng.randint(1, 150))
        if i % 10 == 3:
            text = f"{text} {items[i % 8][1]} {prose(5)}"
            leaked.add(i)
        rows.append((i, text, ["en", "de", None][i % 3], [None, "a", "b", "é"][i % 4], 0))
    chain = prose(120).split()
    for i in range(60, 90):
        chain = list(chain)
        chain[rng.randrange(len(chain))] = f"word{'x' * (i - 60)}"
        rows.append((i, " ".join(chain), "en", "a", 0))
    rows += [(i, rows[5][1], "en", "b", 0) for i in range(90, 120)]
    rows += [(120, None, "en", "a", 0), (121, "", None, None, 0), (122, "12 345 - 6", "de", "a", 0), (123, " \t\n", "en", "b", 0)]
    rows += [(None, prose(40), "en", "a", 0), rows[1]]
    return rows, items, leaked


def test_pipeline(spark, tmp_path, monkeypatch):
    rows, items, leaked = inputs()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = {}

    def watched(df, name):
        out[name] = store.stored(df, name)
        return out[name]

    monkeypatch.setattr(corpus_pipeline, "stored", watched)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert list(out) == [name for name, _ in corpus_pipeline.STAGES]
    for name in list(out)[:-1]:
        assert out[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]

    def count_of(found):
        return collections.Counter((r[0], r[1]) for r in found)

    in_language = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert count_of(out["language_id"].collect()) == count_of(in_language)

    kept = kept_of_groups({r[0]: r[1] for r in in_language if r[0] is not None})
    one_each = [r for r in in_language if r[0] is None or r[0] in kept]
    assert count_of(out["near_duplicates"].collect()) == count_of(one_each)

    clean = [r for r in one_each if r[0] not in leaked]
    assert len(clean) < len(one_each)
    assert count_of(out["decontamination"].collect()) == count_of(clean)

    mixed = out["source_mix"].collect()
    copies = count_of(mixed)
    there = count_of(clean)
    assert all(k in there and n <= 3 * there[k] for k, n in copies.items())
    sizes, largest, taken = collections.Counter(), collections.Counter(), collections.Counter()
    for r in clean:
        n = len(r[1].split())
        sizes[r[3]] += n
        largest[r[3]] = max(largest[r[3]], n)
    for r in mixed:
        taken[r["source"]] += len(r["text"].split())
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    target = {s: sum(sizes.values()) * w / sum(weights.values()) for s, w in weights.items()}
    assert all(target[s] <= 3 * sizes[s] for s in sizes)
    # Whole documents, drawn: a few documents' words above or below.
    assert all(abs(taken[s] - target[s]) <= 3 * largest[s] for s in sizes), (taken, target, sizes, largest)

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    parts = collections.Counter()
    for row in packed:
        ids, cuts = np.frombuffer(row["ids"], "<u2"), row["cu_seqlens"]
        for doc, a, b in zip(row["doc_ids"], cuts, cuts[1:]):
            parts[doc, tuple(ids[a:b].tolist())] += 1
    whole = collections.Counter((r["doc_id"], tuple([*encoding.encode_ordinary(r["text"]), 50256])) for r in mixed)
    assert parts == whole
