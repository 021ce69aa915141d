"""The mix follows its quotas, shard by shard."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from bazaarframe.llm import mixing

SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    sizes = [rng.randint(0, 60) for _ in range(600)] + [4000]
    return [(i, " ".join(["w"] * n), "abcd"[rng.choice([0, 0, 0, 1, 1, 2, 3])]) for i, n in enumerate(sizes)]


def test_quotas_decide_what_each_shard_takes(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    total = sum(len(t.split()) for _, t, _ in rows)
    block = total // 90
    source = {i: s for i, _, s in rows}
    apportion = mixing.apportion

    def moved(*args):
        more = F.when((F.col("src") == "sa") & (F.col("shard") == 1), -2).when((F.col("src") == "sb") & (F.col("shard") == 3), 2)
        return apportion(*args).withColumn("quota", F.col("quota") + F.coalesce(more, F.lit(0)))

    taken = {}
    for name, dealt in (("own", apportion), ("moved", moved)):
        quotas = {}

        def watched(*args, dealt=dealt, quotas=quotas):
            found = dealt(*args)
            quotas.update({(r["src"][1:], r["shard"]): r["quota"] for r in found.collect()})
            return found

        monkeypatch.setattr(mixing, "apportion", watched)
        found = mixing.mix(docs, blocks=90, shards=5).collect()
        shares, sizes, targets = collections.Counter(), {}, {}
        for r in found:
            assert r["taken"] == sum(r["by_shard"]) <= 3 * r["size"] and len(r["by_shard"]) == 5
            s = source[r["doc_id"]]
            sizes[s], targets[s] = r["source_size"], r["target"]
            for j, n in enumerate(r["by_shard"]):
                shares[s, j] += n
        for s in "abcd":
            so_far = [min(block * sum(quotas[s, k] for k in range(j + 1)), 3 * sizes[s]) for j in range(5)]
            assert [sum(shares[s, k] for k in range(j + 1)) for j in range(5)] == so_far
            if name == "own":
                assert abs(so_far[-1] - targets[s]) <= block
        taken[name] = shares
    assert taken["moved"]["a", 1] == taken["own"]["a", 1] - 2 * block
    assert sum(taken["moved"]["b", j] for j in range(5)) == sum(taken["own"]["b", j] for j in range(5)) + 2 * block


def test_whole_documents_miss_the_target_by_at_most_one(spark, rows):
    # Ids that repeat with other texts, ids that are null, and equal rows are documents like any other.
    rows = [(None if i % 50 == 0 else i % 400, t, s) for i, t, s in rows] + rows[:3] * 2
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    sizes, largest, taken = collections.Counter(), collections.Counter(), collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
        largest[s] = max(largest[s], len(t.split()))
    for most in (3.0, 1.0):
        target = {s: n for s, n in zip("abcd", _targets([sizes[s] for s in "abcd"], (1, 2, 3, 1), most))}
        taken.clear()
        mixed = [tuple(r) for r in mixing.mixed_documents(docs, most=most).collect()]
        for _, t, s in mixed:
            taken[s] += len(t.split())
        there = collections.Counter(rows)
        assert all(n <= most * there[r] for r, n in collections.Counter(mixed).items())
        for s in "abcd":  # half a document, and a block of one word
            assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1
    assert sorted(map(str, mixed)) == sorted(map(str, map(tuple, mixing.mixed_documents(docs.repartition(5), most=1.0).collect())))


def _targets(sizes, weights, most):
    """Shares by weight, none beyond ``most`` times its size."""
    target, free = [most * n for n in sizes], set(range(len(sizes)))
    while free:
        rest = sum(sizes) - sum(target[k] for k in range(len(sizes)) if k not in free)
        share = {k: rest * weights[k] / sum(weights[x] for x in free) for k in free}
        full = {k for k in free if share[k] > most * sizes[k]}
        if not full:
            for k in free:
                target[k] = share[k]
            break
        free -= full
    return target
