"""Benchmark items too short for windows, and runs that follow from the edit bound."""

import random

import pytest

from bazaarframe.llm import decontaminate


def test_short_items_are_found_whole(spark):
    items = [(1, "What is it?"), (2, "yes"), (3, "one two three four five six seven"), (4, "what is it?"), (5, " ")]
    texts = {
        0: "so what IS\nit? he said",
        1: "what is not it?",
        2: "one two three four five six eight",
        3: "x one two three four five six seven",
        4: "yes or what is",
        5: "it? no",
        6: None,
        7: "eyes yess",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r["doc_id"]: (r["item_ids"], r["least_edits"]) for r in decontaminate.contaminated(docs, bench).collect()}
    expected = {0: [1, 4], 3: [3], 4: [2]}
    assert found == {i: (expected.get(i, []), 0 if i in expected else None) for i in texts}


def test_runs_follow_the_edit_bound(spark):
    assert decontaminate.sure_run([8, 10, 20, 400], 0.1) == 4
    assert decontaminate.sure_run([10], 0.2) == 3 and decontaminate.sure_run([9], 0.5) == 1
    rng = random.Random(3)
    items = [(k, [f"w{rng.randrange(10**6)}" for _ in range(10)]) for k in range(40)]
    rows = []
    for k, words in items:  # the longest run left has three words
        copy = [*words[:3], "other", *words[4:7], "other", *words[8:]]
        rows.append((k, " ".join(["a"] * 20 + copy + ["b"] * 20)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    found = decontaminate.contaminated(docs, bench, edits=0.2).collect()
    assert sum(r["item_ids"] == [r["doc_id"]] and r["least_edits"] == 2 for r in found) >= 36
    with pytest.raises(ValueError, match="edits"):
        decontaminate.contaminated(docs, bench, edits=1.0)
