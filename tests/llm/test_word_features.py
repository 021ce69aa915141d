"""The language model's word n-grams and skips against plain loops."""

import collections
import math
import random
import timeit

import numpy as np
import pyarrow as pa
import pytest

from bazaarframe.llm import maxent_lm, word_features
from bazaarframe.llm.words import LOWER, SPACES, in_words, lowered, pieces

END = int(maxent_lm.END)


def corpus(n):
    """Texts in which some words follow others, with rare words, an empty text and a repeated one."""
    random.seed(5)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "su", "te", "vor") for b in ("nda", "rel", "sto", "wen", "xil", "yda", "zon")]
    follows = {w: random.sample(words, 3) for w in words}
    texts = ["", "only", "rare1 rare2 rare3"]
    for i in range(n):
        text = [random.choice(words)]
        while len(text) < 30:
            text.append(random.choice(follows[text[-1]]) if text[-1] in follows and random.random() < 0.8 else random.choice([*words, f"once{i}"]))
        texts.append(" ".join(text))
    return [(i, t) for i, t in enumerate([*texts, texts[-1]])]


@pytest.fixture(scope="module")
def trained(spark):
    rows = corpus(200)
    train = spark.createDataFrame([*rows, (None, None)], "doc_id long, text string").repartition(5)
    return rows, train, maxent_lm.fit(train)


def coded(text):
    """Hash of each token of a text and its class by ending."""
    piece = next(pieces(pa.array([text]), lower=True))
    hashes, classes, _ = maxent_lm._tokens(piece)
    return [int(h) for h in hashes], [int(c) for c in classes]


def softmax(logits):
    top = max(logits)
    logs = [x - top for x in logits]
    norm = math.log(sum(map(math.exp, logs)))
    return [x - norm for x in logs]


def class_of(model, word, ending):
    singles = [int(x) for x in model.singles]
    return singles.index(word) if word in singles else ending


def class_logs(model, classes, before):
    """log P(class) of all classes, from the three classes and the two words before."""
    one, two, three = classes
    context = (one * maxent_lm.CLASSES + two) * maxent_lm.CLASSES + three
    logits = [0.0] * maxent_lm.CLASSES
    for row in maxent_lm.feature_rows(np.array([context]))[0]:
        logits = [x + float(w) for x, w in zip(logits, model.class_weights[row])]
    return softmax([x + float(w) for x, w in zip(softmax(logits), word_logits(model, before, None))])


def word_logits(model, before, given):
    one, two = (np.array([w], np.uint64) for w in before)
    given = None if given is None else np.array([given])
    rows = word_features.rows_of(one, two, len(model.word_weights), given)
    return [sum(float(model.word_weights[r[0]][k]) for r in rows) for k in range(word_features.WIDTH)]


def bucket_logs(model, given, before):
    return softmax([math.log(t) + w for t, w in zip(model.cells[given], word_logits(model, before, given))])


def bucket(word):
    return int(word_features.bucket_of(np.array([word], np.uint64))[0])


def brute_score(model, counts, text):
    words, endings = coded(text)
    classes = [class_of(model, w, e) for w, e in zip(words, endings)]
    history, seen, total = [maxent_lm.END_CLASS] * 3, [END] * 2, 0.0
    for word, own in zip(words, classes):
        total += class_logs(model, history, seen)[own]
        if own >= len(model.singles) and own != maxent_lm.END_CLASS:
            total += bucket_logs(model, own, seen)[bucket(word)]
            total += math.log((counts[word] + 0.5) / model.cells[own][bucket(word)])
        history, seen = [own, *history[:2]], [word, seen[0]]
    return total / math.log(10)


def test_scores_are_those_of_plain_loops(spark, trained):
    rows, train, model = trained
    counts = collections.Counter(w for _, t in rows for w in coded(t)[0])
    asked = [*rows[:12], (900, "kanda never seen"), (901, "kanda " + rows[5][1].upper())]
    found = {r["doc_id"]: r["score"] for r in maxent_lm.score(spark.createDataFrame(asked, "doc_id long, text string"), train).collect()}
    for i, text in asked:
        assert found[i] == pytest.approx(brute_score(model, counts, text), abs=2e-3)


def test_rare_words_are_joined(spark, trained, monkeypatch):
    rows, train, _ = trained
    whole = {r["doc_id"]: r["score"] for r in maxent_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), train).collect()}
    monkeypatch.setattr(maxent_lm, "HEAD", 10)
    joined = maxent_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), train).collect()
    assert {r["doc_id"]: pytest.approx(r["score"], abs=2e-3) for r in joined} == whole


def test_all_words_and_one_unknown_a_bucket_sum_to_one(trained):
    rows, _, model = trained
    counts = collections.Counter(w for _, t in rows for w in coded(t)[0])
    ending = {w: e for _, t in rows for w, e in zip(*coded(t))}
    history, before = [30, 2, 47], coded(rows[7][1])[0][:2]
    of_classes, total = class_logs(model, history, before), 0.0
    of_buckets = {c: bucket_logs(model, c, before) for c in range(len(model.singles), maxent_lm.END_CLASS)}
    for word in counts:
        own = class_of(model, word, ending[word])
        p = of_classes[own]
        if own in of_buckets:
            p += of_buckets[own][bucket(word)] + math.log((counts[word] + 0.5) / model.cells[own][bucket(word)])
        total += math.exp(p)
    unknown = sum(
        math.exp(of_classes[c] + logs[b]) * 0.5 / model.cells[c][b] for c, logs in of_buckets.items() for b in range(word_features.WIDTH)
    )
    assert total + unknown == pytest.approx(1, abs=1e-5)


def test_words_of_one_class_cannot_be_exchanged(spark, trained):
    rows, train, model = trained
    pairs = collections.Counter(p for _, t in rows for p in zip(t.split(), t.split()[1:]))
    singles = {int(x) for x in model.singles}
    words = sorted({w for p in pairs for w in p if coded(w)[0][0] not in singles and not w.startswith(("once", "rare"))})
    alike = [(a, b) for a in words for b in words if a < b and coded(a)[1] == coded(b)[1]]
    # A word before which one of the two stands often and the other hardly ever, both ways.
    swaps = [
        (x, a, y, b) for a, b in alike for x in words for y in words if pairs[x, a] > 10 * pairs[x, b] + 10 and pairs[y, b] > 10 * pairs[y, a] + 10
    ]
    assert swaps
    asked = [(2 * i, f"{x} {a} {y} {b}") for i, (x, a, y, b) in enumerate(swaps)]
    asked += [(2 * i + 1, f"{x} {b} {y} {a}") for i, (x, a, y, b) in enumerate(swaps)]
    found = {r["doc_id"]: r["score"] for r in maxent_lm.score(spark.createDataFrame(asked, "doc_id long, text string"), train).collect()}
    assert all(found[2 * i] > found[2 * i + 1] for i in range(len(swaps)))


def test_gradient_is_that_of_plain_loops():
    rng = np.random.default_rng(3)
    n, rows = 50, 16
    weights = rng.normal(size=(rows, word_features.WIDTH)).astype(np.float32)
    known = np.log(rng.dirichlet(np.ones(word_features.WIDTH), n)).astype(np.float32)
    features = [rng.integers(0, rows, n).astype(np.uint16) for _ in range(3)]
    outcomes = rng.integers(0, word_features.WIDTH, n)
    total, mass = np.zeros(weights.shape, np.float32), np.zeros(rows)
    word_features.add_gradient(total, mass, word_features.Events([(known, np.arange(n))], features, outcomes), weights)
    expected, often = np.zeros(weights.shape), np.zeros(rows)
    for i in range(n):
        p = np.exp(softmax([float(known[i, k]) + sum(float(weights[f[i], k]) for f in features) for k in range(word_features.WIDTH)]))
        for f in features:
            expected[f[i]] += np.eye(word_features.WIDTH)[outcomes[i]] - p
            often[f[i]] += 1
    assert np.allclose(total, expected, atol=1e-3) and (mass == often).all()


def test_bytes_by_arithmetic_are_those_of_the_tables():
    data = np.arange(256, dtype=np.uint8)
    assert lowered(data).dtype == np.uint8 and np.array_equal(lowered(data), LOWER)
    assert np.array_equal(in_words(data), ~SPACES)
    assert not len(lowered(data[:0])) and not len(in_words(data[:0]))


def test_softmax_on_columns_is_that_on_rows_to_the_bit():
    rng = np.random.default_rng(6)
    for n in (1, 5, word_features.CHUNK):
        logits = (rng.normal(size=(n, word_features.WIDTH)) * 9).astype(np.float32)
        rows = logits - logits.max(axis=1, keepdims=True)
        columns = word_features.less_largest(logits)
        assert np.array_equal(columns.T, rows)
        assert np.array_equal(word_features.sum_of_outcomes(np.exp(columns)), np.exp(rows).sum(axis=1))


def test_row_sums_are_those_of_reduceat_to_the_bit_in_less_time():
    rng = np.random.default_rng(4)
    n = word_features.CHUNK
    error = rng.normal(size=(n, word_features.WIDTH)).astype(np.float32)
    # Rows of one event, of any number up to and beyond FEW, and of all events; the last row of a feature goes on in the next.
    few = np.repeat(np.arange(40), np.arange(1, 41))[:n]
    features = [rng.integers(0, 1 << 16, n), rng.permutation(np.resize(few, n)), np.full(n, 7), np.full(n, 7), rng.zipf(1.3, n) % 5000]
    features = [f.astype(np.uint16) for f in features]

    def plain():
        for rows in features:
            order = np.argsort(rows, kind="stable")
            own, first, counts = np.unique(rows[order], return_index=True, return_counts=True)
            yield own, counts, np.add.reduceat(error[order], first, axis=0)

    for found, expected in zip(word_features.row_sums(error, features), plain(), strict=True):
        assert all(np.array_equal(a, b) for a, b in zip(found, expected))
    for size in (1, 2):
        ((own, counts, sums),) = word_features.row_sums(error[:size], [np.full(size, 3, np.uint16)])
        assert (own, counts) == (3, size) and np.array_equal(sums[0], error[:size].sum(axis=0))

    rows = [rng.integers(0, 1 << 16, n).astype(np.uint16)]

    def seconds(sums):
        return min(timeit.repeat(sums, number=20, repeat=7))

    order = np.argsort(rows[0], kind="stable")
    first = np.unique(rows[0][order], return_index=True)[1]
    assert seconds(lambda: list(word_features.row_sums(error, rows))) < seconds(lambda: np.add.reduceat(error[order], first, axis=0))


def test_the_matrix_grows_with_the_tokens():
    sizes = [word_features.matrix_rows(n) for n in (0, 10**5, 4 * 10**5, 10**12)]
    assert sizes[0] == word_features.LEAST_ROWS and sizes[-1] == word_features.MOST_ROWS and sizes[1] < sizes[2]


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    model = maxent_lm.fit(empty)
    assert model.total == 0 and not model.word_weights.any()
    assert maxent_lm.score(empty, empty).count() == 0
