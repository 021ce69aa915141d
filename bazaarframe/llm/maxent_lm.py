"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

log P(word | words before) = log P(class of the word | words before) + log P(bucket | class, words before) + log P(word | bucket).
The most frequent words are classes of their own, the end of a text is one, all other words fall into classes by their last
two bytes, and into buckets of their class by hash. The first two factors are softmaxes. Features of the class are the classes
one, two and three words back (skips) and their pairs, trained on counts of (three classes, class), and hashed word
n-grams and skips (``word_features``); those of the bucket are word n-grams and skips that go with the class.
The third is the maximum-entropy solution for word indicators, smoothed counts.

Everything is counted over all training texts. Counts of (context, class) are summed up once; word features are trained on the
texts themselves, each of which goes into one update. Every update adds up gradients over partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarframe.llm import word_features
from bazaarframe.llm.store import stored
from bazaarframe.llm.words import mix, pieces

#: Words that are classes of their own, and classes by ending; one more class for the end of a text.
SINGLES, ENDINGS = 23, 24
CLASSES = SINGLES + ENDINGS + 1
END_CLASS = CLASSES - 1
END = np.uint64(0x0E0D)  # stands for the hash of the end token
#: Rows of the weight matrix; every feature is hashed to one of them.
FEATURE_ROWS = 1 << 13
UPDATES, RATE = 16, 0.25
#: Words whose counts are sent to every executor, at most: the most frequent ones. The others are joined.
HEAD = 1 << 18
#: Words a task counts before it hands on what it has, and partitions of the context counts.
FLUSH, PARTS = 1 << 21, 12


def _tokens(piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end after each; the class by ending of each; where each text begins (and all end)."""
    n = len(piece.bounds) - 1
    last, before = piece.data[piece.ends - 1], piece.data[np.maximum(piece.ends - 2, piece.starts)]
    ending = mix(last.astype(np.uint64) * np.uint64(256) + before) % np.uint64(ENDINGS)
    stops = piece.bounds[1:]
    hashes = np.insert(piece.hashes, stops, END)
    classes = np.insert(ending.astype(np.int64) + SINGLES, stops, END_CLASS)
    return hashes, classes, piece.bounds + np.arange(n + 1)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, total = [], 0

    def counted():
        hashes, at, n = np.unique(np.concatenate([h for h, _ in held]), return_index=True, return_counts=True)
        cells = np.concatenate([c for _, c in held])[at] * word_features.WIDTH + word_features.bucket_of(hashes)
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(cells.astype(np.int32)), pa.array(n)], ["word", "cell", "n"]
        )

    for batch in batches:
        for piece in pieces(batch.column(0), lower=True):
            hashes, classes, _ = _tokens(piece)
            held.append((hashes, classes))
            total += len(hashes)
            if total >= FLUSH:
                yield counted()
                held, total = [], 0
    if held:
        yield counted()


def _classes(hashes: np.ndarray, classes: np.ndarray, singles: np.ndarray) -> np.ndarray:
    """Classes of tokens, the single words' own ones put in; singles: their sorted hashes."""
    if len(singles):
        at = np.minimum(np.searchsorted(singles, hashes), len(singles) - 1)
        own = singles[at] == hashes
        classes = np.where(own, at, classes)
    return classes


def _classes_before(classes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The classes one, two and three tokens before each token; before a text stands its end."""
    place = np.arange(len(classes)) - np.repeat(bounds[:-1], np.diff(bounds))
    found = []
    for back in (1, 2, 3):
        before = np.full(len(classes), END_CLASS)
        before[back:] = classes[:-back] if back < len(classes) else classes[:0]
        found.append(np.where(place >= back, before, END_CLASS))
    return found


def _contexts(classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The three classes before each token as one number."""
    one, two, three = _classes_before(classes, bounds)
    return (one * CLASSES + two) * CLASSES + three


def _count_contexts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        singles = shared.value
        held, total = [], 0

        def counted():
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array((codes // CLASSES).astype(np.int32)), pa.array((codes % CLASSES).astype(np.int32)), pa.array(n)],
                ["context", "class", "n"],
            )

        for batch in batches:
            for piece in pieces(batch.column(0), lower=True):
                hashes, classes, bounds = _tokens(piece)
                classes = _classes(hashes, classes, singles)
                held.append(_contexts(classes, bounds) * CLASSES + classes)
                total += len(classes)
                if total >= FLUSH:
                    yield counted()
                    held, total = [], 0
        if held:
            yield counted()

    return run


def feature_rows(contexts: np.ndarray) -> np.ndarray:
    """Rows of the weight matrix that are active in each context."""
    one, two, three = contexts // CLASSES**2, contexts // CLASSES % CLASSES, contexts % CLASSES
    kinds = [np.zeros_like(one), one, two, three, one * CLASSES + two, one * CLASSES + three, two * CLASSES + three]
    keys = [mix(k.astype(np.uint64) + np.uint64((i + 1) << 32)) % np.uint64(FEATURE_ROWS) for i, k in enumerate(kinds)]
    return np.stack(keys, axis=1).astype(np.int64)


def log_softmax(contexts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """log P(class | context), contexts x classes."""
    logits = np.zeros((len(contexts), CLASSES), np.float32)
    for rows in feature_rows(contexts).T:
        logits += weights[rows]
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _gradient(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        total, loss = np.zeros((FEATURE_ROWS, CLASSES)), 0.0
        for batch in batches:
            context, target, n = [c.to_numpy() for c in batch.columns]
            distinct, at = np.unique(context.astype(np.int64), return_inverse=True)
            for i in range(0, len(distinct), 20_000):
                part = distinct[i : i + 20_000]
                mine = (at >= i) & (at < i + len(part))
                seen = np.zeros((len(part), CLASSES))
                np.add.at(seen, (at[mine] - i, target[mine]), n[mine])
                scores = log_softmax(part, weights)
                loss -= (seen * scores).sum()
                error = seen - seen.sum(axis=1, keepdims=True) * np.exp(scores)
                for rows in feature_rows(part).T:
                    order = np.argsort(rows, kind="stable")
                    own, first = np.unique(rows[order], return_index=True)
                    total[own] += np.add.reduceat(error[order], first, axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([total.astype(np.float32).tobytes()], pa.binary()), pa.array([loss])], ["gradient", "loss"]
        )

    return run


def train_classes(counts: DataFrame) -> np.ndarray:
    """Weights of the class softmax from (context, class, n): updates with a rate of their own for each weight.

    There are at most CLASSES**4 rows of counts, in PARTS partitions, so an update brings PARTS small matrices to the driver.
    """
    context = counts.sparkSession.sparkContext
    weights = np.zeros((FEATURE_ROWS, CLASSES), np.float32)
    # The feature that is always active starts at what it would be alone: the classes' frequencies.
    often = np.full(CLASSES, 0.5)
    for class_, n in counts.groupBy("class").agg(F.sum("n")).collect():
        often[class_] += n
    weights[feature_rows(np.zeros(1, np.int64))[0, 0]] = np.log(often / often.sum())
    moved = np.zeros_like(weights, np.float64)
    for _ in range(UPDATES):
        shared = context.broadcast(weights)
        parts = counts.mapInArrow(_gradient(shared), "gradient binary, loss double").collect()
        gradient = np.sum([np.frombuffer(p["gradient"], np.float32).reshape(weights.shape) for p in parts], axis=0, dtype=np.float64)
        moved += gradient**2
        weights = (weights + RATE * gradient / np.sqrt(moved + 1e-9)).astype(np.float32)
        shared.unpersist()
    return weights


@dataclass
class Model:
    """A trained model; what executors need of it has a bounded size, the counts of rare words are a table."""

    total: int  # training tokens
    distinct: int
    words: DataFrame  # word (hash), cell (class and bucket), n
    least: int | None  # words this frequent are in head_words, all others are joined
    head_words: np.ndarray  # sorted hashes
    head_counts: np.ndarray
    singles: np.ndarray  # sorted hashes of the words that are classes of their own
    class_weights: np.ndarray
    cells: np.ndarray  # classes x buckets: smoothed counts of their words
    word_weights: np.ndarray


def _in_buckets(classes: np.ndarray, singles: np.ndarray) -> np.ndarray:
    """Which tokens have a bucket: a single word, like the end, is all of its class."""
    return (classes >= len(singles)) & (classes != END_CLASS)


def _events(hashes, classes, bounds, model, rows: int) -> tuple[word_features.Events, word_features.Events]:
    """The choices of classes, one for each token, and of buckets, one for each token that has one."""
    singles, class_tables, log_cells = model
    before = word_features.words_before(hashes, bounds, END)
    keys = word_features.keys_of(*before)
    one, two, three = _classes_before(classes, bounds)
    pairs = (one * CLASSES + two, one * CLASSES + three, two * CLASSES + three)
    in_buckets = np.flatnonzero(_in_buckets(classes, singles))
    given = classes[in_buckets]
    return (
        word_features.Events(list(zip(class_tables, pairs)), word_features.rows_of_keys(keys, rows), classes),
        word_features.Events(
            [(log_cells, given)],
            word_features.rows_of_keys([k[in_buckets] for k in keys], rows, given),
            word_features.bucket_of(hashes[in_buckets]),
        ),
    )


def class_tables(weights: np.ndarray) -> list[np.ndarray]:
    """Three tables by pairs of classes before, (one, two), (one, three) and (two, three) back, that add up to a context's logits."""
    a, b = np.divmod(np.arange(CLASSES**2), CLASSES)
    zero = np.zeros_like(a)

    def logits(one, two, three, kinds) -> np.ndarray:
        rows = feature_rows((one * CLASSES + two) * CLASSES + three)
        return np.sum([weights[rows[:, k]] for k in kinds], axis=0, dtype=np.float32)

    # Kinds in the order of feature_rows: always, one, two, three, (one, two), (one, three), (two, three).
    return [logits(a, b, zero, (0, 1, 2, 4)), logits(a, zero, b, (3, 5)), logits(zero, a, b, (6,))]


def _training_events(column: pa.Array, model, rows: int) -> Iterator[word_features.Events]:
    for piece in pieces(column, lower=True):
        hashes, classes, bounds = _tokens(piece)
        yield from _events(hashes, _classes(hashes, classes, model[0]), bounds, model, rows)


def _log_cells(cells: np.ndarray) -> np.ndarray:
    return np.log(cells / cells.sum(axis=1, keepdims=True)).astype(np.float32)


def _places(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """searchsorted of hashes in sorted words; asked in order, neighbouring searches end in the same part of the words."""
    order = np.argsort(hashes)
    places = np.empty(len(hashes), np.intp)
    places[order] = np.searchsorted(words, hashes[order])
    return places


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_words, head_counts, singles, class_weights, cells, word_weights, base_total = shared.value
        # log10 of a smoothed count of 0 stands in for words to be joined; their true part is added later.
        head_logs = np.log10(head_counts + 0.5)
        known_parts = (singles, class_tables(class_weights), _log_cells(cells))
        cell_logs = np.log10(cells)
        for batch in batches:
            for piece in pieces(batch.column(0), lower=True):
                hashes, classes, bounds = _tokens(piece)
                classes = _classes(hashes, classes, singles)
                at = np.minimum(_places(head_words, hashes), max(len(head_words) - 1, 0))
                known = head_words[at] == hashes if len(head_words) else np.zeros(len(hashes), bool)
                logs = np.where(known, head_logs[at], 0.0) if len(head_words) else np.zeros(len(hashes))
                of_class, of_bucket = _events(hashes, classes, bounds, known_parts, len(word_weights))
                modelled = word_features.chosen(of_class, word_weights) / np.log(10)
                in_buckets = _in_buckets(classes, singles)
                word = logs[in_buckets] - cell_logs[classes[in_buckets], of_bucket.outcomes]
                modelled[in_buckets] += word_features.chosen(of_bucket, word_weights) / np.log(10) + word
                first = bounds[:-1]
                n = np.diff(bounds)
                rest = ~known
                starts = np.concatenate([[0], np.cumsum(rest)])[bounds]
                tail = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(hashes[rest].view(np.int64)))
                columns = [c.slice(piece.first, piece.last - piece.first) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays(
                    [
                        *columns,
                        pa.array(n, pa.int64()),
                        pa.array(np.add.reduceat(known.astype(np.int64), first)),
                        pa.array(np.add.reduceat(logs, first) - n * np.log10(base_total)),
                        pa.array(np.add.reduceat(modelled, first)),
                        tail,
                    ],
                    [*batch.schema.names[1:], "n_tokens", "n_known", "base_score", "score", "tail"],
                )

    return run


def fit(train: DataFrame, text_col: str = "text") -> Model:
    """Learns from all texts of ``train`` (null counts as empty); an empty table gives a model in which every word is unknown."""
    context = train.sparkSession.sparkContext
    learn = train.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    words = learn.mapInArrow(_count_words, "word long, cell int, n long").groupBy("word").agg(
        F.first("cell").alias("cell"), F.sum("n").alias("n")
    )
    words = stored(words, "words")
    end = int(END)
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = words.where(F.col("word") != end).orderBy(F.desc("n"), "word").limit(SINGLES).collect()
    singles = np.sort(np.array([r["word"] for r in top], np.int64).view(np.uint64))
    cells = np.full(CLASSES * word_features.WIDTH, 0.5)
    alone = F.col("word").isin([r["word"] for r in top] + [end])
    for cell, n, v in words.where(~alone).groupBy("cell").agg(F.sum("n"), F.count("*")).collect():
        cells[cell] = n + 0.5 * (v + 1)
    cells = cells.reshape(CLASSES, word_features.WIDTH)
    # The least count that is frequent enough to be sent: as many as fit, all words of a count or none.
    least, held = None, 0
    for n, v in words.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        if held + v > HEAD:
            break
        least, held = n, held + v
    # Words that are all of their class are among them, however rare: what is joined is added to scores as a word of a bucket.
    head = words.where((F.col("n") >= (least if least is not None else total + 1)) | alone).select("word", "n").toPandas()
    head_words = head["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(head_words)
    head_counts = head["n"].to_numpy(np.float64)[order]

    counts = learn.mapInArrow(_count_contexts(context.broadcast(singles)), "context int, class int, n long")
    counts = counts.groupBy("context", "class").agg(F.sum("n").alias("n")).repartition(PARTS, "context")
    class_weights = train_classes(stored(counts.sortWithinPartitions("context"), "contexts"))
    parts = (singles, class_tables(class_weights), _log_cells(cells))
    word_weights = word_features.train(learn, _training_events, parts, total)
    return Model(total, distinct, words, least, head_words[order], head_counts, singles, class_weights, cells, word_weights)


def score(docs: DataFrame, train: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep``, n_tokens, n_known, train_tokens, base_score, score.

    Texts are lower-cased (A-Z), a token for each word and one for the end, so a null or empty text has one token. n_known
    tokens occur in the texts of ``train``, train_tokens is their number there; base_score is the log10 probability by
    smoothed counts of single words, score by the model. Words are told apart by 64-bit hashes. With nothing to
    learn from, every word is unknown and the counts are 0. Columns of ``keep`` named like a result are left out. Repeated rows are scored each; an empty table gives an empty
    result; other columns are ignored.
    """
    model = fit(train, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(
        (
            model.head_words,
            model.head_counts,
            model.singles,
            model.class_weights,
            model.cells,
            model.word_weights,
            model.total + 0.5 * (model.distinct + 1),
        )
    )
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in keep if c.lower() not in results]
    rows = docs.select(F.col(f"`{text_col}`").cast("string"), *[F.col(f"`{c}`") for c in kept])
    rows = rows.toDF("text", *[f"c{i}" for i in range(len(kept))])
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    scored = rows.mapInArrow(
        _score(shared), f"{schema}n_tokens long, n_known long, base_score double, score double, tail array<long>"
    )
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = model.words if model.least is None else model.words.where(F.col("n") < model.least)
    tail = scored.select("row", F.explode("tail").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    found = tail.join(rare.select("word", "n"), "word", "left")
    n = F.coalesce("n", F.lit(0))
    sums = found.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(n + 0.5)).alias("more"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("known")
    )
    out = scored.drop("tail").join(sums, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        *rows.columns[1:],
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    ).toDF(*kept, *results)
