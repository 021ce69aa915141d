"""Word n-gram and skip features of the two softmaxes of the language model, hashed into rows of one weight matrix.

A token is two events: its class among all classes and, unless the word is all of its class, its bucket within the
class. The features of an event are the word before, the word before that (a skip) and both (a trigram); for buckets each goes
with the class. An event's log probabilities are the softmax of what is known without words before (``known``) plus the rows of
its features. Weights start at zero, and each update moves them along the gradient, summed up in Spark by blocks of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarframe.llm.words import fold, mix

#: Outcomes of either softmax: classes, and buckets within a class.
WIDTH = 48
#: Rows of the matrix: a power of two that grows with the training tokens, one row for so many, within these bounds.
LEAST_ROWS, MOST_ROWS, TOKENS_A_ROW = 1 << 12, 1 << 16, 8
#: Every update takes one of so many parts of the training texts, dealt by hash, so that all are read once.
UPDATES = 4
#: Step along the gradient; observations that each weight has before the first (they hold rare features back); largest step.
RATE, PRIOR, LARGEST = 0.3, 1.0, 1.5
#: Events whose probabilities are held at once, rows of a block of the matrix, and training tokens for each task.
CHUNK, BLOCK_ROWS, TASK_TOKENS = 1 << 10, 1 << 10, 1 << 21
#: Events of one row of the matrix up to which they are added up together with those of other rows, not row by row.
FEW = 8


def matrix_rows(tokens: int) -> int:
    rows = LEAST_ROWS
    while rows < MOST_ROWS and rows * TOKENS_A_ROW < tokens:
        rows *= 2
    return rows


def bucket_of(words: np.ndarray) -> np.ndarray:
    """Bucket of a word within its class, by its hash."""
    return (mix(words ^ np.uint64(0x5BD1E995)) % np.uint64(WIDTH)).astype(np.int64)


def words_before(hashes: np.ndarray, bounds: np.ndarray, end: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The word before each token and the one before that; before a text stands its end."""
    place = np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))
    one, two = np.full(len(hashes), end), np.full(len(hashes), end)
    one[1:] = np.where(place[1:] >= 1, hashes[:-1], end)
    two[2:] = np.where(place[2:] >= 2, hashes[:-2], end)
    return one, two


def keys_of(one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
    """Keys of each event's features, the same for classes and for buckets: the word before, the one before that, and both."""
    mixed = mix(one)
    return [mixed, mix(two), fold(mixed, two)]


def rows_of_keys(keys: list[np.ndarray], rows: int, given: np.ndarray | None = None) -> list[np.ndarray]:
    """Rows of the matrix for each event's features; given: the class, for events that choose a bucket; rows: a power of two."""
    salt = np.uint64(0) if given is None else (given.astype(np.uint64) + np.uint64(1)) << np.uint64(8)
    return [(mix(k ^ (salt ^ np.uint64(i))) & np.uint64(rows - 1)).astype(np.uint16) for i, k in enumerate(keys, 1)]


def rows_of(one: np.ndarray, two: np.ndarray, rows: int, given: np.ndarray | None = None) -> list[np.ndarray]:
    """Rows of the matrix for events after the words one and two back."""
    return rows_of_keys(keys_of(one, two), rows, given)


@dataclass
class Events:
    """What one softmax has to foretell: tables of logits and, for each of them, the row that each event takes."""

    known: list[tuple[np.ndarray, np.ndarray]]
    features: list[np.ndarray]
    outcomes: np.ndarray

    def chunks(self, weights: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """Slices of the events, small enough for a processor's cache, and the logits of all outcomes."""
        spare = np.empty((CHUNK, weights.shape[1]), np.float32)
        tables = [*self.known, *[(weights, f) for f in self.features]]
        for i in range(0, len(self.outcomes), CHUNK):
            part = slice(i, min(i + CHUNK, len(self.outcomes)))
            logits = np.take(*_taken(tables[0], part), axis=0)
            for table in tables[1:]:
                logits += np.take(*_taken(table, part), axis=0, out=spare[: len(logits)], mode="clip")
            yield part, logits


def _taken(table: tuple[np.ndarray, np.ndarray], part: slice) -> tuple[np.ndarray, np.ndarray]:
    return table[0], table[1][part]


def less_largest(logits: np.ndarray) -> np.ndarray:
    """Logits of events x outcomes less the event's largest, as outcomes x events: so numpy takes many events at a time."""
    logits = np.ascontiguousarray(logits.T)
    logits -= logits.max(axis=0)
    return logits


def sum_of_outcomes(powers: np.ndarray) -> np.ndarray:
    """Sums of outcomes x events, in the order in which numpy adds up a row of events x outcomes: by eights, then pairs."""
    sums = powers[0:8] + powers[8:16]
    for i in range(16, len(powers), 8):
        sums += powers[i : i + 8]
    while len(sums) > 1:
        sums = sums[0::2] + sums[1::2]
    return sums[0]


def chosen(events: Events, weights: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each event's outcome."""
    out = np.zeros(len(events.outcomes))
    for part, logits in events.chunks(weights):
        logits = less_largest(logits)
        own = logits[events.outcomes[part], np.arange(logits.shape[1])]
        out[part] = own - np.log(sum_of_outcomes(np.exp(logits, out=logits)))
    return out


def row_sums(error: np.ndarray, features: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each feature its distinct rows, the events of each, and the sums of these events' errors.

    Most rows of a chunk have one event or a few, for which ``reduceat`` costs a call for each row and outcome. These rows are
    taken all at once instead: the first event of each, the second of those that have one, and so on, added up
    in the order of ``reduceat``, the first to the sum of the others, so that not a bit differs.
    """
    orders = [np.argsort(rows, kind="stable") for rows in features]
    order, ranked = np.concatenate(orders), np.concatenate([rows[o] for rows, o in zip(features, orders)])
    begins = np.ones(len(order), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=begins[1:])
    begins[:: len(error)] = True  # where a feature ends, so does its last row
    first = np.flatnonzero(begins)
    n = np.empty_like(first)
    np.subtract(first[1:], first[:-1], out=n[:-1])
    n[-1] = len(order) - first[-1]
    sums = np.take(error, order[first], axis=0)
    several = np.flatnonzero((n > 1) & (n <= FEW))
    if len(several):
        several = several[np.argsort(-n[several])]
        at, others = first[several], n[several]
        rest = np.take(error, order[at + 1], axis=0)
        for k in range(2, others[0]):
            more = np.count_nonzero(others > k)  # so many have an event of this place, and stand in front
            rest[:more] += np.take(error, order[at[:more] + k], axis=0)
        sums[several] += rest
    many = n > FEW
    if many.any():
        events = order[np.repeat(many, n)]
        starts = np.cumsum(n[many]) - n[many]
        sums[many] = np.add.reduceat(np.take(error, events, axis=0), starts, axis=0)
    cuts = [0, *np.searchsorted(first, len(error) * np.arange(1, len(features))), len(first)]
    own = ranked[first].astype(np.intp)
    for i, j in zip(cuts[:-1], cuts[1:]):
        yield own[i:j], n[i:j], sums[i:j]


def add_gradient(total: np.ndarray, mass: np.ndarray, events: Events, weights: np.ndarray) -> None:
    """Adds observed less expected outcomes to total, row by row, and the number of events to mass."""
    for part, error in events.chunks(weights):
        powers = less_largest(error)
        np.exp(powers, out=powers)
        powers *= -1 / sum_of_outcomes(powers)
        error = np.ascontiguousarray(powers.T)
        error[np.arange(len(error)), events.outcomes[part]] += 1
        for own, n, sums in row_sums(error, [f[part] for f in events.features]):
            sums += np.take(total, own, axis=0)
            total[own] = sums
            mass[own] += n


def stepped(weights: np.ndarray, total: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Weights after a step: the gradient over the events that a weight would expect of an even chance."""
    step = RATE * total / (mass[:, None] / WIDTH + PRIOR)
    return (weights + np.clip(step, -LARGEST, LARGEST)).astype(np.float32)


def _gradients(events_of, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, weights = shared.value
        total, mass = np.zeros(weights.shape, np.float32), np.zeros(len(weights))
        for batch in batches:
            for events in events_of(batch.column(0), model, len(weights)):
                add_gradient(total, mass, events, weights)
        for first in range(0, len(weights), BLOCK_ROWS):
            rows = first + np.flatnonzero(mass[first : first + BLOCK_ROWS])
            if len(rows):
                # Means are within -1..1, so half precision keeps them; times whole counts they add up alike in any order.
                mean = (total[rows] / mass[rows, None]).astype(np.float16)
                values = [rows.astype(np.int32).tobytes(), mass[rows].tobytes(), mean.tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first // BLOCK_ROWS], pa.int32()), *[pa.array([v], pa.binary()) for v in values]],
                    ["block", "rows", "mass", "mean"],
                )

    return run


def _steps(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value[1]
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of the blocks of this task, a few hundred KB each
        for batch in batches:
            for row in batch.to_pylist():
                total, mass = sums.setdefault(row["block"], (np.zeros((BLOCK_ROWS, WIDTH)), np.zeros(BLOCK_ROWS)))
                at = np.frombuffer(row["rows"], np.int32) - row["block"] * BLOCK_ROWS
                n = np.frombuffer(row["mass"])
                total[at] += np.frombuffer(row["mean"], np.float16).reshape(-1, WIDTH).astype(np.float64) * n[:, None]
                mass[at] += n
        for block, (total, mass) in sums.items():
            new = stepped(weights[block * BLOCK_ROWS : (block + 1) * BLOCK_ROWS], total, mass)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([new.tobytes()], pa.binary())], ["block", "new"])

    return run


def train(texts: DataFrame, events_of, model, tokens: int) -> np.ndarray:
    """Weights from the one column ``texts``; events_of(column, model, rows) yields the Events of a batch.

    Tasks hand on the rows they met only, a shuffle by block sums them up, and the driver sees the new weights alone: at most
    MOST_ROWS x WIDTH numbers.
    """
    context = texts.sparkSession.sparkContext
    weights = np.zeros((matrix_rows(tokens), WIDTH), np.float32)
    texts = texts.coalesce(max(1, -(-tokens // TASK_TOKENS)))
    for update in range(UPDATES):
        shared = context.broadcast((model, weights))
        part = texts.where(F.pmod(F.xxhash64(texts.columns[0]), F.lit(UPDATES)) == update)
        sums = part.mapInArrow(_gradients(events_of, shared), "block int, rows binary, mass binary, mean binary")
        moved = sums.repartition("block").mapInArrow(_steps(shared), "block int, new binary").collect()
        weights = weights.copy()
        for row in moved:
            weights[row["block"] * BLOCK_ROWS : (row["block"] + 1) * BLOCK_ROWS] = np.frombuffer(row["new"], np.float32).reshape(-1, WIDTH)
        shared.unpersist()
    return weights
