"""Maximal periodic runs of words, by lag scans for short periods and multi-scale minimizers for long ones.

Words become exact numbers, and so do runs of 2, 4, 8, ... words (numbers of pairs of numbers), as long as some run of that
many words occurs twice. Periods below SHORT are found by comparing the words with themselves at each lag. For
periods from P to 2P, P a power of two, the runs of P/2 words are sampled by their least hash in every window of P
words: inside a periodic run the same samples come again one period later, so a pair of equal samples at that distance seeds
the run, and the numbers of longer and longer word runs extend the seed to both sides, exactly.

Word runs that are themselves periodic would come again too often; they are left out of the samples, because they lie in
runs that a shorter scale has found. A longer run that has only such stretches in a window repeats the beginnings or the ends of those
shorter runs one period later, or stands on the border of two of them that touch; these are seeds too. So each scale
takes a few seeds per sampled place, and no run is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarframe.llm.words import PIECE_BYTES, mix, sliding_min

#: Periods below are scanned lag by lag; a power of two, at least twice the least length of a run.
SHORT = 32
#: Words that a run has at least, besides two periods.
LEAST = 12
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_EMPTY = np.zeros(0, np.int64)


def _numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    return pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)


def _longer(names: np.ndarray, step: int) -> np.ndarray:
    """Numbers of the runs of 2*step words from those of step words; -1 where a run occurs once."""
    n = len(names) - step
    out = np.full(max(n, 0), -1, np.int32)
    if n <= 0:
        return out
    at = np.flatnonzero((names[:n] >= 0) & (names[step:] >= 0))
    pairs = names[at].astype(np.int64) * (len(names) + 1) + names[at + step]
    _, which, count = np.unique(pairs, return_inverse=True, return_counts=True)
    again = count > 1
    number = np.where(again, np.cumsum(again) - 1, -1)
    out[at] = number[which]
    return out


class Names:
    """Numbers of the word runs of 1, 2, 4, ... words; a number is -1 where the run occurs once."""

    def __init__(self, ids: np.ndarray):
        count = np.bincount(ids)
        self.levels = [np.where(count[ids] > 1, ids, -1).astype(np.int32)]
        while (self.levels[-1] >= 0).any():
            self.levels.append(_longer(self.levels[-1], 1 << (len(self.levels) - 1)))

    def right(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from x and from y on are equal."""
        return self._reach(x, y, 1)

    def left(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before x and before y are equal."""
        return self._reach(x, y, -1)

    def _reach(self, x: np.ndarray, y: np.ndarray, way: int) -> np.ndarray:
        total = np.zeros(len(x), np.int64)
        # No run of as many words as the last level has occurs twice, so each level counts once at most.
        for k in reversed(range(len(self.levels))):
            names, back = self.levels[k], 0 if way > 0 else 1 << k
            a, b = x + way * total - back, y + way * total - back
            inside = (a >= 0) & (b >= 0) & (a < len(names)) & (b < len(names))
            a, b = np.where(inside, a, 0), np.where(inside, b, 0)
            if len(names):
                total += np.where(inside & (names[a] >= 0) & (names[a] == names[b]), 1 << k, 0)
        return total


def _lag_scan(ids: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches with period q of LEAST words and two periods."""
    need = max(LEAST, 2 * q) - q
    same = ids[:-q] == ids[q:]
    if len(same) < need:
        return _EMPTY, _EMPTY
    width = 1  # words from here on that must be equal
    while 2 * width <= need:
        same = same[:-width] & same[width:]
        width *= 2
    if need > width:
        same = same[: width - need] & same[need - width :]
    if not same.any():
        return _EMPTY, _EMPTY
    edges = np.diff(np.concatenate([[0], same.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + need - 1 + q


def _least_periods(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the periods found for one stretch the least, by start and end."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[first], end[first], period[first]


def _minimizers(names: np.ndarray, left_out: np.ndarray, window: int) -> np.ndarray:
    """Places whose run of words has the least hash of some window; runs that occur once or are left out do not count."""
    hashes = mix(names.astype(np.uint64) + np.uint64(1))
    hashes[(names < 0) | left_out] = _NONE
    if len(hashes) < window:
        return _EMPTY
    least = sliding_min(hashes, window)
    around = np.zeros(len(least) + 2 * (window - 1), np.uint64)
    around[window - 1 : window - 1 + len(least)] = np.where(least == _NONE, 0, least)
    # The largest least hash of the windows around a place is its own exactly if it is the minimum of one.
    largest = ~sliding_min(~around, window)
    return np.flatnonzero((largest == hashes) & (hashes != _NONE))


def _equal_pairs(names: np.ndarray, places: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of equal word runs from low to below high apart."""
    order = np.lexsort((places, names[places]))
    places, name = places[order], names[places[order]]
    at, far, step = [], [], 1
    while step < len(places):
        distance = places[step:] - places[:-step]
        near = (name[step:] == name[:-step]) & (distance < high)
        if not near.any():
            break
        take = np.flatnonzero(near & (distance >= low))
        at.append(places[take])
        far.append(distance[take])
        step += 1
    return (np.concatenate(at), np.concatenate(far)) if at else (_EMPTY, _EMPTY)


def _border_seeds(names: np.ndarray, start, end, period, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds from shorter runs: equal ends or starts one period apart, and borders of runs that touch."""
    at, far = [], []
    for step in range(1, len(start)):
        begins, ends = start[step:] - start[:-step], end[step:] - end[:-step]
        touching = start[step:] <= end[:-step]
        if not (touching | (begins < high) | (ends < high)).any():
            break
        for distance, place in ((begins, start[:-step]), (ends, end[:-step] - 1)):
            take = np.flatnonzero((distance >= low) & (distance < high))
            at.append(place[take])
            far.append(distance[take])
        for i in np.flatnonzero(touching & (period[step:] == period[:-step])):
            j, d = i + step, period[i]
            here = np.flatnonzero(names[start[i] : start[i] + d] == names[start[j]])
            if len(here) and names[start[j]] >= 0:
                shift = (start[j] - start[i] - here[0]) % d
                q = np.arange(low + (shift - low) % d, min(high, begins[i] + d + 1, ends[i] + d + 1), d)
                at.append(np.maximum(start[i], start[j] - q))
                far.append(q)
    return (np.concatenate(at), np.concatenate(far)) if at else (_EMPTY, _EMPTY)


def periodic_runs(ids: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and least period of every maximal run of LEAST words and two periods, by start and end.

    ``ids`` are small whole numbers of words; texts are divided by numbers that occur once, ``longest`` is the number
    of words of the longest text.
    """
    found = [(_EMPTY, _EMPTY, _EMPTY)]
    for q in range(1, min(SHORT, longest // 2 + 1)):
        start, end = _lag_scan(ids, q)
        found.append((start, end, np.full(len(start), q)))
    runs = _least_periods(*[np.concatenate(c) for c in zip(*found)])
    if longest < 2 * SHORT:
        return runs
    names, low = Names(ids), SHORT
    while 2 * low <= longest and len(names.levels) > (k := low.bit_length() - 2) and (names.levels[k] >= 0).any():
        own, size = names.levels[k], low // 2
        start, end, period = runs
        inner = np.flatnonzero((period <= size // 2) & (end - start >= size))
        marks = np.zeros(len(ids) + 1, np.int64)
        np.add.at(marks, start[inner], 1)
        np.add.at(marks, end[inner] - size + 1, -1)
        periodic = np.cumsum(marks)[: len(own)] > 0
        places = _minimizers(own, periodic, low - size + 1)
        wide = inner[end[inner] - start[inner] >= low]
        seeds = [_equal_pairs(own, places, low, 2 * low), _border_seeds(own, start[wide], end[wide], period[wide], low, 2 * low)]
        at, far = [np.concatenate(c) for c in zip(*seeds)]
        if len(at):
            begin = at - names.left(at, at + far)
            close = at + far + names.right(at, at + far)
            fit = close - begin >= 2 * far
            more = (begin[fit], close[fit], far[fit])
            runs = _least_periods(*[np.concatenate(c) for c in zip(runs, more)])
        low *= 2
    return runs


def _pieces(texts: pa.Array) -> Iterator[list[bytes]]:
    """Texts by the megabyte; a longer one comes alone."""
    held, size = [], 0
    for text in texts:
        text = (text.as_py() or "").encode()
        if held and size + len(text) > PIECE_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def _described(texts: list[bytes], with_text: bool) -> list[tuple]:
    """Columns of some texts, a tuple each."""
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words])
    # One number that occurs once after each text.
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    ids = np.zeros(ends[-1], np.int32)
    inside = np.ones(len(ids), bool)
    inside[ends - 1] = False
    own = _numbered([w for text in words for w in text])
    ids[inside] = own
    ids[~inside] = (own.max(initial=-1) + 1) + np.arange(len(texts))
    start, end, period = periodic_runs(ids, int(sizes.max()))
    marks = np.zeros(len(ids) + 1, np.int64)
    np.add.at(marks, start + period, 1)
    np.add.at(marks, end, -1)
    dropped = np.cumsum(marks[:-1]) > 0
    cuts = np.searchsorted(start, np.append(begins, len(ids)))
    out = []
    for i, text in enumerate(words):
        runs, rest = [], text
        if cuts[i + 1] > cuts[i]:
            mine = slice(cuts[i], cuts[i + 1])
            runs = sorted(zip((start[mine] - begins[i]).tolist(), (end[mine] - start[mine]).tolist(), period[mine].tolist()), key=lambda r: (r[0], r[2]))
            gone = dropped[begins[i] : begins[i] + len(text)]
            rest = [w for w, g in zip(text, gone) if not g]
        first, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        kept = b" ".join(rest)
        row = (len(text), len(runs), first, length, q, 1000 * length // q if runs else None)
        row += (hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
        out.append((*row, [{"start": s, "length": n, "period": p} for s, n, p in runs], kept.decode()) if with_text else row)
    return out


_COLUMNS = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_REAL = ", runs array<struct<start: long, length: long, period: long>>, collapsed_text string"


def _find(with_text: bool):
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    kinds += [pa.list_(run), pa.string()] if with_text else []
    names = [c.split()[0].rstrip(":") for c in _COLUMNS.split(", ")] + (["runs", "collapsed_text"] if with_text else [])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in _pieces(batch.column(1)):
                columns = zip(*_described(texts, with_text))
                arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(texts)), *arrays], ["id", *names])
                done += len(texts)

    return find


def run_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per input row: ``<id_col>``, n_words, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256.

    A run is a stretch of words with least period q (words q apart are equal), of at least 12 words and two periods, that no
    neighbouring word extends. start, length, period and exponent_milli (thousandths of length by period) are those of the longest run, then of the first,
    then of the shortest period, and null without runs. runs_sha256 is the digest of all runs' lines ``start,length,period``.
    Words of a run after its first q are dropped; collapsed_sha256 is the digest of the others joined by one space.
    ``with_text`` adds the runs and the collapsed text themselves.

    A null, empty or blank text has no words and no runs; a text is searched whole, however long. Repeated rows and
    rows without an id are each described by their own text. An empty table gives an empty result; other columns are ignored,
    whatever their names.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_find(with_text), f"id {kind}, {_COLUMNS}{_REAL if with_text else ''}")
    return out.withColumnRenamed("id", id_col)
