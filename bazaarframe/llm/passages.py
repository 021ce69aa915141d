"""Passages that stand in more than one place: count-min prefilter, then exact groups of the windows that pass.

Every window of ``size`` words has an anchor, the shorter word run inside it with the least hash; equal windows have equal
anchors, so a window occurs at most as often as its anchor. Each partition counts its anchors in a count-min sketch whose
cells stop at two; merged, the sketches overestimate and never underestimate. A second pass emits only windows whose anchor
may occur twice, and groups them exactly by a 96-bit hash. A window met several times in one piece of text needs one row
in its own group, so a common passage does not pile up in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarframe.llm.words import WINDOW_SEEDS, mix, pieces, sliding_min

#: Words of the run that anchors a window, at most.
ANCHOR = 20
#: Rows and cells (a power of two) of the sketch: 2 x 2**26 bits go to every executor, whatever the input. Beyond a few
#: 10**8 anchors the sketch lets more windows pass; the exact groups still decide.
ROWS, CELL_BITS, SLICE_BITS = 2, 26, 18
#: Anchors a task counts before it hands on what it has.
FLUSH = 1 << 21
#: Words whose windows are grouped before they leave a task.
EMIT_WORDS = 1 << 20


def _anchored(piece, size: int):
    """Window starts that lie in one text, each one's anchor hash, and all hashes of the anchor runs."""
    run = min(ANCHOR, size)
    grams = piece.windows(run, WINDOW_SEEDS[1])
    n = len(piece.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), grams
    owner = piece.texts_of_words()
    inside = np.flatnonzero(owner[: len(owner) - size + 1] == owner[size - 1 :])
    return inside, sliding_min(grams, size - run + 1)[inside], grams


def _anchor_places(inside: np.ndarray, least: np.ndarray, grams: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs that anchor some window, one for each place where they stand."""
    if not len(inside):
        return least
    reach = size - min(ANCHOR, size) + 1
    # The largest least hash of the windows around a run is its own hash exactly if it anchors one of them.
    top = np.zeros(len(grams) + reach - 1, np.uint64)
    top[inside + reach - 1] = least
    best = ~sliding_min(~top, reach)
    return grams[(best == grams[: len(best)]) & (best > 0)]


def _cells(anchors: np.ndarray, row: int) -> np.ndarray:
    return (mix(anchors + np.uint64(0x9E3779B97F4A7C15 * (row + 1) & (2**64 - 1))) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted():
            anchors = np.concatenate(held)
            slices, once, more = [], [], []
            for row in range(ROWS):
                cells, n = np.unique(_cells(anchors, row), return_counts=True)
                cuts = np.searchsorted(cells, np.arange((1 << CELL_BITS - SLICE_BITS) + 1) << SLICE_BITS)
                for s in np.flatnonzero(np.diff(cuts)):
                    own, twice = cells[cuts[s] : cuts[s + 1]] & ((1 << SLICE_BITS) - 1), n[cuts[s] : cuts[s + 1]] > 1
                    slices.append((row << CELL_BITS - SLICE_BITS) + int(s))
                    once.append(own[~twice].astype(np.uint32).tobytes())
                    more.append(own[twice].astype(np.uint32).tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(slices, pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())], ["slice", "once", "more"]
            )

        total = 0
        for batch in batches:
            for piece in pieces(batch.column(0), lower=False):
                found = _anchor_places(*_anchored(piece, size), size)
                if len(found):
                    held.append(found)
                    total += len(found)
                if total >= FLUSH:
                    yield counted()
                    held, total = [], 0
        if held:
            yield counted()

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the cells with two or more, for slices whose rows come one after the other."""
    now, counts = None, None

    def bits():
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int32()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())], ["slice", "bits"]
        )

    for batch in batches:
        for s, once, more in zip(*[c.to_pylist() for c in batch.columns]):
            if s != now:
                if now is not None:
                    yield bits()
                now, counts = s, np.zeros(1 << SLICE_BITS, np.uint8)
            at = np.frombuffer(once, np.uint32)
            counts[at] = np.minimum(counts[at] + 1, 2)
            counts[np.frombuffer(more, np.uint32)] = 2
    if now is not None:
        yield bits()


def _maybe_repeated(anchors: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    passed = np.ones(len(anchors), bool)
    for row in range(ROWS):
        cells = _cells(anchors, row)
        passed &= (sketch[row, cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)
    return passed


def _windows(size: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.frombuffer(shared.value, np.uint8).reshape(ROWS, -1)
        for batch in batches:
            held, words = [], 0
            for piece in pieces(batch.column(2), lower=False):
                inside, least, _ = _anchored(piece, size)
                inside = inside[_maybe_repeated(least, sketch)] if len(inside) else inside
                if len(inside):
                    owner = piece.texts_of_words()[inside]
                    first, second = piece.windows(size, WINDOW_SEEDS[0]), piece.windows(size, WINDOW_SEEDS[1])
                    held.append((first[inside], second[inside], owner + piece.first, inside - piece.bounds[owner]))
                words += len(piece.hashes)
                if words >= EMIT_WORDS and held:
                    yield _rows(batch, held)
                    held, words = [], 0
            if held:
                yield _rows(batch, held)

    return run


def _place_hashes(window: np.ndarray, start: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """A hash of a window and the place where it stands."""
    return mix(window ^ mix(start.astype(np.uint64) + np.uint64(1)) ^ mix(keys))


def _rows(batch: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
    """A row per window: its hash, its text and place, whether it was met before here.

    Of equal windows one keeps their hash and says that there are more; the others are known to be repeated and take a
    hash of their own place instead, which spreads them.
    """
    first, second, text, start = [np.concatenate(x) for x in zip(*held)]
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    again = np.zeros(len(a), bool)
    again[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    several = again.copy()
    several[:-1] |= again[1:]
    text, start = text[order], start[order]
    keys = batch.column(1).take(pa.array(text)).to_numpy(zero_copy_only=False).view(np.uint64)
    own = _place_hashes(a, start, keys)
    a, b = np.where(again, own, a), np.where(again, mix(own), b)
    place = np.where(several, ~start, start).astype(np.int32).view(np.uint32).astype(np.uint64)
    # The second hash's upper half and the place share a number: rows are many, and hashes do not compress.
    return pa.RecordBatch.from_arrays(
        [
            batch.column(1).take(pa.array(text)),
            pa.array(a.view(np.int64)),
            pa.array((b & np.uint64(0xFFFFFFFF00000000) | place).view(np.int64)),
        ],
        ["row_key", "w1", "w2_place"],
    )


def _own_starts(batch: pa.RecordBatch, row: int, size: int) -> np.ndarray:
    """The starts that came to a row's key and are its own: another row may have the same key."""
    (piece,) = pieces(batch.column(1).slice(row, 1), lower=False)
    first = piece.windows(size, WINDOW_SEEDS[0])
    found = batch.column(2)[row].values.to_numpy()
    found = found[found >> 16 < len(first)]
    at, check = found >> 16, (found & 0xFFFF).astype(np.uint64)
    key = np.array([batch.column(3)[row].as_py()], np.int64).view(np.uint64)
    own = (first[at] >> np.uint64(48) == check) | (_place_hashes(first[at], at, key) >> np.uint64(48) == check)
    return np.unique(at[own])


def _removed(size: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digests, texts = [], [], [], []
            for i, (text, starts) in enumerate(zip(batch.column(1), batch.column(2))):
                words = (text.as_py() or "").encode().split()
                n_words.append(len(words))
                at = _own_starts(batch, i, size) if starts.is_valid else None
                if at is not None and len(at):
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, at, 1)
                    np.add.at(edges, at + size, -1)
                    covered = np.cumsum(edges[:-1]) > 0
                    n_removed.append(int(covered.sum()))
                    words = [w for w, c in zip(words, covered) if not c]
                else:
                    n_removed.append(0)
                rest = b" ".join(words)
                digests.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    texts.append(rest.decode())
            columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return run


def repeated_passages(
    docs: DataFrame, size: int = 35, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per input row: ``<id_col>``, n_words, n_removed, kept_sha256, and kept_text if asked for.

    Words stay as they are. A word goes if a window of ``size`` words that covers it has the word sequence of a window
    that starts elsewhere, in the same text or another; windows are judged on the input. kept_sha256 is the digest of the
    words that are left, joined by one space. A null or blank text has no words; texts shorter than a window lose
    none. Rows that repeat one another lose all words if they have a window. Rows with one id and different texts are
    told apart. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # A row is known by 64 bits of its id and text. Should two rows share them, each takes up only starts of windows it has.
    key = F.xxhash64(f"`{id_col}`", text)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), key.alias("row_key"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    partial = rows.select("text").mapInArrow(_sketch(size), "slice int, once binary, more binary")
    merged = partial.repartition("slice").sortWithinPartitions("slice").mapInArrow(_merged, "slice int, bits binary")
    sketch = np.zeros((ROWS << CELL_BITS - SLICE_BITS, (1 << SLICE_BITS) // 8), np.uint8)
    for row in merged.toLocalIterator():  # as many slices as the sketch has, whatever the input
        sketch[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(sketch.tobytes())

    found = rows.mapInArrow(_windows(size, shared), "row_key long, w1 long, w2_place long")
    # Dealt out by the first hash alone, which serves the groups as well, so that no further column is shuffled.
    dealt = found.repartition("w1").withColumns(
        {"w2": F.shiftright("w2_place", 32), "place": F.col("w2_place").bitwiseAND(F.lit(0xFFFFFFFF))}
    )
    # A window counts twice if it was met several times before it came here: its place is below zero, here above 2**31.
    several = F.col("place") >= 1 << 31
    met = F.sum(F.when(several, 2).otherwise(1)).over(Window.partitionBy("w1", "w2"))
    start = F.when(several, (1 << 32) - 1 - F.col("place")).otherwise(F.col("place"))
    # A start and 16 bits of its window's hash share a number.
    checked = F.shiftleft(start, 16).bitwiseOR(F.shiftrightunsigned("w1", 48))
    repeated = dealt.withColumn("met", met).where("met > 1")
    starts = repeated.groupBy("row_key").agg(F.collect_set(checked).alias("starts"))
    whole = rows.join(starts, "row_key", "left")
    extra = ", kept_text string" if with_text else ""
    out = whole.select("id", "text", "starts", "row_key").mapInArrow(
        _removed(size, with_text), f"id {kind}, n_words long, n_removed long, kept_sha256 string{extra}"
    )
    return out.withColumnRenamed("id", id_col)
