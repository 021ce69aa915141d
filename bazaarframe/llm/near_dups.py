"""Near-duplicate documents: banded MinHash candidates, checked by odd sketches, confirmed on full shingle sets.

MinHash samples in bands of a few are bucket keys. Documents that share a bucket get an odd sketch: more samples, folded
into a bitmap by parity. How far two documents' samples differ shows in the bits of the bitmaps' XOR, precisely so
at high similarities. Candidates whose XOR has too many bits are never looked at again; the others are compared on their
full sets of shingles.

Documents with equal sets are one class from the start. Of a bucket's classes, all are compared with the one that
shares most buckets, then those outside the bucket's largest component with members of that; classes that are linked by
then need no comparison any more, and pairs of different components are compared until none is left. So a group of copies
costs a few comparisons a copy, and no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarframe.llm.store import components, stored, unnamed
from bazaarframe.llm.words import lists, mix, pieces

BANDS = 48
#: Chance that a pair exactly at the threshold shares no bucket.
MISS = 1e-6
#: Samples that are folded into the bits of an odd sketch.
SKETCH_SAMPLES, SKETCH_BITS = 2048, 4096
SIGMAS = 5
#: Rounds in which classes outside a bucket's largest component are compared with a member of it.
ROUNDS = 2
#: Shingles hashed at once.
STEP = 1024


def band_rows(similarity: float) -> int:
    """Samples in a band, as many as keep the miss chance at the threshold below MISS."""
    return max(1, math.floor(math.log(1 - MISS ** (1 / BANDS)) / math.log(similarity)))


def most_odd_bits(similarity: float) -> int:
    """XOR bits that a pair at the threshold stays below but for a chance of five standard deviations."""
    spread = math.sqrt(SKETCH_SAMPLES * similarity * (1 - similarity))
    differing = 2 * (SKETCH_SAMPLES * (1 - similarity) + SIGMAS * spread)
    expected = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** differing)
    return math.ceil(expected + 4 * differing / math.sqrt(SKETCH_BITS))


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; with fewer words, of the whole sequence."""
    n = min(size, len(hashes))
    if not n:
        return hashes
    with np.errstate(over="ignore"):
        runs = hashes[: len(hashes) - n + 1].copy()
        for i in range(1, n):
            runs = mix(runs * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - n + 1 + i])
        return np.unique(mix(runs + np.uint64(n)))


class Sampler:
    """Least values of a shingle set under many hash functions."""

    def __init__(self, samples: int, seed: int):
        rng = np.random.default_rng(seed)
        self.samples = samples
        self.times = rng.integers(0, 1 << 32, samples, np.uint32) | np.uint32(1)
        self.plus = rng.integers(0, 1 << 32, samples, np.uint32)
        self.which = rng.integers(0, 1 << 63, samples, np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.samples, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), STEP):
            np.minimum(least, (x[i : i + STEP, None] * self.times + self.plus).min(axis=0), out=least)
        return mix(least.astype(np.uint64) + self.which)


def band_keys(samples: np.ndarray, rows: int) -> np.ndarray:
    keys = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for column in samples.reshape(BANDS, rows).T:
        keys = mix(keys ^ column)
    return keys


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity of the samples that fall on each bit."""
    at = (samples % np.uint64(SKETCH_BITS)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=SKETCH_BITS) & 1).astype(np.uint8)).view(np.uint64)


def _signatures(shingle: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = band_rows(similarity)
        sample = Sampler(BANDS * rows, 20)
        for batch in batches:
            for piece in pieces(batch.column(2), lower=True):
                sizes, keys, bands = [], [], []
                for i in range(piece.last - piece.first):
                    own = shingle_set(piece.hashes[piece.bounds[i] : piece.bounds[i + 1]], shingle)
                    sizes.append(len(own))
                    if len(own):
                        at = np.arange(1, len(own) + 1, dtype=np.uint64)
                        keys.append(np.array([(own * at).sum(dtype=np.uint64), mix(own).sum(dtype=np.uint64)]).tobytes())
                        bands.append(band_keys(sample(own), rows))
                    else:
                        keys.append(None)
                        bands.append(np.zeros(BANDS, np.uint64))
                n = piece.last - piece.first
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, n),
                        batch.column(1).slice(piece.first, n),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.binary()),
                        lists(np.concatenate(bands), BANDS),
                    ],
                    ["id", "text_key", "n_shingles", "set_key", "bands"],
                )

    return run


def _sketches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = Sampler(SKETCH_SAMPLES, 21)
        for batch in batches:
            for piece in pieces(batch.column(2), lower=True):
                odd = [
                    odd_sketch(sample(shingle_set(piece.hashes[piece.bounds[i] : piece.bounds[i + 1]], shingle)))
                    for i in range(piece.last - piece.first)
                ]
                columns = [c.slice(piece.first, piece.last - piece.first) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*columns, lists(np.concatenate(odd), SKETCH_BITS // 64)], ["id", "n", "text", "bands", "odd"]
                )

    return run


def _confirmed(shingle: int, part: int, whole: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            keep = []
            firsts, names = batch.column(2), batch.column(0).to_pylist()
            for piece in pieces(batch.column(3), lower=True):
                for i in range(piece.last - piece.first):
                    row = piece.first + i
                    if last[0] is None or last[0] != names[row]:
                        (own,) = pieces(firsts.slice(row, 1), lower=True)
                        last = (names[row], shingle_set(own.hashes, shingle))
                    other = shingle_set(piece.hashes[piece.bounds[i] : piece.bounds[i + 1]], shingle)
                    both = len(np.intersect1d(last[1], other, assume_unique=True))
                    if both and whole * both >= part * (len(last[1]) + len(other) - both):
                        keep.append(row)
            if keep:
                rows = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])

    return run


def _few_odd_bits(left: str, right: str, most: int):
    bits = [F.bit_count(F.col(f"{left}.odd")[i].bitwiseXOR(F.col(f"{right}.odd")[i])) for i in range(SKETCH_BITS // 64)]
    return reduce(lambda x, y: x + y, bits) <= most


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, part: int = 80, whole: int = 100
) -> DataFrame:
    """One row per input row: ``<id_col>``, n_shingles, component_id, kept.

    Words are lower-cased (A-Z); a document's set has its distinct runs of ``shingle`` words, or the whole sequence if
    it has fewer. Two documents are linked if ``whole * intersection >= part * union``; component_id is the smallest
    id that links reach, kept tells whether it is the document's own. A null or blank text has an empty set and
    no links. Rows with one id are one document: they share a component and are kept or not together. A row without an id
    is kept; its component_id is that of the documents with the same set, else null. An empty table gives an empty
    result; other columns are ignored.
    """
    similarity = part / whole
    most = most_odd_bits(similarity)
    text = F.col(f"`{text_col}`").cast("string")
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    signatures = stored(
        source.mapInArrow(
            _signatures(shingle, similarity),
            f"id {kind}, text_key long, n_shingles long, set_key binary, bands array<long>",
        ),
        "signatures",
    )
    # Equal sets have equal samples, so any row of a class speaks for it.
    classes = stored(
        signatures.where("set_key is not null and id is not null")
        .groupBy("set_key")
        .agg(
            F.min(F.struct("id", "text_key")).alias("row"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        )
        .select("set_key", "row.*", "n", "bands"),
        "classes",
    )
    keys = classes.select("id", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = stored(keys.join(shared, "key"), "buckets")
    wanted = buckets.select("id").distinct()
    known = classes.select("id", "text_key", "n", "bands").join(wanted, "id", "left_semi").join(source, ["id", "text_key"])
    known = known.dropDuplicates(["id", "text_key"])  # a class's row may be repeated
    known = known.select("id", "n", "text", "bands").mapInArrow(
        _sketches(shingle), f"id {kind}, n long, text string, bands array<long>, odd array<long>"
    )
    known = stored(known, "texts")

    def confirm(pairs: DataFrame) -> DataFrame:
        """Of candidate pairs (a, b), those that the full sets confirm."""
        x, y = known.select("id", "n", "odd").alias("x"), known.select("id", "n", "odd").alias("y")
        fit = (
            pairs.join(x, F.col("a") == F.col("x.id"))
            .join(y, F.col("b") == F.col("y.id"))
            .where(F.least("x.n", "y.n") * whole >= F.greatest("x.n", "y.n") * part)
            .where(_few_odd_bits("x", "y", most))
            .select("a", "b")
        )
        first = known.select(F.col("id").alias("a"), F.col("text").alias("first"))
        second = known.select(F.col("id").alias("b"), F.col("text").alias("second"))
        whole_texts = fit.join(second, "b").join(first, "a").select("a", "b", "first", "second")
        return stored(
            whole_texts.mapInArrow(_confirmed(shingle, part, whole), f"a {kind}, b {kind}"),
            "confirmed",
        )

    # Every class with the most widely shared class of each of its buckets.
    reach = buckets.groupBy("id").agg(F.sum("n").alias("reach"))
    leaders = buckets.join(reach, "id").groupBy("key").agg(F.max(F.struct("reach", "id")).alias("l"))
    stars = buckets.join(leaders, "key").select(F.col("l.id").alias("a"), F.col("id").alias("b")).where("a <> b")
    linked = confirm(stars.distinct())
    labels = stored(components(linked), "labels")

    def several_labels() -> DataFrame:
        """Rows of the buckets with several labels (equal only if linked): band, key, id, label, main (the commonest)."""
        rows = buckets.select("band", "key", "id").join(labels, F.col("id") == F.col("node"), "left")
        rows = rows.select("band", "key", "id", F.coalesce("component", "id").alias("label"))
        main = (
            rows.groupBy("key", "label")
            .agg(F.count("*").alias("n"))
            .groupBy("key")
            .agg(F.max(F.struct("n", "label")).alias("main"), F.count("*").alias("labels"))
            .where("labels > 1")
            .select("key", F.col("main.label").alias("main"))
        )
        return rows.join(main, "key")

    # The classes outside a bucket's largest component with one of that component, another one in every bucket.
    for turn in range(ROUNDS):
        several = stored(several_labels(), "several")
        inside = several.where("label = main").groupBy("key")
        leaders = inside.agg(F.max(F.struct(F.xxhash64(F.lit(turn), "key", "id").alias("h"), "id", "label")).alias("l"))
        pairs = several.where("label <> main").join(leaders, "key")
        pairs = stored(pairs.select(F.col("l.id").alias("a"), F.col("id").alias("b"), F.col("l.label").alias("label")).distinct(), "pairs")
        found = confirm(pairs.select("a", "b"))
        linked = linked.union(found)
        moved = found.join(pairs, ["a", "b"]).groupBy("b").agg(F.min("label").alias("label"))
        labels = labels.join(moved, F.col("node") == F.col("b"), "full").select(
            F.coalesce("node", "b").alias("node"), F.coalesce("label", "component").alias("component")
        )
        labels = stored(labels, "labels")

    # What is left: pairs in a bucket that are not yet known to be connected.
    mixed = stored(several_labels().join(known.select("id", "n", "bands", "odd"), "id"), "mixed")
    x, y = mixed.where("label <> main").alias("x"), mixed.alias("y")
    left = (
        x.join(
            y,
            (F.col("x.key") == F.col("y.key"))
            & (F.col("x.label") != F.col("y.label"))
            & ((F.col("y.label") == F.col("y.main")) | (F.col("x.id") < F.col("y.id")))
            & (F.least("x.n", "y.n") * whole >= F.greatest("x.n", "y.n") * part)
            & _few_odd_bits("x", "y", most)
            # A pair meets in several buckets; the first band in which it does speaks for it.
            & (F.array_position(F.zip_with("x.bands", "y.bands", lambda a, b: a == b), True) == F.col("x.band") + 1),
        )
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        .distinct()
    )
    found = confirm(left)
    links = linked.union(found)
    rows = signatures.select("id", "set_key", "n_shingles").join(
        classes.select("set_key", F.col("id").alias("class_id")), "set_key", "left"
    )
    # Classes in which one id occurs are one document's.
    uses = rows.select("id", "class_id").where("id is not null and class_id is not null").distinct()
    several = uses.groupBy("id").agg(F.min("class_id").alias("a"), F.count("*").alias("n")).where("n > 1")
    one = uses.join(several, "id").select("a", F.col("class_id").alias("b"))
    labels = components(linked.union(found).union(one))
    out = rows.join(labels, F.col("class_id") == F.col("node"), "left")
    component = F.coalesce("component", "class_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that near_duplicates keeps, with all their columns; a row without an id stays."""
    found = near_duplicates(docs, id_col, text_col, **options)
    drop = found.where("not kept").select(F.col(f"`{id_col}`").alias("drop_id")).distinct()
    rows, (own_id,) = unnamed(docs, id_col)
    return rows.join(drop, F.col(own_id) == F.col("drop_id"), "left_anti").toDF(*docs.columns)
