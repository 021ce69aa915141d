"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

The mix has as many words as the documents. Sources share them by weight, but none beyond a multiple of its own size;
what a source cannot take goes to the others by weight. The mix is cut into equal blocks; every shard of it is given its
blocks by highest quotients target / (2k + 1), so a source's quotas are integers and add up over the shards. A
source's documents form a stream in seeded order that is cut into blocks of the same size, and the blocks are put in seeded
order, pass after pass. Shard after shard takes its quota of blocks where the shard before it stopped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarframe.llm.store import stored, unnamed
from bazaarframe.llm.words import WORD

#: Blocks in the mix; a block has at least one word.
BLOCKS = 1_000_000
SHARDS = 16


def next_prime(n: int) -> int:
    while any(n % i == 0 for i in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, *keep: str) -> DataFrame:
    """Rows (id, source, src, size, place, keep): src never null, place a seeded number of the row."""
    text = F.col(f"`{text_col}`").cast("string")
    source = F.col(f"`{source_col}`").cast("string")
    return docs.select(
        F.col(f"`{id_col}`").alias("id"),
        source.alias("source"),
        F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("src"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), f"`{id_col}`", text).alias("place"),
        *keep,
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: float) -> tuple[DataFrame, int]:
    """Rows (src, source, source_size, target), one per source, and the words of all."""
    sums = sizes.groupBy("src").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    ordered = sums.repartitionByRange(F.asc_nulls_last("source")).sortWithinPartitions(F.asc_nulls_last("source"))
    ordered = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("at", 33)
    before = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = before.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )  # one row per partition of the sources
    ranked = ordered.join(before, part == F.col("part")).withColumn(
        "rank", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double")
    known = stored(
        ranked.select("src", "source", "source_size", "rows", weight.alias("w"), (F.col("source_size") * float(most)).alias("top")),
        "weights",
    )
    total, level = known.agg(F.sum("source_size"), F.sum("w")).first()
    total = int(total or 0)
    if not total:
        return known.select("src", "source", "source_size", "rows", F.lit(0.0).alias("target")), 0
    level = total / level
    while True:  # the level rises until no further source is full
        full = F.col("top") < F.col("w") * level
        taken, rest = known.agg(F.sum(F.when(full, F.col("top")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("w")))).first()
        higher = (total - taken) / rest if rest else level
        if higher <= level * (1 + 1e-15):
            break
        level = higher
    target = F.least("top", F.col("w") * level)
    return known.select("src", "source", "source_size", "rows", target.alias("target")), total


def apportion(targets: DataFrame, total: int, house: int, shards: int) -> DataFrame:
    """Rows (src, shard, quota): the blocks of each shard, by highest quotients target / (2k + 1).

    Seats of a house grow one by one, so a shard's quota is the seats of the house up to its end less those up to its
    start. The seats are found from rounded shares, mended by the few quotients next to them.
    """
    ends = F.explode(F.array(*[F.struct(F.lit(j).alias("shard"), F.lit(house * (j + 1) // shards).alias("seats")) for j in range(shards)]))
    share = F.col("target") / F.lit(float(max(total, 1)))
    first = targets.select("src", "target", share.alias("share"), ends.alias("e")).select("src", "target", "share", "e.*")
    first = first.withColumn("base", F.floor(F.col("share") * F.col("seats") + 0.5))
    gaps = first.groupBy("shard").agg(
        (F.first("seats") - F.sum("base")).alias("gap"), F.count("*").alias("sources")
    )  # a row per shard
    near = first.join(F.broadcast(gaps), "shard")
    reach = (F.ceil((F.abs("gap") + F.col("sources")) * F.col("share")) + 1).cast("long")
    up = near.where("gap > 0 and target > 0").select(
        "shard", "src", "target", "gap", F.explode(F.sequence(F.col("base"), F.col("base") + reach)).alias("k"), F.lit(1).alias("more")
    )
    down = near.where("gap < 0 and base > 0").select(
        "shard",
        "src",
        "target",
        "gap",
        F.explode(F.sequence(F.greatest(F.col("base") - reach, F.lit(0)), F.col("base") - 1)).alias("k"),
        F.lit(-1).alias("more"),
    )
    quotient = F.col("target") / (2 * F.col("k") + 1) * F.col("more")
    moved = (
        up.union(down)
        .withColumn("place", F.row_number().over(Window.partitionBy("shard").orderBy(F.desc(quotient), F.col("more") * F.col("k"), "src")))
        .where(F.col("place") <= F.abs("gap"))
        .groupBy("shard", "src")
        .agg(F.sum("more").alias("moved"))
    )
    seats = first.join(moved, ["shard", "src"], "left").select(
        "src", "shard", (F.col("base") + F.coalesce("moved", F.lit(0))).cast("long").alias("seats")
    )
    before = F.coalesce(F.lag("seats").over(Window.partitionBy("src").orderBy("shard")), F.lit(0))
    return seats.select("src", "shard", (F.col("seats") - before).alias("quota"))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the words of the source up to each row, in the sorted rows of a partition."""
    source, words = None, 0
    for batch in batches:
        src, size = batch.column("src"), batch.column("size").to_numpy()
        if not len(batch):
            continue
        starts = np.flatnonzero(np.append(True, pc.not_equal(src[1:], src[:-1]).to_numpy(zero_copy_only=False)))
        total = np.cumsum(size)
        before = total[starts] - size[starts]
        if src[0].as_py() == source:
            before[0] -= words
        so_far = total - np.repeat(before, np.diff(np.append(starts, len(src))))
        source, words = src[-1].as_py(), int(so_far[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(so_far, pa.int64())], [*batch.schema.names, "so_far"])


def _streams(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: float = 3.0,
    blocks: int = BLOCKS,
    shards: int = SHARDS,
    seed: int = 5,
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, int, int]:
    """The rows in their sources' streams, the words of a block, and the prime that orders the blocks.

    A row's words are start..stop of its source's stream. ends are the words of the source that the mix holds up to the end of
    each shard: whole blocks, but never beyond ``most`` times the source's words.
    """
    # Rows that repeat one another differ by a number, so that many of them need not meet in one task.
    numbered = word_counts(docs, id_col, text_col, source_col, seed, *keep).withColumn("tie", F.monotonically_increasing_id())
    sizes = stored(numbered, "sizes")
    targets, total = source_targets(sizes, weights, most)
    targets = stored(targets, "targets")
    block = max(1, total // blocks)
    house = total // block
    prime = next_prime(max(blocks, house) + 2 + 2 * seed)

    so_far = F.sum("quota").over(Window.partitionBy("src").orderBy("shard"))
    dealt = apportion(targets, total, house, shards).select("src", "shard", "quota", so_far.alias("so_far"))
    dealt = dealt.groupBy("src").agg(
        F.sum("quota").alias("quota"), F.sort_array(F.collect_list(F.struct("shard", "so_far")))["so_far"].alias("so_far")
    )
    plan = targets.join(dealt, "src").selectExpr(
        "src",
        "source_size",
        "target",
        "quota",
        f"greatest(1L, ceil(source_size / {block}L)) as blocks",
        f"transform(so_far, q -> least(q * {block}L, cast(floor(source_size * {float(most)!r}D) as long))) as ends",
    ).withColumn("shift", F.expr(f"pmod(xxhash64({seed}, src), blocks)"))

    order = ["src", "place", "id", "size", "tie"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sizes.schema)
    dealt = sizes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    stream = stored(dealt.mapInArrow(_running, f"{fields}, part int, so_far long"), "stream")
    # A row per partition and source.
    sums = stream.groupBy("src", "part").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("src").orderBy("part")) - F.col("words")
    sums = stored(sums.select("src", "part", before.alias("before")).join(plan, "src"), "sums")
    spread = stream.join(sums, ["src", "part"]).withColumn("stop", F.col("before") + F.col("so_far"))
    return spread.withColumn("start", F.col("stop") - F.col("size")), block, prime


def _deal(block: int, prime: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            own = {c: batch.column(c).to_numpy() for c in ("size", "source_size", "start", "blocks", "shift")}
            ends = batch.column("ends").flatten().to_numpy().reshape(n, -1)
            first = own["start"] // block
            touched = np.where(own["size"] > 0, (own["start"] + own["size"] - 1) // block - first + 1, 0)
            row = np.repeat(np.arange(n), touched)
            i = np.arange(len(row)) - np.repeat(np.cumsum(touched) - touched, touched) + first[row]
            size, start, whole, blocks, shift = (own[c][row] for c in ("size", "start", "source_size", "blocks", "shift"))
            low, high = np.maximum(start, i * block), np.minimum(start + size, (i + 1) * block)
            # Where the words of block i stand in a pass: the last block of the stream may be short.
            at, short_at = (i * prime + shift) % blocks, ((blocks - 1) * prime + shift) % blocks
            place = at * block + low - i * block - np.where(at > short_at, blocks * block - whole, 0)
            shares = np.zeros((n, ends.shape[1]), np.int64)
            for one in range(int(np.max(-(-ends[:, -1] // np.maximum(own["source_size"], 1)), initial=0))):
                a = place + one * whole
                b, before = a + high - low, np.zeros(len(row), np.int64)
                for j in range(ends.shape[1]):
                    end = ends[row, j]
                    got = np.maximum(np.minimum(b, end) - np.maximum(a, before), 0)
                    shares[:, j] += np.bincount(row, got, n).astype(np.int64)
                    before = end
            offsets = np.arange(n + 1, dtype=np.int32) * ends.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "size", "source_size", "target")),
                    pa.array(shares.sum(axis=1)),
                    batch.column("quota"),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(shares.ravel())),
                ],
                ["id", "size", "source_size", "target", "taken", "quota", "by_shard"],
            )

    return run


def mix(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per input row: ``<id_col>``, size, source_size, target, taken, quota, by_shard. Options: those of _streams.

    A document's size is its number of words (null: 0). Sources in code point order, null last and a source of its own,
    have the weights in turn; targets (words, of the source) stop at ``most`` times the source's size. quota is
    the source's number of blocks over all shards, by_shard the words of the document that each shard holds, repeats
    counted, taken their sum: at most ``ceil(most)`` times its size. A source's words taken are those of its quota, or
    ``most`` times its own if that is less. Equal seeds give equal results. Documents without words are taken 0
    times; if no document has words, all numbers are 0. An empty table gives an empty result; other columns are ignored.
    """
    spread, block, prime = _streams(docs, id_col, **options)
    rows = spread.select("id", "size", "source_size", "target", "quota", "start", "blocks", "shift", "ends")
    kind = rows.schema["id"].dataType.simpleString()
    dealt = rows.mapInArrow(
        _deal(block, prime),
        f"id {kind}, size long, source_size long, target double, taken long, quota long, by_shard array<long>",
    )
    return dealt.withColumnRenamed("id", id_col)


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The documents of the mix with all their columns, whole, as many copies of each as fill their source's quota.

    A source's words are filled by full passes over its documents and then by documents in the seeded order of its
    stream; the one in which the words end is taken if more than half of it is, or just half. So a source misses the words
    that mix takes of it by at most half a document. Rows are told apart even if they repeat an id or have none. Documents
    without words are not taken; an empty table gives an empty result. Other columns may have any names. Options: those of _streams.
    """
    rows, (own_id, text, source) = unnamed(docs, id_col, text_col, source_col)
    numbered = stored(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    spread, _, _ = _streams(numbered, own_id, text, source, keep=("row",), **options)
    words = F.element_at("ends", -1)
    found = spread.where("size > 0").select(
        "row", "size", "start", F.expr("element_at(ends, -1) div source_size").alias("passes"), (words % F.col("source_size")).alias("rest")
    )
    once_more = (2 * F.col("start") + F.col("size") <= 2 * F.col("rest")).cast("int")
    found = found.select("row", (F.col("passes").cast("int") + once_more).alias("copies")).where("copies > 0")
    again = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return numbered.join(found, "row").select(*rows.columns, again.alias("copy")).drop("copy").toDF(*docs.columns)
