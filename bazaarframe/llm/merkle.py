"""Merkle manifest of a table: one hash tree per group, a tree over the groups, and a proof for every row.

Rows are ranked inside their group by a range-partitioned sort. The rank's digits in base eight say where a leaf stands:
its block, and the way down to it. Inside a block, digit after digit is grouped away, so that every node becomes a struct with its
hash and the list of its child structs; all these groupings share the one exchange by block. The roots of the blocks are
the leaves of the next round, until a group has one block. Coming down again, each block meets the proof of its own root in one
grouping, and a chain of explodes hands it to the leaves, each level adding its siblings.

A block holds at most 8**LEVELS leaves, whatever the group's size, so no task and no row grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarframe.llm.store import stored

#: Children of a node.
FAN = 8
#: Digits that are grouped away inside one block.
LEVELS = 3
_PROOF = "array<struct<left: string, right: string>>"


def sealed(*parts: str | Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """A value with its length in UTF-8 bytes before it, or a dash for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf leads to by a proof."""
    return F.aggregate(proof, leaf, lambda node, step: sealed(step["left"], node, step["right"]))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of a proof's digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their place (from 0) inside ``g`` by ``keys``, equal rows in any order, as column ``rank``.

    The sort is range-partitioned by a number of each row besides, so neither a large group nor many equal rows meet in
    one task. What rows know about earlier partitions is one number per partition and group.
    """
    order = ["g", *keys, "tie"]
    rows = stored(rows.withColumn("tie", F.monotonically_increasing_id()), "nodes")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number's upper bits are the partition, the lower 33 the place in it.
    dealt = stored(dealt.drop("tie").withColumn("at", F.monotonically_increasing_id()), "ordered")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    spans = dealt.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    spans = stored(spans.select(F.col("g").alias("s_g"), F.col("part").alias("s_part"), (before - F.col("first")).alias("shift")), "spans")
    both = dealt.join(spans, dealt["g"].eqNullSafe(spans["s_g"]) & (dealt["part"] == spans["s_part"]))
    return both.withColumn("rank", F.col("at") + F.col("shift")).drop("at", "part", "shift", "s_g", "s_part")


def _blocks(nodes: DataFrame, carry: list[str]) -> DataFrame:
    """Trees of neighbouring nodes: g, block, h (the tree's root), kids (nested structs down to the nodes)."""
    rank, digits = F.col("rank"), [f"d{i}" for i in range(LEVELS)]
    tree = nodes.select(
        "g",
        F.floor(rank / FAN**LEVELS).alias("block"),
        *[(F.shiftright(rank, 3 * i) % FAN).alias(d) for i, d in enumerate(digits)],
        "h",
        *carry,
    ).repartition("g", "block")
    for i, digit in enumerate(digits):
        above = ["block", *digits[i + 1 :]]
        kid = F.struct(digit, "h", *(["kids"] if i else carry))
        tree = tree.groupBy("g", *above).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
        # A node that is alone on its whole level is the root already.
        alone = F.size("kids") == 1
        for place in above:
            alone &= F.col(place) == 0
        tree = tree.withColumn("h", F.when(alone, F.col("kids.h")[0]).otherwise(sealed(F.array_join("kids.h", ""))))
    return tree


def _rounds(nodes: DataFrame, carry: list[str]) -> list[DataFrame]:
    """Blocks of the nodes, blocks of those blocks' roots and so on, up to one block per group."""
    rounds = [stored(_blocks(nodes, carry), "blocks")]
    while rounds[-1].agg(F.max("block")).first()[0]:
        roots = rounds[-1].select("g", F.col("block").alias("rank"), "h")
        rounds.append(stored(_blocks(roots, []), "blocks"))
    return rounds


def _opened(blocks: DataFrame, above: DataFrame, carry: list[str]) -> DataFrame:
    """Nodes of the blocks with their proofs: g, rank, h, ``carry``, proof, top.

    ``above`` has the proof and the group's root (top) of every block by (g, rank). Block and proof meet in one grouping.
    """
    kids = blocks.schema["kids"].dataType
    both = blocks.select("g", F.col("block").alias("rank"), "kids", F.lit(None).cast(_PROOF).alias("proof"), F.lit(None).cast("string").alias("top"))
    both = both.union(above.select("g", "rank", F.lit(None).cast(kids).alias("kids"), "proof", "top"))
    rows = both.groupBy("g", "rank").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("kids", "proof", "top")])
    for i in reversed(range(LEVELS)):
        rows = rows.select("*", F.posexplode("kids").alias("at", "kid"))
        siblings, at = F.col("kids.h"), F.col("at")
        step = F.struct(
            F.array_join(F.slice(siblings, F.lit(1), at), "").alias("left"),
            F.array_join(F.slice(siblings, at + 2, F.lit(FAN)), "").alias("right"),
        )
        alone = (F.size("kids") == 1) & (F.col("rank") == 0)
        rows = rows.select(
            "g",
            (F.col("rank") * FAN + at).alias("rank"),
            F.col("kid.h").alias("h"),
            *[F.col(f"kid.{c}").alias(c) for c in (["kids"] if i else carry)],
            F.when(alone, F.col("proof")).otherwise(F.concat(F.array(step), "proof")).alias("proof"),
            "top",
        )
    return rows


def _descend(rounds: list[DataFrame], tops: DataFrame, carry: list[str]) -> DataFrame:
    """From the proofs of the groups' roots (g, rank 0, proof, top) down to those of the nodes."""
    above = tops
    for k in reversed(range(1, len(rounds))):
        above = stored(_opened(rounds[k], above, []).select("g", "rank", "proof", "top"), "proofs")
    return _opened(rounds[0], above, carry)


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    altered: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    group_col: str = "lang",
) -> DataFrame:
    """One row per input row: ``<id_col>``, leaf, subroot, root, proof, altered_leaf.

    A row's leaf is the SHA-256 of its ``fields``, each with its length before it (a dash for null, so null and empty text differ).
    Per group, leaves ascend by id, null ids first; runs of eight become a node, the digest of their digests, until one
    is left: the subroot (a lone leaf itself). Subroots ascend by group, null first, and lead to the root in the same way.
    ``proof`` lists, level by level up to the root, the hex digests left and right of the row's node, each joined
    to one text; ``folded(leaf, proof)`` is the root again. ``altered`` replaces fields in a second leaf, altered_leaf, null where it
    equals the leaf or nothing is altered: what a changed row would be held against.

    Rows with one id stand by leaf; repeated rows take neighbouring places. Texts of any length enter only their own leaf's digest.
    An empty table gives an empty result; other columns are ignored, whatever their names.
    """

    def digest(values: dict[str, Column]) -> Column:
        return sealed(*[framed(values.get(f, F.col(f"`{f}`"))) for f in fields])

    other = digest(altered) if altered else F.lit(None).cast("string")
    leaves = docs.select(F.col(f"`{group_col}`").alias("g"), F.col(f"`{id_col}`").alias("id"), digest({}).alias("h"), other.alias("other"))
    leaves = leaves.withColumn("other", F.when(F.col("other") != F.col("h"), F.col("other")))
    carry = ["id", "other"]
    trees = _rounds(_ranked(leaves, ["id", "h"]), carry)

    groups = trees[-1].select(F.lit(0).alias("g"), F.col("g").alias("name"), "h")
    top = _rounds(_ranked(groups, ["name"]), ["name"])
    first = top[-1].select("h").first()
    root = F.lit(first["h"] if first else None).cast("string")
    none = F.array().cast(_PROOF)
    names = _descend(top, top[-1].select("g", F.col("block").alias("rank"), none.alias("proof"), F.lit("").alias("top")), ["name"])
    tops = stored(names.select(F.col("name").alias("g"), F.lit(0).cast("long").alias("rank"), "proof", F.col("h").alias("top")), "proofs")

    rows = _descend(trees, tops, carry)
    return rows.select(
        F.col("id").alias(id_col),
        F.col("h").alias("leaf"),
        F.col("top").alias("subroot"),
        root.alias("root"),
        "proof",
        F.col("other").alias("altered_leaf"),
    )
