"""Near-duplicate lines by a deletion-neighbourhood join, with DataFrame functions only.

Two lines within one edit become equal when one character is deleted from the longer, or from both at the same place.
All such variants are emitted as hashed keys and equal ones grouped. Emitting them for every line would be as many rows as
characters, so lines are first cut into segments: one edit leaves all segments but one as they are, hence the hash of
all but segment j is a key that both lines share. Only lines with such a key in common with another line emit variants,
each for the characters of one segment. A variant's group needs no pairs: the earliest line of the group is enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarframe.llm.store import stored, unnamed

#: Shorter lines go only if an earlier line is equal; one character would change what they say.
MIN_CHARS = 16
#: Length of a segment of long lines; a line has at least two.
SEGMENT = 256
_TRIM = " \t\r\x0b\x0c"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every line that is not blank: (id, text_key, line_no from 0, l1, l2, line), blanks at its ends cut off."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_key"), F.posexplode(F.split(text, "\n")).alias("line_no", "line")
    )
    rows = rows.withColumn("line", F.btrim("line", F.lit(_TRIM))).where("line <> ''")
    # Two hashes with different seeds name a line.
    return rows.withColumns({"l1": F.xxhash64("line"), "l2": F.xxhash64(F.lit(7), "line")})


def _segments(lines: DataFrame, *keep: str) -> DataFrame:
    """A row for each length the shorter line of a pair may have, and each segment left out: its key and its characters."""
    # In UTF-32 every character has four bytes, so parts are found without reading what stands before them.
    cut = lines.where(F.char_length("line") >= MIN_CHARS).select(*keep, F.encode("line", "UTF-32").alias("line"))
    n = F.expr("cast(octet_length(line) div 4 as int)")
    cut = cut.select(*keep, "line", n.alias("n"), F.explode(F.array(n, n - 1)).alias("n0"))
    cut = cut.withColumn("m", F.greatest(F.lit(2), F.ceil(F.col("n0") / SEGMENT)).cast("int"))
    cut = cut.withColumn("size", F.floor(F.col("n0") / F.col("m")).cast("int"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j"))
    before, after = F.col("j") * F.col("size"), (F.col("m") - 1 - F.col("j")) * F.col("size")

    def part(first, chars):
        return F.substring("line", first * 4 + 1, chars * 4)

    key = F.xxhash64("j", "m", "size", part(F.lit(0), before), part(F.col("n") - after, after))
    return cut.select(*keep, "n", "n0", key.alias("key"), part(before, F.col("n") - before - after).alias("middle"))


def _variants(lines: DataFrame) -> DataFrame:
    """Rows (l1, l2, place, role, v): v is equal for lines that agree but for one character.

    role 0: the character at the same place of both is deleted; 1: the shorter line itself; 2: the longer without one.
    """
    rows = _segments(lines, "l1", "l2", "place")
    each = F.expr("explode(sequence(1, cast(octet_length(middle) div 4 as int)))").alias("i")
    before, after = F.expr("substring(middle, 1, 4 * i - 4)"), F.expr("substring(middle, 4 * i + 1)")
    same = F.xxhash64(F.lit(0), "n0", "key", "i", before, after)
    one = F.xxhash64(F.lit(1), "n0", "key", "middle")
    less = F.xxhash64(F.lit(1), "n0", "key", F.concat(before, after))
    equal = rows.where("n = n0")
    return (
        equal.select("*", each).select("l1", "l2", "place", F.lit(0).alias("role"), same.alias("v"))
        .union(equal.select("l1", "l2", "place", F.lit(1), one))
        .union(rows.where("n = n0 + 1").select("*", each).select("l1", "l2", "place", F.lit(2), less))
    )


def _rows_in_question(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The lines that occur again or share a key with another line: (id, text_key, line_no, l1, l2, place, line).

    The text of a line is there only if it shares a key. Keys and hashes are grouped first, without texts.
    """
    lines = _lines(docs, id_col, text_col)
    keys = _segments(lines, "l1", "l2").select("key", "l1", "l2")
    shared = keys.groupBy("key").agg(F.min("l1").alias("low"), F.max("l1").alias("high")).where("low <> high").select("key")
    shared = stored(shared, "shared")
    close = keys.join(shared, "key", "left_semi").select("l1", "l2").distinct().withColumn("close", F.lit(True))
    again = lines.groupBy("l1", "l2").agg(F.count("*").alias("n")).where("n > 1").select("l1", "l2")
    wanted = stored(again.join(close, ["l1", "l2"], "full"), "wanted")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "line_no", "text_key")
    rows = lines.join(wanted, ["l1", "l2"]).withColumn("line", F.when(F.col("close"), F.col("line")))
    return stored(rows.select("id", "text_key", "line_no", "l1", "l2", place.alias("place"), "line"), "rows")


def _gone(rows: DataFrame) -> DataFrame:
    """Of the lines in question (l1, l2, first: place of the first, near: whether that goes too, for an earlier line)."""
    known = stored(
        rows.groupBy("l1", "l2").agg(F.min("place").alias("place"), F.first("line").alias("line")), "distinct_lines"
    )
    texts = known.where("line is not null")
    group = Window.partitionBy("v")
    others = [F.min(F.when(F.col("role") == r, F.col("place"))).over(group) for r in (0, 2, 1)]
    earliest = F.when(F.col("role") == 0, others[0]).when(F.col("role") == 1, others[1]).otherwise(others[2])
    candidates = (
        _variants(texts).withColumn("keep", earliest).where("keep < place").groupBy("l1", "l2").agg(F.min("keep").alias("keep"))
    )
    checked = (
        candidates.join(texts.select("l1", "l2", "line"), ["l1", "l2"])
        .join(texts.select(F.col("place").alias("keep"), F.col("line").alias("kept_line")), "keep")
        .where(F.levenshtein("line", "kept_line", 1) >= 0)
        .select("l1", "l2", F.lit(True).alias("near"))
        .distinct()
    )
    return known.select("l1", "l2", F.col("place").alias("first")).join(checked, ["l1", "l2"], "left")


def _removed(lines: DataFrame) -> DataFrame:
    """Rows (id, text_key, removed): the numbers of the lines that go."""
    gone = stored(_gone(lines), "gone")
    return (
        lines.join(gone, ["l1", "l2"])
        .where(F.col("near") | (F.col("place") != F.col("first")))
        .groupBy("id", "text_key")
        .agg(F.sort_array(F.collect_set("line_no")).alias("removed"))
    )


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``<id_col>``, n_lines, n_removed, removed_lines (numbers from 0, ascending, joined by commas).

    Lines are divided by line feeds and compared without blanks at their ends; blank lines count but never go. A line goes
    if an equal line stands earlier, or if a line within one edit (one character inserted, deleted or replaced) has its
    first place earlier and both have at least MIN_CHARS characters; earlier is by id, then by line number, rows
    without an id last. A null text has one blank line. Rows that repeat both id and text stand at the same place: what
    is first in one is first in the other. An empty table gives an empty result; other columns are ignored.
    """
    removed = _removed(_rows_in_question(docs, id_col, text_col))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_key"), F.size(F.split(text, "\n")).cast("long").alias("n_lines")
    )
    r = removed.select(F.col("id").alias("r_id"), F.col("text_key").alias("r_key"), "removed")
    out = rows.join(r, rows["id"].eqNullSafe(F.col("r_id")) & (rows["text_key"] == F.col("r_key")), "left")
    return out.select(
        F.col("id").alias(id_col),
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed_lines"),
    )


def without_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the lines that duplicate_lines names taken out of the text; null stays null.

    Rows with one id and different texts lose their own lines each. Other columns may have any names; an empty table gives
    an empty result.
    """
    removed = _removed(_rows_in_question(docs, id_col, text_col))
    found = removed.select(F.col("id").alias("r_id"), F.col("text_key").alias("r_key"), F.col("removed").cast("array<int>").alias("gone"))
    rows, (own_id, own_text) = unnamed(docs, id_col, text_col)
    text = F.coalesce(F.col(own_text).cast("string"), F.lit(""))
    joined = rows.join(found, F.col(own_id).eqNullSafe(F.col("r_id")) & (F.xxhash64(text) == F.col("r_key")), "left")
    rest = F.expr(f"array_join(filter(split({own_text}, '\\n'), (x, i) -> not array_contains(gone, i)), '\\n')")
    kept = F.when(F.col("gone").isNull(), F.col(own_text)).otherwise(rest).alias(own_text)
    return joined.select(*[kept if c == own_text else c for c in rows.columns]).toDF(*docs.columns)
