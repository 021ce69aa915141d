"""Benchmark passages in documents: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

The CGK embedding walks over a sequence and writes down the symbol it stands on at every step; whether it then moves on is a
random bit that depends on step and symbol. Sequences a few edits apart soon walk in step again, so their embeddings differ
in few places. Items and windows of documents are sequences of words. Each of many walks samples some places of
the embedding within the first steps that an item of that length takes; a window that has an item's words in all
places sampled by one walk is a candidate, and a candidate counts if its edit distance to the item is within the bound.

Windows are taken where they can matter: an item within the bound has a run of so many words unedited (sure_run), so only
starts that such a run of some item allows are embedded. This leaves out no pair within the bound. Short items are found
by the hash of all their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarframe.llm.store import unnamed
from bazaarframe.llm.words import mix, pieces

#: Edits (words inserted, deleted or replaced) allowed for each word of the item.
EDITS = 0.1
#: Shorter items say too little to tell an edited copy from chance; they count if all their words stand in a row.
MIN_WORDS = 8
#: Words of the runs that windows are taken from, at most.
RUN = 4
WALKS = 48
SAMPLED = 3
#: Bytes of benchmark text that one broadcast holds; a larger benchmark is searched in several blocks.
BLOCK_BYTES = 8 << 20
_GATE_BITS = 20


def allowed(n: int, edits: float) -> int:
    return int(n * edits)


def sure_run(lengths: list[int], edits: float) -> int:
    """Words in a row that every item of these lengths keeps within the bound, RUN at most: n - e words in e + 1 runs."""
    kept = [-(-(n - allowed(n, edits)) // (allowed(n, edits) + 1)) for n in lengths]
    return min([RUN, *kept])


def walks(symbols: np.ndarray, starts: np.ndarray, stops: np.ndarray, seeds: np.ndarray, steps: int) -> np.ndarray:
    """Embedding of symbols[start:stop] by each seed: starts x seeds x steps; past the end it writes zeros."""
    at = np.repeat(starts[:, None], len(seeds), axis=1)
    out = np.zeros((len(starts), len(seeds), steps), np.uint64)
    padded = np.append(symbols, np.uint64(0))
    for step in range(steps):
        here = np.where(at < stops[:, None], padded[np.minimum(at, len(symbols))], np.uint64(0))
        out[:, :, step] = here
        at += (mix(here + seeds + np.uint64(step * 0x9E3779B97F4A7C15 & (2**64 - 1))) >> np.uint64(63)).astype(np.int64)
    return out


class Benchmark:
    """A block of items, ready to be searched for."""

    def __init__(self, items: list[tuple], edits: float, n_walks: int):
        rng = np.random.default_rng(8)
        self.edits = edits
        self.seeds = rng.integers(0, 1 << 63, n_walks, np.uint64) * np.uint64(2) + np.uint64(1)
        texts = pa.array([text for _, text in items], pa.string()).cast(pa.binary())
        self.ids, self.words = [], []
        short: dict[int, list[tuple]] = {}
        for piece in pieces(texts, lower=True):
            for i in range(piece.last - piece.first):
                own = piece.hashes[piece.bounds[i] : piece.bounds[i + 1]]
                if len(own) >= MIN_WORDS:
                    self.ids.append(items[piece.first + i][0])
                    self.words.append(own.copy())
                elif len(own):
                    short.setdefault(len(own), []).append((int(_runs(own, len(own))[0]), items[piece.first + i][0]))
        # Hashes of the short items of each length in order, and their places in ids, after the longer ones.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n, own in short.items():
            hashes = np.array([h for h, _ in own], np.uint64)
            order = np.argsort(hashes, kind="stable")
            self.short[n] = hashes[order], order + len(self.ids)
            self.ids += [item for _, item in own]
        self.lengths = sorted({len(w) for w in self.words})
        # For every run and length of an item that holds it: the least and greatest place at which it stands there.
        self.run = sure_run(self.lengths, edits)
        runs: dict[tuple[int, int], list[int]] = {}
        for own in self.words:
            for at, run in enumerate(_runs(own, self.run)):
                low_high = runs.setdefault((int(run), len(own)), [at, at])
                low_high[0], low_high[1] = min(low_high[0], at), max(low_high[1], at)
        entries = sorted(runs)
        self.runs = np.array([r for r, _ in entries], np.uint64)
        self.sizes = np.array([n for _, n in entries], np.int64)
        slack = np.array([allowed(n, edits) for _, n in entries], np.int64)
        self.low = np.array([runs[e][0] for e in entries], np.int64) - slack
        self.high = np.array([runs[e][1] for e in entries], np.int64) + slack
        self.gate = np.zeros(1 << _GATE_BITS, bool)
        self.gate[(self.runs >> np.uint64(64 - _GATE_BITS)).astype(np.int64)] = True
        # A walk needs about two steps a word; places are sampled where it is still inside the item.
        self.places = {
            n: np.stack([np.sort(rng.choice(max(SAMPLED, int(1.8 * n)), SAMPLED, replace=False)) for _ in self.seeds])
            for n in self.lengths
        }
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in self.lengths:
            members = [i for i, w in enumerate(self.words) if len(w) == n]
            symbols = np.concatenate([self.words[i] for i in members])
            starts = np.arange(len(members)) * n
            keys = self.keys(walks(symbols, starts, starts + n, self.seeds, int(1.8 * n) + SAMPLED), n)
            flat, order = keys.ravel(), np.argsort(keys.ravel(), kind="stable")
            self.tables[n] = flat[order], np.repeat(members, len(self.seeds))[order]

    def keys(self, embedded: np.ndarray, n: int) -> np.ndarray:
        """Hash of the sampled places of each walk, for items of n words."""
        picked = np.take_along_axis(embedded, self.places[n][None, :, :], axis=2)
        key = mix(self.seeds[None, :] + np.uint64(n))
        for i in range(SAMPLED):
            key = mix(key ^ picked[:, :, i])
        return key

    def windows(self, piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item-sized windows that may hold an item: where each begins, its words, and the end of its text."""
        if not len(self.runs):
            return (np.zeros(0, np.int64),) * 3
        runs = _runs(piece.hashes, self.run)
        at = np.flatnonzero(self.gate[(runs >> np.uint64(64 - _GATE_BITS)).astype(np.int64)])
        first, last = np.searchsorted(self.runs, runs[at], "left"), np.searchsorted(self.runs, runs[at], "right")
        entry, at = _spread(first, last - first), np.repeat(at, last - first)
        if not len(at):
            return (np.zeros(0, np.int64),) * 3
        text = np.searchsorted(piece.bounds, at, "right") - 1
        begins = piece.bounds[text]
        low = np.maximum(at - self.high[entry], begins)
        high = np.maximum(np.minimum(at - self.low[entry], at), begins)
        starts = _spread(low, high - low + 1)
        entry = np.repeat(entry, high - low + 1)
        stops = np.repeat(piece.bounds[text + 1], high - low + 1)
        _, one = np.unique(starts * (self.lengths[-1] + 1) + self.sizes[entry], return_index=True)
        return starts[one], self.sizes[entry[one]], stops[one]

    def short_items(self, piece) -> list[tuple[int, int]]:
        """(text, item) of the short items that stand in a text, all words in a row."""
        found = []
        for n, (known, items) in self.short.items():
            runs = _runs(piece.hashes, n)
            first, last = np.searchsorted(known, runs, "left"), np.searchsorted(known, runs, "right")
            at = np.flatnonzero(last > first)
            text = np.searchsorted(piece.bounds, at, "right") - 1
            inside = at + n <= piece.bounds[text + 1]
            at, text = at[inside], text[inside]
            # Each text and hash once, then the items with that hash.
            once = np.unique(np.stack([text, first[at], last[at]], axis=1), axis=0)
            found += [(int(t), int(item)) for t, a, b in once for item in items[a:b]]
        return found

    def candidates(self, piece, starts: np.ndarray, sizes: np.ndarray, stops: np.ndarray) -> set[tuple[int, int]]:
        """(start, item) of the windows that share the sampled places of some walk with an item of their size."""
        found: set[tuple[int, int]] = set()
        for n in np.unique(sizes).tolist():
            known, items = self.tables[n]
            own, ends = starts[sizes == n], stops[sizes == n]
            for i in range(0, len(own), 256):
                part = own[i : i + 256]
                keys = self.keys(walks(piece.hashes, part, ends[i : i + 256], self.seeds, int(1.8 * n) + SAMPLED), n).ravel()
                low, high = np.searchsorted(known, keys, "left"), np.searchsorted(known, keys, "right")
                for k in np.flatnonzero(high > low):
                    found.update((int(part[k // len(self.seeds)]), int(item)) for item in items[low[k] : high[k]])
        return found


def _spread(first: np.ndarray, several: np.ndarray) -> np.ndarray:
    """first, first + 1, ... as many as several says, for each."""
    return np.repeat(first - (np.cumsum(several) - several), several) + np.arange(several.sum())


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the size words from each word on."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    runs = words[: len(words) - size + 1].copy()
    for i in range(1, size):
        runs = mix(runs * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - size + 1 + i])
    return runs


def passage_distance(item: np.ndarray, text: np.ndarray) -> int:
    """Least word edit distance of the item to any run of words of the text."""
    places = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item, 1):
        step = np.empty_like(row)
        step[0] = i
        step[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(step - places) + places
    return int(row.min())


def _search(shared, edits: float, n_walks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Benchmark(shared.value, edits, n_walks)
        for batch in batches:
            rows, items, distances = [], [], []
            for piece in pieces(batch.column(2), lower=True):
                best: dict[tuple[int, int], int] = {found: 0 for found in known.short_items(piece)}
                windows = known.windows(piece)
                for start, item in sorted(known.candidates(piece, *windows)):
                    text = int(np.searchsorted(piece.bounds, start, "right")) - 1
                    if best.get((text, item)) == 0:
                        continue
                    own = known.words[item]
                    most = allowed(len(own), edits)
                    low = max(int(piece.bounds[text]), start - most)
                    region = piece.hashes[low : min(int(piece.bounds[text + 1]), start + len(own) + 2 * most)]
                    distance = passage_distance(own, region)
                    if distance <= most:
                        best[text, item] = min(distance, best.get((text, item), distance))
                for (text, item), distance in best.items():
                    rows.append(piece.first + text)
                    items.append(known.ids[item])
                    distances.append(distance)
            if rows:
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(items), pa.array(distances, pa.int32())],
                    ["id", "text_key", "item_id", "edits"],
                )

    return run


def _hits(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_id_col: str, item_text_col: str, edits: float, n_walks: int):
    """Ids and text keys of all rows, and the items found by id and text key."""
    if not 0 <= edits < 1:
        raise ValueError(f"edits must be at least 0 and below 1, not {edits}")
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    items = benchmark.select(F.col(f"`{item_id_col}`").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text")).dropna()
    item_kind = items.schema["item_id"].dataType.simpleString()
    size = items.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    hits = spark.createDataFrame([], f"id {kind}, text_key long, item_id {item_kind}, edits int")
    for block in range(blocks):  # each of a bounded size, against all rows
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        shared = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in own])
        hits = hits.union(rows.mapInArrow(_search(shared, edits, n_walks), hits.schema))
    by_text = hits.groupBy("id", "text_key").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.min("edits").alias("least_edits")
    )
    return rows.select("id", "text_key"), by_text.select(F.col("id").alias("h_id"), F.col("text_key").alias("h_key"), "item_ids", "least_edits")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    edits: float = EDITS,
    n_walks: int = WALKS,
) -> DataFrame:
    """One row per input row: ``<id_col>``, contaminated, n_items, item_ids (ascending), least_edits (null if clean).

    A document is contaminated by an item if some run of its words is within ``edits`` word edits for each word of the
    item, A-Z in lower case, or, for an item of fewer than MIN_WORDS words, if all its words stand in it in a row. Whole texts
    and all items are searched but blank and null items, and items without an id. ``edits`` is below 1. A null or empty text is clean. Rows with one id and different texts are
    told apart; repeated rows get the same answer. With an empty benchmark all rows are clean; an empty table gives
    an empty result; other columns are ignored.
    """
    rows, h = _hits(docs, benchmark, id_col, text_col, item_id_col, item_text_col, edits, n_walks)
    item_kind = h.schema["item_ids"].dataType.elementType.simpleString()
    out = rows.join(h, rows["id"].eqNullSafe(F.col("h_id")) & (rows["text_key"] == F.col("h_key")), "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast(f"array<{item_kind}>")).alias("item_ids"),
        "least_edits",
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", spare_without_id: bool = True, **options
) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, with all their columns, whatever their names.

    Each row is judged by its own text: of rows with one id only those that hold a passage go. Rows without an id stay unless
    ``spare_without_id`` is false; then they are judged as well. Repeated rows go or stay together; null and empty texts stay. With
    an empty benchmark all stay; an empty table gives an empty result. Options: those of contaminated.
    """
    given = {"item_id_col": "item_id", "item_text_col": "text", "edits": EDITS, "n_walks": WALKS} | options
    _, h = _hits(docs, benchmark, id_col, text_col, **given)
    rows, (own_id, own_text) = unnamed(docs, id_col, text_col)
    key = F.xxhash64(F.coalesce(F.col(own_text).cast("string"), F.lit("")))
    h = h.where("h_id is not null") if spare_without_id else h
    return rows.join(h, F.col(own_id).eqNullSafe(F.col("h_id")) & (key == F.col("h_key")), "left_anti").toDF(*docs.columns)
