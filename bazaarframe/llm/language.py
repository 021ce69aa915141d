"""Language of a text by error-correcting output codes over hashed byte trigrams.

Every language has a codeword. For each bit of the code a binary classifier says, from the trigrams of the whole text, on
which side of the bit the language is: the log odds of the trigrams under the languages with a 1 against those with
a 0, learned from counts over all training rows. The bits' margins are decoded to the codeword of the least
logistic loss, each bit weighted by how well its two sides can be told apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarframe.llm.store import unnamed
from bazaarframe.llm.words import LOWER, SPACES, texts_and_offsets

FEATURES = 1 << 15
#: Weight of a trigram that no training row has.
SMOOTHING = 0.5
#: The model has a column of FEATURES counts per language, so their number is bounded; more raise an error.
MAX_LANGUAGES = 1024
#: Below this share of the decoded weight for the best codeword a text counts as ambiguous.
SURE = 0.6
UNKNOWN = "und"

_CLASS = LOWER.copy()
_CLASS[SPACES] = 0x20
_CLASS[0x30:0x3A] = 0x30
_LETTERS = np.zeros(256, bool)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = True


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The trigram that ends at each byte of texts (blanks before each text), as a number below FEATURES."""
    x = _CLASS[data].astype(np.uint32)
    begins = offsets[:-1][np.diff(offsets) > 0]
    before, before2 = np.empty_like(x), np.empty_like(x)
    before[1:], before2[2:] = x[:-1], x[:-2]
    before[begins] = before2[begins] = 0x20
    before2[np.minimum(begins + 1, len(x) - 1)] = 0x20
    mixed = (x * np.uint32(0x9E3779B1) + before * np.uint32(0x85EBCA77) + before2 * np.uint32(0xC2B2AE3D)).astype(np.uint32)
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(17)).astype(np.int64)


def _texts(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Neighbouring rows first..last with their bytes and offsets, about a megabyte at a time."""
    data, offsets = texts_and_offsets(column)
    first = 0
    while first < len(column):
        last = min(max(int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = batch.column(0).to_pylist()
        for first, last, data, offsets in _texts(batch.column(1)):
            found = features(data, offsets)
            for i in range(last - first):
                if offsets[i] < offsets[i + 1]:
                    own = counts.setdefault(languages[first + i], np.zeros(FEATURES, np.int64))
                    own += np.bincount(found[offsets[i] : offsets[i + 1]], minlength=FEATURES)
    for language, own in counts.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())],
            ["language", "feature", "n"],
        )


def codewords(n: int) -> np.ndarray:
    """A codeword of -1 and 1 per language: all splits of up to six languages, random balanced splits of more."""
    if n <= 6:
        splits = [[1] + [1 if s >> i & 1 else -1 for i in range(n - 1)] for s in range((1 << (n - 1)) - 1)]
        return np.array(splits, np.int8).reshape(-1, n).T
    rng = np.random.default_rng(3)
    half = np.where(np.arange(n) < n // 2, 1, -1)
    return np.array([rng.permutation(half) for _ in range(int(np.ceil(15 * np.log2(n))))], np.int8).T


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # trigrams x bits: log odds of the bit
    trust: np.ndarray  # weight of each bit in the loss

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest codeword and its share, for the margins of each text."""
        if not self.code.shape[1]:
            return np.zeros(len(margins), int), np.ones(len(margins))
        loss = np.stack([(np.logaddexp(0, -margins * word) * self.trust).sum(axis=1) for word in self.code], axis=1)
        share = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        return best, share[np.arange(len(best)), best]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from all rows with a text and a language; trigrams are counted where the rows are."""
    rows = docs.select(F.col(f"`{lang_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")).dropna()
    totals = rows.mapInArrow(_count, "language string, feature int, n long").groupBy("language", "feature").agg(F.sum("n").alias("n"))
    by_language = (
        totals.groupBy("language").agg(F.sort_array(F.collect_list(F.struct("feature", "n"))).alias("counts")).orderBy("language")
    )
    found = by_language.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = np.full((len(found), FEATURES), SMOOTHING)
    for own, row in zip(share, found):
        own[[c[0] for c in row["counts"]]] += [c[1] for c in row["counts"]]
    share /= share.sum(axis=1, keepdims=True)
    code = codewords(len(found)) if found else np.zeros((0, 0), np.int8)
    weights, trust = np.zeros((FEATURES, code.shape[1]), np.float32), np.ones(code.shape[1])
    for bit in range(code.shape[1]):
        yes, no = share[code[:, bit] > 0].mean(axis=0), share[code[:, bit] < 0].mean(axis=0)
        odds = np.log(yes) - np.log(no)
        weights[:, bit] = odds
        trust[bit] = ((yes - no) * odds).sum()
    trust /= trust.mean() if len(trust) and trust.mean() > 0 else 1
    return Model([row["language"] for row in found], code, weights, trust)


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            for first, last, data, offsets in _texts(batch.column(0)):
                n = last - first
                lengths = np.diff(offsets)
                full = np.flatnonzero(lengths)
                margins = np.zeros((n, m.weights.shape[1]))
                letters = np.zeros(n, bool)
                if len(full):
                    sums = np.add.reduceat(m.weights[features(data, offsets)], offsets[:-1][full], axis=0, dtype=np.float64)
                    margins[full] = sums / np.sqrt(lengths[full])[:, None]
                    letters[full] = np.logical_or.reduceat(_LETTERS[data], offsets[:-1][full])
                    for i in full[~letters[full]]:
                        own = data[offsets[i] : offsets[i + 1]].tobytes()
                        letters[i] = any(c.isalpha() for c in own.decode("utf-8", "replace"))
                best, share = m.decode(margins) if m.languages else (np.zeros(n, int), np.zeros(n))
                known = letters & bool(m.languages)
                names = [m.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                share = np.where(known, np.clip(share, 0, 1), 0.0)
                columns = [c.slice(first, n) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(names, pa.string()), pa.array(share), pa.array(known & (share < SURE))],
                    [*batch.schema.names[1:], "lang_pred", "score", "ambiguous"],
                )

    return run


def held_out(id_col: str, parts: int) -> Column:
    """Whether crc32 of the id as text leaves 1; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % parts == 1


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: the columns ``keep``, lang_pred, score (0 to 1), ambiguous.

    Columns of ``keep`` that are named like one of the three results are left out. Repeated rows get the same prediction. The whole text is read. lang_pred is ``und`` with score 0 if the text is null or has no letter, or if there was nothing
    to learn from. Nothing but the text is an input. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.code, model.weights, model.trust))
    kept = [c for c in keep if c.lower() not in ("lang_pred", "score", "ambiguous")]
    rows = docs.select(F.col(f"`{text_col}`").cast("string"), *[F.col(f"`{c}`") for c in kept])
    rows = rows.toDF("text", *[f"c{i}" for i in range(len(kept))])
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:]], "lang_pred string, score double, ambiguous boolean"])
    return rows.mapInArrow(_predict(shared), schema).toDF(*kept, "lang_pred", "score", "ambiguous")


def with_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in a language that the model knows, with all their columns, whatever their names.

    Rows whose text is null or has no letter go, and all if there was nothing to learn from.
    """
    rows, (text,) = unnamed(docs, text_col)
    return predict(rows, model, text, tuple(rows.columns)).where(F.col("lang_pred") != UNKNOWN).select(*rows.columns).toDF(*docs.columns)
