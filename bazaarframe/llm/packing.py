"""Token ids packed into rows of one length: best fit decreasing, found by a segment tree over free room.

Documents are encoded where they are; a document longer than a row is split into parts that together hold all its tokens.
Parts are packed in windows of a few million tokens, longest first, each into the row with the least room that still
holds it. A task holds one window at a time, nothing is shuffled, and a lost task is repeated from its input alone.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarframe.llm.token_counts import splits_at_blanks

_CUT = re.compile(r"(?<=\S) (?=\S)")
MEMO = 300_000
BATCH = 256


def _memoised(encode: Callable[[list[str]], list], dtype) -> Callable[[str], np.ndarray]:
    """Encode runs between single blanks once each; only for tokenizers that never join over such a blank."""
    memo: dict[str, bytes] = {}

    def run(text: str) -> np.ndarray:
        first, *rest = _CUT.split(text)
        runs = [first, *[" " + r for r in rest]]
        new = list({r for r in runs if r not in memo})
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = list(set(runs))
        for i in range(0, len(new), BATCH):
            part = new[i : i + BATCH]
            memo.update((k, np.array(ids, dtype).tobytes()) for k, ids in zip(part, encode(part)))
        return np.frombuffer(b"".join(map(memo.__getitem__, runs)), dtype)

    return run


def encoder(path: str, content: bytes, dtype) -> Callable[[str], np.ndarray]:
    """Function from a text to its token ids, for a ``.tiktoken``, ``.json`` or ``.model`` file; special strings are text."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda text: np.array(model.encode(text), dtype)
    if path.endswith(".json"):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content.decode())
        tokenizer.encode_special_tokens = True
        tokenizer.no_truncation()
        tokenizer.no_padding()
        encode = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if splits_at_blanks(json.loads(content)):
            return _memoised(encode, dtype)
        return lambda text: np.array(encode([text])[0], dtype)
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _memoised(lambda texts: [encoding.encode_ordinary(t) for t in texts], dtype)


class FreeRoom:
    """Open rows by free room: a segment tree whose leaves are amounts of room, to find the least that is enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.tree = bytearray(2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.size
        while at and not self.tree[at]:
            self.tree[at] = 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Room and number of the row with the least room of at least ``need``, which leaves the tree."""
        at = need + self.size
        if not self.tree[at]:
            while at > 1 and (at & 1 or not self.tree[at + 1]):  # up to the first branch to the right that holds one
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at + (not self.tree[2 * at])
        room = at - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            while at and (at >= self.size or not (self.tree[2 * at] or self.tree[2 * at + 1])):
                self.tree[at] = 0
                at >>= 1
        return room, row


def best_fit_decreasing(lengths: list[int], length: int) -> list[list[int]]:
    """Numbers of the parts in each row; no part may be longer than a row."""
    rows: list[list[int]] = []
    open_rows = FreeRoom(length)
    for part in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = open_rows.take(lengths[part])
        if found is None:
            rows.append([])
            found = length, len(rows) - 1
        room, row = found
        rows[row].append(part)
        if room > lengths[part]:
            open_rows.add(room - lengths[part], row)
    return rows


def _pack(path: str, shared, length: int, end_id: int | None, pad_id: int, id_bytes: int, window: int, id_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype, place = np.dtype(f"<u{id_bytes}"), np.dtype("<u2" if length <= 1 << 16 else "<u4")
        encode = encoder(path, shared.value, dtype)
        counter = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        ends = [] if end_id is None else [end_id]
        parts: list[tuple] = []  # (id, number of the part, tokens)
        held = 0

        def packed():
            nonlocal counter
            for at in range(0, len(rows := best_fit_decreasing([len(p[2]) for p in parts], length)), 1024):
                some = rows[at : at + 1024]
                own = [[parts[i] for i in row] for row in some]
                starts = [np.cumsum([0, *[len(p[2]) for p in row]]) for row in own]
                ids = [np.concatenate([*[p[2] for p in row], np.full(length - s[-1], pad_id, dtype)]) for row, s in zip(own, starts)]
                resets = [
                    np.concatenate([*[np.arange(len(p[2]), dtype=place) for p in row], np.zeros(length - s[-1], place)])
                    for row, s in zip(own, starts)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(counter, counter + len(some)), pa.int64()),
                        pa.array([int(s[-1]) for s in starts], pa.int32()),
                        pa.array([[p[0] for p in row] for row in own], pa.list_(id_type)),
                        pa.array([[p[1] for p in row] for row in own], pa.list_(pa.int32())),
                        pa.array([s.astype(np.int32) for s in starts], pa.list_(pa.int32())),
                        pa.array([i.tobytes() for i in ids], pa.binary()),
                        pa.array([r.tobytes() for r in resets], pa.binary()),
                    ],
                    ["pack_id", "n_tokens", "doc_ids", "parts", "cu_seqlens", "ids", "positions"],
                )
                counter += len(some)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for name, text in zip(names, batch.column(1)):
                tokens = encode(text.as_py() or "")
                if ends:
                    tokens = np.concatenate([tokens, np.array(ends, dtype)])
                for number, at in enumerate(range(0, len(tokens), length)):
                    parts.append((name, number, tokens[at : at + length]))
                    held += min(length, len(tokens) - at)
                if held >= window:
                    yield from packed()
                    parts, held = [], 0
        if parts:
            yield from packed()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 2048,
    end_id: int | None = None,
    pad_id: int = 0,
    id_bytes: int = 2,
    window: int = 1 << 22,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows of ``length`` token ids: pack_id, n_tokens, doc_ids, parts, cu_seqlens, ids, positions.

    ids is the row of the id matrix, little-endian unsigned numbers of ``id_bytes`` bytes, filled up with ``pad_id``;
    cu_seqlens has where each part begins and where the last ends (n_tokens); doc_ids and parts name the document
    of each part and which of its parts it is; positions (two bytes each, four if a row is longer than 65,536) count
    from 0 in each part and are 0 in the filling. ``end_id`` ends every document, so a null or empty text is that one
    token; without it such texts have no part. A document's parts in order give back all its tokens. Repeated rows
    are packed each; rows without an id are packed under null. An empty table gives an empty result; other columns
    are ignored.
    """
    with open(tokenizer, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    return rows.mapInArrow(
        _pack(tokenizer, shared, length, end_id, pad_id, id_bytes, window, to_arrow_type(kind)),
        f"pack_id long, n_tokens int, doc_ids array<{kind.simpleString()}>, parts array<int>, cu_seqlens array<int>, "
        "ids binary, positions binary",
    )
