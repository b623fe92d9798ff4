"""Best-fit decreasing packing with a segment tree over remaining capacities.

Documents become pieces: an overlong document is first cut into full windows
of ``capacity`` tokens, its remainder is one more piece. Pieces are placed per
group in decreasing length: each goes into the open window whose remaining
capacity is the smallest that holds it, which a segment tree indexed by
remaining capacity finds in log2(capacity) steps; where none holds it a new
window is opened. The tree keeps one count per capacity, so its memory does
not depend on the documents. Groups (a hash of document and row) pack
independently; only the last windows of a group stay open.

A sequence is padded to ``capacity`` tokens, unless its tokens are a power of
two: then it stays as it is (column ``padded_length``).

Results for odd input: a null text is the empty text (its end id alone); rows
without an id and repeated rows are packed as often as they occur; an empty
table gives none; a text of any length is cut.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.chunks import ranked_encoder
from demandlens.llm.common import arrow_map, id_text

CAPACITY = 2048
#: Documents of a group that is packed by one task.
GROUP_DOCS = 32_768


class CapacityTree:
    """Open windows by remaining capacity: leaf c counts those with c left, an
    inner node those below it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()  # leaves 0..capacity
        self.count = [0] * (2 * self.size)

    def add(self, remaining: int, change: int) -> None:
        node = remaining + self.size
        while node:
            self.count[node] += change
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least ``need``."""
        count, node = self.count, need + self.size
        if count[node]:
            return need
        while node > 1:  # up to the first subtree on the right that has windows
            if not node & 1 and count[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.size:  # down to its leftmost window
            node *= 2
            if not count[node]:
                node += 1
        return node - self.size


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each length; lengths are from 1 to ``capacity``."""
    order = np.argsort(-lengths, kind="stable").tolist()
    sizes = lengths.tolist()
    tree = CapacityTree(capacity)
    windows: list[list[int]] = [[] for _ in range(capacity + 1)]  # by remaining capacity
    window, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    used = 0
    for i in order:
        n = sizes[i]
        left = capacity if n == capacity else tree.tightest(n)
        if left is None or left == capacity:
            left, w = capacity, used
            used += 1
        else:
            tree.add(left, -1)
            w = windows[left].pop()
        window[i], offset[i] = w, capacity - left
        if left > n:
            tree.add(left - n, 1)
            windows[left - n].append(w)
    return window, offset


def padded_length(tokens: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """What a sequence of so many tokens takes."""
    return np.where(tokens & (tokens - 1), capacity, tokens)


_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("salt", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
    ]
)


def cut_documents(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 1, capacity: int = CAPACITY
) -> DataFrame:
    """(doc_id, salt, start, length, ids_crc32, doc_tokens): the pieces of
    (doc_id, text). ``salt`` numbers the documents of a scan task, which
    spreads repeated and missing ids over the groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ranked_encoder(vocabulary)
        end = np.asarray([end_id], "<u4").tobytes()
        row = 0
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = memoryview(encode(text) + end)
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    out.append((doc, row, start, len(part) // 4, zlib.crc32(part), total))
                row += 1
            columns = list(zip(*out)) if out else [[]] * len(_PIECE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE
            )

    return arrow_map(
        docs, run,
        "doc_id long, salt long, start long, length long, ids_crc32 long, doc_tokens long",
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    end_id: int = 1,
    capacity: int = CAPACITY,
    group_docs: int = GROUP_DOCS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, padded_length (of its whole sequence). Sequence ids
    are unique over all groups."""
    source = id_text(docs, id_col, text_col)
    groups = max(1, math.ceil(source.count() / group_docs))
    cut = cut_documents(source, vocabulary, end_id, capacity).select(
        F.pmod(F.xxhash64("doc_id", "salt"), F.lit(groups)).cast("long").alias("group"), "*"
    )

    def place(key: tuple, got: pa.Table) -> pa.Table:
        got = got.sort_by([("doc_id", "ascending"), ("salt", "ascending"), ("start", "ascending")])
        lengths = got.column("length").to_numpy()
        window, offset = best_fit_decreasing(lengths, capacity)
        tokens = np.bincount(window, lengths).astype(np.int64)
        out = got.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        out = out.append_column("sequence_id", pa.array(window + (key[0].as_py() << 40)))
        out = out.append_column("offset", pa.array(offset))
        return out.append_column("padded_length", pa.array(padded_length(tokens, capacity)[window]))

    return cut.groupBy("group").applyInArrow(
        place,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, padded_length long",
    )
