"""Best-fit packing by sums of squares.

Documents become pieces of at most ``capacity`` tokens (only longer ones are
cut; the first piece takes the remainder). Pieces are packed per group: in
decreasing length, each goes where the sum over residual gaps of (open bins
with that gap) squared becomes smallest; a new sequence is opened only where
no open one fits. The state is one count per gap, so memory is bounded by the
capacity, and groups (a hash of document and row) pack independently.

Results for odd input: a null text is the empty text (its end id alone);
repeated rows are packed as often as they occur; an empty table gives none.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.chunks import ranked_encoder
from demandlens.llm.common import arrow_map, id_text

CAPACITY = 1024
#: Documents of a group that is packed by one task.
GROUP_DOCS = 32_768


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document of n tokens; only the first may be shorter."""
    if n <= capacity:
        return [n]
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def pieces(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 2, capacity: int = CAPACITY
) -> DataFrame:
    """(doc_id, salt, piece, start, length, ids_crc32) of (doc_id, text)."""

    def run(batches):
        encode = ranked_encoder(vocabulary)
        end = np.asarray([end_id], "<u4").tobytes()
        row = 0
        for batch in batches:
            out: list[tuple] = []
            ids_col, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for doc, text in zip(ids_col, texts):
                data, start = memoryview(encode(text) + end), 0
                for k, n in enumerate(cut_lengths(len(data) // 4, capacity)):
                    crc = zlib.crc32(data[4 * start : 4 * (start + n)])
                    out.append((doc, row, k, start, n, crc))
                    start += n
                row += 1
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)],
                ["doc_id", "salt", "piece", "start", "length", "ids_crc32"],
            )

    return arrow_map(
        docs, run, "doc_id long, salt long, piece int, start long, length long, ids_crc32 long"
    )


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length. Decreasing lengths; a piece goes to the
    open gap g for which the squared counts of open bins per gap grow least
    (ties: the smallest gap), to a new bin if it fits nowhere."""
    order = np.argsort(-lengths, kind="stable")
    count = np.zeros(capacity + 1, np.int64)  # open bins by residual gap
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    for i in order:
        n = int(lengths[i])
        fits = np.flatnonzero(count[n:capacity])
        if len(fits):
            change = 1 - 2 * count[fits + n] + np.where(fits > 0, 2 * count[fits] + 1, 0)
            gap = int(fits[int(change.argmin())]) + n
            count[gap] -= 1
            b = open_bins[gap].pop()
        else:
            gap, b = capacity, used
            used += 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > n:
            count[gap - n] += 1
            open_bins[gap - n].append(b)
    return bins, offsets


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    end_id: int = 2,
    capacity: int = CAPACITY,
    group_docs: int = GROUP_DOCS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. Sequence ids are unique over all groups."""
    source = id_text(docs, id_col, text_col)
    groups = max(1, math.ceil(source.count() / group_docs))
    # the row number in its scan task spreads repeated ids
    cut = pieces(source, vocabulary, end_id, capacity).select(
        F.pmod(F.xxhash64("doc_id", "salt"), F.lit(groups)).cast("long").alias("group"), "*"
    )

    def place(key: tuple, got: pa.Table) -> pa.Table:
        got = got.sort_by([("doc_id", "ascending"), ("salt", "ascending"), ("piece", "ascending")])
        bins, offsets = sum_of_squares(got.column("length").to_numpy(), capacity)
        ids = bins + (key[0].as_py() << 40)
        keep = got.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        return keep.append_column("sequence_id", pa.array(ids)).append_column(
            "offset", pa.array(offsets)
        )

    return cut.groupBy("group").applyInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
