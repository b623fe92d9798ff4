"""Byte-level BPE as a monoid: encodings of neighbours are joined in a tree.

``encode`` halves a pretoken down to short leaves, encodes the leaves by plain
merging, and joins neighbours upwards. A join re-encodes a window of tokens
around the seam and widens it until both of its edges are stable. Stable
means: re-encoding the two tokens at an edge gives these two tokens. That is
enough, because the first merge that reached across the edge in the whole
text would also happen when only these two tokens are encoded; so a sequence
whose neighbours are all stable is the encoding. Decoding concatenates bytes
up the same kind of tree.

Every match of the public pattern is a pretoken of its own. A null text is
the empty text: no ids; repeated rows stay; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from array import array

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from demandlens.llm.chunks import ChunkEncoder, byte_chunks
from demandlens.llm.common import arrow_map, id_text

#: Bytes of a leaf, and ids of a leaf when decoding.
LEAF, DECODE_LEAF = 8, 4096
#: Bytes of spans whose encoding is remembered, and entries of the memories of
#: spans and seams, pretokens, and chunks (each starts anew when full).
MEMO_BYTES, MEMO_ENTRIES = 10, 300_000
PRETOKENS, CHUNKS = 500_000, 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class TreeBpe:
    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF):
        self.ranks, self.leaf = ranks, max(1, leaf)
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for data, rank in ranks.items():
            self.bytes_of[rank] = data
        self._stable: dict[tuple[int, int], bool] = {}
        self._merged: dict[bytes, list[int]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE of a span: the neighbours of lowest rank merge first, the
        leftmost of equals. Short spans, which words share, are remembered."""
        ranks = self.ranks
        if data in ranks:
            return [ranks[data]]
        if len(data) > 4 * self.leaf:
            return self._merge_long(data)
        if len(data) > MEMO_BYTES:
            return self._merge_short(data)
        found = self._merged.get(data)
        if found is None:
            if len(self._merged) > MEMO_ENTRIES:
                self._merged.clear()
            found = self._merged[data] = self._merge_short(data)
        return found

    def _merge_short(self, data: bytes) -> list[int]:
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, r in enumerate(pairs):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return [ranks[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap and links, for windows that grew long."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # end of the part that begins here
        prev, alive = list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := ranks.get(data[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop or end[i] == stop:
                continue  # one of the two has merged meanwhile
            alive[end[i]] = False
            end[i] = stop
            if stop < n:
                prev[stop] = i
            offer(i)
            if prev[i] >= 0:
                offer(prev[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return out

    def stable(self, a: int, b: int) -> bool:
        key = (a, b)
        if key not in self._stable:
            if len(self._stable) > MEMO_ENTRIES:
                self._stable.clear()
            self._stable[key] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return self._stable[key]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring encoded spans."""
        if not left or not right:
            return left + right
        if self.stable(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merge(b"".join([self.bytes_of[t] for t in left[-i:] + right[:j]]))
            fits_left = i >= len(left) or self.stable(left[-i - 1], window[0])
            fits_right = j >= len(right) or self.stable(window[-1], right[j])
            if fits_left and fits_right:
                return left[: max(0, len(left) - i)] + window + right[j:]
            if not fits_left:
                i *= 2
            if not fits_right:
                j *= 2

    def encode(self, data: bytes) -> list[int]:
        """Ids of one pretoken."""
        if data in self.ranks:
            return [self.ranks[data]]
        if len(data) <= self.leaf:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.encode(data[:half]), self.encode(data[half:]))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return b"".join([self.bytes_of[i] for i in ids])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _little(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


_LOADED: dict[str, tuple[TreeBpe, ChunkEncoder]] = {}


def loaded(name: str) -> tuple[TreeBpe, ChunkEncoder]:
    """Tree and text encoder of a rank file, one per Python worker."""
    if name not in _LOADED:
        tree = TreeBpe(load_ranks(public_tokenizers.path(name)))
        matches = regex.compile(public_tokenizers.PATTERN).findall
        known: dict[str, bytes] = {}  # of pretokens, which chunks share

        def encode_many(chunks: list[str]) -> list[bytes]:
            if len(known) > PRETOKENS:
                known.clear()
            out = []
            for chunk in chunks:
                parts = []
                for m in matches(chunk):
                    ids = known.get(m)
                    if ids is None:
                        ids = known[m] = _little(tree.encode(m.encode()))
                    parts.append(ids)
                out.append(b"".join(parts))
            return out

        _LOADED[name] = tree, ChunkEncoder(encode_many, byte_chunks, CHUNKS)
    return _LOADED[name]


def encode_decode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.tiktoken",
    with_ids: bool = False,
) -> DataFrame:
    """Per document: n_tokens, sha256 of the ids and of the bytes they decode
    to; with ``with_ids`` also the ids themselves."""

    def run(batches):
        tree, encode = loaded(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows: list[list] = [[], [], []]
            kept: list = []
            for at in range(0, len(texts), 32):
                for ids in encode(texts[at : at + 32]):
                    numbers = np.frombuffer(ids, "<u4").tolist()
                    rows[0].append(len(numbers))
                    rows[1].append(hashlib.sha256(ids).hexdigest())
                    rows[2].append(hashlib.sha256(tree.decode(numbers)).hexdigest())
                    if with_ids:
                        kept.append(numbers)
            out = [batch.column("doc_id"), pa.array(rows[0], pa.int64())]
            out += [pa.array(r, pa.string()) for r in rows[1:]]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                out, names = [*out, pa.array(kept, pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(
        id_text(docs, id_col, text_col), run, schema + (", ids array<long>" if with_ids else "")
    )
