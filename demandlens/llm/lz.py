"""Lempel-Ziv phrase fingerprints.

A text is parsed into its LZ78 phrases (each the shortest string not met
before); the phrases' hashes are a set, and the ``SIZE`` smallest ones are the
signature. The likeness of two signatures is the share of common values among
the smallest ones of both together, an estimate of the Jaccard index of the
phrase sets (exact for texts of few phrases).

Results for odd input: null and empty texts have the empty signature; two
empty signatures are alike by 1, an empty and another one by 0; equal texts
have equal signatures; the only document is its own successor; documents
without id come first, equal ids are ordered by a hash of the text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.common import arrow_map, id_text, partitions, range_buckets

#: Hashes of a signature.
SIZE = 64
#: Odd multiplier of the polynomial hash and of its final mix, fixed.
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SHIFT = 21  # bits of a code point


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def parse(codes: list[int], start: int, trie: dict[int, int], ends: list[int]) -> None:
    """Goes on parsing at ``start``; adds the end of each new phrase."""
    get, node, size = trie.get, 0, len(trie) << _SHIFT
    step = 1 << _SHIFT
    add = ends.append
    for at, c in enumerate(codes[start:] if start else codes, start + 1):
        key = node | c
        node = get(key, 0)
        if not node:
            size += step
            trie[key] = size
            add(at)


_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << n.bit_length()
        run = lambda x: np.concatenate(
            [np.ones(1, np.uint64), np.cumprod(np.full(size - 1, x, np.uint64))]
        )
        _POWERS, _INVERSES = run(BASE), run(pow(BASE, -1, 1 << 64))
    return _POWERS, _INVERSES


def running_hash(codes: np.ndarray, start: int = 0, before: int = 0) -> np.ndarray:
    """Running sums of the polynomial hash: entry k covers ``start + k`` code
    points, ``before`` being the sum of those before ``start``."""
    powers, _ = _powers(start + len(codes) + 1)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX)
    mixed ^= mixed >> np.uint64(29)
    mixed *= powers[start : start + len(codes)]
    out = np.empty(len(codes) + 1, np.uint64)
    out[0] = before
    np.cumsum(mixed, out=out[1:])
    out[1:] += out[0]
    return out


def phrase_hashes(total: np.ndarray, ends: list[int], offset: int = 0, begin: int = 0) -> np.ndarray:
    """32-bit hashes of the phrases that begin at ``begin`` and end at
    ``ends``; ``total`` holds running sums from ``offset`` on. A phrase's hash
    is a polynomial in its code points, mixed at the end."""
    if not ends:
        return np.zeros(0, np.uint32)
    last = np.asarray(ends)
    first = np.concatenate([[begin], last[:-1]])
    _, inverses = _powers(int(last[-1]) + 1)
    h = (total[last - offset] - total[first - offset]) * inverses[first]
    h += (last - first).astype(np.uint64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(MIX)
    h ^= h >> np.uint64(32)
    return (h * np.uint64(BASE) >> np.uint64(32)).astype(np.uint32)


def signature(h: np.ndarray) -> np.ndarray:
    """The smallest hashes (ascending, distinct)."""
    if len(h) > 4 * SIZE:
        h = np.partition(h, 2 * SIZE)[: 2 * SIZE]
    return np.unique(h)[:SIZE]


def to_hex(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    x, y = set(a.tolist()), set(b.tolist())
    if not x or not y:
        return float(len(x) == len(y))
    both, common = sorted(x | y)[:SIZE], x & y
    return sum(v in common for v in both) / len(both)


class Parsed:
    """A text with its phrases and signature."""

    def __init__(self, text: str):
        self.text, self.trie, self.ends = text, {}, []
        codes = code_points(text)
        self.codes = codes.tolist()
        parse(self.codes, 0, self.trie, self.ends)
        self.total = running_hash(codes)
        self.hashes = phrase_hashes(self.total, self.ends)
        self.signature = signature(self.hashes)

    def edited(self, following: str) -> tuple[str, np.ndarray]:
        """The text whose last quarter gives way to the beginning of the
        following text, and its signature. Both texts share the phrases of
        their common beginning, so parsing goes on from there; this uses up
        the parsed text."""
        n = len(self.text)
        cut = n - n // 4
        tail = following[: n // 4]
        kept = bisect_right(self.ends, cut)
        for _ in range(len(self.ends) - kept):
            self.trie.popitem()  # the latest phrases
        begin = self.ends[kept - 1] if kept else 0
        new = code_points(tail)
        ends: list[int] = []
        parse(self.codes[:cut] + new.tolist(), begin, self.trie, ends)
        total = np.concatenate([self.total[begin:cut], running_hash(new, cut, self.total[cut])])
        added = phrase_hashes(total, ends, begin, begin)
        return self.text[:cut] + tail, signature(np.concatenate([self.hashes[:kept], added]))


def fingerprint(text: str) -> str:
    return to_hex(Parsed(text).signature)


def with_successor(docs: DataFrame) -> DataFrame:
    """Rows (bucket, ord, doc_id, text) of (doc_id, text), partitioned by
    ranges of doc_id and sorted: each bucket's documents (ord 0) and then the
    first document of the next bucket (ord 1), after the last bucket the very
    first document. Texts are shuffled once."""
    spark = docs.sparkSession
    n = partitions(spark)
    placed = range_buckets(docs, "doc_id", 4 * n).withColumn("h", F.xxhash64("text"))
    firsts = placed.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "h")).alias("m"))
    rows = firsts.orderBy("bucket").select("bucket", "m.doc_id", "m.h").collect()  # one per bucket
    before = [(r[1], r[2], rows[k - 1][0]) for k, r in enumerate(rows)]
    marks = spark.createDataFrame(before, "first_id long, first_h long, previous int")
    own = F.struct("bucket", F.lit(0).alias("ord"))
    also = F.struct(F.col("previous").alias("bucket"), F.lit(1).alias("ord"))
    return (
        placed.join(
            F.broadcast(marks),
            F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h")),
            "left",
        )
        .select(
            F.explode(F.when(F.col("previous").isNull(), F.array(own)).otherwise(F.array(own, also))).alias("to"),
            "doc_id", "text", "h",
        )
        .select("to.bucket", "to.ord", "doc_id", "text", "h")
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", "ord", "doc_id", "h")
        .select("bucket", "ord", "doc_id", "text")
    )


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every document."""

    def run(batches):
        held: tuple | None = None  # (bucket, doc_id, parsed)
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("bucket", "ord", "doc_id", "text"))
            for bucket, order, doc, text in zip(*columns):
                if order and (held is None or held[0] != bucket):
                    continue  # the next bucket's first document, repeated
                now = Parsed(text)
                if held is not None and held[0] == bucket:
                    _, name, parsed = held
                    size, sig = len(parsed.text), parsed.signature
                    edited, edited_sig = parsed.edited(text)
                    out.append((
                        name, size, hashlib.sha256(edited.encode()).hexdigest(), to_hex(sig),
                        to_hex(edited_sig), likeness(sig, edited_sig), likeness(sig, now.signature),
                    ))
                held = None if order else (bucket, doc, now)
            cols = list(zip(*out)) if out else [[]] * 7
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    return arrow_map(
        with_successor(id_text(docs, id_col, text_col)),
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
