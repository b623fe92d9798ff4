"""SimHash near-duplicates found through the binary Golay code.

Fingerprints (64 bits) are cut into three segments. Two fingerprints with at
most two differing bits have, for one of the ordered pairs of segments
(0, 1), (1, 2), (2, 0), an equal first and an at most once differing second
segment. The second one is decoded with the perfect [23, 12] Golay code: every
23-bit word lies within three bits of exactly one codeword. Words that differ
in one bit share a codeword: the nearest one of the first lies within four
bits of the second, and at most six codewords do. So every fingerprint is
stored under (pair, equal segment, codeword) for all codewords within four
bits of its other segment and looked up under the nearest one; matches are
verified by counting differing bits.

Equal fingerprints are one node. Where more than ``BUCKET`` fingerprints meet
under one key, no pairs are made: each of them names the 65 words within one
bit, and those that name a common word (exactly the pairs of at most two
differing bits) are linked to the smallest one. Nothing is capped.

Results for odd input: null, empty and blank texts have fingerprint zero and
are linked like any other; rows without an id get the component of the
documents with ids they are linked to, else null; repeated rows stay.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.common import arrow_map, id_text
from demandlens.llm.components import components
from demandlens.session import scratch_path

#: Stored fingerprints of a key up to which pairs are compared directly.
BUCKET = 64
#: Differing bits of a link; the segments and codewords below follow from it.
MAX_BITS = 2
#: Segments as (shift, bits), and which pairs are (equal, decoded).
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (1, 2), (2, 0))
#: Generator polynomial of the Golay code, fixed.
GENERATOR = 0b101011100011


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included."""
    tokens = text.encode().lower().split()
    n = len(tokens)
    if not n:
        return 0
    joined = b" ".join(tokens)
    count = max(1, n - words + 1)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, n) + 1) - 1
    first = np.concatenate([[0], ends[:-1] + 1])[:count].tolist()
    last = ends[min(words, n) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    votes = np.zeros(64, np.int64)
    for at in range(0, count, 8192):
        raw = b"".join(
            [digest(joined[a:b], seed) for a, b in zip(first[at : at + 8192], last[at : at + 8192])]
        )
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > count).tobytes(), "big")


@lru_cache(1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(remainder of each 23-bit word's upper 12 bits, masks): masks[s] holds
    six masks that turn a word of syndrome s into the codewords within four
    bits, the nearest one first; a missing one repeats the first."""
    remainder = np.zeros(4096, np.int64)
    for message in range(4096):
        word = message << 11
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        remainder[message] = word
    codewords = (np.arange(4096) << 11) | remainder
    heavy = [int(c) for c in codewords if int(c).bit_count() == 7]
    masks = np.zeros((2048, 6), np.int64)
    bits = [1 << i for i in range(23)]
    errors = {0: 0}
    for i, a in enumerate(bits):
        errors[a] = 1
        for j, b in enumerate(bits[i + 1 :], i + 1):
            errors[a | b] = 2
            for c in bits[j + 1 :]:
                errors[a | b | c] = 3
    for error, weight in errors.items():
        syndrome = (error & 2047) ^ int(remainder[error >> 11])
        near = [error]
        if weight == 3:
            near += [error ^ h for h in heavy if h & error == error]
        masks[syndrome] = near + [error] * (6 - len(near))
    return remainder, masks


def near_codewords(segment: np.ndarray) -> np.ndarray:
    """(n, 6) indices of the codewords within four bits, the nearest first."""
    remainder, masks = golay_tables()
    syndrome = (segment & 2047) ^ remainder[segment >> 11]
    return (segment[:, None] ^ masks[syndrome]) >> 11


def _keys(prints: DataFrame, stored: bool) -> DataFrame:
    """(key, fp): all keys under which a fingerprint is stored, or looked up."""

    def run(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            word = fp.view(np.uint64)
            parts = [
                ((word >> np.uint64(s)) & np.uint64((1 << b) - 1)).astype(np.int64)
                for s, b in SEGMENTS
            ]
            keys, owners = [], []
            for pair, (equal, other) in enumerate(PAIRS):
                codes = near_codewords(parts[other])
                for k in range(6 if stored else 1):
                    use = slice(None) if not k else codes[:, k] != codes[:, 0]
                    key = (parts[equal] << 14) | (codes[:, k] << 2) | pair
                    keys.append(key[use])
                    owners.append(fp[use])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.concatenate(owners))], ["key", "fp"]
            )

    return arrow_map(prints.select("fp"), run, "key long, fp long")


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect all
    those with at most two differing bits."""
    stored, asked = _keys(prints, True), _keys(prints, False)
    hot = stored.groupBy("key").count().filter(F.col("count") > bucket).select("key").checkpoint()
    left = asked.join(hot, "key", "left_anti").withColumnRenamed("fp", "a")
    right = stored.join(hot, "key", "left_anti").withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    direct = left.join(right, "key").filter(near & (F.col("a") != F.col("b"))).select("a", "b")
    crowded = stored.join(hot, "key", "left_semi").select("fp").distinct()
    reach = [F.lit(0)] + [F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)]
    named = crowded.select(
        F.explode(F.array(*[F.col("fp").bitwiseXOR(r.cast("long")) for r in reach])).alias("word"),
        "fp",
    )
    least = named.groupBy("word").agg(F.min("fp").alias("b"), F.max("fp").alias("top"))
    stars = named.join(least.filter("b <> top"), "word").filter("fp <> b")
    return direct.union(stars.select(F.col("fp").alias("a"), "b"))


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of (doc_id, text); fp is the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), words, seed) for t in batch.column("text")]
            signed = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signed)], ["doc_id", "fp"]
            )

    return arrow_map(docs, run, "doc_id long, fp long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    bucket: int = BUCKET,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id
    reachable by links of at most two differing bits)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    fingerprints(id_text(docs, id_col, text_col), words).write.parquet(path)
    prints = spark.read.parquet(path)
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).checkpoint()
    found = components(links(nodes, bucket))
    named = nodes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    named = named.checkpoint()
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = named.join(least, "label").select("fp", "component_id").checkpoint()
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
