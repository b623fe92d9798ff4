"""Token ids in binary blocks with Elias-Fano document boundaries.

Format of a block (little-endian): magic ``EFID``, version u8, id width u8,
documents u32, documents without id u32, ids u64, least doc_id i64, sizes of
the two boundary codes u32 each; then the code of the document ends, the code
of the doc_ids above the least one, then all ids concatenated. A code holds n,
the universe, the low bits packed, the high bits in unary, and the position of
every 64th one: ``select`` jumps there and counts bits in at most a few words,
so an offset costs about 2 + log2(u/n) bits and no 64-bit table is kept.

Blocks are rows of a Parquet table in the shared folder, written by Spark's
committer (a lost executor's task is simply run again), ordered by
(shard, block); shards are ranges of ascending doc_id.

Results for odd input: a null or empty text is its end id alone; documents
without an id come first, repeated rows are documents of their own; a text
longer than a block is a block of its own; an empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm.chunks import word_encoder
from demandlens.llm.common import arrow_map, id_text, partitions
from demandlens.session import scratch_path

MAGIC, VERSION = b"EFID", 1
_HEAD = struct.Struct("<4sBBIIQqII")
_CODE = struct.Struct("<IQBII")
SAMPLE = 64
#: Ids after which a block is closed (a longer document is a block of its own).
BLOCK_IDS = 1 << 20


class EliasFano:
    """A non-decreasing sequence of n values in [0, universe]."""

    def __init__(self, n: int, universe: int, low_bits: int, low, high, samples):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def encode(cls, values, universe: int) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        bits = max(0, (universe // n).bit_length() - 1) if n else 0
        low_part = v & np.uint64((1 << bits) - 1)
        places = (low_part[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(places.astype(np.uint8).ravel(), bitorder="little")
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        return cls(
            n, universe, bits, low, np.packbits(unary, bitorder="little"),
            ones[::SAMPLE].astype("<u4"),
        )

    def to_bytes(self) -> bytes:
        head = _CODE.pack(self.n, self.universe, self.low_bits, len(self.low), len(self.high))
        return b"".join([head, self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()])

    @classmethod
    def from_bytes(cls, data) -> EliasFano:
        n, universe, bits, n_low, n_high = _CODE.unpack_from(data)
        at = _CODE.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        samples = np.frombuffer(data, "<u4", -(-n // SAMPLE), at + n_low + n_high)
        return cls(n, universe, bits, low, high, samples)

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        last = first + self.low_bits
        word = int.from_bytes(self.low[first // 8 : (last + 7) // 8].tobytes(), "little")
        return (word >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value, from the sampled position nearest before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        word = int(self.high[byte]) >> (at % 8) << (at % 8)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        at = byte * 8 + (word & -word).bit_length() - 1
        return ((at - i) << self.low_bits) | self._low(i)

    def all(self) -> np.ndarray:
        """All values, decoded together."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits]
        weight = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        low = (bits.reshape(self.n, self.low_bits).astype(np.uint64) * weight).sum(1)
        return (high | low.astype(np.uint64)).astype(np.int64)


def write_block(doc_ids: list, ids: list[bytes], width: int) -> bytes:
    """One block; documents without an id come first, then ascending ids."""
    nulls = sum(d is None for d in doc_ids)
    known = [int(d) for d in doc_ids[nulls:]]
    least = known[0] if known else 0
    ends = np.cumsum([len(b) // width for b in ids])
    total = int(ends[-1]) if len(ends) else 0
    bounds = EliasFano.encode(ends, total).to_bytes()
    names = EliasFano.encode([d - least for d in known], known[-1] - least if known else 0).to_bytes()
    head = _HEAD.pack(
        MAGIC, VERSION, width, len(ids), nulls, total, least, len(bounds), len(names)
    )
    return b"".join([head, bounds, names, *ids])


class Block:
    """A block read back; offsets come from its boundary code."""

    def __init__(self, data: bytes):
        magic, version, self.width, self.n_docs, nulls, self.n_ids, least, a, b = _HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a block of token ids")
        at = _HEAD.size
        view = memoryview(data)
        self.ends = EliasFano.from_bytes(view[at : at + a])
        names = EliasFano.from_bytes(view[at + a : at + a + b])
        self.doc_ids = [None] * nulls + [least + int(x) for x in names.all()]
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, at + a + b)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


def write_ids(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 1,
    width: int = 2,
) -> None:
    """Encodes the texts, appends ``end_id`` to each and writes the blocks in
    ascending doc_id order (equal ids in the order of the source, nulls first):
    shard numbers, and blocks within a shard, ascend with the ids. Rows are
    dealt to shards by ranges of (doc_id, source row), so rows that share an id,
    or have none, split too. ``width`` is the bytes of an id: 2 serve
    vocabularies up to 65,536, larger ones raise."""
    spark = docs.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.col("row")]
    placed = (
        id_text(docs, id_col, text_col)
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    )

    def run(batches):
        encode = word_encoder(vocabulary, f"<u{width}")
        end = np.asarray([end_id], f"<u{width}").tobytes()
        shard, block, before, size = None, 0, 0, 0
        names: list = []
        held: list[bytes] = []

        def close():
            nonlocal block, before, size, names, held
            out = pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()),
                "n_docs": pa.array([len(names)], pa.int64()), "n_ids": pa.array([size], pa.int64()),
                "before": pa.array([before], pa.int64()),
                "data": pa.array([write_block(names, held, width)], pa.binary()),
            })
            block, before, size, names, held = block + 1, before + size, 0, [], []
            return out

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id")))
            texts = batch.column("text").to_pylist()
            coded = (x for at in range(0, len(texts), 32) for x in encode(texts[at : at + 32]))
            for (own, doc), ids in zip(rows, coded):
                ids += end
                count = len(ids) // width
                if names and (own != shard or size + count > BLOCK_IDS):
                    yield close()
                if own != shard:
                    shard, block, before = own, 0, 0
                names.append(doc)
                held.append(ids)
                size += count
        if names:
            yield close()

    blocks = arrow_map(
        placed, run, "shard int, block int, n_docs long, n_ids long, before long, data binary"
    )
    blocks.write.option("compression", "zstd").mode("overwrite").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.
    The ids before a shard are a running sum over the shards' totals (one row
    per shard; their number is set by the writer, not by the data)."""
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    starts, at = [], 0
    for shard, n in totals:
        starts.append((shard, at))
        at += n
    base = spark.createDataFrame(starts, "shard int, base long")
    placed = blocks.join(F.broadcast(base), "shard").select(
        (F.col("base") + F.col("before")).alias("first"), "data"
    )

    def run(batches):
        for batch in batches:
            for first, data in zip(
                batch.column("first").to_pylist(), batch.column("data").to_pylist()
            ):
                block = Block(data)
                ends = np.array([block.ends.select(i) for i in range(block.n_docs)], np.int64)
                begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                crc = [
                    zlib.crc32(block.ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(begins, ends)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block.doc_ids, pa.int64()),
                        pa.array(begins + first, pa.int64()),
                        pa.array(ends - begins, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return arrow_map(placed, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, **options) -> DataFrame:
    """Writes the documents' ids below the shared folder and reads them back."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, **options)
    return read_ids(docs.sparkSession, path)
