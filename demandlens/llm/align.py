"""Alignment of two tokenizers over a corpus, each distinct text once.

1. The texts are shuffled by their full text and counted (equal texts meet
   after a map-side count, so a text with very many copies is one row per map
   task); each distinct text is tokenised by A and B and aligned once, and the
   result is written with its multiplicity to the shared folder.
2. Consecutive texts of a written file form blocks. Per block the links of
   each (A id, B id) pair are added up, weighted by multiplicity; the sums over
   all blocks are the pair counts, the largest per B id marks the best pairs.
3. The measures of a text come from the counts of its pairs. Up to
   ``BROADCAST_PAIRS`` pairs (counted first) go to every task; of more, each
   block gets back the counts of its own pairs, and a pair that nearly every
   text holds is one row per block.
4. The measures are joined to all documents by the SHA-256 of the text. Texts
   with at least one in ``HOT_SHARE`` of all documents (so at most that many
   texts) are broadcast, the others are shuffled.

Byte offsets where tokens of A and of B both end cut a text into groups; the
two tokens that end there are a link. A token of A is the bytes of its
byte-level entry; one of B its piece with U+2581 as a blank, or its raw byte.
Both read a blank and the text (B puts the blank there itself).

Results for odd input: null and empty texts, and texts whose tokens do not
give back blank + text (B's special characters), have no tokens: all measures
0, the digest ''. Rows without an id and repeated rows stay, a text of any
length is aligned whole, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.chunks import ChunkMemory, RankCoder, byte_chunks, byte_vocabulary
from demandlens.llm.common import arrow_map, id_text
from demandlens.session import scratch_path

#: Distinct links of the texts of a block (a longer text is a block of its own).
BLOCK_LINKS = 1 << 20
#: What a text counts in a block at least, so that blocks are bounded in texts.
LEAST_LINKS = 64
#: Pairs, of 17 bytes each, up to which their counts are sent to every task.
BROADCAST_PAIRS = 2_000_000
#: Texts with at least this share of all documents are broadcast.
HOT_SHARE = 1024
#: Bytes of remembered alignments in a worker.
MEMORY_BYTES = 256 << 20
#: A pair is kept as one number: A id times this plus B id.
PAIR = 1 << 31
#: Two numbers of tokens are kept as one: of A times this plus of B.
SIDE = 1 << 40

_ZEROS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
_BLANK, _LINE = "▁", "\n"
#: Texts whose unknown chunks are tokenised together.
TOGETHER = 64


class Aligner:
    """Groups and links of texts under a byte-level and a piece vocabulary.

    A text is cut at single blanks and around line feeds, where both end a
    token for certain: the byte-level pattern never reaches across, and no
    piece holds a line feed or, but for runs of blanks, a blank after its first
    character (checked on loading). So each distinct short chunk is tokenised
    and aligned once while it is remembered. Other texts go whole."""

    def __init__(self, path_a: str, path_b: str, limit: int = MEMORY_BYTES):
        self.code_a = RankCoder(path_a).code
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_a = {i: data for data, i in byte_vocabulary(path_a).items()}
        self.bytes_a = [bytes_a.get(i, b"") for i in range(max(bytes_a) + 1)]
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace(_BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        # a chunk without a blank before it is read after a line feed, whose
        # ids (and those of the blank that the model puts first) are dropped
        self.lead = model.encode(_LINE)
        inner = [p for p in pieces if p.strip(_BLANK) and (_BLANK in p[1:] or _LINE in p)]
        self.chunked = not inner and [model.is_byte(i) for i in self.lead] == [False, True]
        self.memory = ChunkMemory(limit)

    def align(self, data: bytes, a: list[int], b: list[int]) -> tuple | None:
        """(tokens, groups, pairs) of the tokens of some bytes, ``tokens`` the
        numbers of both in one (``SIDE``), ``pairs`` eight bytes per link and
        group; None where they are not the tokens' own bytes."""
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        if b"".join([bytes_a[i] for i in a]) != data or b"".join([bytes_b[i] for i in b]) != data:
            return None
        groups, pairs = [], array("q")
        end_a = end_b = from_a = from_b = at_b = 0
        for at_a, token in enumerate(a, 1):
            end_a += len(bytes_a[token])
            while end_b < end_a:
                end_b += len(bytes_b[b[at_b]])
                at_b += 1
            if end_a == end_b:
                pairs.append(token * PAIR + b[at_b - 1])
                left, right = map(str, a[from_a:at_a]), map(str, b[from_b:at_b])
                groups.append(",".join(left) + "|" + ",".join(right))
                from_a, from_b = at_a, at_b
        return len(a) * SIDE + len(b), ";".join(groups).encode(), pairs.tobytes()

    def whole(self, text: str) -> tuple | None:
        """The alignment of blank + text."""
        spaced = " " + text
        return self.align(spaced.encode(), self.code_a(spaced), self.model.encode(text))

    def learn(self, chunks: list[str]) -> dict[str, tuple | None]:
        """The alignments of chunks as they stand in a text."""
        bare = [c[1:] if c.startswith(" ") else _LINE + c for c in chunks]
        found = {}
        for chunk, b in zip(chunks, self.model.encode(bare, num_threads=1)):
            if chunk == " ":  # at the end of a text
                b = self.lead[:1]
            elif not chunk.startswith(" "):
                b = b[2:] if b[:2] == self.lead else []
            found[chunk] = got = self.align(chunk.encode(), self.code_a(chunk), b)
            # a remembered tuple with its number besides its two strings
            self.memory.keep(chunk, got, 160 + (len(got[1]) + len(got[2]) if got else 0))
        return found

    def __call__(self, texts: list[str]) -> list[tuple | None]:
        cut = [byte_chunks(" " + t) if t and self.chunked else None for t in texts]
        # nothing stands before the first cut, at the blank, or after a last line feed
        cut = [c and c[1 : len(c) if c[-1] else -1] for c in cut]
        memory = self.memory
        known = [c and [memory.get(x, False) for x in c] for c in cut]
        missing = {x for c, k in zip(cut, known) if c for x, got in zip(c, k) if got is False}
        fresh = self.learn(list(missing)) if missing else {}
        out: list[tuple | None] = []
        for text, chunks, parts in zip(texts, cut, known):
            if chunks is None:
                out.append(self.whole(text) if text else None)
                continue
            parts = [fresh[x] if got is False else got for x, got in zip(chunks, parts)]
            if None in parts:
                out.append(None)
                continue
            tokens, groups, pairs = zip(*parts)
            out.append((sum(tokens), b";".join(groups), b"".join(pairs)))
        return out


_LOADED: dict[tuple[str, str], Aligner] = {}


def loaded(vocabulary_a: str, vocabulary_b: str) -> Aligner:
    """The aligner of two vocabulary files, one per Python worker."""
    key = (vocabulary_a, vocabulary_b)
    if key not in _LOADED:
        _LOADED[key] = Aligner(public_tokenizers.path(vocabulary_a), public_tokenizers.path(vocabulary_b))
    return _LOADED[key]


_ALIGNED = pa.schema(
    [
        ("key", pa.string()),
        ("copies", pa.int64()),
        ("block", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("groups_sha256", pa.string()),
        ("pairs", pa.list_(pa.int64())),
        ("uses", pa.list_(pa.int32())),
    ]
)
_ALIGNED_SQL = (
    "key string, copies long, block long, n_a long, n_b long, n_groups long, "
    "groups_sha256 string, pairs array<long>, uses array<int>"
)


def lists(offsets: list[int], values: list[np.ndarray], kind: np.dtype) -> pa.ListArray:
    flat = np.concatenate(values) if values else np.empty(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(kind)))


def align_texts(texts: DataFrame, vocabulary_a: str, vocabulary_b: str, block_links: int) -> DataFrame:
    """One row per (text, key, copies, task): the alignment, its distinct pairs
    with their uses, and the block, a number of task and order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = loaded(vocabulary_a, vocabulary_b)
        block, held = 0, 0
        for batch in batches:
            keys, copies = batch.column("key").to_pylist(), batch.column("copies").to_pylist()
            tasks = batch.column("task").to_pylist()
            rows: list[tuple] = []
            offsets, pairs, uses = [0], [], []
            texts = batch.column("text").to_pylist()
            results = (r for at in range(0, len(texts), TOGETHER) for r in align(texts[at : at + TOGETHER]))
            for key, n, task, found in zip(keys, copies, tasks, results):
                if found is None:
                    n_a = n_b = 0
                    links, digest = b"", ""
                else:
                    (n_a, n_b), links = divmod(found[0], SIDE), found[2]
                    digest = hashlib.sha256(found[1]).hexdigest()
                pair, use = np.unique(np.frombuffer(links, np.int64), return_counts=True)
                size = max(len(pair), LEAST_LINKS)
                if held and held + size > block_links:
                    block, held = block + 1, 0
                held += size
                rows.append((key, n, (task << 32) + block, n_a, n_b, len(links) // 8, digest))
                pairs.append(pair)
                uses.append(use)
                offsets.append(offsets[-1] + len(pair))
            columns = list(zip(*rows)) if rows else [[]] * 7
            arrays = [pa.array(c, f.type) for c, f in zip(columns, _ALIGNED)]
            arrays += [lists(offsets, pairs, np.int64), lists(offsets, uses, np.int32)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_ALIGNED)

    return arrow_map(texts, run, _ALIGNED_SQL)


def block_pairs(aligned: DataFrame) -> DataFrame:
    """(block, pair, links): the links of each pair in each run of texts of a
    block, weighted by multiplicity. A block may have several such rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            copies = batch.column("copies").to_numpy()
            offsets = batch.column("pairs").offsets.to_numpy()
            pairs = batch.column("pairs").values.to_numpy()
            links = batch.column("uses").values.to_numpy() * np.repeat(copies, np.diff(offsets))
            starts = np.flatnonzero(np.diff(blocks, prepend=-1))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(blocks)]):
                here = slice(offsets[a], offsets[b])
                distinct, which = np.unique(pairs[here], return_inverse=True)
                # exact: sums of integers, not the doubles of bincount
                total = np.zeros(len(distinct), np.int64)
                np.add.at(total, which, links[here])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(distinct), blocks[a])), pa.array(distinct), pa.array(total)],
                    ["block", "pair", "links"],
                )

    return arrow_map(aligned, run, "block long, pair long, links long")


def pair_counts(parts: DataFrame) -> DataFrame:
    """(pair, count, best): a pair's links in all documents, and whether no
    other pair of the same B id has more. B ids are a vocabulary, so their
    table of largest counts is small."""
    counts = parts.groupBy("pair").agg(F.sum("links").alias("count"))
    b = F.col("pair").bitwiseAND(PAIR - 1)
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(F.broadcast(most), "b").select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best")
    )


#: Columns that a text's measures are added to.
_KEPT = ["key", "copies", "n_a", "n_b", "n_groups", "groups_sha256"]
_MEASURES_SQL = (
    "key string, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, "
    "n_links long, n_best long, count_sum long"
)


class PairCounts:
    """Counts of pairs, looked up by their number."""

    def __init__(self, table: pa.Table):
        table = table.select(["pair", "count", "best"]).sort_by("pair")
        self.pair = table.column("pair").to_numpy()
        self.count = table.column("count").to_numpy()
        self.best = table.column("best").to_numpy().astype(np.int64)

    def measure(self, texts: pa.Table | pa.RecordBatch) -> pa.Table:
        """The measures of texts, all of whose pairs are known here."""
        texts = texts if isinstance(texts, pa.Table) else pa.Table.from_batches([texts])
        pairs = texts.column("pairs").combine_chunks()
        uses = texts.column("uses").combine_chunks().flatten().to_numpy().astype(np.int64)
        sizes = pairs.value_lengths().to_numpy()
        ends = np.cumsum(sizes)
        where = np.searchsorted(self.pair, pairs.flatten().to_numpy())

        def per_text(values: np.ndarray) -> pa.Array:
            upto = np.concatenate([[0], np.cumsum(values)]).astype(np.int64)
            return pa.array(upto[ends] - upto[ends - sizes])

        out = texts.select(_KEPT).append_column("n_links", per_text(uses))
        out = out.append_column("n_best", per_text(uses * self.best[where]))
        return out.append_column("count_sum", per_text(uses * self.count[where]))


def measure_everywhere(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The measures of each distinct text, with all counts in every task."""
    known = aligned.sparkSession.sparkContext.broadcast(PairCounts(counts.toArrow()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from known.value.measure(batch).to_batches()

    return arrow_map(aligned, run, _MEASURES_SQL)


def measure_by_block(aligned: DataFrame, parts: DataFrame, counts: DataFrame) -> DataFrame:
    """The same with each block's own counts only."""
    answers = parts.select("block", "pair").distinct().join(counts, "pair")

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        return PairCounts(known).measure(texts)

    return aligned.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, _MEASURES_SQL)


def align_corpus(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_a: str = "byte_bpe_50k.json",
    vocabulary_b: str = "piece_bpe_32k.model",
    block_links: int = BLOCK_LINKS,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum and the
    SHA-256 of its groups."""
    spark = docs.sparkSession
    source = id_text(docs, id_col, text_col)

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    distinct = source.filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    distinct = distinct.select(
        "text", "copies", F.sha2("text", 256).alias("key"), F.spark_partition_id().cast("long").alias("task")
    )
    aligned = written(align_texts(distinct, vocabulary_a, vocabulary_b, block_links), "aligned")
    parts = written(block_pairs(aligned.filter(F.size("pairs") > 0)), "block-pairs")
    counts = written(pair_counts(parts), "pair-counts")
    if counts.count() <= broadcast_pairs:
        measures = written(measure_everywhere(aligned, counts), "measures")
    else:
        measures = written(measure_by_block(aligned, parts, counts), "measures")

    ids = written(source.select("doc_id", F.sha2("text", 256).alias("key")), "document-keys")
    hot = F.col("copies") >= max(1, math.ceil(ids.count() / HOT_SHARE))
    frequent, others = measures.filter(hot).drop("copies"), measures.filter(~hot).drop("copies")
    empty = hashlib.sha256(b"").hexdigest()
    texts = ids.filter(F.col("key") != empty)
    near = texts.join(F.broadcast(frequent), "key")  # at most HOT_SHARE rows
    rare = texts.join(F.broadcast(frequent.select("key")), "key", "left_anti")
    far = rare.join(others.hint("shuffle_merge"), "key")
    none = ids.filter(F.col("key") == empty).select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in _ZEROS], F.lit("").alias("groups_sha256")
    )
    columns = ["doc_id", *_ZEROS, "groups_sha256"]
    return near.select(*columns).unionByName(far.select(*columns)).unionByName(none)
