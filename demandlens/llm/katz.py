"""Katz back-off language model in partitioned count tables.

Counts of n-grams are discounted by Good-Turing (counts up to ``K``); what a
history's continuations lose goes to shorter n-grams, with back-off weights
that make every history sum to one exactly. Unigrams leave their lost mass to
one unknown word. ``score`` evaluates the model recursively per token.

How it runs: documents become parts of a bounded number of tokens, written
once with their tokens as local numbers. A part sends each distinct n-gram
(64-bit hash) with its training count once to a hash bucket; a bucket adds up
the counts and answers every part in the order it asked, naming one part the
owner of the n-gram. Owners sum discounted probability per history and send
these sums to the history's bucket, which answers with back-off weights. So
only distinct n-grams per part are shuffled (a frequent word or pair is one
entry per part, never a hot key), answers live in Parquet tables by bucket and
part in the shared folder, and memory is bounded by part and bucket.

Results for odd input: null and empty texts are the end token alone; rows
without an id are trained on and not held out; repeated rows stay and count;
without training text the only word is the unknown one, of probability 1.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.common import arrow_map, id_text
from demandlens.session import scratch_path

#: Counts up to this one are discounted.
K = 5
#: Tokens of a part, and tokens of the input for each bucket.
PART_TOKENS, BUCKET_TOKENS = 1 << 20, 1 << 20
#: Hashes of the end token and of the place before a text; no word has white space.
END, START = xxhash.xxh64_intdigest(b"\n"), xxhash.xxh64_intdigest(b"\t")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pack(a: np.ndarray) -> bytes:
    """Byte planes, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T if len(a) else a
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (a >> np.uint64(31))) * _M1 + b * _M2
    h ^= h >> np.uint64(29)
    h *= _M1
    return h ^ (h >> np.uint64(32))


def held_out(doc_id: int | None, parts: int = 10) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == 0


def _encode_parts(docs: DataFrame) -> DataFrame:
    """One row per part: its documents, their sizes in tokens, the distinct
    word hashes and the tokens as ranks by frequency."""

    def run(batches):
        task = TaskContext.get().partitionId()
        digest, end = xxhash.xxh64_digest, END.to_bytes(8, "big")
        serial, size = 0, 0
        ids: list = []
        sizes: list[int] = []
        raw: list[bytes] = []

        def close():
            nonlocal serial, size, ids, sizes, raw
            hashes = np.frombuffer(b"".join(raw), ">u8").astype(np.uint64)
            words, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable").astype(np.uint32)  # rank -> word
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            out = pa.RecordBatch.from_pydict({
                "part": pa.array([(task << 32) + serial], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "sizes": pa.array([sizes], pa.list_(pa.int64())),
                "n": pa.array([size], pa.int64()),
                "words": pa.array([pack_sorted(words)], pa.binary()),
                "ranks": pa.array([pack(order)], pa.binary()),
                "tokens": pa.array([pack(rank[inverse])], pa.binary()),
            })
            serial, size, ids, sizes, raw = serial + 1, 0, [], [], []
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = text.encode().lower().split()
                if ids and size + len(words) + 1 > PART_TOKENS:
                    yield close()
                ids.append(doc)
                sizes.append(len(words) + 1)
                raw.append(b"".join([digest(w) for w in words]) + end)
                size += len(words) + 1
        if ids:
            yield close()

    return arrow_map(
        docs,
        run,
        "part long, doc_ids array<long>, sizes array<long>, n long, words binary, ranks binary, tokens binary",
    )


class Part:
    """A part decoded: per level its distinct n-grams (sorted hashes), the
    n-gram of each token, its history and its suffix one level below."""

    def __init__(self, row: dict, order: int):
        self.doc_ids, self.sizes = row["doc_ids"], np.asarray(row["sizes"])
        words = unpack_sorted(row["words"])
        token = words[unpack(row["ranks"], np.uint32)][unpack(row["tokens"], np.uint32)]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        self.held = np.array([held_out(d) for d in self.doc_ids], bool)
        train = np.repeat(~self.held, self.sizes)
        # how many tokens stand before a token in its document
        place = np.arange(len(token)) - np.repeat(self.starts, self.sizes)
        self.grams, self.of, self.counts = [], [], []
        self.histories: list = [None]
        self.history_of: list = [None]
        self.suffix_of: list = [None]
        history = None
        for n in range(1, order + 1):
            if n == 1:
                gram = token
            else:
                back = n - 1
                older = np.full(len(token), START, np.uint64)
                older[back:] = token[: max(0, len(token) - back)]
                older[place < back] = START
                history = older if n == 2 else _mix(older, history)
                gram = _mix(history, token) + np.uint64(n)
            distinct, first, inverse = np.unique(gram, return_index=True, return_inverse=True)
            self.grams.append(distinct)
            self.counts.append(np.bincount(inverse, train, len(distinct)).astype(np.int64))
            if n > 1:
                names, which = np.unique(history[first], return_inverse=True)
                self.histories.append(names)
                self.history_of.append(which)
                self.suffix_of.append(self.of[-1][first])
            self.of.append(inverse)

    def per_document(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts)


def _slices(hashes: np.ndarray, buckets: int):
    """(bucket, from, to) of sorted hashes, empty ones left out."""
    which = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    names, first = np.unique(which, return_index=True)
    return list(zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(hashes)]))


_ASK = "level int, bucket int, part long, hashes binary, a binary, b binary, c binary"
_ANSWER = "level int, bucket int, part long, a binary, b binary, stats array<long>"


def _batch(rows: list[tuple], schema: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(cols, schema)], [n for n, _ in schema]
    )


_BIN, _INT, _LONG = pa.binary(), pa.int32(), pa.int64()
_ASKED = [("level", _INT), ("bucket", _INT), ("part", _LONG), ("hashes", _BIN), ("a", _BIN), ("b", _BIN), ("c", _BIN)]
_ANSWERED = [("level", _INT), ("bucket", _INT), ("part", _LONG), ("a", _BIN), ("b", _BIN), ("stats", pa.list_(_LONG))]


def _ask_counts(parts: DataFrame, order: int, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                part = Part(row, order)
                out = []
                for n in range(order):
                    for k, a, b in _slices(part.grams[n], buckets):
                        out.append((
                            n + 1, k, row["part"], pack_sorted(part.grams[n][a:b]),
                            pack(part.counts[n][a:b].astype(np.uint32)), b"", b"",
                        ))
                yield _batch(out, _ASKED)

    return arrow_map(parts, run, _ASK)


def _answer_counts(key: tuple, asked: pa.Table) -> pa.Table:
    """Total training counts in the order of each part's question, and which
    n-grams the part owns; the row of part -1 has the bucket's statistics:
    tokens, distinct trained n-grams, and how many occur 1 to K + 1 times."""
    rows = sorted(asked.to_pylist(), key=lambda r: r["part"])
    hashes = [unpack_sorted(r["hashes"]) for r in rows]
    counts = [unpack(r["a"], np.uint32) for r in rows]
    _, first, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    total = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
    owner = np.zeros(len(inverse), bool)
    owner[first] = True
    out, at = [], 0
    level, bucket = key[0].as_py(), key[1].as_py()
    for r, h in zip(rows, hashes):
        span = slice(at, at + len(h))
        out.append((level, bucket, r["part"], pack(total[inverse[span]]), np.packbits(owner[span]).tobytes(), None))
        at += len(h)
    often = [int((total == r).sum()) for r in range(1, K + 2)]
    out.append((level, bucket, -1, None, None, [int(total.sum()), int((total > 0).sum()), *often]))
    return pa.Table.from_batches([_batch(out, _ANSWERED)])


def _answer_histories(key: tuple, asked: pa.Table) -> pa.Table:
    """Denominator and back-off weight of each history asked for. Where the
    discounts leave nothing, one is added to the denominator."""
    rows = asked.to_pylist()
    hashes = [unpack_sorted(r["hashes"]) for r in rows]
    _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    total, kept, below = (
        np.bincount(inverse, np.concatenate([unpack(r[c], np.float64) for r in rows])) for c in "abc"
    )
    denominator = np.where((total > 0) & (total - kept <= 1e-9 * total), total + 1, total)
    left = (denominator - kept) / np.maximum(denominator, 1)
    weight = np.where(total > 0, left / np.maximum(1 - below, 1e-300), 1.0)
    out, at = [], 0
    for r, h in zip(rows, hashes):
        own = inverse[at : at + len(h)]
        out.append((-key[0].as_py(), key[1].as_py(), r["part"], pack(denominator[own]), pack(weight[own]), None))
        at += len(h)
    return pa.Table.from_batches([_batch(out, _ANSWERED)])


def discounts(often: list[int]) -> np.ndarray:
    """Good-Turing discount of the counts 0 to K (index), from how many
    n-grams occur 1 to K + 1 times; where the counts of counts give no factor
    between 0 and 1, half a count is taken off."""
    out = np.ones(K + 1)
    n = [0, *often]
    common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        d = 0.0
        if common < 1 and n[r]:
            d = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class Model:
    """The statistics of all levels and the recursive evaluation in a part."""

    def __init__(self, stats: dict[int, list[int]], order: int):
        self.order = order
        self.tokens, self.distinct = stats.get(1, [0, 0])[:2]
        self.d = {n: discounts(stats.get(n, [0] * (K + 3))[2:]) for n in range(1, order + 1)}
        often = stats.get(1, [0] * (K + 3))[2:]
        lost = sum((1 - self.d[1][r]) * r * often[r - 1] for r in range(1, K + 1))
        self.unknown = max(lost, 0.5) / max(self.tokens + max(0.5 - lost, 0), 0.5)
        # without rare words half a count is lent to the unknown word
        self.base = max(self.tokens + max(0.5 - lost, 0), 0.5)

    def discounted(self, n: int, counts: np.ndarray) -> np.ndarray:
        return self.d[n][np.where(counts <= K, counts, 0)] * counts

    def probability(self, part: Part, answers: dict, n: int) -> np.ndarray:
        """Probability of each distinct n-gram's last word after its history."""
        counts = answers[n][0]
        if n == 1:
            seen = self.discounted(1, counts) / self.base
            return np.where(counts > 0, seen, self.unknown)
        denominator, weight = (x[part.history_of[n - 1]] for x in answers[-n])
        shorter = self.probability(part, answers, n - 1)[part.suffix_of[n - 1]]
        seen = self.discounted(n, counts) / np.maximum(denominator, 1)
        return np.where(counts > 0, seen, weight * shorter)


def _collect(part: Part, rows: list[dict]) -> dict:
    """Answers of a part by level: (counts, owned), and below zero
    (denominators, weights) of the level's histories."""
    out: dict = {}
    for level in {r["level"] for r in rows}:
        own = sorted((r for r in rows if r["level"] == level), key=lambda r: r["bucket"])
        if level > 0:
            counts = [unpack(r["a"], np.int64) for r in own]
            owned = [
                np.unpackbits(np.frombuffer(r["b"], np.uint8))[: len(c)].astype(bool)
                for r, c in zip(own, counts)
            ]
            out[level] = (np.concatenate(counts), np.concatenate(owned))
        else:
            out[level] = tuple(np.concatenate([unpack(r[c], np.float64) for r in own]) for c in "ab")
    return out


def _ask_histories(parts: DataFrame, answers: DataFrame, model: Model, n: int, buckets: int) -> DataFrame:
    """Sums over the owned n-grams of each history: counts, discounted counts,
    probabilities one level below."""
    order = model.order

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for row in left.to_pylist():
            part = Part(row, order)
            got = _collect(part, right.to_pylist())
            counts, owned = got[n]
            use = owned & (counts > 0)
            where, size = part.history_of[n - 1], len(part.histories[n - 1])
            below = model.probability(part, got, n - 1)[part.suffix_of[n - 1]]
            sums = [
                np.bincount(where, np.where(use, v, 0.0), size)
                for v in (counts, model.discounted(n, counts), below)
            ]
            for k, a, b in _slices(part.histories[n - 1], buckets):
                out.append((n, k, row["part"], pack_sorted(part.histories[n - 1][a:b]), *(pack(s[a:b]) for s in sums)))
        return pa.Table.from_batches([_batch(out, _ASKED)])

    return parts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(run, _ASK)


def _evaluate(parts: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    order = model.order
    names = [("doc_id", _LONG), ("held_out", pa.bool_()), ("n_tokens", _LONG), ("n_known", _LONG),
             ("train_tokens", _LONG), ("base_score", pa.float64()), ("score", pa.float64())]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for row in left.to_pylist():
            part = Part(row, order)
            got = _collect(part, right.to_pylist())
            counts = got[1][0]
            spread = model.tokens + 0.1 * (model.distinct + 1)
            base = np.log10((counts + 0.1) / spread)[part.of[0]]
            logs = np.log10(model.probability(part, got, order))[part.of[-1]]
            n = len(part.doc_ids)
            columns = [
                part.doc_ids, part.held, part.sizes, part.per_document((counts > 0)[part.of[0]].astype(np.int64)),
                np.full(n, model.tokens), part.per_document(base), part.per_document(logs),
            ]
            tables.append(pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, names)], [x for x, _ in names]))
        return pa.Table.from_batches(tables or [_batch([], names)])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return parts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(run, schema)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """Scores every document with the model of the documents not held out:
    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    root = scratch_path(spark, "katz")
    _encode_parts(id_text(docs, id_col, text_col)).write.parquet(f"{root}/parts")
    parts = spark.read.parquet(f"{root}/parts")
    total = parts.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_TOKENS))
    asked = _ask_counts(parts, order, buckets)
    asked.groupBy("level", "bucket").applyInArrow(_answer_counts, _ANSWER).write.parquet(f"{root}/counts")
    answers = spark.read.parquet(f"{root}/counts")
    stats: dict[int, list[int]] = {}
    sums = [F.sum(F.col("stats")[k]) for k in range(K + 3)]
    for level, *row in answers.filter("part = -1").groupBy("level").agg(*sums).collect():
        stats[level] = row
    model = Model(stats, order)
    answers = answers.filter("part >= 0").select("level", "bucket", "part", "a", "b")
    for n in range(2, order + 1):
        asked = _ask_histories(parts, answers, model, n, buckets)
        path = f"{root}/histories-{n}"
        asked.groupBy("level", "bucket").applyInArrow(_answer_histories, _ANSWER).write.parquet(path)
        answers = answers.union(spark.read.parquet(path).select(*answers.columns))
    return _evaluate(parts, answers, model)
