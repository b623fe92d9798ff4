"""Operators 11, 12, 13: ranked search, alignment, best-fit decreasing."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandlens.llm import align, best_fit, chunks, lexical
from tests.llm.conftest import CLASHING, ODD

ITEMS = [
    (1, "The quick brown fox, the lazy dog"),
    (2, "brown FOX the Call example org"),
    (2, "brown FOX the Call example org"),
    (3, None),
    (4, " ?! "),
    (None, "été naïve the"),
    (5, "word nobody wrote"),
    (6, "The quick brown fox x " + "1 " * 40),
]


def _rows(df, *columns):
    return sorted([tuple(r[c] for c in columns) for r in df.collect()], key=str)


def _texts(n, seed, words):
    rng = random.Random(seed)
    return [rng.choice([" ", " ", " ", "\n", "  "]).join(rng.choice(words) for _ in range(rng.randint(0, 25))) for _ in range(n)]


# --------------------------------------------------------------- search


def _search_plainly(docs, items, k=20):
    def terms(text):
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, c.total()) for d, c in counted if c]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in counted:
            m = 100 - 25 + (25 * n * n_docs) // total
            s = 0
            for t in terms(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                s += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) if c[t] else 0
            if s > 0:
                scores.append((s, d))
        scores.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, r, d, s) for r, (s, d) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def many_docs():
    words = ["The", "quick", "brown", "fox", "dog", "lazy", "call", "x", "1", "été", "Org"]
    return [(k % 90, t) for k, t in enumerate(_texts(120, 5, words))] + [(d, t) for d, t, _ in ODD]


@pytest.mark.parametrize(("k", "block_items"), [(20, 1024), (3, 1), (200, 3)])
def test_search_equals_brute_force(spark, many_docs, k, block_items):
    docs = spark.createDataFrame(many_docs, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = lexical.search(docs, items, k=k, block_items=block_items)
    assert _rows(got, "item_id", "rank", "doc_id", "score") == _search_plainly(many_docs, ITEMS, k)


def test_search_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for c in CLASHING + ["rank", "doc_id", "terms", "tfs", "n", "item"]:
        items = items.withColumn(c, F.lit("x"))
    got = _rows(lexical.search(odd_docs, items), "item_id", "rank", "doc_id", "score")
    assert got == _search_plainly([(d, t) for d, t, _ in ODD], ITEMS)
    assert lexical.search(no_docs, items).collect() == []
    assert lexical.search(odd_docs, items.limit(0)).collect() == []
    assert lexical.search(odd_docs.filter("text is null"), items).collect() == []


def test_small_accumulators_and_slices_change_nothing(spark, many_docs, monkeypatch):
    monkeypatch.setattr(lexical, "ACCUMULATOR_BYTES", 600)
    docs = spark.createDataFrame(many_docs, "doc_id long, text string").repartition(2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = _rows(lexical.search(docs, items), "item_id", "rank", "doc_id", "score")
    assert got == _search_plainly(many_docs, ITEMS)
    for _, text in many_docs:
        whole = [t for part in lexical.term_slices(text or "") for t in part]
        assert [t for part in lexical.term_slices(text or "", 7) for t in part] == whole


def _leaves(plan, node):
    if node < len(plan.leaves):
        return [plan.leaves[node]]
    return [x for p in plan.sums[node - len(plan.leaves)] for x in _leaves(plan, p)]


@pytest.mark.parametrize("segment", [2, 5, 64])
def test_mined_plan_keeps_every_item_and_shares(segment):
    rng = random.Random(segment)
    common = [rng.sample(range(40), 6) for _ in range(4)]
    items = []
    for _ in range(60):
        terms = set(rng.sample(range(200), rng.randint(0, 8))).union(*rng.sample(common, 2))
        items.append({t: rng.choice([1, 1, 2]) if t > 40 else 1 for t in terms})
    plan = lexical.mine(items)
    for terms, parts in zip(items, plan.items):
        found = [x for p in parts for x in _leaves(plan, p)]
        assert len(found) == len(terms) and dict(found) == terms
    for k, parts in enumerate(plan.sums):
        assert max(parts) < len(plan.leaves) + k
    assert plan.additions() < sum(max(0, len(t) - 1) for t in items)


def test_best_keeps_ties_in_order():
    best = lexical.Best(3)
    best.offer(np.array([5, 5, 0, 7, 5]), [9, 4, 1, 8, None])
    best.offer(np.array([5, 7, 4]), [2, 3, 0])
    assert best.rows == [(7, 3), (7, 8), (5, 2)]


# --------------------------------------------------------------- alignment


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def _align_plainly(docs, libraries):
    a, b = libraries
    of = chunks.byte_characters()
    aligned = []
    for doc, text in docs:
        data = (" " + (text or "")).encode()
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            piece = b.id_to_piece(i)
            raw = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            bytes_b.append(bytes.fromhex(raw[1]) if raw else piece.replace("▁", " ").encode())
        if not text or b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            aligned.append((doc, [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        both = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups, links = [], []
        cut_a, cut_b = [0, *np.searchsorted(ends_a, both) + 1], [0, *np.searchsorted(ends_b, both) + 1]
        for k in range(len(both)):
            left, right = ids_a[cut_a[k] : cut_a[k + 1]], ids_b[cut_b[k] : cut_b[k + 1]]
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
            links.append((left[-1], right[-1]))
        aligned.append((doc, (ids_a, ids_b), groups, links))
    counts = Counter(link for _, _, _, links in aligned for link in links)
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for doc, ids, groups, links in aligned:
        n_a, n_b = (len(ids[0]), len(ids[1])) if ids else (0, 0)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if ids else ""
        n_best = sum(counts[x] == most[x[1]] for x in links)
        out.append((doc, n_a, n_b, len(groups), len(links), n_best, sum(counts[x] for x in links), sha))
    return sorted(out, key=str)


MEASURES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize(("block_links", "broadcast_pairs"), [(1 << 20, 1 << 20), (100, 0), (1, 0)])
def test_alignment_equals_brute_force(spark, libraries, block_links, broadcast_pairs, monkeypatch):
    monkeypatch.setattr(align, "HOT_SHARE", 30)
    words = ["the", "The", "naïve", "'s", "中文", "<|endoftext|>", "</s>", "<0x41>", "▁x", "a1b", "\t", "😀", ",", "fox"]
    texts = _texts(80, 3, words) + _texts(40, 4, ["the", "quick", "fox", "été."])
    docs = [(k, t) for k, t in enumerate(texts)] + [(500 + k, texts[100]) for k in range(20)]
    docs += [(d, t) for d, t, _ in ODD]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = align.align_corpus(table, block_links=block_links, broadcast_pairs=broadcast_pairs)
    assert _rows(got, *MEASURES) == _align_plainly(docs, libraries)


def test_alignment_of_odd_and_empty_tables(spark, libraries, odd_docs, no_docs):
    for c in ("key", "copies", "block", "pairs", "count", "best"):
        odd_docs = odd_docs.withColumn(c, F.lit("x"))
    got = _rows(align.align_corpus(odd_docs), *MEASURES)
    assert got == _align_plainly([(d, t) for d, t, _ in ODD], libraries)
    assert align.align_corpus(no_docs).collect() == []
    assert align.align_corpus(no_docs, broadcast_pairs=-1).collect() == []
    blank = odd_docs.filter("text is null or text = ''")
    assert all(r[1:] == (0,) * 6 + ("",) for r in _rows(align.align_corpus(blank), *MEASURES))


def test_chunks_align_like_whole_texts():
    aligner = align.loaded("byte_bpe_50k.json", "piece_bpe_32k.model")
    assert aligner.chunked
    rng = random.Random(6)
    alphabet = ["a", "b", " ", " ", "\n", ".", "é", "中", "'s", "▁", "\t", "the", "<0x41>", "<|endoftext|>", "😀", "\x00"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(2000)]
    assert aligner(texts) == [aligner.whole(t) for t in texts]
    small = align.Aligner(*map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")), limit=2000)
    assert small(texts) == aligner(texts)
    assert small.memory.used < 2000 + 4 * chunks.ENTRY_BYTES


# --------------------------------------------------------------- packing


def _windows_plainly(lengths, capacity):
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [w for w in left if w >= n]
        if fits:
            left.remove(min(fits))
            left.append(min(fits) - n)
        else:
            left.append(capacity - n)
    return sorted(left)


@pytest.mark.parametrize("capacity", [1, 2, 7, 16, 100, 2048])
def test_best_fit_decreasing_equals_brute_force(capacity):
    rng = np.random.default_rng(capacity)
    for n in (0, 1, 2, 40, 400):
        lengths = np.minimum(capacity, rng.geometric(3 / (capacity + 2), n))
        window, offset = best_fit.best_fit_decreasing(lengths, capacity)
        filled = np.bincount(window, lengths).astype(int) if n else np.empty(0, int)
        assert sorted((capacity - filled).tolist()) == _windows_plainly(lengths.tolist(), capacity)
        for w in range(len(filled)):  # gapless from 0
            here = sorted(zip(offset[window == w].tolist(), lengths[window == w].tolist()))
            assert [o for o, _ in here] == np.cumsum([0, *[x for _, x in here][:-1]]).tolist()


def test_ranked_ids_equal_the_library(libraries):
    encode = chunks.ranked_encoder("byte_bpe_50k.json")
    texts = _texts(300, 8, ["the", "naïve", "'s", "中文", "<|endoftext|>", "\t", "\r\n", "😀", "x" * 99, "..."])
    for text in texts + [t or "" for _, t, _ in ODD]:
        ids = libraries[0].encode(text, add_special_tokens=False).ids
        assert encode(text) == np.array(ids, "<u4").tobytes()


def test_memory_is_bounded_by_bytes():
    encode = chunks.RankedEncoder(public_tokenizers.path("byte_bpe_50k.json"), limit=10_000)
    for k in range(500):
        encode(f"word{k} " + "z" * 500)
    assert encode.memory.used < 10_000 + 1000 and not any(len(c) > chunks.MEMORY_CHARS for c in encode.memory)


def test_packing_query_on_odd_rows(spark, libraries, odd_docs, no_docs):
    for c in ("offset", "sequence_id", "doc_tokens", "padded_length"):
        odd_docs = odd_docs.withColumn(c, F.lit("x"))
    rows = best_fit.pack(odd_docs, capacity=64, group_docs=5).collect()
    ids_of = Counter()
    for doc, text, _ in ODD:
        ids = libraries[0].encode(text or "", add_special_tokens=False).ids + [1]
        for start in range(0, len(ids), 64):
            part = ids[start : start + 64]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            ids_of[(doc, start, len(part), crc, len(ids))] += 1
    got = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    assert got == ids_of
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length, r.padded_length))
    for parts in by_sequence.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and {p for _, _, p in parts} == {at if at & (at - 1) == 0 else 64}
    assert best_fit.pack(no_docs).collect() == []


def test_packing_pads_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    packed = best_fit.pack(docs).groupBy("sequence_id").agg(
        F.sum("length").alias("tokens"), F.first("padded_length").alias("padded")
    )
    total = packed.agg(F.sum("tokens"), F.sum("padded"), F.max("tokens")).first()
    assert total[1] - total[0] <= 2 * 2048 and total[2] <= 2048
