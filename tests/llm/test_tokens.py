"""Operators 2, 3, 4: tree BPE, packing, Elias-Fano id files."""

import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from demandlens.llm import bpe_tree, chunks, ef_ids, packing
from demandlens.session import scratch_path
from tests.llm.conftest import ODD


def _texts(n, seed, alphabet="ab \n.,'sTté中1\t= "):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def ranks():
    return bpe_tree.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _u4(ids):
    return np.array(ids, "<u4").tobytes()


def _by_key(rows):
    return sorted([tuple(r) for r in rows], key=str)


def test_tree_encoding_equals_plain_encoding(ranks):
    plain = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    pieces = ["=" * 999, "a" * 4097, "abab" * 500, "naïveé" * 40, "-" * 63 + "x", "中文" * 99]
    pieces += ["".join(rng.choice("aeinst=- ") for _ in range(rng.randint(1, 120))) for _ in range(300)]
    for leaf in (1, 2, 8):
        tree = bpe_tree.TreeBpe(ranks, leaf)
        for p in pieces:
            ids = tree.encode(p.encode())
            assert ids == plain.encode_ordinary(p), p[:40]
            assert tree.decode(ids) == p.encode()


def test_heap_merging_equals_plain_merging(ranks):
    tree, rng = bpe_tree.TreeBpe(ranks), random.Random(2)
    for _ in range(200):
        data = bytes(rng.choice(b"aehtnr =") for _ in range(rng.randint(2, 33)))
        if data not in ranks:
            assert tree._merge_long(data) == tree.merge(data)


def test_cached_chunks_equal_the_library():
    for name, cut in (("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")):
        library = Tokenizer.from_file(public_tokenizers.path(name))
        library.encode_special_tokens = True
        coder = chunks.ChunkEncoder(
            chunks.LibraryCoder(public_tokenizers.path(name), "<u4"),
            {"byte": chunks.byte_chunks, "word": chunks.word_chunks}[cut],
        )
        texts = _texts(400, 3) + [r[1] or "" for r in ODD] + ["a <|endoftext|> b", "<|startoftext|>", " x", "x ", "\n"]
        for at in range(0, len(texts), 7):
            part = texts[at : at + 7]
            want = [_u4(library.encode(t, add_special_tokens=False).ids) for t in part]
            assert coder(part) == want


def test_bpe_query_on_odd_rows(odd_docs, no_docs, ranks):
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t, _ in ODD:
        ids = plain.encode_ordinary(t or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (_u4(ids), (t or "").encode())]
        want.append((d, len(ids), *sha))
    assert _by_key(bpe_tree.encode_decode(odd_docs).collect()) == _by_key(want)
    assert bpe_tree.encode_decode(no_docs).count() == 0
    kept = bpe_tree.encode_decode(odd_docs, with_ids=True).filter("doc_id = 7").first()
    assert plain.decode(kept.ids) == ODD[6][1]


def _naive_sum_of_squares(lengths, capacity):
    gaps = []  # residual gap per bin
    for n in sorted(lengths, reverse=True):
        best = None
        for g in sorted({g for g in gaps if n <= g < capacity}):
            after = gaps[:]
            after[after.index(g)] = g - n
            cost = sum(after.count(h) ** 2 for h in range(1, capacity))
            if best is None or cost < best[0]:
                best = (cost, g)
        if best:
            gaps[gaps.index(best[1])] -= n
        else:
            gaps.append(capacity - n)
    return sorted(gaps)


def test_packing_follows_the_sum_of_squares_rule():
    rng = random.Random(4)
    for _ in range(30):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(0, 40))]
        bins, offsets = packing.sum_of_squares(np.array(lengths, np.int64), 20)
        fill = {}
        for n, b, o in sorted(zip(lengths, bins.tolist(), offsets.tolist()), key=lambda x: (x[1], x[2])):
            assert fill.get(b, 0) == o
            fill[b] = o + n
        assert sorted(20 - f for f in fill.values()) == _naive_sum_of_squares(lengths, 20)


def test_packing_is_close_to_the_lower_bound():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 1025, 5000)
    bins, _ = packing.sum_of_squares(lengths)
    assert bins.max() + 1 <= 1.01 * -(-lengths.sum() // 1024)


def test_cut_lengths():
    assert packing.cut_lengths(5, 4) == [1, 4]
    assert packing.cut_lengths(8, 4) == [4, 4]
    assert packing.cut_lengths(4, 4) == [4]


def test_pack_on_odd_rows(odd_docs, no_docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rows = packing.pack(odd_docs, group_docs=4).collect()
    want = []
    for d, t, _ in ODD:
        ids, at = library.encode(t or "", add_special_tokens=False).ids + [2], 0
        for k, n in enumerate(packing.cut_lengths(len(ids), 1024)):
            want.append((d, k, at, n, zlib.crc32(_u4(ids[at : at + n]))))
            at += n
    assert _by_key(r[:5] for r in rows) == _by_key(want)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in by_sequence.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at
            at += n
        assert at <= 1024
    assert packing.pack(no_docs).count() == 0


def test_elias_fano_round_trip():
    rng = np.random.default_rng(6)
    for n, top in ((0, 0), (1, 0), (1, 10**12), (5, 3), (1000, 10), (1000, 10**6), (300, 2**40)):
        values = np.sort(rng.integers(0, top + 1, n))
        code = ef_ids.EliasFano.encode(values, top)
        back = ef_ids.EliasFano.from_bytes(code.to_bytes())
        assert back.all().tolist() == values.tolist()
        assert [back.select(i) for i in range(n)] == values.tolist()
        if n:
            bits = 8 * len(code.to_bytes()) - 8 * ef_ids._CODE.size
            assert bits <= n * (2.6 + max(0, np.log2((top + 1) / n))) + 64
    with pytest.raises(IndexError):
        code.select(300)


def test_blocks():
    data = ef_ids.write_block([None, -3, 8], [b"\1\0\2\0", b"", b"\7\0"], 2)
    block = ef_ids.Block(data)
    assert block.doc_ids == [None, -3, 8]
    assert [block.document(i).tolist() for i in range(3)] == [[1, 2], [], [7]]
    with pytest.raises(ValueError):
        ef_ids.Block(b"x" * 64)


def test_id_files_on_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    rows = ef_ids.write_and_read(odd_docs).collect()
    want = [library.encode(t or "", add_special_tokens=False).ids + [1] for _, t, _ in ODD]
    assert _by_key((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == _by_key(
        (d, len(x), zlib.crc32(_u4(x))) for (d, _, _), x in zip(ODD, want)
    )
    at = 0
    ordered = sorted(rows, key=lambda r: r.start)
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    ids = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert ids == sorted(ids)
    path = scratch_path(spark, "none")
    ef_ids.write_ids(no_docs, path)
    assert ef_ids.read_ids(spark, path).count() == 0


def test_plain_words_equal_the_library():
    """Every entry of the vocabulary as a word, and words of odd letters."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    coder = chunks.WordEndCoder(path, "<u2")
    letters = [chr(c) for c in range(0x21, 0x250) if not chr(c).isspace()]
    words = letters + [f"x{c}" for c in letters] + [f"{c}b." for c in letters]
    of = chunks.byte_characters()
    with open(path, encoding="utf-8") as f:
        entries = [k.removesuffix("</w>") for k in json.load(f)["model"]["vocab"]]
    for entry in entries:
        if all(c in of for c in entry):
            word = bytes(of[c] for c in entry).decode(errors="ignore")
            words += [word] if word and not any(c.isspace() for c in word) else []
    rng = random.Random(8)
    words += ["".join(rng.choice("abcXYéß.!?'1-") for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    plain = [(w, coder.plain(w)) for w in words]
    assert sum(ids is not None for _, ids in plain) > 40_000
    want = library.encode_batch_fast([w for w, ids in plain if ids is not None], add_special_tokens=False)
    for (w, ids), e in zip([x for x in plain if x[1] is not None], want):
        assert ids == np.array(e.ids, "<u2").tobytes(), w
    with pytest.raises(ValueError, match="do not fit"):
        chunks.WordEndCoder(path, "u1")


def test_word_encoder_equals_the_library_on_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = _texts(300, 7) + [t or "" for _, t, _ in ODD] + ["Don't stop, it's THE end...", "İstanbul\u0301 e\u0301"]
    for limit in (1 << 20, 2000):
        got = chunks.WordEncoder(path, "<u2", limit)(texts)
        want = library.encode_batch_fast(texts, add_special_tokens=False)
        assert got == [np.array(e.ids, "<u2").tobytes() for e in want]


def test_files_are_in_order_of_ids_and_split_rows_that_share_one(spark):
    rows = [(k * 7 % 300, f"text {k}") for k in range(300)] + [(5, "again")] * 200 + [(None, "none")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = scratch_path(spark, "ids")
    ef_ids.write_ids(docs, path)
    blocks = spark.read.parquet(path).orderBy("shard", "block").collect()
    found = [i for b in blocks for i in ef_ids.Block(bytes(b.data)).doc_ids]
    assert found == sorted([r[0] for r in rows], key=lambda i: (i is not None, i or 0))
    assert len({b.shard for b in blocks}) > 2 and max(b.n_docs for b in blocks) < 400
    starts = sorted((r.start, r.n_tokens) for r in ef_ids.read_ids(spark, path).collect())
    at = 0
    for start, n in starts:
        assert start == at
        at += n
