"""Operators 1, 6, 7, 9: LZ fingerprints, Katz model, personal data, language."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from demandlens.llm import katz, langid, lz, pii
from demandlens.llm.lstm_crf import BiLstmCrf
from tests.llm.conftest import LONG, ODD

SF = "/root/testdata/sf0.01"


def _key(r):
    return tuple((x is not None, x) if x is None or isinstance(x, int) else (True, str(x)) for x in r)


# -- LZ fingerprints --------------------------------------------------------


def _phrases(text):
    seen, w, out = set(), "", []
    for c in text:
        w += c
        if w not in seen:
            seen.add(w)
            out.append(w)
            w = ""
    return out


def test_phrases_and_edited_signature():
    rng = random.Random(0)
    for _ in range(200):
        a = "".join(rng.choice("abé\U0001f600 ") for _ in range(rng.randint(0, 300)))
        b = "".join(rng.choice("abx ") for _ in range(rng.randint(0, 120)))
        p = lz.Parsed(a)
        assert [a[x:y] for x, y in zip([0, *p.ends], p.ends)] == _phrases(a)
        text, sig = p.edited(b)
        assert text == a[: len(a) - len(a) // 4] + b[: len(a) // 4]
        assert lz.to_hex(sig) == lz.fingerprint(text)


def test_likeness_estimates_jaccard():
    rng = random.Random(1)
    for share in (0.2, 0.5, 0.9):
        words = [f"{rng.getrandbits(40):x}" for _ in range(3000)]
        a = " ".join(words)
        b = " ".join(words[: int(share * 3000)] + [f"{rng.getrandbits(40):x}" for _ in range(3000 - int(share * 3000))])
        x, y = set(_phrases(a)), set(_phrases(b))
        got = lz.likeness(lz.Parsed(a).signature, lz.Parsed(b).signature)
        assert abs(got - len(x & y) / len(x | y)) < 0.25
    none = np.zeros(0, np.uint32)
    assert lz.likeness(none, none) == 1 and lz.likeness(none, lz.Parsed("a").signature) == 0


def test_fingerprint_query_on_odd_rows(odd_docs, no_docs, spark):
    rows = lz.compare(odd_docs).collect()
    from pyspark.sql import functions as F

    order = odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    order = [(r.doc_id, r.t) for r in order.orderBy("doc_id", "h").collect()]
    want = []
    for k, (d, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
        a, b, c = (lz.Parsed(x).signature for x in (t, edited, following))
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), lz.to_hex(a), lz.to_hex(b),
                     lz.likeness(a, b), lz.likeness(a, c)))
    assert sorted([tuple(r) for r in rows], key=_key) == sorted(want, key=_key)
    assert lz.compare(no_docs).count() == 0
    one = lz.compare(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abca").hexdigest() and one.near_next == 1


# -- Katz model -------------------------------------------------------------


def _katz(rows, order):
    docs = []
    for d, t in rows:
        held = d is not None and zlib.crc32(str(d).encode()) % 10 == 0
        docs.append((d, held, (t or "").encode().lower().split() + [b"\n"]))
    count = [None] + [Counter() for _ in range(order)]
    for _, held, w in docs:
        x = [b"\t"] * (order - 1) + w
        for i in range(order - 1, len(x)) if not held else ():
            for n in range(1, order + 1):
                count[n][tuple(x[i - n + 1 : i + 1])] += 1
    tokens, distinct = sum(count[1].values()), len(count[1])
    often = lambda n: [sum(v == r for v in count[n].values()) for r in range(1, katz.K + 2)]
    d = [None] + [katz.discounts(often(n)) for n in range(1, order + 1)]
    cut = lambda n, c: d[n][c if c <= katz.K else 0] * c
    lost = tokens - sum(cut(1, c) for c in count[1].values())
    base = tokens if lost >= 0.5 else tokens + 0.5 - lost
    unknown = max(lost, 0.5) / base
    following = defaultdict(dict)
    for n in range(2, order + 1):
        for g, c in count[n].items():
            following[g[:-1]][g[-1]] = c
    weights = {}

    def p(g):
        if len(g) == 1:
            return cut(1, count[1][g]) / base if count[1][g] else unknown
        seen, n = following.get(g[:-1]), len(g)
        if not seen:
            return p(g[1:])
        if g[:-1] not in weights:
            total, kept = sum(seen.values()), sum(cut(n, c) for c in seen.values())
            whole = total + 1 if total - kept <= 1e-9 * total else total
            weights[g[:-1]] = whole, (whole - kept) / whole / (1 - sum(p(g[1:-1] + (w,)) for w in seen))
        whole, weight = weights[g[:-1]]
        return cut(n, seen[g[-1]]) / whole if g[-1] in seen else weight * p(g[1:])

    words = [w for (w,) in count[1]] + [b"(unknown)"]
    for history in list(following)[:30] + [(b"(unknown)",) * (order - 1)]:
        assert abs(sum(p(history + (w,)) for w in words) - 1) < 1e-9
    out = []
    for doc, held, w in docs:
        x = [b"\t"] * (order - 1) + w
        model = sum(math.log10(p(tuple(x[i - order + 1 : i + 1]))) for i in range(order - 1, len(x)))
        plain = sum(math.log10((count[1][(t,)] + 0.1) / (tokens + 0.1 * (distinct + 1))) for t in w)
        out.append((doc, held, len(w), sum(count[1][(t,)] > 0 for t in w), tokens, plain, model))
    return out


def _same_scores(got, want):
    got, want = (sorted([tuple(r) for r in x], key=lambda r: str(r[:4])) for x in (got, want))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_katz_equals_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(katz, "PART_TOKENS", 3000)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 5000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id < 60").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = katz.score(docs.repartition(3), order=order).collect()
    _same_scores(got, _katz(rows, order))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_katz_on_odd_rows(odd_docs, no_docs, spark):
    _same_scores(katz.score(odd_docs).collect(), _katz([r[:2] for r in ODD], 2))
    assert katz.score(no_docs).count() == 0
    held = next(i for i in range(99) if katz.held_out(i))
    only = katz.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (only.n_tokens, only.n_known, only.train_tokens, only.score) == (3, 0, 0, 0.0)


def test_discounts_are_usable():
    d = katz.discounts([1000, 400, 220, 140, 100, 75])
    assert (0 < d[1:]).all() and (d[1:] < 1).all() and d[0] == 1
    assert ((katz.discounts([0, 5, 0, 0, 0, 9])[1:] > 0)).all()


def test_packed_arrays():
    for a in (np.arange(7, dtype=np.uint64) ** 9, np.zeros(0, np.uint64), np.array([3, 3, 9], np.uint64)):
        assert katz.unpack_sorted(katz.pack_sorted(a)).tolist() == a.tolist()


# -- personal data ----------------------------------------------------------

_BASE = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def _base(text):
    size = lambda s: len(re.sub("[^0-9]", "", s))
    checks = [
        lambda s: True,
        lambda s: all(int(x) <= 255 for x in s.split(".")),
        lambda s: 12 <= size(s) <= 19 and pii.luhn(re.sub("[^0-9]", "", s)),
        lambda s: 9 <= size(s) <= 15,
    ]
    return sorted(
        (m.start(), k, m.end()) for k, p in enumerate(_BASE) for m in re.finditer(p, text) if checks[k](m.group())
    )


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for alphabet in ("ab.@%-", "012.", "0123 -", "+0123456789 ().-", "a@.1+ 2-²"):
        for _ in range(400):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
            assert pii.base_spans(t) == _base(t), t
    assert pii.base_spans("4111 1111 1111 1111") == [(0, 2, 19)]


def test_patterns_take_linear_time():
    assert pii.base_spans("a" * 200_000 + " " + "1" * 200_000) == []
    assert pii.base_spans("a@" * 50_000) == []
    assert pii.base_spans("1." * 2 + "1" * 100_000) == []


def test_gradient_and_decoding_of_the_tagger():
    rng = np.random.default_rng(0)
    model = BiLstmCrf(5, np.ones((3, 3), bool), np.ones(3, bool), embed=3, hidden=4)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    ids, tags = rng.integers(0, 5, (4, 6)), rng.integers(0, 3, (4, 6))
    _, grad = model.loss_and_gradient(ids, tags)
    for k, v in model.p.items():
        at = tuple(rng.integers(0, s) for s in v.shape)
        old, sides = v[at], []
        for e in (1e-5, -1e-5):
            v[at] = old + e
            sides.append(model.loss_and_gradient(ids, tags)[0])
        v[at] = old
        assert abs(grad[k][at] - (sides[0] - sides[1]) / 2e-5) < 1e-6
    emit = model.emissions(ids[:1])
    trans = model.p["t"] + model.mask
    paths = {p: sum(emit[t, 0, x] for t, x in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:])) for p in itertools.product(range(3), repeat=6)}
    assert tuple(model.viterbi(emit[:, 0])) == max(paths, key=paths.get)
    total = np.logaddexp.reduce(list(paths.values()))
    share = sum(math.exp(v - total) for p, v in paths.items() if p[2] == 1)
    assert abs(model.marginals(emit)[2, 0, 1] - share) < 1e-9


@pytest.fixture(scope="module")
def tagger():
    model = BiLstmCrf(pii.SYMBOLS, *pii._allowed())
    model.fit(*pii.training_windows(["some plain words of a text, nothing else. " * 9]), steps=200)
    return model


def test_tagger_adds_local_forms_and_leaves_clean_text(tagger):
    texts = [
        "please call me at (830) 555-5433 or write to a.b@c.de soon",
        "nothing here but 2015-01-15 10:22 deadbeef12345678 and version 1.2.3",
        "",
        "no anchors at all",
    ]
    got = pii.annotate(tagger, texts)
    assert (18, 3, 32) in got[0][1] and (18, 3, 32) not in got[0][0]
    assert [f for _, f in got[1:]] == [[], [], []]
    for base, full in got:
        assert set(base) <= set(full)


def test_windows_are_reconciled(tagger):
    """The tagging of a stretch does not depend on where windows begin."""
    text = "word " * 40 + "call (830) 555-5433 now " + "word " * 40
    for shift in range(0, 40, 7):
        spans = pii.tagged_spans(tagger, ["y" * shift + " " + text])[0]
        assert [(s - shift - 1, k) for s, k, _ in spans] == [(205, 3)]


def test_pii_query_and_masking_on_odd_rows(odd_docs, no_docs, spark):
    rows = pii.find(odd_docs).collect()
    want = []
    for d, t, _ in ODD:
        base = _base(t or "")
        want.append((d, *(sum(s[1] == k for s in base) for k in range(4)), hashlib.sha256(pii.span_string(base).encode()).hexdigest()))
    assert sorted([tuple(r)[:6] for r in rows], key=_key) == sorted(want, key=_key)
    masked = pii.redact(odd_docs)
    assert masked.columns == odd_docs.columns and masked.dtypes == odd_docs.dtypes
    got = {r.doc_id: r for r in masked.collect()}
    assert got[5].text == "Call <PHONE> or <EMAIL> now, please." and got[5].n_chars == len(got[5].text)
    assert got[1].text is None and got[9].text == LONG
    assert pii.find(no_docs).count() == 0 and pii.redact(no_docs).count() == 0
    assert pii.mask("abcdef", [(1, 0, 3), (2, 3, 4)]) == "a<EMAIL>ef"


# -- language ---------------------------------------------------------------


def _segmentations(word, index):
    if not word:
        yield []
    for j in range(1, len(word) + 1):
        if word[:j] in index:
            for rest in _segmentations(word[j:], index):
                yield [index[word[:j]], *rest]


def test_forward_sums_all_segmentations():
    name = "byte_bpe_multi_50k.tiktoken"
    index, _ = langid.pieces(name)
    rng = np.random.default_rng(1)
    prob = np.vstack([rng.dirichlet(np.ones(max(index.values()) + 1), 2).T, np.zeros((1, 2))])
    for word in ("the", "été", "queue"):
        coded = b" " + word.encode()
        want = sum(np.prod(prob[ids], axis=0) for ids in _segmentations(coded, index))
        assert np.allclose(langid.log_words([word], prob, name)[0], np.log(want))
        assert np.allclose(langid._long_word(coded, prob, name), np.log(want))
    long = "abcdefgh" * 30
    assert np.isfinite(langid.log_words([long], prob, name)).all()


def _log_forward(word, prob, index):
    sums = [np.zeros(prob.shape[1])]
    for j in range(1, len(word) + 1):
        ways = [sums[i] + np.log(prob[index[word[i:j]]]) for i in range(max(0, j - 64), j) if word[i:j] in index]
        sums.append(np.logaddexp.reduce(ways))
    return sums[-1]


def test_long_words_of_any_length_are_scored_whole():
    name = "byte_bpe_multi_50k.tiktoken"
    index, _ = langid.pieces(name)
    rng = np.random.default_rng(2)
    prob = np.vstack([rng.dirichlet(np.ones(max(index.values()) + 1), 3).T, np.zeros((1, 3))])
    words = ["中文" * k for k in (6, 7, 30)] + ["abcdefgh" * 9, "é" * 90, "x" * 300, "日本語" * 99, "a"]
    got = langid.log_words(words, prob, name)
    assert np.allclose(got, [_log_forward(b" " + w.encode(), prob, index) for w in words])


def test_long_words_are_learned_from(monkeypatch):
    name = "byte_bpe_multi_50k.tiktoken"
    counts = {("zh", "中国人民的历史和文化是什么样子呢"): 3, ("zh", "他们说我们不知道" * 20): 1}
    counts |= {("ja", "これは日本語の文章です。".strip("。") * 3): 2, ("en", "the"): 5, ("en", "queue"): 2}
    prob = langid.fit_pieces(counts, ["en", "ja", "zh"], name)
    assert langid.log_words(["我们知道中国的历史文化"], prob, name)[0].argmax() == 2
    assert langid.log_words(["これは文章"], prob, name)[0].argmax() == 1
    # both ways of expectation give the same, and parts of a word are all of it
    monkeypatch.setattr(langid, "LONG_WORD", 4)
    assert np.allclose(prob, langid.fit_pieces(counts, ["en", "ja", "zh"], name))
    word = ("é" * 500 + "中" * 77).encode()
    parts = langid._parts(word)
    assert b"".join(parts) == word and all(p.decode() and len(p) <= langid.VERY_LONG_WORD for p in parts)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 100
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_on_odd_rows(odd_docs, no_docs):
    got = {}
    for r in langid.identify(odd_docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[5]) == 2 and len(got[None]) == 2
    assert [got[k][0].lang_pred for k in (1, 2, 3, 4)] == ["und"] * 4
    assert got[9][0].lang_pred == "en"
    assert got[7][0].held_out == (zlib.crc32(b"7") % 4 == 2)
    assert langid.identify(no_docs).count() == 0
    blind = langid.identify(odd_docs.withColumn("lang", odd_docs["lang"].substr(9, 0)).filter("lang is null"))
    assert {r.lang_pred for r in blind.collect()} == {"und"}


# -- personal data, whole texts -----------------------------------------------


def test_best_path_of_the_whole_text_is_found_in_parts():
    """What is skipped is outside on the best path of the whole text."""
    rng = np.random.default_rng(4)
    skipped = 0
    for seed in range(6):
        model = BiLstmCrf(pii.SYMBOLS, *pii._allowed(), seed=seed)
        model.p["t"] = rng.standard_normal((pii.TAGS, pii.TAGS)).astype(np.float32)
        emit = rng.standard_normal((600, pii.TAGS)).astype(np.float32) * 4
        emit[:, 0] += rng.choice([0, 14], (12, 1), p=[0.2, 0.8]).repeat(50, 0)[:, 0]
        whole = model.viterbi(emit)
        parts = np.zeros_like(whole)
        for a, b in pii._around(pii.unsure(model, emit)):
            parts[a:b] = model.viterbi(emit[a:b])
        assert (parts == whole).all() and whole.any()
        skipped += (~pii.unsure(model, emit)).sum()
    assert skipped > 100


def test_paths_together_equal_paths_one_by_one():
    rng = np.random.default_rng(9)
    model = BiLstmCrf(pii.SYMBOLS, *pii._allowed())
    model.p["t"] = rng.standard_normal((pii.TAGS, pii.TAGS)).astype(np.float32)
    emits = [rng.standard_normal((n, pii.TAGS)).astype(np.float32) * 4 for n in rng.integers(1, 70, 40)]
    emits += [np.empty((0, pii.TAGS), np.float32)]
    for together in (1, 7, 64):
        for emit, path in zip(emits, model.best_paths(emits, together)):
            assert len(emit) == len(path) and (not len(emit) or (path == model.viterbi(emit)).all())
        for emit, sure in zip(emits, model.all_marginals(emits, together)):
            assert len(emit) == len(sure)
            if len(emit):
                assert np.allclose(sure, model.marginals(emit[:, None].astype(np.float64))[:, 0])


def test_windows_cover_every_character():
    """Averaged emissions of a text are those of its windows, whatever lies
    beside it and however few windows are tagged together."""
    model = BiLstmCrf(pii.SYMBOLS, *pii._allowed())
    rng = np.random.default_rng(3)
    sizes = (1, pii.STEP - 1, pii.STEP, pii.STEP + 1, pii.SPAN, pii.SPAN + 1, pii.SPAN + pii.STEP, 2000)
    texts = ["".join(rng.choice(list("ab1 @.é"), n)) for n in sizes]
    for text, got in zip(texts, pii._emissions(model, texts)):
        room = len(text) + 2 * pii.SPAN
        sums, weights = np.zeros((room, pii.TAGS)), np.zeros((room, 1))
        padded = np.full(len(sums), 32, np.uint8)
        padded[: len(text)] = pii.symbols(text)
        at = 0
        while True:
            window = model._run(padded[None, at : at + pii.SPAN].astype(np.int64))[0][:, 0]
            sums[at : at + pii.SPAN] += window * pii._WEIGHT
            weights[at : at + pii.SPAN] += pii._WEIGHT
            if at + pii.SPAN >= len(text):
                break
            at += pii.STEP
        assert np.allclose(got, (sums / np.maximum(weights, 1))[: len(text)], atol=1e-3)


def test_fast_emissions_equal_those_of_training():
    model = BiLstmCrf(pii.SYMBOLS, *pii._allowed())
    ids = np.random.default_rng(1).integers(0, pii.SYMBOLS, (5, pii.WINDOW))
    assert np.abs(model.emissions(ids) - model._run(ids)[0]).max() < 1e-4


def test_windows_cost_what_they_hold(monkeypatch):
    """The blanks that fill up a text's last window are not run through the
    network; their effect on the text is that of a filled-up window."""
    model = BiLstmCrf(pii.SYMBOLS, *pii._allowed())
    ids = np.random.default_rng(2).integers(0, pii.SYMBOLS, (3, 40))
    filled = np.concatenate([ids, np.full((3, 60), pii.BLANK)], axis=1)
    got = model.emissions(ids, model.after(pii.BLANK, 60)[60])
    assert np.abs(got - model._run(filled)[0][:40]).max() < 1e-4
    run, read = BiLstmCrf.emissions, []
    monkeypatch.setattr(BiLstmCrf, "emissions", lambda self, ids, *more: read.append(np.size(ids)) or run(self, ids, *more))
    texts = ["a few words"] * 400 + ["b" * (pii.SPAN + pii.STEP // 4)] * 400
    pii._emissions(model, texts)
    assert sum(read) < 1.3 * sum(map(len, texts))


def test_unsure_characters_are_those_of_every_possible_span():
    rng = np.random.default_rng(8)
    model = BiLstmCrf(pii.SYMBOLS, *pii._allowed())
    model.p["t"] = rng.standard_normal((pii.TAGS, pii.TAGS)).astype(np.float32)
    enter, inner, leave = (x[:, 0].astype(np.float64) for x in pii._gains(model))
    for n in (1, 2, 30):
        emit = rng.standard_normal((n, pii.TAGS)).astype(np.float32) * 4
        emit[:, 0] += 6
        want = np.zeros(n, bool)
        for k in range(len(pii.KINDS)):
            for a in range(n):
                gain = emit[a, 1 + 2 * k] - emit[a, 0] + (enter[k] if a else max(enter[k], 0)) + leave[k]
                for b in range(a, n):
                    if b > a:
                        gain += emit[b, 2 + 2 * k] - emit[b, 0] + inner[k]
                    if gain > -1e-3:
                        want[a : b + 1] = True
        assert (pii.unsure(model, emit) == want).all()


def test_tagger_reads_whole_texts():
    """Spelled-out data, digits of other scripts and short forms, also where no
    ASCII digit or at sign is near; ordinary words stay."""
    model = BiLstmCrf(pii.SYMBOLS, *pii._allowed())
    source = ["some plain words of a text, nothing else. At home one of the two dogs sat near three cats. " * 4]
    model.fit(*pii.training_windows(source), steps=1200)
    plain = "some plain words of a text, nothing else. At home one of the two dogs sat near three cats. "
    for kind, span in (
        (0, "jane (at) example (dot) com"), (3, "five five five one two three four five six seven"),
        (3, "٨٣٠-٥٥٥-٥٤٣٣"), (3, "8305555433"), (1, "fe80::1"), (1, "::1"),
    ):
        text = f"{plain}call {span} now. {plain}"
        assert pii.annotate(model, [text])[0] == ([], [(len(plain) + 5, kind, len(plain) + 5 + len(span))]), span
    assert pii.annotate(model, [plain * 30, "", "x"]) == [([], [])] * 3
