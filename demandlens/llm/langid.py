"""Language identification by unigram pieces, summed over all segmentations.

Every word is a blank plus its lower-case letters in UTF-8; the pieces are the
entries of a fixed public byte-level vocabulary, whose single bytes make every
word segmentable. A language has one probability per piece; the probability of
a word is the sum over all its segmentations (forward algorithm), and that of
a text the product over its words. Piece probabilities are learned with
expectation maximisation (forward-backward over the distinct words of a
bounded sample, of every length; words above ``VERY_LONG_WORD`` bytes in parts
of at most that size), smoothed with the mean of all languages and a uniform
share.

Results for odd input: a text that is null or has no letter is ``und`` with
score 0, as is every text if no labelled row can be learned from; equal
scores go to the language that sorts first; repeated rows stay.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.bpe_tree import load_ranks
from demandlens.llm.common import arrow_map

UNKNOWN = "und"
#: Labelled documents of a language that the model is fitted on (expected).
SAMPLE_DOCS = 400
ROUNDS = 4
#: Shares of the mean of all languages and of the uniform distribution.
SHARED, UNIFORM = 0.02, 0.01
#: Distinct chunks that a worker remembers; then it starts anew (memory bound).
CACHE_ENTRIES = 500_000
#: Words above so many bytes go together in batches of any lengths, those above
#: so many alone, rescaled on the way. Texts without blanks have such words.
LONG_WORD, VERY_LONG_WORD = 40, 240
#: Long words of a batch.
TOGETHER = 256
#: Bytes of a long word whose sums share a scale, as a power of two, and the
#: most such blocks that a piece (of 64 bytes) reaches back.
SCALED, REACH = 4, 5

_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


@lru_cache(2)
def pieces(vocabulary: str) -> tuple[dict[bytes, int], int]:
    """(index of each piece, bytes of the longest one that letters can use)."""
    ranks = load_ranks(public_tokenizers.path(vocabulary))
    return ranks, min(64, max(map(len, ranks), default=1))


@lru_cache(2)
def reach(vocabulary: str) -> dict[bytes, int]:
    """Bytes of the longest piece by its first two bytes."""
    index, longest = pieces(vocabulary)
    out: dict[bytes, int] = {}
    for piece in index:
        if 1 < len(piece) <= longest:
            out[piece[:2]] = max(out.get(piece[:2], 1), len(piece))
    return out


def _lattice(words: list[bytes], n: int, vocabulary: str):
    """Spans (i, j) of words of n bytes and their piece ids, -1 for none."""
    index, longest = pieces(vocabulary)
    spans = [(i, j) for j in range(1, n + 1) for i in range(max(0, j - longest), j)]
    get = index.get
    ids = np.array([get(w[i:j], -1) for w in words for i, j in spans], np.int64)
    ids = ids.reshape(len(words), len(spans))
    used = [k for k in range(len(spans)) if (ids[:, k] >= 0).any()]
    return [(*spans[k], ids[:, k]) for k in used]


def _forward(lattice, m: int, n: int, prob: np.ndarray) -> np.ndarray:
    """alpha[j]: probability of the first j bytes, (n + 1, m, languages)."""
    alpha = np.zeros((n + 1, m, prob.shape[1]))
    alpha[0] = 1
    for i, j, ids in lattice:
        alpha[j] += alpha[i] * prob[ids]
    return alpha


class _Batch:
    """The pieces of some long words of any lengths, by where they end."""

    def __init__(self, words: list[bytes], vocabulary: str):
        (index, _), far = pieces(vocabulary), reach(vocabulary)
        get, reaches, found = index.get, far.get, []
        for w, word in enumerate(words):
            size = len(word)
            for i in range(size):
                stop = i + reaches(word[i : i + 2], 1)
                for j in range(i + 1, (stop if stop < size else size) + 1):
                    if (k := get(word[i:j])) is not None:
                        # end, word, bytes and piece as one number, in sorting order
                        found.append((j << 42) | (w << 27) | ((j - i) << 20) | k)
        keys = np.sort(np.array(found, np.int64))
        self.end, self.word, self.piece = keys >> 42, (keys >> 27) & 0x7FFF, keys & 0xFFFFF
        self.start = self.end - ((keys >> 20) & 0x7F)
        self.sizes = np.array([len(w) for w in words])
        self.cuts = np.searchsorted(self.end, np.arange(self.sizes.max() + 2)).tolist()

    def forward(self, prob: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(alpha, p, scale): alpha are the probabilities of the first bytes of
        each word (bytes + 1, words, languages); every 2^SCALED positions they
        get a new scale (blocks, words, languages; logarithms), so that words
        of any length stay in range. p are the pieces' probabilities times what
        the scales of their two ends differ by."""
        p = prob[self.piece]
        alpha = np.zeros((self.sizes.max() + 1, len(self.sizes), prob.shape[1]))
        alpha[0] = 1
        scale = np.zeros(((len(alpha) >> SCALED) + 1, *alpha.shape[1:]))
        shift, origin = np.ones_like(scale), self.start >> SCALED
        for j in range(1, len(alpha)):
            block = j >> SCALED
            if j & ((1 << SCALED) - 1) == 0:
                top = alpha[j - (1 << SCALED) : j].max(0)
                scale[block] = scale[block - 1] + np.log(np.where(top > 0, top, 1))
                near = slice(max(0, block - REACH), block + 1)  # no piece begins before
                shift[near] = np.exp(np.minimum(scale[near] - scale[block], 600))
            here = slice(self.cuts[j], self.cuts[j + 1])
            word = self.word[here]
            first = np.flatnonzero(np.diff(word, prepend=-1))
            if len(first):
                p[here] *= shift[origin[here], word]
                alpha[j, word[first]] = np.add.reduceat(alpha[self.start[here], word] * p[here], first)
        return alpha, p, scale

    def log_words(self, prob: np.ndarray) -> np.ndarray:
        alpha, _, scale = self.forward(prob)
        rows = np.arange(len(self.sizes))
        return np.log(alpha[self.sizes, rows]) + scale[self.sizes >> SCALED, rows]

    def expected(self, prob: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, (pieces, languages), for words that
        occur ``weight`` (words, languages) times."""
        alpha, p, _ = self.forward(prob)
        at = self.sizes, np.arange(len(self.sizes))
        beta = np.zeros_like(alpha)
        beta[at] = weight / np.maximum(alpha[at], 1e-300)
        for j in range(len(alpha) - 1, 0, -1):
            here = slice(self.cuts[j], self.cuts[j + 1])
            word = self.word[here]  # a start and a word occur once per end
            beta[self.start[here], word] += p[here] * beta[j, word]
        share = alpha[self.start, self.word] * p * beta[self.end, self.word]
        columns = [np.bincount(self.piece, share[:, k], len(prob)) for k in range(prob.shape[1])]
        return np.stack(columns, 1)


def _long_word(word: bytes, prob: np.ndarray, vocabulary: str) -> np.ndarray:
    """Log probability of one very long word, rescaled as the pass goes."""
    (index, longest), far = pieces(vocabulary), reach(vocabulary)
    ring = longest + 1
    window = np.zeros((ring, prob.shape[1]))  # alpha of position p at p % ring
    window[0] = 1
    scale = np.zeros(prob.shape[1])
    for i in range(len(word)):
        now = window[i % ring].copy()
        window[i % ring] = 0  # its place is that of position i + ring from here on
        for j in range(i + 1, min(len(word), i + far.get(word[i : i + 2], 1)) + 1):
            if (k := index.get(word[i:j])) is not None:
                window[j % ring] += now * prob[k]
        if i % 8 == 7:
            top = window.max(0)
            window /= top
            scale += np.log(top)
    return np.log(window[len(word) % ring]) + scale


def _parts(word: bytes) -> list[bytes]:
    """A very long word in parts that begin with a character."""
    out, at = [], 0
    while len(word) - at > VERY_LONG_WORD:
        stop = at + VERY_LONG_WORD
        while word[stop] & 0xC0 == 0x80:
            stop -= 1
        out.append(word[at:stop])
        at = stop
    return [*out, word[at:]]


def log_words(words: list[str], prob: np.ndarray, vocabulary: str) -> np.ndarray:
    """(words, languages) log probabilities. ``prob`` ends with a zero row."""
    out = np.zeros((len(words), prob.shape[1]))
    by_size: dict[int, list[int]] = {}
    coded = [b" " + w.encode() for w in words]
    for k, w in enumerate(coded):
        by_size.setdefault(len(w), []).append(k)
    long = sorted((n, k) for n, rows in by_size.items() if LONG_WORD < n <= VERY_LONG_WORD for k in rows)
    for at in range(0, len(long), TOGETHER):
        rows = [k for _, k in long[at : at + TOGETHER]]
        out[rows] = _Batch([coded[k] for k in rows], vocabulary).log_words(prob)
    for n, rows in by_size.items():
        if n > LONG_WORD:
            for k in rows if n > VERY_LONG_WORD else ():
                out[k] = _long_word(coded[k], prob, vocabulary)
            continue
        own = [coded[k] for k in rows]
        out[rows] = np.log(_forward(_lattice(own, n, vocabulary), len(own), n, prob)[n])
    return out


def fit_pieces(counts: dict[tuple[str, str], int], langs: list[str], vocabulary: str) -> np.ndarray:
    """(pieces + 1, languages) probabilities from (lang, word) counts by
    expectation maximisation; the last row is zero."""
    index, _ = pieces(vocabulary)
    size = max(index.values()) + 1
    column = {lang: k for k, lang in enumerate(langs)}
    by_size: dict[int, dict[str, np.ndarray]] = {}
    for (lang, word), n in counts.items():
        own = by_size.setdefault(len(word.encode()) + 1, {})
        own.setdefault(word, np.zeros(len(langs)))[column[lang]] += n
    groups, long = [], []
    for n, own in sorted(by_size.items()):
        words = [b" " + w.encode() for w in own]
        if n <= LONG_WORD:
            groups.append((n, len(words), _lattice(words, n, vocabulary), np.array(list(own.values()))))
        else:
            long += [(part, times) for w, times in zip(words, own.values()) for part in _parts(w)]
    batches = []
    for at in range(0, len(long), TOGETHER):
        words, times = zip(*long[at : at + TOGETHER])
        batches.append((_Batch(list(words), vocabulary), np.array(times)))
    prob = np.full((size + 1, len(langs)), 1 / size)
    prob[-1] = 0
    for _ in range(ROUNDS):
        expected = np.zeros_like(prob)
        for n, m, lattice, weight in groups:
            alpha = _forward(lattice, m, n, prob)
            beta = np.zeros_like(alpha)
            beta[n] = weight / np.maximum(alpha[n], 1e-300)
            for i, j, ids in reversed(lattice):
                beta[i] += prob[ids] * beta[j]
            for i, j, ids in lattice:
                share = alpha[i] * prob[ids] * beta[j]
                for k in range(len(langs)):
                    expected[:, k] += np.bincount(ids + 1, share[:, k], size + 1)[
                        np.r_[1 : size + 1, 0]
                    ]
        for batch, weight in batches:
            expected += batch.expected(prob, weight)
        expected[-1] = 0
        own = expected / np.maximum(expected.sum(0), 1e-300)
        mean = own.mean(1, keepdims=True)
        prob = (1 - SHARED - UNIFORM) * own + SHARED * mean + UNIFORM / size
        prob[-1] = 0
        prob /= prob.sum(0)
    return prob


class LanguageModel:
    """Piece probabilities and log priors; scores texts through a cache of
    blank-separated chunks."""

    def __init__(self, langs: list[str], prob: np.ndarray, prior: np.ndarray, vocabulary: str):
        self.langs, self.prob, self.prior, self.vocabulary = langs, prob, prior, vocabulary
        self._reset()

    def _reset(self) -> None:
        self.row: dict[str, int] = {}
        self.sums = np.zeros((1 << 14, len(self.langs) + 1))  # last column: letter words

    def __getstate__(self):
        return self.langs, self.prob, self.prior, self.vocabulary

    def __setstate__(self, state):
        self.__init__(*state)

    def _learn(self, chunks: list[str]) -> None:
        letters = [_LETTERS.findall(c) for c in chunks]
        distinct = {w: k for k, w in enumerate(dict.fromkeys(w for ws in letters for w in ws))}
        logs = log_words(list(distinct), self.prob, self.vocabulary)
        at = len(self.row)
        if at + len(chunks) > len(self.sums):
            more = np.zeros((max(len(self.sums), len(chunks)), self.sums.shape[1]))
            self.sums = np.concatenate([self.sums, more])
        owner = np.repeat(np.arange(len(chunks)), [len(ws) for ws in letters])
        if len(owner):
            picked = logs[[distinct[w] for ws in letters for w in ws]]
            np.add.at(self.sums[at : at + len(chunks), :-1], owner, picked)
        self.sums[at : at + len(chunks), -1] = [len(ws) for ws in letters]
        self.row.update(zip(chunks, range(at, at + len(chunks))))

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        if len(self.row) > CACHE_ENTRIES:
            self._reset()
        cut = [t.lower().replace("\n", " ").split(" ") for t in texts]
        new = list(set().union(*cut).difference(self.row)) if cut else []
        if new:
            self._learn(sorted(new))
        out = []
        for chunks in cut:
            total = self.sums[[self.row[c] for c in chunks]].sum(0)
            if not total[-1]:
                out.append((UNKNOWN, 0.0))
                continue
            logs = total[:-1] + self.prior
            best = int(logs.argmax())
            out.append((self.langs[best], float(1 / np.exp(logs - logs[best]).sum())))
        return out


def train(
    labelled: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken", sample_docs: int = SAMPLE_DOCS
) -> LanguageModel:
    """Fits on (text, lang) rows. About ``sample_docs`` documents of each
    language are drawn at random with a fixed seed; only their distinct words
    reach the driver."""
    rows = labelled.filter("lang is not null").groupBy("lang").count().orderBy("lang").collect()
    langs, counts = [r[0] for r in rows], [r[1] for r in rows]
    if not langs:
        return LanguageModel([], np.zeros((1, 0)), np.zeros(0), vocabulary)
    share = F.create_map(*[x for k, n in zip(langs, counts) for x in (F.lit(k), F.lit(sample_docs / n))])
    sample = labelled.filter("lang is not null and text is not null").filter(
        F.rand(seed=11) < share[F.col("lang")]
    )

    def count_words(batches):
        for batch in batches:
            found: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for w in words_of(text):
                    found[lang, w] = found.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in found], pa.string()),
                    pa.array([k[1] for k in found], pa.string()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                ["lang", "word", "n"],
            )

    words = (
        arrow_map(sample.select("lang", "text"), count_words, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    table = {
        (a, b): n
        for a, b, n in sorted(zip(*(words.column(c).to_pylist() for c in ("lang", "word", "n"))))
    }
    prior = np.log(np.array(counts) / sum(counts))
    return LanguageModel(langs, fit_pieces(table, langs, vocabulary), prior, vocabulary)


def predict(
    docs: DataFrame,
    model: LanguageModel,
    keep: list[str] | None = None,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The kept columns (default doc_id) with language and score, from text."""
    keep = ["doc_id"] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages

    def run(batches):
        own = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            got = own.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                [*keep, *names],
            )

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    return arrow_map(source, run, f"{schema}, `{names[0]}` string, `{names[1]}` double")


def remainder(id_col: str = "doc_id", parts: int = 4):
    return F.crc32(F.col(id_col).cast("string")) % parts


def identify(docs: DataFrame, held_out: int = 2, parts: int = 4) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Learned from labelled documents
    whose crc32(doc_id) mod ``parts`` is not ``held_out``."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    fold = F.coalesce(remainder(parts=parts) == held_out, F.lit(False))
    model = train(source.filter(~fold))
    return predict(source, model).select("doc_id", fold.alias("held_out"), "lang_pred", "score")
