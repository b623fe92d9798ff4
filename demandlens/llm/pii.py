"""Personal data: fixed patterns plus spans of a BiLSTM-CRF tagger.

The base spans (email, ip, card, phone) come from fixed patterns and always
stay. The tagger is trained from labelled spans: base spans of a bounded
sample of documents, and written forms that the patterns miss (numbers in
local notation, other separators, digits of other scripts, addresses and
numbers spelled out in words) put into sampled contexts, beside look-alike
strings labelled as nothing. Overlapping windows over the whole text give
emissions, which are averaged per character (weighted towards window centres);
the best path of the whole text is decoded where it can leave "outside".
Tagger spans are added where they are confident, of a form of their kind
(spelled-out and short ones too) and clear of base spans.

Results for odd input: null and empty texts have no spans (hash of the empty
string); texts of any length are read whole, in windows; repeated rows stay.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.common import arrow_map, id_text
from demandlens.llm.lstm_crf import BiLstmCrf

KINDS = ("email", "ip", "card", "phone")
#: Length of training windows, length and step of the windows over a text, and
#: characters decoded around what may be a span.
WINDOW, SPAN, STEP, REACH = 64, 256, 224, 32
#: Windows tagged together (what fits a processor's cache) and mean marginal of
#: an added span.
TOGETHER, CONFIDENT = 384, 0.95
#: Characters whose emissions are held together, unless one text has more.
HELD = 1 << 20
#: Documents that training contexts and labelled spans are drawn from.
SAMPLE_DOCS = 400

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# the look-behind only skips starts inside a run of digits, which never match
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_DOTTED = re.compile(r"[0-9]\.[0-9]++\.[0-9]")  # stands in each of them
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of the address pattern, in linear time: a match's local part is
    the run of its characters that ends at the at sign."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        run = text[done:at]
        size = len(run) - len(run.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if size else None
        if domain:
            out.append((at - size, domain.end()))
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end), sorted."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text) if _DOTTED.search(text) else ():
        # a very long run of digits is no part of at most 255
        parts = [p.lstrip("0")[:4] for p in m.group().split(".")]
        if all(int(p or "0") <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def span_string(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# -- tagger ---------------------------------------------------------------

#: Tags: 0 outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
SYMBOLS, BLANK = 132, 32


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    ok = np.ones((TAGS, TAGS), bool)
    start = np.ones(TAGS, bool)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        ok[:, inside] = False
        ok[inside - 1, inside] = ok[inside, inside] = True
        start[inside] = False
    return ok, start


def _symbol(c: str) -> int:
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return 48 + digit
    if "\uff01" <= c <= "\uff5e":  # wide forms of ASCII
        return ord(c) - 0xFEE0
    return 130 if not c.isalpha() else 129 if c.isupper() else 128


def symbols(text: str) -> np.ndarray:
    """ASCII as it is; digits of any script and wide forms as their ASCII
    character; other letters by case, other characters as one."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    other = np.flatnonzero(code >= 128)
    if len(other):
        distinct, where = np.unique(code[other], return_inverse=True)
        code[other] = np.array([_symbol(chr(x)) for x in distinct])[where]
    return code


def _tags(n: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    tags = np.zeros(n, np.int64)
    for a, k, b in spans:
        if not tags[a:b].any():
            tags[a] = 1 + 2 * k
            tags[a + 1 : b] = 2 + 2 * k
    return tags


def _with_luhn(rng, n: int) -> str:
    head = "".join(map(str, rng.integers(0, 10, n - 1)))
    return next(head + c for c in "0123456789" if luhn(head + c))


def _number(rng, n: int) -> str:
    return str(rng.integers(1, 10)) + "".join(map(str, rng.integers(0, 10, n - 1)))


def _grouped(s: str, sizes, sep: str) -> str:
    out, at = [], 0
    for n in sizes:
        out.append(s[at : at + n])
        at += n
    return sep.join(x for x in [*out, s[at:]] if x)


_WORDS = "zero one two three four five six seven eight nine".split()
_SCRIPTS = [chr(0x660), chr(0x6F0), chr(0x966), chr(0xFF10)]  # their zeros


def _spelled_email(rng, word) -> str:
    pick = lambda *xs: xs[rng.integers(len(xs))]
    at = pick(" (at) ", " [at] ", " at ", "(at)", " AT ", "[at]", " (at) ")
    dot = pick(" (dot) ", " [dot] ", "(dot)", "[dot]", " DOT ") if at.strip() != "at" else " dot "
    name = lambda: pick(word(), "".join(chr(97 + x) for x in rng.integers(0, 26, int(rng.integers(2, 9)))))
    user = pick(name(), name(), name().capitalize(), f"{name()}.{name()}", name() + dot + name())
    domain = pick("example", "mail", name(), name())
    return user + at + domain + dot + pick("com", "org", "net", "de")


def _example(rng, words: list[str]) -> tuple[str, int | None]:
    """A string and its kind, or None for a look-alike."""
    pick = lambda *xs: xs[rng.integers(len(xs))]
    word = lambda: words[rng.integers(len(words))]
    quad = ".".join(str(rng.integers(0, 256)) for _ in range(4))
    kind = int(rng.integers(0, 14))
    if kind == 0:
        user = pick(word(), f"{word()}.{rng.integers(100)}", f"{word()}_{word()}")
        return f"{user}@{word()}{pick('', str(rng.integers(10)))}.{pick('example.com', 'org', 'net', 'de')}", 0
    if kind == 1:
        six = ":".join(f"{x:x}" for x in rng.integers(0, 65536, 8))
        few = [f"{x:x}" for x in rng.integers(0, 65536, int(rng.integers(1, 4)))]
        short = pick("::" + ":".join(few), "fe80::" + ":".join(few), "::1", "fe80::1", f"2001:db8::{few[0]}")
        return pick(quad, quad, six, short), 1
    if kind == 2:
        s = _with_luhn(rng, 16)
        return pick(s, _grouped(s, (4, 4, 4), pick(" ", "-", ".", "/"))), 2
    if kind in (3, 4, 13):
        a, b, c = _number(rng, 3), _number(rng, 3), _number(rng, 4)
        plain = pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{a} {b}{c}", f"00{a[:2]} {b} {c}", a + b + c)
        return pick(f"+{rng.integers(1, 99)} ({a}) {b}-{c}", plain, plain), 3
    if kind in (5, 6):
        return _spelled_email(rng, word), 0
    if kind == 7:
        return pick(" ", " ", "-").join(_WORDS[x] for x in rng.integers(0, 10, pick(7, 10, 10))), 3
    if kind == 8:
        a, b, c = _number(rng, 3), _number(rng, 3), _number(rng, 4)
        zero = ord(pick(*_SCRIPTS))
        wide = str.maketrans({str(d): chr(zero + d) for d in range(10)})
        s, k = pick((f"{a}-{b}-{c}", 3), (f"+{a[:2]} {b} {c}{a}", 3), (f"({a}) {b}-{c}", 3), (quad, 1), (_with_luhn(rng, 16), 2))
        return s.translate(wide), k
    hexes = "".join("0123456789abcdef"[x] for x in rng.integers(0, 16, rng.integers(8, 40)))
    date = f"{rng.integers(1990, 2030)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}"
    small = f"{rng.integers(0, 50)}.{rng.integers(0, 50)}{pick('', f'.{rng.integers(50)}')}"
    if rng.random() < 0.35:  # words that also stand in spelled-out data
        few = " ".join(_WORDS[x] for x in rng.integers(0, 10, int(rng.integers(1, 4))))
        return pick(
            few, f"{few} {word()}", f"{word()} at {word()}", f"{word()} at {few} {word()}", f"the dot {word()}",
            f"{word()} dot", f"at the {word()}", f"({word()})", f"{word()} (at {word()})", "dot com",
            f"{pick(word(), word(), 'at', 'dot')} " * int(rng.integers(4, 12)), f"{word()} at at at at at {word()}",
            chr(97 + rng.integers(26)) * int(rng.integers(4, 40)) + f" {word()}" * int(rng.integers(1, 9)),
            f"{word()} at {word()} {word()}", f"one {word()} at {word()}", f"{word()}: {word()}", f"{word()}::{word()}",
        ), None
    return pick(
        hexes, f'"{hexes}"', date, small, f"{rng.integers(0, 99999)}", f"{word()}{rng.integers(99)}",
        _number(rng, int(rng.integers(5, 9))), f"{word()}@{word()}", f"{rng.integers(24)}:{rng.integers(60):02d}",
        f"${rng.integers(1, 9999)}.{rng.integers(10, 99)}", f"{quad}.{rng.integers(9)}.{rng.integers(9)}",
    ), None


def training_windows(texts: list[str], n: int = 3000, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Windows (ids, tags) with one or two labelled strings each, and windows
    around the base spans of the texts."""
    rng = np.random.default_rng(seed)
    source = [t for t in texts if t.strip()] or ["the quick brown fox jumps over the lazy dog " * 4]
    words = sorted({w for t in source for w in re.findall("[a-z]{2,9}", t)})[:5000] or ["word"]
    ids, tags = [], []

    def add(text: str, spans) -> None:
        text = text[:WINDOW].ljust(WINDOW)
        ids.append(symbols(text))
        tags.append(_tags(WINDOW, [(a, k, min(b, WINDOW)) for a, k, b in spans if a < WINDOW]))

    def context(size: int) -> str:
        t = source[rng.integers(len(source))]
        at = int(rng.integers(0, max(1, len(t) - size)))
        return _ANCHOR.sub("x", t[at : at + size])

    for _ in range(n):
        text, spans = context(int(rng.integers(0, 40))), []
        for _ in range(int(rng.integers(1, 3))):
            s, kind = _example(rng, words)
            text += " " if rng.random() < 0.8 or text[-1:].isalnum() else "("
            if kind is not None:
                spans.append((len(text), kind, len(text) + len(s)))
            text += s + ("", ".", ",", "###", ";")[rng.integers(5)] + " "
            text += context(int(rng.integers(2, 12)))
        text += context(WINDOW)
        cut = int(rng.integers(0, 16))  # windows begin anywhere, not inside a span
        if any(a < cut < b for a, _, b in spans):
            cut = 0
        add(text[cut:], [(a - cut, k, b - cut) for a, k, b in spans if a >= cut])
    for _ in range(n // 4):  # most of a text is neither
        add(context(WINDOW), [])
    for t in source:
        for a, _, b in base_spans(t)[:4]:
            at = max(0, a - int(rng.integers(8, 24)))
            spans = base_spans(t[at : b + WINDOW])
            add(t[at : b + WINDOW], [s for s in spans if s[0] + at >= a])
    return np.stack(ids), np.stack(tags)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, steps: int = 1200) -> BiLstmCrf | None:
    """A tagger from (doc_id, text) rows: about ``sample_docs`` whole texts,
    drawn at random with a fixed seed, give the contexts and base spans. None
    for an empty table."""
    rows = docs.count()
    if not rows:
        return None
    drawn = docs.filter(F.rand(seed=7) < sample_docs / rows).select("text")
    texts = [r[0] for r in drawn.toLocalIterator()]
    model = BiLstmCrf(SYMBOLS, *_allowed())
    model.fit(*training_windows(sorted(texts)), steps=steps)
    return model


def _gains(model: BiLstmCrf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per kind the most that transitions add to a span over "outside": at its
    begin, at each of its insides and after it."""
    trans = model.p["t"] + model.mask
    begin, inside = np.arange(1, TAGS, 2), np.arange(2, TAGS, 2)
    after = np.concatenate([[0], begin])
    enter = (trans[:, begin] - trans[:, :1]).max(0)
    inner = np.maximum(trans[begin, inside], trans[inside, inside]) - trans[0, 0]
    leave = np.maximum((trans[begin][:, after] - trans[0, after]).max(1), (trans[inside][:, after] - trans[0, after]).max(1))
    return enter[:, None], inner[:, None], np.maximum(leave, 0)[:, None]


def unsure(model: BiLstmCrf, emit: np.ndarray, gains=None) -> np.ndarray:
    """Per character whether the best path of the whole text may hold a span
    there. A span gains over "outside" at most its begin, the sum of its
    insides and the transitions; where no such sum is positive, none is."""
    enter, inner, leave = gains or _gains(model)
    rows = emit.T
    first = (rows[1::2] - rows[0]).astype(np.float64) + enter
    first[:, :1] += np.maximum(enter, 0) - enter  # no transition at the ends
    total = np.cumsum((rows[2::2] - rows[0]).astype(np.float64) + inner, axis=1)
    lower = np.maximum.accumulate(first - total, axis=1)
    least = -1e-3 - leave  # and what rounding may take
    out = np.zeros(len(emit), bool)
    for own, low, limit in zip(total, lower, least):
        if (own + low > limit).any():  # a span of this kind that ends somewhere
            out |= np.maximum.accumulate(own[::-1])[::-1] + low > limit
    return out


def _around(marked: np.ndarray) -> list[tuple[int, int]]:
    """Contiguous parts within REACH of a marked character."""
    at = np.flatnonzero(marked)
    if not len(at):
        return []
    cuts = np.flatnonzero(np.diff(at) > 2 * REACH)
    first, last = at[np.concatenate([[0], cuts + 1])], at[np.concatenate([cuts, [len(at) - 1]])]
    return [(max(0, int(a) - REACH), min(len(marked), int(b) + 1 + REACH)) for a, b in zip(first, last)]


#: Windows count most at their middle; their first and last characters, which
#: the tagger sees without context, least. Where two windows overlap, these are
#: the shares of the later one.
_WEIGHT = np.minimum(np.arange(1, SPAN + 1), np.arange(SPAN, 0, -1)).astype(np.float32)[:, None]
_LATER = (_WEIGHT[: SPAN - STEP] / (_WEIGHT[: SPAN - STEP] + _WEIGHT[STEP:]))[:, 0]


def _emissions(model: BiLstmCrf, parts: list[str]) -> list[np.ndarray]:
    """Per part (characters, tags): the windows' emissions, averaged. A part is
    read as if blanks filled up its last window; only their effect on what
    stands before them is taken, so a window costs as much as it holds of the
    part. Windows are tagged a few of like length at a time and added up at
    once, so besides the averages only those few are held, however long a part
    is."""
    codes = [symbols(p) for p in parts]
    sizes = np.array([len(c) for c in codes])
    ends = np.cumsum(sizes)
    windows = 1 + np.maximum(0, -(-(sizes - SPAN) // STEP))
    part = np.repeat(np.arange(len(parts)), windows)
    number = np.arange(len(part)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = (ends - sizes)[part] + number * STEP
    lengths = np.minimum(SPAN, ends[part] - at)
    ids = np.full(ends[-1] + SPAN, BLANK, np.uint8)
    ids[: ends[-1]] = np.concatenate(codes)
    blanks = model.after(BLANK, SPAN)
    flat = np.zeros((TAGS, ends[-1]), np.float32)
    order = np.argsort(-lengths, kind="stable")
    k = 0
    while k < len(order):
        steps = lengths[order[k]]
        like = np.searchsorted(-lengths[order], -0.8 * steps)
        some = order[k : min(k + TOGETHER, max(like, k + TOGETHER // 6))]
        k += len(some)
        within = np.arange(steps)
        view = np.where(within < lengths[some, None], ids[at[some, None] + within], BLANK)
        got = np.ascontiguousarray(model.emissions(view, blanks[SPAN - steps]).transpose(2, 1, 0))
        got[:, number[some] > 0, : SPAN - STEP] *= _LATER[:steps]
        if steps == SPAN:
            got[:, number[some] < windows[part[some]] - 1, STEP:] *= 1 - _LATER
        for j, (a, size) in enumerate(zip(at[some].tolist(), lengths[some].tolist())):
            flat[:, a : a + size] += got[:, j, :size]
    return [flat[:, b - n : b].T for b, n in zip(ends.tolist(), sizes.tolist())]


_SPELLED = re.compile(r"[\s(\[]*\bdot\b[\s)\]]*", re.I)
_WORD = re.compile("|".join(_WORDS), re.I)
_DOT = r"(?:\.|\s*[(\[]\s*dot\s*[)\]]\s*|\s+dot\s+)"
_AT = r"(?:@|\s*[(\[]\s*at\s*[)\]]\s*|\s+at\s+)"
_FORMS = {
    0: re.compile(rf"[^\s@()\[\]]+(?:{_DOT}[\w-]+)*{_AT}[\w-]+(?:{_DOT}[\w-]+)+", re.I),
    3: re.compile(rf"\+?\(?(?>(?:[0-9]|{'|'.join(_WORDS)}|oh\b)(?:[\s().,/+-]*(?:[0-9]|{'|'.join(_WORDS)}|oh\b))*)(?![\w:])", re.I),
}


def formed(kind: int, s: str) -> int:
    """Length of the well-formed beginning of a tagged string, 0 if it is none
    of its kind. Digits may be of any script or spelled out, at signs and dots
    too; card numbers have their check digit, IP addresses valid parts."""
    s = "".join(chr(x) for x in symbols(s))
    digits = lambda x: len(_digits(_WORD.sub("0", x)))
    if kind in _FORMS:
        m = _FORMS[kind].match(s)
        return m.end() if m and (kind == 0 or 7 <= digits(m.group()) <= 15) else 0
    if kind == 1:
        s1 = _SPELLED.sub(".", s)
        if ":" not in s1:
            s1 = ".".join(p.lstrip("0") or p[:1] for p in s1.split("."))
        try:
            ipaddress.ip_address(s1)
        except ValueError:
            return 0
        return len(s)
    number = _digits(_WORD.sub(lambda m: str(_WORDS.index(m[0].lower())), s))
    return len(s) if 12 <= len(number) <= 19 and luhn(number) else 0


def _spans_on(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the spans of a path."""
    starts = np.flatnonzero(tags % 2 == 1)
    out = []
    for at in starts.tolist():
        end = at + 1
        while end < len(tags) and tags[end] == tags[at] + 1:
            end += 1
        out.append((at, int(tags[at] - 1) // 2, end))
    return out


def tagged_spans(model: BiLstmCrf, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Spans that the tagger finds in each text, all kinds, sorted: those on
    the best path of the whole text that are confident and of their form."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    gains = _gains(model)
    own: list[int] = []
    held = 0
    for k, text in enumerate(texts):
        if text:
            own.append(k)
            held += len(text)
        if own and (held >= HELD or k == len(texts) - 1):
            regions = [
                (j, a, emit[a:b])
                for j, emit in zip(own, _emissions(model, [texts[j] for j in own]))
                for a, b in _around(unsure(model, emit, gains))
            ]
            paths = model.best_paths([r[2] for r in regions], TOGETHER)
            some = [(j, a, emit, tags) for (j, a, emit), tags in zip(regions, paths) if tags.any()]
            for (j, a, _, tags), sure in zip(some, model.all_marginals([s[2] for s in some], TOGETHER)):
                for at, kind, end in _spans_on(tags):
                    mean = sure[np.arange(at, end), tags[at:end]].mean()
                    size = formed(kind, texts[j][a + at : a + end]) if mean >= CONFIDENT else 0
                    if size:
                        found[j].append((a + at, kind, a + at + size))
            own, held = [], 0
    return found


def annotate(model: BiLstmCrf | None, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    more = tagged_spans(model, texts) if model else [[] for _ in texts]
    full = []
    for own, extra in zip(base, more):
        clear = [s for s in extra if all(s[2] <= a or b <= s[0] for a, _, b in own)]
        full.append(sorted(own + clear))
    return list(zip(base, full))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base spans per kind, base_sha256, spans."""
    source = id_text(docs, id_col, text_col)
    model = source.sparkSession.sparkContext.broadcast(train(source))  # some 10,000 numbers

    def run(batches):
        for batch in batches:
            got = annotate(model.value, batch.column("text").to_pylist())
            counts = [[sum(s[1] == k for s in b) for b, _ in got] for k in range(len(KINDS))]
            digest = [hashlib.sha256(span_string(b).encode()).hexdigest() for b, _ in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts)]
                + [pa.array(digest, pa.string()), pa.array([span_string(f) for _, f in got], pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return arrow_map(source, run, f"doc_id long, {counts}, base_sha256 string, spans string")


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or union of overlapping spans, replaced by the
    name of its first kind in angle brackets."""
    out, done, at = [], 0, 0
    while at < len(spans):
        a, kind, b = spans[at]
        while at + 1 < len(spans) and spans[at + 1][0] < b:
            at += 1
            b = max(b, spans[at][2])
        out += [text[done:a], f"<{KINDS[kind].upper()}>"]
        done, at = b, at + 1
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The same columns and rows with personal data masked in the text, and
    the size column, if there is one, set to the new code points. Null texts
    stay null."""
    source = id_text(docs, id_col, text_col)
    model = source.sparkSession.sparkContext.broadcast(train(source))
    columns = docs.columns

    def run(batches):
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            got = annotate(model.value, [t or "" for t in texts])
            new = [None if t is None else mask(t, f) for t, (_, f) in zip(texts, got)]
            sizes = [None if t is None else len(t) for t in new]
            arrays = dict(zip(batch.schema.names, batch.columns))
            arrays[text_col] = pa.array(new, pa.string())
            if size_col in arrays:
                old = arrays[size_col]
                arrays[size_col] = pa.array(
                    [o if n is None else n for o, n in zip(old.to_pylist(), sizes)], old.type
                )
            yield pa.RecordBatch.from_arrays([arrays[c] for c in columns], columns)

    return arrow_map(docs, run, docs.schema)
