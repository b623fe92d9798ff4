"""Cached tokenisation by chunks.

A text is cut where the pre-tokenisers of the public vocabularies cut it for
certain, and each distinct chunk is encoded once per Python worker: natural
text repeats its words, so most chunks come from the cache."""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Distinct chunks that a worker remembers; then it starts anew (memory bound).
CACHE_ENTRIES = 1_200_000

# white space besides blank and line feed, and the separator used below
_OTHER_SPACE = re.compile(
    r"[\x00\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)


def byte_chunks(text: str) -> list[str] | None:
    """Cuts for the byte-level pattern: before each blank and around each line
    feed. With single white space between words the pattern never reaches
    across these places. None where that does not hold: use the whole text."""
    if (
        "  " in text
        or "\n\n" in text
        or " \n" in text
        or "\n " in text
        or _OTHER_SPACE.search(text)
    ):
        return None
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


def word_chunks(text: str) -> list[str]:
    """Cuts for vocabularies that drop white space: at blanks and line feeds."""
    return text.replace("\n", " ").split(" ")


class ChunkEncoder:
    """Texts to little-endian ids (as bytes) through a cache of chunks.

    ``encode_many`` maps strings to the bytes of their ids; ``cut`` maps a
    text to chunks whose ids may be concatenated, or to None: such a text is
    encoded whole."""

    def __init__(
        self,
        encode_many: Callable[[list[str]], list[bytes]],
        cut: Callable[[str], list[str] | None],
        entries: int = CACHE_ENTRIES,
    ):
        self.encode_many, self.cut, self.entries = encode_many, cut, entries
        self.cache: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        cache = self.cache
        if len(cache) > self.entries:
            cache.clear()
        cut = [self.cut(t) for t in texts]
        new = list(set().union(*[c for c in cut if c]).difference(cache))
        if new:
            cache.update(zip(new, self.encode_many(new)))
        return [
            self.encode_many([t])[0] if c is None else b"".join([cache[x] for x in c])
            for t, c in zip(texts, cut)
        ]


class LibraryCoder:
    """Ids from a tokenizers file. Many short strings go through the library
    as one text with its special token between them, which ends a segment."""

    def __init__(self, path: str, dtype: str):
        self.dtype = np.dtype(dtype)
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # special strings in a text are text
        self.split = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.split.get_added_tokens_decoder().items() if t.special}
        self.mark, self.mark_id = min(special.items(), key=lambda x: x[1])
        self.special = tuple(special)

    def __call__(self, strings: list[str]) -> list[bytes]:
        if len(strings) == 1 or any(s in x for x in strings for s in self.special):
            coded = self.whole.encode_batch_fast(strings, add_special_tokens=False)
            return [np.array(e.ids, self.dtype).tobytes() for e in coded]
        out: list[bytes] = []
        for at in range(0, len(strings), 1000):
            text = self.mark.join(strings[at : at + 1000])
            ids = np.array(
                self.split.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32
            )
            size = self.dtype.itemsize
            ends = (np.flatnonzero(ids == self.mark_id) * size).tolist()
            data = ids.astype(self.dtype).tobytes()
            begins = [0, *[e + size for e in ends]]
            out += [data[a:b] for a, b in zip(begins, [*ends, len(data)])]
        return out


_LOADED: dict[tuple, ChunkEncoder] = {}


def library_encoder(name: str, cut: str, dtype: str = "<u4") -> ChunkEncoder:
    """The encoder of a tokenizers file, one per Python worker."""
    key = (name, cut, dtype)
    if key not in _LOADED:
        coder = LibraryCoder(public_tokenizers.path(name), dtype)
        _LOADED[key] = ChunkEncoder(coder, {"byte": byte_chunks, "word": word_chunks}[cut])
    return _LOADED[key]


# --------------------------------------------------------------------------
# byte-level vocabularies whose ids are their merge ranks
# --------------------------------------------------------------------------

#: Bytes of keys and values that one memory of chunks may hold in a worker, and
#: the longest chunk (in characters) that is remembered at all.
MEMORY_BYTES, MEMORY_CHARS = 192 << 20, 64
#: What an entry of a dict of short strings takes besides its characters.
ENTRY_BYTES = 200


def byte_characters() -> dict[str, int]:
    """Byte of each character in byte-level vocabulary files: printable Latin-1
    stands for itself, the other bytes follow from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def byte_vocabulary(path: str) -> dict[bytes, int]:
    """Bytes of each ordinary entry of a byte-level tokenizers file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec["added_tokens"] if t["special"]}
    of = byte_characters()
    return {
        bytes([of[c] for c in piece]): i
        for piece, i in spec["model"]["vocab"].items()
        if piece not in special
    }


class RankCoder:
    """Ids of a byte-level tokenizers file through merge ranks. The file's ids
    must grow in merge order, which is checked; then the lowest rank merges
    first in both libraries, and the ids are the same."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        ranks = [vocabulary[a + b] for a, b in pairs]
        if ranks != sorted(ranks):
            raise ValueError(f"the ids of {path} do not grow in merge order")
        self.code = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=byte_vocabulary(path),
            special_tokens={},
        ).encode_ordinary

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        ids = array("I", self.code(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


class ChunkMemory(dict):
    """What was made of short chunks; starts anew when its bytes are used up."""

    def __init__(self, limit: int = MEMORY_BYTES):
        super().__init__()
        self.limit, self.used = limit, 0

    def keep(self, chunk: str, value, size: int) -> None:
        if len(chunk) <= MEMORY_CHARS:
            if self.used > self.limit:
                self.clear()
                self.used = 0
            self[chunk] = value
            self.used += ENTRY_BYTES + len(chunk) + size


class RankedEncoder:
    """Texts to ids, each distinct short chunk coded once while remembered."""

    def __init__(self, path: str, limit: int = MEMORY_BYTES):
        self.code, self.memory = RankCoder(path), ChunkMemory(limit)

    def __call__(self, text: str) -> bytes:
        chunks = byte_chunks(text)
        if chunks is None:
            return self.code(text)
        found = list(map(self.memory.get, chunks))
        if None in found:
            for k, data in enumerate(found):
                if data is None:
                    chunk = chunks[k]
                    found[k] = data = self.code(chunk)
                    self.memory.keep(chunk, data, len(data))
        return b"".join(found)


_RANKED: dict[str, RankedEncoder] = {}


def ranked_encoder(name: str) -> RankedEncoder:
    """The encoder of a byte-level tokenizers file, one per Python worker."""
    if name not in _RANKED:
        _RANKED[name] = RankedEncoder(public_tokenizers.path(name))
    return _RANKED[name]


# --------------------------------------------------------------------------
# vocabularies with word ends
# --------------------------------------------------------------------------

#: A word of letters that composed forms leave as they are, and what may follow.
_PLAIN_WORD = re.compile(r"([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u012f\u0131-\u024f]+)([.,;:!?]*)")
_END = "\0"  # stands for the word end, and occurs in no plain word


class WordEndCoder:
    """Ids of a byte-level file whose merges know a word's last character.
    Plain words, with or without punctuation after them, go through merge
    ranks: the end is a byte of its own that merges with the last one first.
    Everything else goes through the library. The ids of the merges must grow
    in merge order, which is checked."""

    def __init__(self, path: str, dtype: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix, vocabulary = model["end_of_word_suffix"], model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [vocabulary[a + b] for a, b in pairs]
        if ids != sorted(ids) or (ids and ids[0] != 512):
            raise ValueError(f"the ids of {path} do not grow in merge order")
        self.size = max(vocabulary.values()) + 1
        self.dtype = np.dtype(dtype)
        if self.size > 1 << (8 * self.dtype.itemsize):
            raise ValueError(f"{self.size} ids do not fit into {self.dtype.itemsize} bytes each")
        self.kind = {1: "B", 2: "H", 4: "I", 8: "Q"}[self.dtype.itemsize]
        of, ranks = byte_characters(), {}
        for piece, i in vocabulary.items():
            ends = piece.endswith(suffix)
            body = piece[: -len(suffix)] if ends else piece
            if all(c in of for c in body):
                ranks[bytes([of[c] for c in body]) + (_END.encode() if ends else b"")] = i
        self.merge = tiktoken.Encoding(
            "word-ends", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.library = LibraryCoder(path, dtype)

    def plain(self, chunk: str) -> bytes | None:
        """Ids of a plain word, None for anything else."""
        m = _PLAIN_WORD.fullmatch(chunk)
        if not m or not m[1].isalpha():
            return None
        marked = m[1].lower() + _END + (m[2] + _END if m[2] else "")
        ids = array(self.kind, self.merge(marked))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


class WordEncoder:
    """Texts to ids, each distinct short chunk coded once while remembered."""

    def __init__(self, path: str, dtype: str, limit: int = MEMORY_BYTES):
        self.coder, self.memory = WordEndCoder(path, dtype), ChunkMemory(limit)

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [word_chunks(t) for t in texts]
        found = [list(map(self.memory.get, c)) for c in cut]
        fresh: dict[str, bytes | None] = {}
        for chunks, got in zip(cut, found):
            if None in got:
                for chunk, data in zip(chunks, got):
                    if data is None and chunk not in fresh:
                        fresh[chunk] = self.coder.plain(chunk) if chunk else b""
        odd = [c for c, data in fresh.items() if data is None]
        if odd:
            fresh.update(zip(odd, self.coder.library(odd)))
        for chunk, data in fresh.items():
            self.memory.keep(chunk, data, len(data))
        return [
            b"".join([fresh[c] if data is None else data for c, data in zip(chunks, got)])
            if None in got
            else b"".join(got)
            for chunks, got in zip(cut, found)
        ]


_WORDS: dict[tuple[str, str], WordEncoder] = {}


def word_encoder(name: str, dtype: str) -> WordEncoder:
    """The encoder of a file with word ends, one per Python worker."""
    key = (name, dtype)
    if key not in _WORDS:
        _WORDS[key] = WordEncoder(public_tokenizers.path(name), dtype)
    return _WORDS[key]
