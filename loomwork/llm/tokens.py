"""Token ids of whole texts with a ready-made byte-level BPE vocabulary (a file; nothing is trained)."""

from __future__ import annotations

import functools
import os
import re
import struct
from collections.abc import Callable

import numpy as np

END_ID = 0
_CACHE_WORDS = 500_000
_LONG = 1 << 20
_KEPT_POWERS = 1 << 22
_BETWEEN = re.compile("[A-Za-z0-9] (?=[A-Za-z0-9])")
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = "".join(c for c in map(chr, range(65, 256)) if c.isalpha() and c not in "ªº")
_MARKS = ".,;:!?"
_PLAIN = re.compile(f" ([{_LETTERS}]+)([{_MARKS}]?)")
_BLANK = 32
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _hash_table() -> np.ndarray:
    """A 64-bit number per byte value (splitmix steps from 1 on)."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _loose(data: np.ndarray, borders: np.ndarray, blanks: np.ndarray) -> np.ndarray:
    """Texts with white space right before a blank or at their end.

    A character of three bytes there counts as white space if its first byte is one that wide blanks begin with.
    """
    at = np.concatenate([blanks, borders[1:]])
    text = np.concatenate([np.searchsorted(borders, blanks, side="right") - 1, np.arange(len(borders) - 1)])
    last, second, third = (data[np.maximum(at - back, 0)] for back in (1, 2, 3))
    white = _WHITE[last] | ((second == 0xC2) & ((last == 0x85) | (last == 0xA0)))
    white |= (last >= 0x80) & (second >= 0x80) & (third >= 0xE1) & (third <= 0xE3)
    white &= at > borders[text]
    return np.bincount(text[white], minlength=len(borders) - 1) > 0


class Words:
    """Ids of words by the words' hashes, in flat arrays: an open-addressed table whose rows point into one pool of ids."""

    def __init__(self, room: int):
        self.count, self.filled = 0, 0
        self.keys, self.begin, self.size = np.empty(room, np.uint64), np.empty(room, np.int32), np.empty(room, np.int32)
        self.pool = np.empty(4 * room, "<u4")
        self._hash(room)

    def _hash(self, room: int) -> None:
        bits = max(4, (2 * room - 1).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        self._place(np.arange(self.count, dtype=np.int32))

    def _place(self, rows: np.ndarray) -> None:
        at = ((self.keys[rows] * _SPREAD) >> self.shift).astype(np.int64)
        while len(rows):
            free = self.slots[at] < 0
            self.slots[at[free]] = rows[free]  # of several for one slot the last one stays
            left = self.slots[at] != rows
            rows, at = rows[left], (at[left] + 1) & self.last

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if absent."""
        at = ((keys * _SPREAD) >> self.shift).astype(np.int64)
        row = self.slots[at]
        open_ = np.flatnonzero((row >= 0) & (self.keys[row] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.last
            row[open_] = self.slots[at[open_]]
            open_ = open_[(row[open_] >= 0) & (self.keys[row[open_]] != keys[open_])]
        return row

    def ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some rows one behind the other, and how many each has."""
        size = self.size[rows].astype(np.int64)
        after = np.cumsum(size)
        return self.pool[np.repeat(self.begin[rows] - (after - size), size) + np.arange(after[-1] if len(after) else 0)], size

    def add(self, keys: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Words that are not there yet."""
        n, filled = self.count + len(keys), self.filled + len(ids)
        if n > len(self.keys):
            self.keys, self.begin, self.size = (np.resize(x, 2 * n) for x in (self.keys, self.begin, self.size))
            self._hash(2 * n)
        if filled > len(self.pool):
            self.pool = np.resize(self.pool, 2 * filled)
        rows = np.arange(self.count, n, dtype=np.int32)
        self.keys[rows], self.size[rows] = keys, size
        self.begin[rows] = self.filled + np.cumsum(size) - size
        self.pool[self.filled:filled] = ids
        self.count, self.filled = n, filled
        self._place(rows)


class Encoder:
    """Encodes texts word by word, keeping the ids of words seen before.

    Byte-level BPE never merges across the border before a blank that follows a visible character, so
    the ids of a text are those of its first word and of every further word with its blank. Words of a batch are told apart
    by a 64-bit hash of their bytes in vector steps; only words not met before reach the library. Those of Latin letters,
    with a mark behind or not, go straight to its BPE model (letters and marks are pre-tokens of their own), all others in one
    call, as one text, and are separated by their byte lengths. Texts with other white space next to a blank, and those that contain
    one of the vocabulary's added tokens, are encoded whole.

    Words are kept in two generations of ``_CACHE_WORDS``: a full one becomes the old one, and words found in that move
    on to the new one, so frequent words are never learned again. Texts over ``_LONG`` characters are cut between two words
    of letters or digits with one blank between them, where no token can span.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task per core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(re.escape(t) for t in added).encode(), re.IGNORECASE) if added else None
        # Cutting at blanks needs added tokens without one.
        self.cuts = not any(" " in t for t in added)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for piece, i in vocabulary.items():
            self.width[i] = len(piece)  # byte-level pieces spell one character per byte
        self.model = self.tokenizer.model
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {ord(c): spell(c)[0][0] for c in " " + _LETTERS}
        self.marks = {c: self.whole(c) for c in _MARKS}
        self.table = _hash_table()
        self.powers = [np.empty(0, np.uint64)] * 2
        self.words, self.old = Words(_CACHE_WORDS), None

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4").tobytes()

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A polynomial over the bytes of each word, from differences of running sums."""
        powers = self.powers
        if len(powers[0]) <= len(data):
            powers = [np.cumprod(np.full(len(data) + 1, x, np.uint64), dtype=np.uint64) for x in (_ODD, _INVERSE)]
            if len(data) <= _KEPT_POWERS:
                self.powers = powers
        up, down = powers
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.table[data] * up[:len(data)], dtype=np.uint64)])
        return (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of words; those without a leading blank begin a text."""
        out: list[bytes | None] = []
        others, tokenize = [], self.model.tokenize
        for place, word in enumerate(words):
            plain = _PLAIN.fullmatch(word)
            if plain is not None:
                letters, mark = plain.groups()
                ids = [t.id for t in tokenize((" " + letters).translate(self.spelling))]
                out.append(struct.pack(f"<{len(ids)}I", *ids) + (self.marks[mark] if mark else b""))
            elif word[0] == " ":
                others.append(place)
                out.append(None)
            else:
                out.append(self.whole(word))
        if others:
            text = "".join(words[i] for i in others)
            raw = self.whole(text)
            # Each of these words holds one blank, its first character; ids begin there, too.
            begins = np.flatnonzero(np.frombuffer(text.encode(), np.uint8) == _BLANK)
            ends = np.cumsum(self.width[np.frombuffer(raw, "<u4")])
            borders = (4 * np.searchsorted(ends, begins, side="right")).tolist()
            for i, a, b in zip(others, borders, [*borders[1:], len(raw)]):
                out[i] = raw[a:b]
        return out

    def _know(self, keys: np.ndarray, text_of: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """Rows of distinct words, learning those not met before; ``text_of`` gives the words at some places."""
        # Before the tables grow, not behind it.
        if self.words.count + len(keys) > _CACHE_WORDS and self.words.count:
            self.words, self.old = Words(_CACHE_WORDS), self.words
        absent = np.flatnonzero(self.words.find(keys) < 0)
        if self.old is not None and len(absent):
            row = self.old.find(keys[absent])
            found = row >= 0
            ids, size = self.old.ids(row[found])
            self.words.add(keys[absent[found]], size, ids)
            absent = absent[~found]
        if len(absent):
            learned = self._learn(text_of(absent))
            self.words.add(keys[absent], np.array([len(x) // 4 for x in learned], np.int64), np.frombuffer(b"".join(learned), "<u4"))
        return self.words.find(keys)

    def _pieces(self, text: str) -> list[str]:
        """The text, or stretches of it that are encoded alike on their own."""
        if len(text) <= _LONG or not self.cuts:
            return [text]
        out, begin = [], 0
        while begin < len(text):
            between = _BETWEEN.search(text, begin + _LONG)
            end = between.start() + 1 if between else len(text)
            out.append(text[begin:end])
            begin = end
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, without an end id."""
        out: list[bytes] = []
        some: list[str] = []
        for text in texts:
            pieces = self._pieces(text)
            if len(pieces) == 1:
                some.append(text)
                continue
            out += self._encode(some)
            out.append(b"".join(self._encode([piece])[0] for piece in pieces))
            some = []
        return out + self._encode(some)

    def _encode(self, texts: list[str]) -> list[bytes]:
        raws = [t.encode() for t in texts]
        borders = np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64)
        joined = b"".join(raws)
        data = np.frombuffer(joined, np.uint8)
        if not len(data):
            return [b""] * len(texts)
        blanks = np.flatnonzero(data == _BLANK)
        loose = _loose(data, borders, blanks)
        if self.added is not None:
            for m in self.added.finditer(joined):
                # A match across a border marks two texts, which does no harm.
                loose[np.searchsorted(borders, [m.start(), m.end() - 1], side="right") - 1] = True
        starts = np.unique(np.concatenate([blanks, borders[:-1][np.diff(borders) > 0]]))
        ends = np.append(starts[1:], len(data))
        text = np.searchsorted(borders, starts, side="right") - 1
        cut = ~loose[text]
        starts, ends, text = starts[cut], ends[cut], text[cut]
        hashes, first, which = np.unique(self._hashes(data, starts, ends), return_index=True, return_inverse=True)
        words = lambda at: [joined[a:b].decode() for a, b in zip(starts[first[at]].tolist(), ends[first[at]].tolist())]
        rows = self._know(hashes, words)
        pool, sizes = self.words.ids(rows)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        counts = sizes[which]
        after = np.cumsum(counts)
        out = pool[np.repeat(begin[which] - (after - counts), counts) + np.arange(after[-1] if len(after) else 0)]
        per_text = np.concatenate([[0], np.cumsum(np.bincount(text, counts, len(texts)))]).astype(np.int64).tolist()
        return [self.whole(t) if whole else out[a:b].tobytes() for t, whole, a, b in zip(texts, loose.tolist(), per_text, per_text[1:])]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_documents(texts: list[str | None], path: str) -> list[bytes]:
    """Ids with the end id appended; a null text is empty."""
    end = np.array([END_ID], "<u4").tobytes()
    return [ids + end for ids in encoder(path).encode([t or "" for t in texts])]


def slices(n_bytes: list[int], limit: int):
    """(begin, end) of consecutive rows with at most ``limit`` bytes together, one row at least."""
    begin, total = 0, 0
    for i, n in enumerate(n_bytes):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(n_bytes):
        yield begin, len(n_bytes)
