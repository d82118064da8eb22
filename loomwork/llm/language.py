"""Language identification by prediction by partial matching (PPM) on bytes.

``fit`` counts, for each language, the bytes that follow every context of 0 to ``order`` bytes in a bounded
sample of labelled rows and freezes code lengths with escape method C: a byte seen c times in a context with n
bytes, d of them different, costs -log2(c / (n + d)) bits; an unseen one costs an escape, -log2(d / (n + d)), and is
then coded in the context without its oldest byte; below order 0 every byte costs 8 bits. ``identify`` streams whole
texts past these trees and takes the language with the shortest code.

The sample: of each language the ``per_language`` rows with the smallest hash of their id among those of at most
``max_chars`` characters, or its shortest text if all are longer. That bounds what reaches the driver by languages x per_language x
max_chars and those shortest texts; the number of languages is bounded by ``max_languages``. Everything else runs in the rows' own partitions,
without a shuffle, a bounded number of bytes at a time.

Defined results: ``und`` with score 0 for a null text or one without a letter, and for every row if nothing could be
learned; equal code lengths go to the smaller language name; equal texts get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.tokens import slices

ORDER = 4
UNDETERMINED = "und"
_EVIDENCE = 16  # bytes whose code length counts in the score
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PART = 1 << 18
_NUMBERED = re.compile(r"(?<!\S)[^\s\d]*+\d\S*+")
_LETTERS = re.compile(r"[^\W\d_]+")
_BLANK = re.compile(r"\s")


@dataclass
class Table:
    """A hash table with linear probing from 64-bit keys to rows of ``values``; lookups are vector steps."""

    keys: np.ndarray
    values: np.ndarray
    slots: np.ndarray = field(init=False)
    shift: np.uint64 = field(init=False)

    def __post_init__(self):
        bits = max(4, int(4 * max(1, len(self.keys))).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        todo = np.arange(len(self.keys), dtype=np.int32)
        at = self._first(self.keys)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]  # of several for one slot the last one stays
            left = self.slots[at] != todo
            todo, at = todo[left], (at[left] + 1) & (len(self.slots) - 1)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _ODD) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if absent."""
        at = self._first(keys)
        row = self.slots[at]
        open_ = np.flatnonzero((row >= 0) & (self.keys[row] != keys)) if len(self.keys) else np.empty(0, np.int64)
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
            row[open_] = self.slots[at[open_]]
            open_ = open_[(row[open_] >= 0) & (self.keys[row[open_]] != keys[open_])]
        return row


@dataclass
class Model:
    """Code lengths in bits for all languages side by side: of known (context, byte) pairs, and of escapes."""

    languages: list[str]
    order: int
    codes: list[Table]
    escapes: list[Table]

    def code_lengths(self, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
        """Bits of each text under each language; text i is ``data[borders[i]:borders[i + 1]]``.

        A stretch of ``_PART`` bytes at a time, so that one long text takes no more memory than many short ones.
        """
        total = np.zeros((len(borders) - 1, len(self.languages)))
        for begin in range(0, len(data), _PART):
            end = min(begin + _PART, len(data))
            first = int(np.searchsorted(borders, begin, side="right")) - 1
            last = int(np.searchsorted(borders, end, side="left"))
            inside = np.clip(borders[first:last + 1], begin, end) - begin
            bits = self._bits(context_keys(data, borders, self.order, begin, end))
            full = np.flatnonzero(np.diff(inside) > 0)
            total[first + full] += np.add.reduceat(bits, inside[full], axis=0, dtype=np.float64)
        return total

    def _bits(self, grams: np.ndarray) -> np.ndarray:
        bits = np.zeros((len(grams), len(self.languages)), np.float32)
        rest = np.arange(len(grams))
        for k in range(self.order, -1, -1):
            key = grams[rest] & np.uint64((1 << 8 * (k + 1)) - 1)
            row = self.codes[k].find(key)
            hit = row >= 0
            bits[rest[hit]] += self.codes[k].values[row[hit]]
            rest, key = rest[~hit], key[~hit]
            if not len(rest):
                break
            row = self.escapes[k].find(key >> np.uint64(8))
            hit = row >= 0
            bits[rest[hit]] += self.escapes[k].values[row[hit]]
        bits[rest] += 8
        return bits


def context_keys(data: np.ndarray, borders: np.ndarray, order: int, begin: int = 0, end: int | None = None) -> np.ndarray:
    """For each byte from ``begin`` to ``end`` a number: the byte itself above the bytes before it, the nearest lowest but one.

    Bits 0 to 7 hold the byte, bits 8 to 15 the one before and so on; zeros stand before the text.
    """
    end = len(data) if end is None else end
    at = np.arange(begin, end)
    place = at - borders[np.searchsorted(borders, at, side="right") - 1]
    keys = data[begin:end].astype(np.uint64)
    for back in range(1, order + 1):
        former = np.zeros(end - begin, np.uint64)
        former[max(0, back - begin):] = data[max(0, begin - back):max(0, end - back)]
        former[place < back] = 0
        keys |= former << np.uint64(8 * back)
    return keys


def train(texts: dict[str, list[bytes]], order: int = ORDER) -> Model:
    """The frozen model of some labelled texts."""
    languages = sorted(texts)
    keys = {}
    for name in languages:
        data = np.frombuffer(b"".join(texts[name]), np.uint8)
        borders = np.concatenate([[0], np.cumsum([len(t) for t in texts[name]])]).astype(np.int64)
        keys[name] = context_keys(data, borders, order)
    codes, escapes, below = [], [], None
    for k in range(order + 1):
        mask = np.uint64((1 << 8 * (k + 1)) - 1)
        seen = {name: np.unique(keys[name] & mask, return_counts=True) for name in languages}
        union = np.unique(np.concatenate([g for g, _ in seen.values()]))
        contexts = np.unique(union >> np.uint64(8))
        value = np.zeros((len(union), len(languages)), np.float32)
        escape = np.zeros((len(contexts), len(languages)), np.float32)
        shorter = np.full((len(union), len(languages)), 8, np.float32) if below is None else below.values[
            below.find(union & np.uint64((1 << 8 * k) - 1))]
        for j, name in enumerate(languages):
            gram, count = seen[name]
            place = np.searchsorted(contexts, gram >> np.uint64(8))
            total = np.bincount(place, count, len(contexts))
            distinct = np.bincount(place, minlength=len(contexts))
            known = distinct > 0
            escape[known, j] = -np.log2(distinct[known] / (total[known] + distinct[known]))
            # Unseen here: the escape of the context, if this language has it, and the code of the shorter one.
            value[:, j] = shorter[:, j] + escape[np.searchsorted(contexts, union >> np.uint64(8)), j]
            value[np.searchsorted(union, gram), j] = -np.log2(count / (total + distinct)[place])
        below = Table(union, value)
        codes.append(below)
        escapes.append(Table(contexts, escape))
    return Model(languages, order, codes, escapes)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 200,
        max_chars: int = 20_000, max_languages: int = 1000, order: int = ORDER, words_only: bool = False) -> Model | None:
    """Learn from rows with text and label, or from their ``words_of``; None if there are none. Runs two small jobs."""
    rows = labelled.select(labelled[lang_col].alias("lang"), labelled[text_col].alias("text"), F.length(labelled[text_col]).alias("n"),
                           F.xxhash64(labelled[id_col].cast("string"), labelled[text_col]).alias("h")).filter(F.col("lang").isNotNull() & (F.col("n") > 0))
    short = F.col("n") <= max_chars
    counts = rows.groupBy("lang").agg(F.count_if(short).alias("count"), F.min(F.struct("n", "h")).alias("shortest")).limit(max_languages + 1).collect()
    if not counts:
        return None
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    # A share of the hash range that holds about twice the rows wanted, then the smallest hashes of each language.
    sampled = F.lit(False)
    if any(c["count"] for c in counts):
        share = F.create_map(*[x for c in counts if c["count"] for x in (F.lit(c["lang"]), F.lit(min(1.0, (2 * per_language + 50) / c["count"])))])
        sampled = short & ((F.col("h").cast("double") / 2.0 ** 64 + 0.5) <= share[F.col("lang")])
    # Languages with long texts only: of each the shortest.
    for c in counts:
        if not c["count"]:
            sampled = sampled | ((F.col("lang") == c["lang"]) & (F.col("n") == c["shortest"]["n"]) & (F.col("h") == c["shortest"]["h"]))
    some = rows.filter(sampled)
    texts: dict[str, list[tuple[int, bytes]]] = {}
    for row in some.collect():
        texts.setdefault(row["lang"], []).append((row["h"], (words_of(row["text"]) if words_only else row["text"]).encode()))
    return train({name: [t for _, t in sorted(found)[:per_language]] for name, found in texts.items()}, order)


def score(bits: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """Share of the best language if each weighs 2 ** -(bits per ``_EVIDENCE`` bytes)."""
    excess = (bits - bits.min(axis=1, keepdims=True)) * (_EVIDENCE / np.maximum(n_bytes, _EVIDENCE))[:, None]
    return 1 / np.exp2(-excess).sum(axis=1)


def _blank_cuts(text: str, size: int) -> Iterator[str]:
    """A text in pieces of about ``size`` characters, cut at blanks."""
    begin = 0
    while begin < len(text):
        blank = _BLANK.search(text, begin + size)
        end = blank.start() if blank else len(text)
        yield text[begin:end]
        begin = end


def words_of(text: str) -> str:
    """The words of a text in lower case without marks and without words that hold a digit; those too if there are no others."""
    parts = [" ".join(_LETTERS.findall(_NUMBERED.sub(" ", part.lower()))) for part in _blank_cuts(text, _PART)]
    if not any(parts):
        parts = [" ".join(_LETTERS.findall(part.lower())) for part in _blank_cuts(text, _PART)]
    return " ".join(filter(None, parts))


def own_bits(data: np.ndarray) -> float:
    """Bits a byte of a text whose bytes are coded one by one by their own frequencies."""
    counts = np.bincount(data)
    share = counts[counts > 0] / max(1, len(data))
    return float(-(share * np.log2(share)).sum())


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None, words_only: bool = False) -> DataFrame:
    """``keep`` columns (default: all) and ``lang_pred``, ``score`` (0 to 1), ``bits_per_byte`` of the whole text or of its ``words_of``,
    ``own_bits_per_byte``, what those cost without any language, and ``n_bytes``, how many they are."""
    keep = docs.columns if keep is None else keep
    has_letter: Column = F.coalesce(docs[text_col].rlike(r"\p{L}"), F.lit(False))
    # A text that is kept crosses to Python once.
    own = keep.index(text_col) if text_col in keep else len(keep)
    chosen = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate([*keep, *[text_col] * (own == len(keep))])], has_letter.alias("l"))
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema.fields[:len(keep)]]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            column = batch.column(own).cast(pa.binary())
            column = pc.if_else(batch.column(batch.num_columns - 1), column, pa.scalar(None, pa.binary()))
            for begin, end in slices(pc.fill_null(pc.binary_length(column), 0).to_pylist(), _PART):
                part = column.slice(begin, end - begin).to_pylist()
                if words_only:
                    part = [None if t is None else words_of(t.decode()).encode() for t in part]
                sizes = np.array([len(t or b"") for t in part], np.int64)
                names, points = [UNDETERMINED] * len(part), [0.0] * len(part)
                rates: list[float | None] = [None] * len(part)
                plain: list[float | None] = [None] * len(part)
                if known is not None:
                    borders = np.concatenate([[0], np.cumsum(sizes)])
                    data = np.frombuffer(b"".join(t or b"" for t in part), np.uint8)
                    bits = known.code_lengths(data, borders)
                    best, sure = bits.argmin(axis=1), score(bits, sizes)
                    for i, t in enumerate(part):
                        if t is not None:
                            names[i], points[i] = known.languages[best[i]], float(sure[i])
                            rates[i] = float(bits[i, best[i]] / max(1, sizes[i]))
                            plain[i] = own_bits(data[borders[i]:borders[i + 1]])
                lengths = [None if t is None else len(t) for t in part]
                columns = [batch.column(i).slice(begin, end - begin) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(names, pa.string()), pa.array(points, pa.float64()), pa.array(rates, pa.float64()),
                     pa.array(plain, pa.float64()), pa.array(lengths, pa.int64())],
                    [*batch.schema.names[:len(keep)], "lang_pred", "score", "bits_per_byte", "own_bits_per_byte", "n_bytes"])

    out = chosen.mapInArrow(run, ", ".join([*kept, "lang_pred string", "score double", "bits_per_byte double", "own_bits_per_byte double", "n_bytes bigint"]))
    return out.toDF(*keep, "lang_pred", "score", "bits_per_byte", "own_bits_per_byte", "n_bytes")


def held_out(id_col: Column) -> Column:
    """Rows kept from learning: remainder 2 of the id's CRC-32 by 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))
