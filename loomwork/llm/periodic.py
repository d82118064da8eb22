"""Runs of periodically repeated words, found through maximal pairs.

A run is a stretch of words with smallest period q and at least ``min_exponent`` times q words that no neighbouring
word extends. Let s be its start and L its length: the suffixes at s and s + q agree on exactly L - q words and stand behind
different words, so they are a maximal pair at distance q. Conversely a maximal pair at distance d that agrees on l >= (min_exponent - 1) d
words spans a stretch of l + d words with period d that cannot be extended; of the pairs with one stretch the nearest has its smallest
period. Nothing needs extending.

``runs`` works on the words of many texts at once. Prefix doubling sorts the suffixes, texts kept apart; only those
that share enough words with another one go on. Their longest common prefixes give the tree of LCP intervals, walked bottom
up. Each interval hands up its places in order, each with the word on its left as its class; where children meet, neighbouring
places of different children and different left words within the allowed distance are the pairs. Neighbours suffice: a place between s and
s + q would give the stretch a smaller period.

Every task works on its own rows, a bounded number of bytes at a time, without a shuffle; a text longer than that takes memory and, up to
a logarithm, time in proportion to its length.

Defined results: a null text, an empty one and one without words have no runs and collapse to the empty text; repeated rows
and equal texts get equal results; ids play no part.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from loomwork.llm.tokens import slices

MIN_EXPONENT = 4
MIN_LENGTH = 6
_PART = 1 << 19
_MANY = 32
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _doubled(rank: np.ndarray, ends: np.ndarray, least: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks by the first 1, 2, 4 ... words until all differ, and the places whose first words, up to ``least``, another one shares."""
    levels, step = [rank], 1
    live = np.arange(len(rank))
    shared = live[:0]
    while True:
        counts = np.bincount(rank[live], minlength=len(rank)) if len(live) else np.zeros(len(rank), np.int64)
        live = live[counts[rank[live]] > 1]
        if step <= least:
            shared = live
        if not len(live):
            return levels, shared
        there = live + step
        inside = there < ends[live]
        behind = np.zeros(len(live), np.int64)
        behind[inside] = rank[there[inside]] + 1
        key = rank[live].astype(np.int64) * (len(rank) + 1) + behind
        order = np.argsort(key, kind="stable")
        key, old, place = key[order], rank[live[order]], np.arange(len(live))
        first = lambda x: np.maximum.accumulate(np.where(np.concatenate([[True], x[1:] != x[:-1]]), place, 0))
        # A group's rank is its first place in the order of all suffixes; its parts follow behind one another.
        rank = rank.copy()
        rank[live[order]] = old + (first(key) - first(old)).astype(rank.dtype)
        levels.append(rank)
        step *= 2


def _common(levels: list[np.ndarray], ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` have in common."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        at = np.flatnonzero((a + length < ends[a]) & (b + length < ends[b]))
        same = at[levels[k][a[at] + length[at]] == levels[k][b[at] + length[at]]]
        length[same] += 1 << k
    return length


def _merge(common: int, children: list[list[int]], left: list[int], reach: int, found: list[tuple[int, int, int]]) -> list[int]:
    """One ordered list of the children's places; pairs between neighbours of different children go to ``found``."""
    children.sort(key=len)
    large = children.pop()
    rest = sum(map(len, children))
    if len(large) < _MANY * rest:
        children.append(large)
        tagged = sorted((place, child) for child, places in enumerate(children) for place in places)
        for (a, one), (b, other) in zip(tagged, tagged[1:]):
            if one != other and b - a <= reach and left[a] != left[b]:
                found.append((a, common + b - a, b - a))
        return [place for place, _ in tagged]
    owner = {place: child for child, places in enumerate(children) for place in places}
    for place, child in owner.items():
        at = bisect(large, place)
        if at and place - large[at - 1] <= reach and owner.get(large[at - 1]) != child and left[large[at - 1]] != left[place]:
            found.append((large[at - 1], common + place - large[at - 1], place - large[at - 1]))
        if at < len(large) and large[at] - place <= reach and owner.get(large[at]) != child and left[large[at]] != left[place]:
            found.append((place, common + large[at] - place, large[at] - place))
        large.insert(at, place)
    return large


def _pairs(places: list[int], common: list[int], left: list[int], least: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, distance) of maximal pairs; ``common[i]`` is what suffix i of the order shares with the one before it."""
    found: list[tuple[int, int, int]] = []
    open_: list[tuple[int, list[list[int]]]] = []
    done = [places[0]]
    for i in range(1, len(places) + 1):
        now = common[i] if i < len(places) else 0
        while open_ and open_[-1][0] > now:
            length, children = open_.pop()
            children.append(done)
            done = _merge(length, children, left, length // (exponent - 1), found)
        if now >= least:
            if open_ and open_[-1][0] == now:
                open_[-1][1].append(done)
            else:
                open_.append((now, [done]))
        if i < len(places):
            done = [places[i]]
    return found


def runs(words: list[list[bytes]], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """Per text its runs as (start, length, period), by start, then period. ``min_exponent`` is 3 or more."""
    if min_exponent < 3:
        raise ValueError("exponents below 3 need pairs that are no neighbours")
    sizes = np.array([len(w) for w in words], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    total = int(sizes.sum())
    if not total:
        return out
    least = min(max((min_exponent - 1) * d, min_length - d) for d in range(1, max(min_length, 2)))
    numbers = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(words)))}
    word = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), np.int64, total)
    text = np.repeat(np.arange(len(words)), sizes)
    begins = np.cumsum(sizes) - sizes
    ends = np.repeat(begins + sizes, sizes)
    key = text * len(numbers) + word
    order = np.argsort(key, kind="stable")
    opens = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(total, np.int32 if total < 1 << 31 else np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens, np.arange(total), 0))
    levels, shared = _doubled(rank, ends, least)
    if not len(shared):
        return out
    places = shared[np.argsort(levels[-1][shared], kind="stable")]
    common = np.zeros(len(places), np.int64)
    common[1:] = _common(levels, ends, places[:-1], places[1:])
    left = np.concatenate([[-1], word[:-1]])
    left[begins[sizes > 0]] = -1  # no word; there is one such place in a text, and texts never meet
    shortest: dict[tuple[int, int], int] = {}
    for start, length, period in _pairs(places.tolist(), common.tolist(), left.tolist(), least, min_exponent):
        if length >= min_length and period < shortest.get((start, length), period + 1):
            shortest[start, length] = period
    for (start, length), period in shortest.items():
        out[text[start]].append((start - int(begins[text[start]]), length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def kept(n_words: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Words that no run contains behind its first period."""
    change = np.zeros(n_words + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def collapse(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, min_exponent: int = MIN_EXPONENT,
             min_length: int = MIN_LENGTH) -> DataFrame:
    """``keep`` columns (default: all), ``runs`` of the whole text and ``collapsed``, its words without the repeats, joined by one blank."""
    keep = docs.columns if keep is None else keep
    chosen = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs[text_col].alias("t"))
    schema = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary())
            for begin, end in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), _PART):
                words = [(t or b"").split() for t in texts.slice(begin, end - begin).to_pylist()]
                found = runs(words, min_exponent, min_length)
                short = [b" ".join([w for w, k in zip(some, kept(len(some), of).tolist()) if k] if of else some) for some, of in zip(words, found)]
                columns = [batch.column(i).slice(begin, end - begin) for i in range(batch.num_columns - 1)]
                rows = [[{"start": s, "length": n, "period": p} for s, n, p in of] for of in found]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, kind), pa.array(short, pa.binary()).cast(pa.string())],
                                                 [*batch.schema.names[:-1], "runs", "collapsed"])

    return chosen.mapInArrow(run, ", ".join([*schema, f"runs {RUNS}", "collapsed string"])).toDF(*keep, "runs", "collapsed")
