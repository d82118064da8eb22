"""Importance resampling of documents towards a target corpus, by hashed n-grams.

Features are the runs of 1 to 3 words of a text, hashed into ``BUCKETS`` buckets. A bucket's gain is the log of its share in the
target over its share in the documents (both smoothed by one), and a document's weight is the sum of the gains of its
features. Adding Gumbel noise drawn from the id and taking the highest scores draws without replacement in proportion to
exp(weight).

Each batch interns its n-grams in a ``GramTable``, an open-addressed table in NumPy arrays: keys are the n-grams' 64-bit xxHash, every
hit is verified byte by byte, and a slot keeps the n-gram's bucket and its count. Counting adds the slots' counts up by bucket;
weighing gathers the gains through the slot id of every occurrence. Texts are worked through in pieces of ``_PIECE`` bytes, cut
between words, each piece taking over the last two words of the former, so a long text takes no more memory than many short ones.

``draw`` reads the documents twice (counts, weights), without a shuffle of texts; what the driver sees is one number per bucket and one
per range of scores. Scores are ranked in range partitions with the number of rows before each.

Defined results: a null text has no words, weight 0 and no features; repeated rows are documents of their own, and take ranks of
their own in any order; null ids are hashed as an empty number and stand behind all others of their score. Without
documents or target the gains follow from the smoothing alone.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.session import scratch_path

BUCKETS = 10_000
WORDS = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
_PIECE = 1 << 19
_LONG = 256  # n-grams of more bytes go to the libraries one by one
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
# The five primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
# Where its four lanes begin: P1 + P2, P2, 0 and -P1.
_LANES = [np.uint64(x % (1 << 64)) for x in (int(_P1) + int(_P2), int(_P2), 0, -int(_P1))]


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(state: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotated(state + lane * _P2, 31) * _P1


@dataclass
class Bytes:
    """A buffer and the little-endian number that its eight bytes from every place on make."""

    raw: bytes
    data: np.ndarray
    lanes: np.ndarray

    @classmethod
    def of(cls, raw: bytes) -> Bytes:
        padded = raw + bytes(8)
        view = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
        return cls(raw, np.frombuffer(raw, np.uint8), view.copy())


def xxhash64(buffer: Bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of every stretch of the buffer, in vector steps over all of them."""
    out = np.empty(len(starts), np.uint64)
    long_ = lengths > _LONG
    for i in np.flatnonzero(long_):
        out[i] = xxhash.xxh64_intdigest(buffer.raw[starts[i]:starts[i] + lengths[i]])
    rows = np.flatnonzero(~long_)
    at, size = starts[rows].copy(), lengths[rows]
    h = np.full(len(rows), _P5)
    wide = np.flatnonzero(size >= 32)
    if len(wide):
        state = [np.full(len(wide), s) for s in _LANES]
        live = np.arange(len(wide))
        for stripe in range(int(size.max()) // 32):
            live = live[size[wide[live]] >= 32 * (stripe + 1)]
            for k in range(4):
                state[k][live] = _round(state[k][live], buffer.lanes[at[wide[live]] + 32 * stripe + 8 * k])
        joined = _rotated(state[0], 1) + _rotated(state[1], 7) + _rotated(state[2], 12) + _rotated(state[3], 18)
        for s in state:
            joined = (joined ^ _round(np.zeros_like(s), s)) * _P1 + _P4
        h[wide] = joined
        at[wide] += size[wide] // 32 * 32
    h += size.astype(np.uint64)
    left = np.where(size >= 32, size % 32, size)
    live = np.flatnonzero(left >= 8)
    while len(live):
        lane = buffer.lanes[at[live]]
        h[live] = _rotated(h[live] ^ _round(np.zeros_like(lane), lane), 27) * _P1 + _P4
        at[live] += 8
        left[live] -= 8
        live = live[left[live] >= 8]
    live = np.flatnonzero(left >= 4)
    if len(live):
        half = buffer.lanes[at[live]] & np.uint64(0xFFFFFFFF)
        h[live] = _rotated(h[live] ^ (half * _P1), 23) * _P2 + _P3
        at[live] += 4
        left[live] -= 4
    live = np.flatnonzero(left > 0)
    while len(live):
        one = buffer.lanes[at[live]] & np.uint64(0xFF)
        h[live] = _rotated(h[live] ^ (one * _P5), 11) * _P1
        at[live] += 1
        left[live] -= 1
        live = live[left[live] > 0]
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    h ^= h >> np.uint64(32)
    out[rows] = h
    return out


def equal(buffer: Bytes, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the stretches at ``a`` and ``b`` of these lengths hold the same bytes."""
    same = np.ones(len(a), bool)
    for i in np.flatnonzero(lengths > _LONG):
        same[i] = buffer.raw[a[i]:a[i] + lengths[i]] == buffer.raw[b[i]:b[i] + lengths[i]]
    live = np.flatnonzero((lengths <= _LONG) & (a != b))
    done = 0
    while len(live):
        unlike = buffer.lanes[a[live] + done] ^ buffer.lanes[b[live] + done]
        rest = np.minimum(lengths[live] - done, 8).astype(np.uint64)
        shift = (np.uint64(8) - rest) * np.uint64(8)
        fit = (unlike << shift) == 0
        same[live[~fit]] = False
        done += 8
        live = live[fit & (lengths[live] > done)]
    return same


def _crc_table() -> np.ndarray:
    return np.array([zlib.crc32(bytes([i])) ^ 0xFF000000 ^ zlib.crc32(b"\0") ^ 0xFF000000 for i in range(256)], np.uint32)


_CRC = _crc_table()


def crc32(buffer: Bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of every stretch, a byte of all of them at a time."""
    out = np.empty(len(starts), np.uint32)
    long_ = lengths > _LONG
    for i in np.flatnonzero(long_):
        out[i] = zlib.crc32(buffer.raw[starts[i]:starts[i] + lengths[i]])
    # Longest first: those still running are always a prefix.
    rows = np.flatnonzero(~long_)
    rows = rows[np.argsort(-lengths[rows], kind="stable")]
    at, size = starts[rows], lengths[rows]
    state = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    running = np.searchsorted(-size, -np.arange(1, (int(size[0]) if len(size) else 0) + 1), side="right")
    for k, n in enumerate(running.tolist()):
        part = state[:n]
        state[:n] = _CRC[(part ^ buffer.data[at[:n] + k]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    out[rows] = state ^ np.uint32(0xFFFFFFFF)
    return out


@dataclass
class GramTable:
    """N-grams of one batch: ``slot`` of every occurrence; key, place, bucket and count of every slot."""

    slot: np.ndarray
    used: np.ndarray
    bucket: np.ndarray
    count: np.ndarray


def intern(buffer: Bytes, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None = None) -> GramTable:
    """Open addressing with linear probing, all occurrences at once.

    In every round an occurrence on a free slot claims it (of several the last one) and all that meet their own
    bytes on their slot stay; the others go one slot on. ``keys`` replaces the hash in tests of equal keys.
    """
    keys = xxhash64(buffer, starts, lengths) if keys is None else keys
    bits = max(4, int(2 * max(1, len(starts))).bit_length())
    size, owner = 1 << bits, np.full(1 << bits, -1, np.int64)
    slot, at = np.empty(len(starts), np.int64), (keys >> np.uint64(64 - bits)).astype(np.int64)
    todo = np.arange(len(starts))
    while len(todo):
        free = owner[at] < 0
        owner[at[free]] = todo[free]
        held = owner[at]
        fit = (keys[held] == keys[todo]) & (lengths[held] == lengths[todo])
        maybe = np.flatnonzero(fit)
        fit[maybe] = equal(buffer, starts[held[maybe]], starts[todo[maybe]], lengths[todo[maybe]])
        slot[todo[fit]] = at[fit]
        todo, at = todo[~fit], (at[~fit] + 1) & (size - 1)
    used = np.flatnonzero(owner >= 0)
    first = owner[used]
    bucket = np.zeros(size, np.int64)
    bucket[used] = crc32(buffer, starts[first], lengths[first]) % np.uint32(BUCKETS)
    return GramTable(slot, used, bucket, np.bincount(slot, minlength=size))


@dataclass
class Grams:
    """One piece of work: n-gram occurrences with the text each belongs to, and the words met per text."""

    table: GramTable
    text: np.ndarray
    words: np.ndarray


def _cut(text: bytes, begin: int) -> int:
    """Where the piece that begins here ends: behind the last gap between words in reach, or the next one if there is none."""
    end = min(begin + _PIECE, len(text))
    if end == len(text):
        return end
    gaps = np.flatnonzero(~_WORD[np.frombuffer(text[begin:end].lower(), np.uint8)])
    if len(gaps):
        return begin + int(gaps[-1]) + 1
    while end < len(text):
        gaps = np.flatnonzero(~_WORD[np.frombuffer(text[end:end + _PIECE].lower(), np.uint8)])
        if len(gaps):
            return end + int(gaps[0]) + 1
        end += _PIECE
    return len(text)


def _parts(texts: list[bytes | None]) -> Iterator[list[tuple[int, bytes, bool]]]:
    """Consecutive (text, lower-case piece, whether the text goes on), about ``_PIECE`` bytes together."""
    some, total = [], 0
    for i, text in enumerate(texts):
        begin = 0
        while text and begin < len(text):
            end = _cut(text, begin)
            if some and total + end - begin > _PIECE:
                yield some
                some, total = [], 0
            some.append((i, text[begin:end].lower(), end < len(text)))
            total += end - begin
            begin = end
    if some:
        yield some


def _last_words(piece: bytes) -> tuple[bytes, int]:
    """The words that n-grams of the next piece may begin with, and how many."""
    inside = _WORD[np.frombuffer(piece, np.uint8)]
    begins = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))[-(WORDS - 1):]
    return (piece[begins[0]:] if len(begins) else b""), len(begins)


def grams(texts: list[bytes | None]) -> Iterator[Grams]:
    """All n-grams of whole texts, a bounded number of bytes at a time."""
    carried = (b"", 0)
    for part in _parts(texts):
        pieces, owners, skip = [], [], []
        for i, piece, more in part:
            pieces.append(carried[0] + b" " + piece)
            owners.append(i)
            skip.append(carried[1])
            carried = _last_words(pieces[-1]) if more else (b"", 0)
        raw = b" ".join(pieces) + b" "
        data = np.frombuffer(raw, np.uint8)
        inside = _WORD[data]
        starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
        lengths = ends - starts
        # Words one behind the other, each before one blank.
        kept = inside.copy()
        kept[ends] = True
        packed = np.where(inside, data, np.uint8(32))[kept].tobytes()
        buffer = Bytes.of(packed)
        place = np.cumsum(lengths + 1) - (lengths + 1)
        borders = np.concatenate([[0], np.cumsum([len(p) + 1 for p in pieces])])
        piece_of = np.searchsorted(borders, starts, side="right") - 1
        first = np.searchsorted(piece_of, np.arange(len(pieces)))
        nth = np.arange(len(starts)) - first[piece_of]
        old = np.array(skip, np.int64)[piece_of]
        text_of = np.array(owners, np.int64)[piece_of]
        begin, size, text = [], [], []
        for n in range(1, WORDS + 1):
            last = np.flatnonzero((nth >= n - 1) & (nth >= old))  # an n-gram belongs to the piece of its last word
            begin.append(place[last - (n - 1)])
            size.append(place[last] + lengths[last] - place[last - (n - 1)])
            text.append(text_of[last])
        fresh = np.bincount(text_of[nth >= old], minlength=len(texts))
        yield Grams(intern(buffer, np.concatenate(begin), np.concatenate(size)), np.concatenate(text), fresh)


def _columns(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            some = batch.slice(begin, rows)
            yield some, some.column(some.num_columns - 1).cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features per bucket over all rows: one row per task and bucket, summed behind one small shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for _, some in _columns(batches):
            for g in grams(some):
                total += np.bincount(g.table.bucket[g.table.used], g.table.count[g.table.used], BUCKETS).astype(np.int64)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    rows = texts.select(text_col).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    of_source, of_target = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * of_source / ((s + 1.0) * of_target))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(id_: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from the first 32 bits of SHA-256 of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``id_col``, ``n_words``, ``n_features``, ``weight`` and ``score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for some, texts in _columns(batches):
            words, features, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for g in grams(texts):
                words += g.words
                features += np.bincount(g.text, minlength=len(texts))
                # Sums of whole numbers below 2 ** 53 are exact in doubles.
                weight += np.bincount(g.text, gain[g.table.bucket][g.table.slot], len(texts)).astype(np.int64)
            drawn = np.array([noise(i, seed) for i in some.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [some.column(0), *(pa.array(x, pa.int64()) for x in (words, features, weight, weight + drawn))],
                ["id", "n_words", "n_features", "weight", "score"])

    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, f"id {kind}, n_words bigint, n_features bigint, weight bigint, score bigint")
    return out.withColumnRenamed("id", id_col)


def rank_rows(rows: DataFrame, id_col: str, most: int) -> DataFrame:
    """Add ``rank``: 1, 2, 3 ... by score, then id, up to ``most``; null behind. No task sees more than a range of scores."""
    spark = rows.sparkSession
    # Rows with one score and one id may be many; their file and place tell them apart.
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("_tie").asc()]
    path = scratch_path(spark, "ranges")
    rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).orderBy("_range").collect()
    before, total = {}, 0
    for row in sizes:
        before[row["_range"]] = total
        total += row["n"]
    offsets = spark.createDataFrame(list(before.items()), "_range int, _before bigint")  # one row per partition
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) + F.col("_before")
    ranked = ranged.join(F.broadcast(offsets), "_range").withColumn("rank", rank)
    return ranked.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank"))).drop("_range", "_before", "_tie")


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS,
         seed: int = SEED) -> DataFrame:
    """Every document with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``; those of a rank are the ones drawn:
    ``percent`` of the documents of ``min_words`` words or more."""
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, text_col))
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "weights")
    weigh(docs, gains, id_col, text_col, seed).write.parquet(path)
    weighed = spark.read.parquet(path)
    able = weighed.filter(F.col("n_words") >= min_words)
    ranked = rank_rows(able, id_col, percent * able.count() // 100)
    return ranked.unionByName(weighed.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint")))
