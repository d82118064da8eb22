"""Toxicity scores by a factorization machine over hashed terms.

Terms are the words of a text in lower case (runs of ASCII letters, digits and characters beyond ASCII), each as a whole and by
its beginnings of ``PREFIXES`` bytes; ``term_rates`` hashes them into ``2 ** BUCKETS`` buckets. A bucket's value is how many
of its terms the text holds per ``PER_WORDS`` words, at most 1, so a text's length plays no part. The machine adds to a linear
model the product of every two terms' values, weighted by the inner product of their factors, which is what tells an insult
beside the name of a group from either of them alone.

``fit`` learns from labelled rows: of each class the ``per_class`` ids with the smallest hash, weighted back to the share their
class has among all labelled ids, and as many of their texts, in hash order, as have ``max_terms`` terms together. This bounds the
sample that reaches the driver whatever the table's size; the model (buckets x (1 + factors) numbers) is bounded by its shape.
Buckets whose values do not differ between the classes beyond chance stay out of the machine.
``score`` runs in the rows' own partitions, without a shuffle, over whole texts in pieces of ``_PIECE`` characters, so
a long text takes no more memory than a short one.

Defined results: a null or empty text, and one without words, gets the score of no terms, which is the model's base rate; without
labels of both classes to learn from, every text gets 0. Labels that are null are left out; of several labels of one
id the largest counts. Equal texts get equal scores. A word longer than a piece is cut there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.session import scratch_path

BUCKETS = 17
PREFIXES = (4, 5, 6, 7, 8)
PER_WORDS = 50
FACTORS = 4
LIMIT = 0.7
_PIECE = 1 << 18
_BATCH_BYTES = 1 << 19
_STEP = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _terms(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every term of lower-case UTF-8 texts laid end to end, and the number of words per text."""
    inside = _WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[borders[:-1][np.diff(borders) > 0]] = inside[borders[:-1][np.diff(borders) > 0]]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(borders, starts, side="right") - 1
    words = np.bincount(text, minlength=len(borders) - 1)
    lengths, state = ends - starts, np.full(len(starts), 1469598103934665603, np.uint64)
    buckets, texts = [], []

    def emit(rows: np.ndarray, states: np.ndarray, kind: int) -> None:
        mixed = (states + np.uint64(kind)) * _MIX
        buckets.append(((mixed ^ (mixed >> np.uint64(29))) * _MIX >> np.uint64(64 - BUCKETS)).astype(np.int64))
        texts.append(text[rows])

    # The hash runs over a word byte by byte; words that have ended leave the loop.
    rows, k = np.arange(len(starts)), 0
    while len(rows):
        state = (state ^ data[starts[rows] + k].astype(np.uint64)) * _STEP
        k += 1
        if k in PREFIXES:
            emit(rows, state, 1)
        ended = lengths[rows] == k
        if ended.any():
            emit(rows[ended], state[ended], 2)
            rows, state = rows[~ended], state[~ended]
    none = np.empty(0, np.int64)
    return np.concatenate([none, *buckets]), np.concatenate([none, *texts]), words


@dataclass
class Rates:
    """Values of the buckets of some texts: those of text i lie in ``borders[i]:borders[i + 1]``."""

    buckets: np.ndarray
    values: np.ndarray
    borders: np.ndarray


def _pieces(text: str) -> Iterator[str]:
    """A text in lower case, cut between words every ``_PIECE`` characters."""
    begin = 0
    while begin < len(text):
        end = min(begin + _PIECE, len(text))
        if end < len(text):
            blank = max(text.rfind(c, begin, end) for c in " \n\t")
            end = blank + 1 if blank >= begin else end
        yield text[begin:end].lower()
        begin = end


def _groups(texts: list[str | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Pieces of consecutive texts, about ``_BATCH_BYTES`` at once."""
    owners, parts, total = [], [], 0
    for i, text in enumerate(texts):
        for piece in _pieces(text or ""):
            raw = piece.encode("utf-8", "replace")
            if parts and total + len(raw) > _BATCH_BYTES:
                yield owners, parts
                owners, parts, total = [], [], 0
            owners.append(i)
            parts.append(raw)
            total += len(raw)
    if parts:
        yield owners, parts


def term_rates(texts: list[str | None]) -> Rates:
    """Rates of all texts. A text in several pieces is summed over them."""
    words = np.zeros(len(texts), np.int64)
    keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for owners, parts in _groups(texts):
        borders = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        bucket, part, n = _terms(np.frombuffer(b"".join(parts), np.uint8), borders)
        owner = np.array(owners, np.int64)
        np.add.at(words, owner, n)
        key, count = np.unique((owner[part] << BUCKETS) | bucket, return_counts=True)
        if len(keys) > 1 and len(key) and keys[-1][-1] >= key[0]:  # the last text goes on in this group
            both, at = np.unique(np.concatenate([keys.pop(), key]), return_inverse=True)
            count = np.bincount(at, np.concatenate([counts.pop(), count])).astype(np.int64)
            key = both
        if len(key):
            keys.append(key)
            counts.append(count)
    key, count = np.concatenate(keys), np.concatenate(counts)
    owner = key >> BUCKETS
    values = np.minimum(1.0, count * (PER_WORDS / np.maximum(words[owner], PER_WORDS))).astype(np.float32)
    return Rates((key & ((1 << BUCKETS) - 1)).astype(np.int32), values, np.searchsorted(owner, np.arange(len(texts) + 1)))


@dataclass
class Machine:
    """A factorization machine of order two."""

    base: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, rates: Rates) -> np.ndarray:
        n = len(rates.borders) - 1
        row = np.repeat(np.arange(n), np.diff(rates.borders))
        out = self.base + np.bincount(row, self.linear[rates.buckets] * rates.values, n)
        for f in range(self.factors.shape[1]):
            part = self.factors[rates.buckets, f] * rates.values
            out += 0.5 * (np.bincount(row, part, n) ** 2 - np.bincount(row, part * part, n))
        return out

    def probabilities(self, rates: Rates) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rates), -30, 30)))


def telling(rates: Rates, labels: np.ndarray, weights: np.ndarray, least: int, sure: float) -> np.ndarray:
    """Buckets met in ``least`` rows whose mean value differs between the classes by ``sure`` standard errors."""
    size = 1 << BUCKETS
    row = np.repeat(np.arange(len(labels)), np.diff(rates.borders))
    mean = [np.bincount(rates.buckets, np.where(labels == side, weights, 0)[row] / max(weights[labels == side].sum(), 1e-9) * rates.values, size) for side in (0, 1)]
    share = weights[labels == 1].sum() / weights.sum()
    middle = mean[0] * (1 - share) + mean[1] * share
    spread = np.bincount(rates.buckets, (weights / weights.sum())[row] * rates.values.astype(np.float64) ** 2, size) - middle ** 2
    error = np.maximum(spread, 1e-12) * sum(1 / max((labels == side).sum(), 1) for side in (0, 1))
    return (np.abs(mean[1] - mean[0]) >= sure * np.sqrt(error)) & (np.bincount(rates.buckets, minlength=size) >= least)


def train(rates: Rates, labels: np.ndarray, weights: np.ndarray, factors: int = FACTORS, rounds: int = 20, least: int = 4,
          sure: float = 4.0, rate: float = 0.1, decay: float = 1e-2, part: int = 64, seed: int = 7) -> Machine:
    """Stochastic steps on the weighted log loss with one step size per number (AdaGrad).

    Only the buckets of ``telling`` are learned, since others could only be learned by heart.
    """
    size = 1 << BUCKETS
    common = telling(rates, labels, weights, least, sure)
    share = float(np.clip(np.average(labels, weights=weights), 1e-6, 1 - 1e-6))
    rng = np.random.default_rng(seed)
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.01, (size, factors)) * common[:, None])
    seen_linear, seen_factors, seen_base = np.full(size, 1e-2), np.full((size, factors), 1e-2), 1e-2
    keep = common[rates.buckets]
    row = np.repeat(np.arange(len(labels)), np.diff(rates.borders))[keep]
    bucket, value = rates.buckets[keep], rates.values[keep].astype(np.float64)
    borders = np.searchsorted(row, np.arange(len(labels) + 1))
    for _ in range(rounds):
        order = rng.permutation(len(labels))
        for begin in range(0, len(order), part):
            rows = order[begin:begin + part]
            at = np.concatenate([np.arange(borders[r], borders[r + 1]) for r in rows])
            local = np.repeat(np.arange(len(rows)), borders[rows + 1] - borders[rows])
            x, (ids, place) = value[at], np.unique(bucket[at], return_inverse=True)
            v = machine.factors[ids]
            sums = np.stack([np.bincount(local, v[place, f] * x, len(rows)) for f in range(factors)], axis=1)
            squares = np.bincount(local, (v[place] ** 2).sum(axis=1) * x * x, len(rows))
            margin = machine.base + np.bincount(local, machine.linear[ids][place] * x, len(rows)) + 0.5 * ((sums ** 2).sum(axis=1) - squares)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]) * weights[rows]
            pull = slope[local] * x
            down = np.bincount(place, pull, len(ids)) + decay * machine.linear[ids]
            seen_linear[ids] += down ** 2
            machine.linear[ids] -= rate * down / np.sqrt(seen_linear[ids])
            for f in range(factors):
                down = np.bincount(place, pull * (sums[local, f] - v[place, f] * x), len(ids)) + decay * v[:, f]
                seen_factors[ids, f] += down ** 2
                machine.factors[ids, f] -= rate * down / np.sqrt(seen_factors[ids, f])
            total = slope.sum()
            seen_base += total ** 2
            machine.base -= rate * total / np.sqrt(seen_base)
    return Machine(machine.base, machine.linear.astype(np.float32), machine.factors.astype(np.float32))


def held_out(id_col: Column) -> Column:
    """Rows kept from learning: remainder 1 of the id's CRC-32 by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """A few rows at a time, with their texts, which stand in the last column."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            some = batch.slice(begin, rows)
            yield some, some.column(some.num_columns - 1).to_pylist()


def _rate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some, texts in _slices(batches):
        rates = term_rates(texts)
        cut = list(zip(rates.borders.tolist(), rates.borders[1:].tolist()))
        yield pa.RecordBatch.from_arrays(
            [some.column(0), some.column(1), pa.array([b - a for a, b in cut], pa.int64()),
             pa.array([rates.buckets[a:b].tobytes() for a, b in cut], pa.binary()),
             pa.array([rates.values[a:b].tobytes() for a, b in cut], pa.binary())], ["h", "label", "n", "buckets", "rates"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_class: int = 2000, max_terms: int = 4_000_000) -> Machine | None:
    """Learn from the documents that ``labels`` (id, 0 or 1) names; None without both classes. Runs a few small jobs."""
    spark = docs.sparkSession
    named = labels.select(labels[id_col].alias("id"), (labels[label_col] > 0).cast("int").alias("label")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull()).groupBy("id").agg(F.max("label").alias("label"))
    totals = {r["label"]: r["n"] for r in named.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return None
    # The share of the hash range that holds the ids wanted and some more, so that few rows are sorted.
    share = F.when(F.col("label") == 1, min(1.0, (1.5 * per_class + 50) / totals[1])).otherwise(min(1.0, (1.5 * per_class + 50) / totals[0]))
    place = F.xxhash64(F.col("id").cast("string"))
    near = named.withColumn("h", place).filter(F.col("h").cast("double") / 2.0 ** 64 + 0.5 <= share)
    chosen = [r for side in (0, 1) for r in near.filter(F.col("label") == side).orderBy("h", "id").limit(per_class).collect()]
    ids = spark.createDataFrame(chosen, near.schema)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(F.broadcast(ids), "id")
    path = scratch_path(spark, "toxic-sample")
    # Rows repeated under one id count once.
    once = texts.dropDuplicates(["id", "text"]).select("h", "label", "text")
    once.mapInArrow(_rate_rows, "h bigint, label int, n bigint, buckets binary, rates binary").write.parquet(path)
    sample = spark.read.parquet(path)
    # Ids with many different texts: the first per_class texts of each class.
    sized = [r for side in (0, 1) for r in sample.filter(F.col("label") == side).select("h", "label", "n").orderBy("h", "n").limit(per_class).collect()]
    last, total = None, 0
    for row in sorted(sized):
        total += row["n"]
        if total > max_terms and last is not None:
            break
        last = row["h"]
    if last is None:
        return None
    rows = [r for side in (0, 1) for r in sample.filter((F.col("label") == side) & (F.col("h") <= last)).orderBy("h", "n", "buckets").limit(per_class).collect()]
    sides = np.array([r["label"] for r in rows], np.int64)
    counts = np.bincount(sides, minlength=2)
    if not counts.all():
        return None
    weights = (np.array([totals[0], totals[1]]) / counts)[sides]
    rates = Rates(np.frombuffer(b"".join(r["buckets"] for r in rows), np.int32), np.frombuffer(b"".join(r["rates"] for r in rows), np.float32),
                  np.concatenate([[0], np.cumsum([r["n"] for r in rows])]).astype(np.int64))
    return train(rates, sides.astype(np.float64), weights / weights.mean())


def score(docs: DataFrame, machine: Machine | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) and ``score``, the probability of label 1."""
    keep = docs.columns if keep is None else keep
    chosen = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs[text_col].alias("t"))
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for some, texts in _slices(batches):
            points = np.zeros(len(texts)) if known is None else known.probabilities(term_rates(texts))
            columns = [some.column(i) for i in range(some.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(points, pa.float64())], [*some.schema.names[:-1], "score"])

    return chosen.mapInArrow(run, ", ".join([*kept, "score double"])).toDF(*keep, "score")
