"""Substring dedup with a compressed FM-index per shard.

A window is ``window`` consecutive words of one document; it is repeated if the same words start earlier (smaller id, or same
document and earlier start). Every word under a repeated window is removed.

1. ``segments``: each window names the smallest hash among its runs of ``anchor`` words, so equal windows name the same anchor wherever
   they stand. Consecutive windows that name one place are a segment: anchor, hash of its words, place. About 2 / (window - anchor + 2) rows a word.
2. Segments whose anchor occurs once cannot hold a repeated window. Of the others, segments with the same words are told apart by
   place: all but the first are repeated as a whole, so only first ones are left, and a text that occurs any number of times is one.
3. First segments that share their anchor with other words meet in shards. A shard builds an FM-index of its segments and streams
   the same segments past it: backward search over the wavelet matrix gives for every end the longest match of up to ``window`` words
   and its suffix interval. Where the match is long enough, the smallest place in the interval tells which window came first. Runs of
   repeated windows are reported as intervals.
4. Intervals meet their documents, words under them go.

An anchor with more than ``hot`` different segments (a phrase used everywhere) would make one large shard: its segments are cut into single
windows, routed by the hash of the window itself, so equal windows still meet; a task sends on one of equal ones. Shards are
numbered by the volume of words.

Words are compared by 64-bit hashes; a wrong match would need two different windows whose words collide one by one.

Defined results: a null or empty text has no words; ids are expected to name one text, equal rows are one document to each other and get the same
result each; texts without an id are documents of their own, before all others in the order of their hashes; texts of any length are one
stream of words; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.fm_index import FMIndex
from loomwork.session import scratch_path

WINDOW = 20
ANCHOR = 6
HOT = 200
SHARD_WORDS = 250_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LEAST = -(1 << 63)
_PLACES = np.uint64((1 << 28) - 1)  # words of one text


def hash_words(data: bytes) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    words = data.split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(29))


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` words."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        out = _mixed(out ^ words[i:i + len(out)])
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours, by doubling."""
    out, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        out = np.minimum(out[:len(out) - step], out[step:])
        covered += step
    return out


def cut_segments(words: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """start, number of windows, anchor hash and hash of all words of each segment."""
    if len(words) < window:
        none = np.empty(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    # The leftmost smallest run, as its place: the upper bits of the hash decide, then the place. Windows that name one place
    # have it at different offsets, so the windows of a segment all differ.
    hashes = run_hashes(words, anchor)
    least = sliding_min((hashes & ~_PLACES) | np.arange(len(hashes), dtype=np.uint64), window - anchor + 1) & _PLACES
    starts = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
    counts = np.diff(np.concatenate([starts, [len(least)]]))
    # The words of a segment as a polynomial of its own: differences of running sums, shifted back to its start.
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(words), _ODD, np.uint64))
        inverse = np.cumprod(np.full(len(words), np.uint64(pow(int(_ODD), -1, 1 << 64)), np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(words) * powers, dtype=np.uint64)])
        ends = starts + counts + window - 1
        content = _mixed((sums[ends] - sums[starts]) * inverse[starts] + counts.astype(np.uint64))
    return starts, counts, hashes[least[starts].astype(np.int64)], content


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def segments(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """anchor, content, id, start, n (windows) of all segments. Input: id, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                starts, counts, anchors, content = cut_segments(hash_words(text.as_py() or b""), window, anchor)
                held.append((np.full(len(starts), _LEAST if doc_id is None else doc_id, np.int64), starts, counts, anchors, content))
                size += len(starts)
                if size > 100_000:
                    yield _segment_batch(held)
                    held, size = [], 0
            if size:
                yield _segment_batch(held)

    return docs.mapInArrow(run, "anchor bigint, content bigint, id bigint, start int, n int")


def _segment_batch(held: list) -> pa.RecordBatch:
    ids, starts, counts, anchors, content = (np.concatenate(x) for x in zip(*held))
    return pa.RecordBatch.from_arrays(
        [_signed(anchors), _signed(content), pa.array(ids), pa.array(starts.astype(np.int32)), pa.array(counts.astype(np.int32))],
        ["anchor", "content", "id", "start", "n"])


def _routed(firsts: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """The words of first segments: route, id, start, n, words. Hot segments as single windows, routed by their own hash.

    Equal hot windows are combined before the shuffle: a task sends on the first of each, the others as rows without words,
    routed by place, which are repeated for certain.
    """
    per_doc = firsts.groupBy("id").agg(F.collect_list(F.struct("start", "n", "anchor", "is_hot")).alias("parts"))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["route", "id", "start", "n", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot: dict[int, tuple] = {}
        for batch in batches:
            rows = []
            for doc_id, parts, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
                words = hash_words(text.as_py() or b"")
                whole = run_hashes(words, window).view(np.int64) if any(p["is_hot"] for p in parts) else None
                for p in parts:
                    begin, end = p["start"], p["start"] + p["n"]
                    if end + window - 1 > len(words):
                        continue  # of another text under the same id
                    if not p["is_hot"]:
                        rows.append((p["anchor"], doc_id, begin, p["n"], words[begin:end + window - 1].tobytes()))
                        continue
                    for at in range(begin, end):
                        found = (int(whole[at]), doc_id, at, 1, words[at:at + window].tobytes())
                        first = hot.get(found[0], found)
                        late = max(first, found, key=lambda r: r[1:3])
                        hot[found[0]] = min(first, found, key=lambda r: r[1:3])
                        if first[1:3] != found[1:3]:
                            rows.append((late[1] ^ late[2], late[1], late[2], 1, None))
                if len(rows) > 50_000:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)
        left = list(hot.values())
        for begin in range(0, len(left), 50_000):
            yield batch_of(left[begin:begin + 50_000])

    return per_doc.join(docs, "id").select("id", "parts", "text").mapInArrow(run, "route bigint, id bigint, start int, n int, words binary")


def repeated_in_shard(ids: np.ndarray, starts: np.ndarray, texts: list[np.ndarray], window: int) -> list[tuple[int, int, int]]:
    """Intervals (id, start, end) of words under windows that another text of the shard, or the same, has earlier."""
    index = FMIndex(texts)
    lengths = np.array([len(t) for t in texts])
    stream = index.codes(np.concatenate(texts))
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    owner = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(len(stream)) - begins[owner]
    ends = np.flatnonzero(place >= window - 1) + 1
    length, low, high = index.search(stream, ends, np.full(len(ends), window))
    # Place of every suffix in the order of the corpus, and the smallest of each interval. Intervals of one length are equal or apart.
    order = np.lexsort((starts, ids))
    text_of = np.searchsorted(index.begins, index.order, side="right") - 1
    rank = np.empty(len(texts), np.int64)
    same = np.concatenate([[False], (np.diff(ids[order]) == 0)])
    rank[order] = np.cumsum(~same)  # ids by rank; starts decide within one
    position = rank[text_of] * (1 << 32) + starts[text_of] + (index.order - index.begins[text_of])
    long_enough = length >= window
    lows, highs = low[long_enough], high[long_enough]
    groups, which = np.unique(lows, return_inverse=True)
    last = np.zeros(len(groups), np.int64)
    last[which] = highs
    bounds = np.stack([groups, last], axis=1).ravel()
    padded = np.concatenate([position, [np.iinfo(np.int64).max]])
    earliest = np.minimum.reduceat(padded, bounds)[::2] if len(bounds) else np.empty(0, np.int64)
    text, begin = owner[ends[long_enough] - 1], place[ends[long_enough] - 1] - window + 1
    own = rank[text] * (1 << 32) + starts[text] + begin
    late = own > earliest[which]
    text, begin = text[late], begin[late]
    if not len(text):
        return []
    fresh = np.concatenate([[True], (np.diff(text) != 0) | (np.diff(begin) != 1)])
    opened = np.flatnonzero(fresh)
    closed = np.concatenate([opened[1:], [len(text)]]) - 1
    return [(int(ids[t]), int(starts[t] + a), int(starts[t] + b + window))
            for t, a, b in zip(text[opened], begin[opened], begin[closed])]


def _key(id_col: Column, text: Column) -> Column:
    """The id; texts without one stand before all ids in the order of their hashes, each a document of its own."""
    return F.coalesce(id_col.cast("bigint"), F.lit(_LEAST) + F.pmod(F.xxhash64(text), F.lit(1 << 61)))


def repeated_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
                       hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """id, start, end: intervals of words (they may overlap) that cover exactly the repeated windows."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "substrings")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    source = docs.select(_key(docs[id_col], docs[text_col]).alias("id"), docs[text_col].alias("text"))
    # Segments are cut twice rather than stored: they are as large as the corpus, and cutting them is cheap.
    found = segments(source, window, anchor)
    # Written, so that both sides of the join come from a shuffle and Spark can split an anchor that very many segments share.
    shared = stored(found.groupBy("anchor").agg(F.count("*").alias("times")).filter("times > 1").select("anchor"), "shared")
    candidates = stored(found.join(shared, "anchor"), "candidates")
    firsts = candidates.groupBy("anchor", "content").agg(F.min(F.struct("id", "start")).alias("first"), F.first("n").alias("n"))
    firsts = stored(firsts, "firsts")
    copies = candidates.join(firsts.select("anchor", "content", "first"), ["anchor", "content"]).filter(
        F.struct("id", "start") != F.col("first")).select("id", "start", (F.col("start") + F.col("n") + window - 1).alias("end"))
    contents = firsts.groupBy("anchor").agg(F.count("*").alias("contents")).filter("contents > 1")
    contested = stored(firsts.join(contents, "anchor").select(
        "first.id", "first.start", "n", "anchor", (F.col("contents") > hot).alias("is_hot")), "contested")
    volume = contested.agg(F.sum(F.when(F.col("is_hot"), F.col("n") * window).otherwise(F.col("n") + window - 1))).first()[0] or 0
    n_shards = max(1, -(-volume // shard_words))
    routed = _routed(contested, source, window).withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(n_shards)))

    def search(table: pa.Table) -> pa.Table:
        ids, starts = table.column("id").to_numpy(), table.column("start").to_numpy().astype(np.int64)
        words = table.column("words").to_pylist()
        rows = [(i, s, s + window) for i, s, w in zip(ids.tolist(), starts.tolist(), words) if w is None]
        kept = np.array([w is not None for w in words], bool)
        if kept.any():
            rows += repeated_in_shard(ids[kept], starts[kept], [np.frombuffer(w, np.uint64) for w in words if w is not None], window)
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.table({"id": pa.array(columns[0], pa.int64()), "start": pa.array(columns[1], pa.int32()), "end": pa.array(columns[2], pa.int32())})

    matched = routed.groupBy("shard").applyInArrow(search, "id bigint, start int, end int")
    return copies.unionByName(matched)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = True,
                   **options) -> DataFrame:
    """``id_col``, ``n_words``, ``n_removed``, ``kept_sha256`` of every row, and ``kept_text`` (kept words joined by one blank)."""
    intervals = repeated_intervals(docs, id_col, text_col, window, **options)
    per_doc = intervals.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("gone"))
    rows = docs.select(docs[id_col].cast("bigint").alias("doc"), docs[text_col].alias("text")).withColumn("id", _key(F.col("doc"), F.col("text")))
    names = [id_col, "n_words", "n_removed", "kept_sha256", *["kept_text"] * with_text]
    kinds = ["bigint", "bigint", "bigint", "string", "string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, texts, digests = [], [], [], []
            for gone, text in zip(batch.column(2).to_pylist(), batch.column(1).cast(pa.binary())):
                words = (text.as_py() or b"").split()
                keep = np.ones(len(words), bool)
                for g in gone or ():
                    keep[g["start"]:g["end"]] = False
                kept = b" ".join([w for w, k in zip(words, keep.tolist()) if k]) if gone else b" ".join(words)
                totals.append(len(words))
                removed.append(int(len(words) - keep.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept.decode())
            columns = [pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *[pa.array(texts, pa.string())] * with_text], names)

    joined = rows.join(per_doc, "id", "left").select("doc", "text", "gone")
    return joined.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))
