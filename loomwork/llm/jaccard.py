"""Chosen-path join: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

1. Texts with one shingle set are one member. In every run a member follows a path: at each node it chooses one of its tokens, the
   one with the smallest hash under the node's own seed, and goes to that token's child. Two sets of similarity s choose alike with
   probability s, so members are split recursively on sampled tokens that they share.
2. All members at a node form its bucket. Buckets of one are dropped; those of at most ``small`` are compared by brute force on
   sketches, and pairs that may reach the threshold join their members; larger ones are split by the next level. A bucket that is
   still larger at the last level shares ``depth`` sampled tokens and is joined as a whole. Nothing is capped: every member of every bucket takes part.
3. There are as many runs as a pair at the threshold needs to share a path through all levels with probability ``recall``.
4. Connected components of these joins are families. Each member's whole set is sent to its family and compared exactly there with all
   others: members in blocks, each pair of blocks a group of its own. Per member only its number of links and one edge leave a group,
   never a table of pairs.
5. Connected components of the exact links are the classes.

Link counts in a family of n near copies take n^2 / 2 set comparisons, in n^2 / (2 BLOCK^2) groups that share nothing; buckets, joins
and components are linear.

Defined results: a text of fewer than five words (null and empty too) has no shingles and no links; texts of the same few words
are copies. A repeated row is a copy like any other. A null id counts as the smallest. An empty table gives no rows. There are
no false links; those just above the threshold are found with the stated recall.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.tokens import slices
from loomwork.session import scratch_path

WORDS = 5
THRESHOLD = 0.8
DEPTH = 4
RECALL = 0.999
SMALL = 24
SKETCH = 48
DOUBT = 0.25  # how far below the threshold an estimate may lie: more than four standard errors of the sketch
BLOCK = 192
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_COLUMNS = 4096
_TOKENS = 1 << 16  # tokens of a set hashed at once
_PART = 1 << 20


def runs_for(recall: float, threshold: float, depth: int) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** depth))


def shingles(data: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``words`` words (split at ASCII white space)."""
    from xxhash import xxh3_64_intdigest

    tokens = data.split()
    if len(tokens) < words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    n = len(tokens) - words + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(words):  # the multiplication in between makes the order count
        mixed = (mixed ^ hashed[i:i + n]) * _ODD
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def paths(tokens: np.ndarray, runs: int, depth: int) -> np.ndarray:
    """Node keys (runs x depth) that a set visits."""
    seeds = (np.arange(1, runs + 1, dtype=np.uint64) * _MIX)[:, None]
    keys = np.empty((runs, depth), np.uint64)
    for level in range(depth):
        least, chosen = None, None
        for begin in range(0, len(tokens), _TOKENS):
            some = tokens[begin:begin + _TOKENS]
            hashed = (some[None, :] ^ seeds) * _ODD
            hashed ^= hashed >> np.uint64(32)
            hashed *= _MIX
            hashed ^= hashed >> np.uint64(29)
            first = hashed.argmin(axis=1)
            value, token = hashed[np.arange(runs), first], some[first]
            if least is None:
                least, chosen = value, token
            else:
                less = value < least
                least, chosen = np.where(less, value, least), np.where(less, token, chosen)
        keys[:, level] = ((seeds[:, 0] ^ chosen) * _MIX) ^ (chosen >> np.uint64(17)) ^ np.uint64(level + 1)
        seeds = (keys[:, level] * _ODD)[:, None]
    return keys


def member_key(data: bytes, tokens: np.ndarray) -> int:
    """A signed 64-bit hash of the shingle set, or of the words of a text that has none."""
    from xxhash import xxh3_64_intdigest

    key = xxh3_64_intdigest(tokens.tobytes(), 1) if len(tokens) else xxh3_64_intdigest(b" ".join(data.split()), 2)
    return key - (1 << 64) if key >> 63 else key


def estimate(a: frozenset, b: frozenset, whole: bool) -> float:
    """Jaccard similarity from bottom sketches; ``whole`` if both hold their whole sets."""
    union = a | b
    shared = a & b
    if not whole and len(union) > SKETCH:
        last = sorted(union)[SKETCH - 1]
        return sum(x <= last for x in shared) / SKETCH
    return len(shared) / max(1, len(union))


class Forest:
    """Union-find over 0 to n - 1; the smaller root wins."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose texts, in the last column, hold about ``_PART`` bytes together."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).cast(pa.binary())
        for begin, end in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), _PART):
            yield batch.slice(begin, end - begin)


def describe(docs: DataFrame, id_col: str, text_col: str, runs: int, depth: int) -> DataFrame:
    """One row per document: id, member, size of its set, node keys and sketch (null without shingles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            members, sizes, keys, sketches = [], [], [], []
            for text in batch.column(1).cast(pa.binary()):
                data = text.as_py() or b""
                tokens = shingles(data)
                members.append(member_key(data, tokens))
                sizes.append(len(tokens))
                keys.append(paths(tokens, runs, depth).view(np.int64).ravel() if len(tokens) else None)
                sketches.append((tokens[:SKETCH] >> np.uint64(32)).astype("<u4").tobytes() if len(tokens) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(members, pa.int64()), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(sketches, pa.binary())], ["id", "member", "size", "keys", "sketch"])

    return docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, "id bigint, member bigint, size int, keys array<bigint>, sketch binary")


def leaves(members: DataFrame, runs: int, depth: int, small: int) -> DataFrame:
    """(bucket, n, member): for each run the first node on the member's path that needs no further split, if another member is there."""
    on_path = members.select("member", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"), "keys").select(
        "member", *[F.get("keys", F.col("run") * depth + level).alias(f"k{level}") for level in range(depth)])
    visited = members.select(F.explode("keys").alias("k")).groupBy("k").agg(F.count("*").alias("n")).filter("n > 1")
    rows = on_path
    for level in range(depth):
        rows = rows.join(visited.select(F.col("k").alias(f"k{level}"), F.col("n").alias(f"n{level}")), f"k{level}", "left" if level else "inner")
    # The first level with few members is the leaf; a node without company on the way ends the path.
    leaf = F.when(F.lit(False), F.struct(F.lit(0).cast("bigint").alias("bucket"), F.lit(0).cast("bigint").alias("n")))
    for level in range(depth):
        fits = F.col(f"n{level}").isNull() | (F.col(f"n{level}") <= small) if level < depth - 1 else F.lit(True)
        leaf = leaf.when(fits, F.struct(F.col(f"k{level}").alias("bucket"), F.col(f"n{level}").alias("n")))
    return rows.select("member", leaf.alias("leaf")).select("leaf.bucket", "leaf.n", "member").filter(F.col("n").isNotNull())


def likely_edges(found: DataFrame, members: DataFrame, small: int, floor: float, ratio: float) -> DataFrame:
    """Edges (a, b) that connect the likely pairs of every bucket: stars, at most one edge per member and bucket."""
    large = found.filter(F.col("n") > small)
    first = large.groupBy("bucket").agg(F.min("member").alias("a"))
    whole = large.join(first, "bucket").select("a", F.col("member").alias("b")).filter("a <> b")
    # Runs bring the same few members together again and again: equal lists are compared once.
    lists = found.filter(F.col("n") <= small).groupBy("bucket").agg(F.array_sort(F.collect_list("member")).alias("who")).select("who").distinct()
    listed = lists.select(F.xxhash64("who").alias("bucket"), F.explode("who").alias("member"))
    filled = listed.join(members.select("member", "size", "sketch"), "member").groupBy("bucket").agg(
        F.sort_array(F.collect_list(F.struct("member", "size", "sketch"))).alias("sets"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = []
            for sets in batch.column(0).to_pylist():
                sketches = [frozenset(np.frombuffer(s["sketch"], "<u4").tolist()) for s in sets]
                joined = Forest(len(sets))
                for i, x in enumerate(sets):
                    for j in range(i + 1, len(sets)):
                        a, b = x["size"], sets[j]["size"]
                        if min(a, b) >= ratio * max(a, b) and joined.root(i) != joined.root(j) and \
                                estimate(sketches[i], sketches[j], max(a, b) <= SKETCH) >= floor:
                            joined.join(i, j)
                edges += [(sets[joined.root(i)]["member"], x["member"]) for i, x in enumerate(sets) if joined.root(i) != i]
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges)], ["a", "b"])

    return whole.unionByName(filled.select("sets").mapInArrow(compare, "a bigint, b bigint"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of an undirected graph (a, b): (node, root), root the smallest node; only nodes with an edge.

    Each round a node takes the smallest root among its neighbours, then its root's root. Rounds are written, and end when
    no root changes.
    """
    spark = edges.sparkSession
    folder = scratch_path(spark, name)
    both = _stored(edges.union(edges.select("b", "a")).toDF("a", "b").filter("a <> b").distinct(), f"{folder}/edges")
    roots = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
    roots = _stored(roots, f"{folder}/round-0")
    turn, changed = 0, True
    while changed:
        turn += 1
        near = both.join(roots, both["b"] == roots["node"]).groupBy("a").agg(F.min("root").alias("m"))
        heard = roots.join(near, roots["node"] == near["a"]).select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        top = roots.select(F.col("node").alias("up"), F.col("root").alias("top"))
        step = heard.join(top, heard["root"] == top["up"]).select("node", F.least("root", "top").alias("root"), "old")
        step = _stored(step, f"{folder}/round-{turn}")
        changed = not step.filter("root <> old").isEmpty()
        roots = step.select("node", "root")
    return roots


def exact_links(families: DataFrame, texts: DataFrame, threshold: float, block: int) -> DataFrame:
    """Per member and group: member, links, and ``a``, the smallest member it is connected with there.

    ``families``: member, family, n_family. ``texts``: member, text, a row for each member.
    """
    n_blocks = F.ceil(F.col("n_family") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("member"), F.col("n_blocks")).cast("int")
    placed = families.withColumn("n_blocks", n_blocks).withColumn("own", own)

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            sets = []
            for member, text in zip(batch.column(0).to_pylist(), batch.column(batch.num_columns - 1).cast(pa.binary())):
                data = text.as_py() or b""
                tokens = shingles(data)
                sets.append(tokens.tobytes() if member_key(data, tokens) == member else None)  # another text under a repeated id
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(batch.num_columns - 1)], pa.array(sets, pa.binary())],
                                             [*batch.schema.names[:-1], "tokens"])

    sets = placed.join(texts, "member").select("member", "family", "n_blocks", "own", "text").mapInArrow(
        tokens_of, "member bigint, family bigint, n_blocks int, own int, tokens binary").filter(F.col("tokens").isNotNull()).dropDuplicates(["member"])
    spread = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "member", "tokens")

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        order = np.argsort(table.column("member").to_numpy(), kind="stable")
        members, own = table.column("member").to_numpy()[order], table.column("own").to_numpy()[order]
        raw = table.column("tokens").to_pylist()
        sets = [np.frombuffer(raw[o], np.uint64) for o in order]
        linked = similar(sets, threshold)
        np.fill_diagonal(linked, False)
        if i != j:  # pairs inside a block belong to the group of that block with itself
            linked &= own[:, None] != own[None, :]
        joined = Forest(len(sets))
        for x, y in zip(*np.nonzero(np.triu(linked))):
            joined.join(int(x), int(y))
        links = linked.sum(axis=1)
        roots = np.array([members[joined.root(x)] for x in range(len(sets))], np.int64)
        some = links > 0
        return pa.table({"member": members[some], "links": links[some].astype(np.int64), "a": roots[some]})

    return spread.groupBy("family", "i", "j").applyInArrow(compare, "member bigint, links bigint, a bigint")


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix: Jaccard similarity at or above the threshold. Tokens of a single set are left out of the products."""
    sizes = np.array([len(s) for s in sets], np.int64)
    rows = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets) if len(sets) else np.empty(0, np.uint64), return_inverse=True, return_counts=True)
    number = np.full(len(times), -1, np.int64)
    number[times > 1] = np.arange(int((times > 1).sum()))
    column = number[column]
    rows, column = rows[column >= 0], column[column >= 0]
    common = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + _COLUMNS])
        present = np.zeros((len(sets), _COLUMNS), np.float32)
        present[rows[a:b], column[a:b] - begin] = 1
        common += (present @ present.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    return (common > 0) & (common >= threshold * union - 1e-9)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, depth: int = DEPTH,
         recall: float = RECALL, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """One row per document: ``id_col``, ``class_id`` (smallest id of its class), ``copy_of`` (smallest id with the same shingle set) and
    ``n_links`` (other shingle sets at or above the threshold)."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "jaccard")
    runs = runs_for(recall, threshold, depth)
    described = _stored(describe(docs, id_col, text_col, runs, depth), f"{folder}/documents")
    owners = _stored(described.groupBy("member").agg(F.min("id").alias("first"), F.count(F.when(F.col("id").isNull(), 1)).alias("nulls")).select(
        "member", F.when(F.col("nulls") == 0, F.col("first")).alias("copy_of"), F.col("first").alias("known")), f"{folder}/owners")
    members = described.filter(F.col("size") > 0).select("member", "size", "keys", "sketch").dropDuplicates(["member"])
    members = _stored(members, f"{folder}/members")
    found = _stored(leaves(members, runs, depth, small), f"{folder}/leaves")
    grouped = components(likely_edges(found, members, small, threshold - DOUBT, threshold), "families")
    sizes = grouped.groupBy("root").agg(F.count("*").alias("n_family"))
    families = grouped.join(sizes, "root").select(F.col("node").alias("member"), F.col("root").alias("family"), "n_family")
    # One document of each member brings its text. A member known only under null ids finds it among the rows without an id.
    carriers = families.select("member").join(owners, "member").select("member", F.col("known").alias("_id"))
    source = docs.select(docs[id_col].cast("bigint").alias("_doc"), docs[text_col].alias("text"))
    texts = carriers.join(source, F.col("_id").eqNullSafe(F.col("_doc"))).select("member", "text")
    links = _stored(exact_links(families, texts, threshold, block), f"{folder}/links")
    classes = components(links.select("a", F.col("member").alias("b")), "classes")
    counted = links.groupBy("member").agg(F.sum("links").alias("n_links"))
    known = owners.join(counted, "member", "left").join(classes.withColumnRenamed("node", "member"), "member", "left").select(
        "member", "copy_of", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("root", "member").alias("root"))
    lowest = known.groupBy("root").agg(F.min("copy_of").alias("first"), F.count(F.when(F.col("copy_of").isNull(), 1)).alias("nulls")).select(
        "root", F.when(F.col("nulls") == 0, F.col("first")).alias("class_id"))
    per_member = _stored(known.join(lowest, "root").select("member", "class_id", "copy_of", "n_links"), f"{folder}/classes")
    return described.select(F.col("id").alias(id_col), "member").join(per_member, "member").select(id_col, "class_id", "copy_of", "n_links")
