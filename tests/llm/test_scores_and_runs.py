"""Toxicity, importance resampling and periodic runs against plain versions, and on the awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loomwork.llm import periodic, resampling, toxicity
from loomwork.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"
AWKWARD = [None, "", "   \n\t ", "12 + 34", "a", "\n\n\n", "äöü ß 漢字 🙂", "same row", "same row"]


def rows_of(spark, table, *cols):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{table}.parquet").select(*cols).collect()]


# ---------------------------------------------------------------- toxicity

def test_terms_are_words_and_beginnings_whatever_the_pieces(monkeypatch):
    texts = ["Idiot, über-idiots! " * 30, None, "", "x", "-- ..", "a" * 50, "one two"]
    whole = toxicity.term_rates(texts)
    monkeypatch.setattr(toxicity, "_PIECE", 16)
    monkeypatch.setattr(toxicity, "_BATCH_BYTES", 40)
    parts = toxicity.term_rates([t for t in texts if t != "a" * 50])
    cut = toxicity.term_rates(texts)
    assert np.array_equal(cut.borders[:6], whole.borders[:6])
    assert np.array_equal(cut.values[:cut.borders[5]], whole.values[:whole.borders[5]])
    # Long words are cut at a piece, nothing else changes.
    assert np.array_equal(parts.buckets[:parts.borders[5]], whole.buckets[:whole.borders[5]])
    # idiot (4, 5, whole), über (4, 5, whole), idiots (6, whole; its beginnings are those of idiot)
    assert np.diff(whole.borders)[:5].tolist() == [8, 0, 0, 1, 0]


def test_margins_are_those_of_the_plain_formula():
    rng = np.random.default_rng(0)
    machine = toxicity.Machine(0.3, rng.normal(size=1 << toxicity.BUCKETS), rng.normal(size=(1 << toxicity.BUCKETS, 3)))
    rates = toxicity.term_rates(["some words to score", "", "other words here, some more"])
    for i, margin in enumerate(machine.margins(rates)):
        a, b = rates.borders[i], rates.borders[i + 1]
        ids, x = rates.buckets[a:b], rates.values[a:b].astype(float)
        want = 0.3 + machine.linear[ids] @ x + sum(machine.factors[ids[j]] @ machine.factors[ids[k]] * x[j] * x[k]
                                                    for j in range(len(ids)) for k in range(j))
        assert margin == pytest.approx(want)


def test_pairs_of_terms_are_learned():
    """Neither term says anything alone; both together do. A linear model cannot tell them apart."""
    texts, labels = [], []
    for i in range(400):
        a, b = i % 2, i // 2 % 2
        texts.append(f"{'foul' if a else 'mild'} {'group' if b else 'stone'}")
        labels.append(float(a == b))
    weights = np.ones(len(texts))
    machine = toxicity.train(toxicity.term_rates(texts), np.array(labels), weights, sure=0.0, rounds=60, decay=1e-4)
    points = machine.probabilities(toxicity.term_rates(["foul group", "foul stone", "mild group", "mild stone"]))
    assert points[0] > 0.8 and points[3] > 0.8 and points[1] < 0.2 and points[2] < 0.2


def test_held_out_toxic_documents_are_found(spark):
    sf = "/root/testdata/sf0.01"
    out = {r["doc_id"]: r for r in QUERIES["op11_toxicity"](spark, sf).collect()}
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for i, r in out.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(labels[i], r["predicted"]) for i, r in out.items() if r["held_out"] and i in labels]
    assert sum(p for y, p in held if y) >= 0.75 * sum(y for y, _ in held)
    assert sum(p for y, p in held if not y) <= 0.02 * len(held)


def test_toxicity_of_awkward_rows(spark):
    docs = spark.createDataFrame([(None if i == 4 else i, t) for i, t in enumerate(AWKWARD)], DOCS)
    docs = docs.withColumn("score", F.lit("clash")).withColumn("label", F.lit(1)).withColumn("h", F.lit(2))
    labels = spark.createDataFrame([(i, y) for i, y in [(0, 1), (1, 0), (7, 1), (8, 0), (8, None), (None, 1), (99, 1)]], "doc_id bigint, toxic int")
    machine = toxicity.fit(docs, labels.withColumn("id", F.lit("x")).withColumn("text", F.lit("x")), per_class=3)
    out = toxicity.score(docs, machine, keep=["doc_id"]).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in out)
    same = {r["score"] for r in out if r["doc_id"] in (7, 8)}
    nothing = {r["score"] for r in out if r["doc_id"] in (0, 1, 2, 5)}
    assert len(same) == 1 and len(nothing) == 1
    assert toxicity.fit(docs, labels.filter("toxic = 1")) is None and toxicity.fit(docs.limit(0), labels) is None
    assert [r["score"] for r in toxicity.score(docs.limit(1), None, keep=[]).collect()] == [0.0]
    assert toxicity.score(docs.limit(0), machine).count() == 0


# ---------------------------------------------------------------- resampling

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_buckets(text):
    words = WORD.findall(text.encode().lower()) if text else []
    grams = [zlib.crc32(b" ".join(words[i:i + n])) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), Counter(grams)


def plain_draw(docs, target):
    counted = [(i, *plain_buckets(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, c in counted:
        s.update(c)
    for text in target:
        t.update(plain_buckets(text)[1])
    of_s, of_t = sum(s.values()), sum(t.values())
    out, able = {}, []
    for i, n, c in counted:
        weight = sum(k * math.floor(1000 * math.log((t[b] + 1) * (of_s + 10000) / ((s[b] + 1) * (of_t + 10000)))) for b, k in c.items())
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = [sum(c.values()), weight, score, None]
        if n >= 20:
            able.append((-score, i))
    for rank, (_, i) in enumerate(sorted(able)[:5 * len(able) // 100], 1):
        out[i][3] = rank
    return out


def test_hashes_are_those_of_the_libraries():
    rng = random.Random(1)
    raw = rng.randbytes(50_000)
    buffer = resampling.Bytes.of(raw)
    starts = np.array([rng.randrange(40_000) for _ in range(2000)])
    sizes = np.array([rng.choice([rng.randrange(1, 40), rng.randrange(1, 400)]) for _ in range(2000)])
    stretches = [raw[a:a + n] for a, n in zip(starts, sizes)]
    assert resampling.xxhash64(buffer, starts, sizes).tolist() == [xxhash.xxh64_intdigest(x) for x in stretches]
    assert resampling.crc32(buffer, starts, sizes).tolist() == [zlib.crc32(x) for x in stretches]


def test_equal_keys_are_told_apart_by_their_bytes():
    words = [b"ab", b"abc", b"cd", b"ab", b"x" * 300, b"x" * 299 + b"y", b"x" * 300, b"abcdefghij", b"abcdefghik"]
    raw = b"".join(words)
    sizes = np.array([len(w) for w in words])
    starts = np.cumsum(sizes) - sizes
    table = resampling.intern(resampling.Bytes.of(raw), starts, sizes, keys=np.full(len(words), 5, np.uint64))
    slots = table.slot.tolist()
    assert slots[0] == slots[3] and slots[4] == slots[6] and len(set(slots)) == 7
    assert [table.count[s] for s in (slots[0], slots[4], slots[5])] == [2, 2, 1]
    assert [table.bucket[s] for s in slots] == [zlib.crc32(w) % 10000 for w in words]


@pytest.mark.parametrize("piece", [64, 300, 1 << 19])
def test_grams_do_not_depend_on_the_pieces(monkeypatch, piece):
    monkeypatch.setattr(resampling, "_PIECE", piece)
    texts = [*AWKWARD, "b " * 500, "x" * 1000 + " y " + "z" * 700, "A-b_c D.e " * 40, "".join(chr(c) for c in range(32, 400)) * 3]
    words, got = np.zeros(len(texts), int), [Counter() for _ in texts]
    for g in resampling.grams([None if t is None else t.encode() for t in texts]):
        words += g.words
        for i, b in zip(g.text, g.table.bucket[g.table.slot]):
            got[i][b] += 1
    for i, t in enumerate(texts):
        assert (words[i], got[i]) == plain_buckets(t)


def test_draw_is_the_plain_one(spark):
    want = plain_draw(rows_of(spark, "documents", "doc_id", "text"), [t for (t,) in rows_of(spark, "benchmark", "text")])
    got = {r[0]: list(r[1:]) for r in QUERIES["op12_resampling"](spark, SF).select("doc_id", "n_features", "weight", "score", "rank").collect()}
    assert got == want and sum(r[3] is not None for r in got.values()) > 5


def test_draw_of_awkward_rows(spark):
    long_ = " ".join(f"w{i}" for i in range(25))
    texts = [*AWKWARD, *[long_] * 100]
    docs = spark.createDataFrame([(None if i % 3 == 0 else 7, t) for i, t in enumerate(texts)], DOCS)
    docs = docs.withColumn("score", F.lit("clash")).withColumn("id", F.lit("clash")).withColumn("rank", F.lit("clash"))
    target = spark.createDataFrame([(0, "w1 w2"), (1, None)], DOCS)
    out = resampling.draw(docs, target).collect()
    assert len(out) == len(texts)
    # One score and one id many times over: ranks of their own all the same, the id before the null ids if scores tie.
    assert sorted(r["rank"] for r in out if r["rank"]) == [1, 2, 3, 4, 5]
    assert all(r["weight"] == 0 == r["n_features"] for r in out if r["n_words"] == 0) and sum(r["n_words"] == 0 for r in out) == 4
    assert resampling.draw(docs.limit(0), target).count() == 0
    assert resampling.draw(docs, target.limit(0)).count() == len(texts)


def test_ranges_keep_the_order(spark):
    rows = spark.range(5000).select((F.col("id") % 1000).alias("doc_id"), (F.xxhash64("id") % 50).alias("score")).repartition(7)
    ranked = [(r["score"], r["doc_id"], r["rank"]) for r in resampling.rank_rows(rows, "doc_id", 4000).collect()]
    assert [r[:2] for r in sorted((r for r in ranked if r[2]), key=lambda r: r[2])] == sorted((r[:2] for r in ranked), key=lambda r: (-r[0], r[1]))[:4000]


# ---------------------------------------------------------------- periodic runs

def plain_runs(words, exponent=4, least=6):
    out = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("many", [1, 32])
def test_runs_are_the_plain_ones(monkeypatch, many):
    monkeypatch.setattr(periodic, "_MANY", many)
    rng = random.Random(3)
    for _ in range(300):
        texts = []
        for _ in range(rng.randrange(1, 6)):
            some = [bytes([97 + i]) for i in range(rng.randrange(1, 5))]
            words = []
            while len(words) < rng.randrange(0, 80):
                words += [rng.choice(some) for _ in range(rng.randrange(1, 7))] * rng.randrange(1, 9)
            texts.append(words)
        exponent, least = rng.choice([3, 4, 4, 5]), rng.choice([1, 3, 6, 9])
        assert periodic.runs(texts, exponent, least) == [plain_runs(t, exponent, least) for t in texts]
    with pytest.raises(ValueError):
        periodic.runs([[b"a"]], 2)


def test_one_long_text_takes_time_in_proportion():
    words = [b"spam"] * 200_000
    assert periodic.runs([words]) == [[(0, 200_000, 1)]]
    phrase = [b"%d" % i for i in range(50)] * 4000
    assert periodic.runs([phrase])[0] == [(0, 200_000, 50)]


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_query_of_runs_is_the_plain_one(spark):
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    docs = rows_of(spark, "documents", "doc_id", "text")
    assert got == {i: plain_digest(i, t) for i, t in docs}
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_runs_of_awkward_rows(spark):
    texts = [*AWKWARD, "a b " * 4, "x " * 6, "x " * 5, "x " * 6 + "y " + "x " * 6]
    docs = spark.createDataFrame([(None if i == 3 else i, t) for i, t in enumerate(texts)], DOCS)
    docs = docs.withColumn("runs", F.lit("clash")).withColumn("t", F.lit("clash"))
    out = periodic.collapse(docs, keep=["doc_id", "t"]).collect()
    assert [(len(r["runs"]), r["collapsed"]) for r in out[:len(AWKWARD)]] == [(0, " ".join((t or "").split())) for t in AWKWARD]
    assert [([tuple(x) for x in r["runs"]], r["collapsed"]) for r in out[len(AWKWARD):]] == [
        ([(0, 8, 2)], "a b"), ([(0, 6, 1)], "x"), ([], "x x x x x"), ([(0, 6, 1), (7, 6, 1)], "x y x")]
    assert out[0]["t"] == "clash" and periodic.collapse(docs.limit(0)).count() == 0
