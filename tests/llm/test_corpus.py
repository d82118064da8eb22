"""Token files, packing, substring dedup, top-k, Jaccard join and mixing against plain versions, and on the awkward rows."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomwork.llm import fm_index, jaccard, mixing, packing, substrings, token_files, tokens, topk
from loomwork.llm.queries import QUERIES
from loomwork.llm.sql import SQL
from test_per_row import AWKWARD, documents

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cur = con.execute(SQL[name])
    order = [d[0] for d in cur.description]
    assert sorted(order) == sorted(df.columns)
    assert sorted(map(tuple, df.select(order).collect()), key=str) == sorted(cur.fetchall(), key=str)


def plain_ids(text):
    tokenizer = tokens.encoder(tokens.default_vocabulary()).tokenizer
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD_TEXTS = [*AWKWARD, "double  blank", " lead", "trail ", "tab\t x", "new\n line \n y", "nb  space  z", "\x1c x \x85 y", "it's  we'll\n\n ok", "<|endoftext|> x",
             "word " * 5000, "é́ 漢字 カナ 🙂🙂 x", "x　 y"]


# ---------------------------------------------------------------- tokens and files

def test_added_tokens_in_a_text_equal_the_plain_library():
    fresh = Tokenizer.from_file(tokens.default_vocabulary())
    asked = ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>", "plain words", "<|endof", "text|> y", " <|endoftext|><|endoftext|>", "it's <|endoftext", ""]
    got = tokens.Encoder(tokens.default_vocabulary()).encode(asked)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [fresh.encode(t, add_special_tokens=False).ids for t in asked]
    assert fresh.encode(asked[1], add_special_tokens=False).ids.count(50256) == 1

def test_encoder_equals_the_tokenizer():
    encoder = tokens.Encoder(tokens.default_vocabulary())
    for _ in range(2):  # with an empty and a full cache
        got = encoder.encode([t or "" for t in ODD_TEXTS])
        assert [np.frombuffer(g, "<u4").tolist() + [0] for g in got] == [plain_ids(t) for t in ODD_TEXTS]


@pytest.mark.parametrize("room, long_", [(3, 1 << 20), (40, 30), (500_000, 7)])
def test_encoder_with_small_generations_and_cut_texts(monkeypatch, room, long_):
    """Words move from one generation of the cache to the next; long texts are cut between words."""
    monkeypatch.setattr(tokens, "_CACHE_WORDS", room)
    monkeypatch.setattr(tokens, "_LONG", long_)
    encoder = tokens.Encoder(tokens.default_vocabulary())
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["word", "x1", "Ünder,", "a.b", "the", f"w{rng.randrange(60)}", "<|endoftext|>"]) for _ in range(40)) for _ in range(60)]
    for _ in range(2):
        for part in (ODD_TEXTS, texts[:20], texts[20:], *([t] for t in texts)):
            got = encoder.encode([t or "" for t in part])
            assert [np.frombuffer(g, "<u4").tolist() + [0] for g in got] == [plain_ids(t) for t in part]


def test_token_files_round_trip(spark, tmp_path):
    docs = documents(spark, ODD_TEXTS, id="x", part=3, start="y").union(documents(spark, ["again"]).selectExpr("*", "'x'", "3", "'y'"))
    docs = docs.union(docs.filter("doc_id = 9").withColumn("doc_id", F.lit(None).cast("bigint")))
    files = token_files.write(docs, f"{tmp_path}/ids", partitions=3)
    rows = token_files.read(files).orderBy("start").collect()
    want = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (doc_id, text) in zip(rows, want):
        ids = plain_ids(text)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, at, len(ids), crc(ids))
        at += len(ids)
    assert len(rows) == len(want)
    path = files.orderBy("part").first()["path"]
    some = dict(token_files.read_frames(path, {1}))
    assert np.frombuffer(some[1], "<u4").tolist() == plain_ids(ODD_TEXTS[1])
    assert token_files.read(token_files.write(docs.filter("false"), f"{tmp_path}/none")).count() == 0


def test_frames_are_independent_and_checked(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_BYTES", 64)
    path = f"{tmp_path}/f.zst"
    docs = [(i, np.arange(i, dtype="<u4").tobytes()) for i in range(40)]
    with open(path, "wb") as sink:
        writer = token_files.FrameWriter(sink)
        for doc in docs:
            writer.add(*doc)
        writer.close()
    assert list(token_files.read_frames(path)) == docs and dict(token_files.read_frames(path, {7, 33})) == {7: docs[7][1], 33: docs[33][1]}
    with open(path, "rb") as source:
        data = bytearray(source.read())
    with open(path, "rb") as source:
        table = token_files.seek_table(source, len(data))
    assert len(table) > 5
    data[table[2][0] + 12] ^= 1
    with open(path, "wb") as sink:
        sink.write(data)
    assert next(token_files.read_frames(path, {0}))[0] == 0  # other frames are not touched
    with pytest.raises(ValueError, match="damaged frame"):
        list(token_files.read_frames(path))


def test_token_file_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    at = 0
    for r in QUERIES["op3_token_files"](spark, SF).orderBy("doc_id").collect():
        ids = plain_ids(texts[r["doc_id"]])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)


# ---------------------------------------------------------------- packing

def check_packed(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_query(spark):
    rows = QUERIES["op7_packing"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pieces = defaultdict(dict)
    for r in rows:
        assert r["piece"] not in pieces[r["doc_id"]]
        pieces[r["doc_id"]][r["piece"]] = r
    assert pieces.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids, at = plain_ids(text), 0
        for k in range(len(pieces[doc_id])):
            r = pieces[doc_id][k]
            assert r["start"] == at and r["ids_crc32"] == crc(ids[at:at + r["length"]])
            assert len(pieces[doc_id]) == 1 or k == 0 or r["length"] == 2048
            at += r["length"]
        assert at == len(ids)
    total = sum(r["length"] for r in rows)
    assert check_packed(rows, 2048) <= 1.02 * total / 2048 + 2


def test_rounds_of_packing_keep_every_piece(spark):
    rng = random.Random(1)
    lengths = [rng.choice([1, 2, 30, 60, 61, 99, 100]) for _ in range(3000)] + [100] * 50
    pieces = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "k bigint, length bigint, item string").repartition(24)
    rows = packing.pack(pieces, capacity=100, slack=0, merge=4, task_items=500).collect()
    assert Counter(r["k"] for r in rows) == Counter(range(len(lengths)))
    least = max(-(-sum(lengths) // 100), sum(n > 50 for n in lengths))
    assert check_packed(rows, 100) <= 1.03 * least + 1
    assert packing.pack(pieces.filter("false")).count() == 0
    assert packing.cut_lengths(5000, 2048) == [904, 2048, 2048] and packing.cut_lengths(2048, 2048) == [2048]


def test_packing_awkward_rows(spark):
    docs = documents(spark, [*ODD_TEXTS, *ODD_TEXTS], piece=1, offset="x", bin=2)
    rows = packing.pack(packing.cut_pieces(docs)).collect()
    check_packed(rows, 2048)
    assert sum(r["length"] for r in rows) == 2 * sum(len(plain_ids(t)) for t in ODD_TEXTS)


# ---------------------------------------------------------------- substrings

def plain_removed(texts, window):
    seen, words, removed = {}, {}, {}
    for i in sorted(texts):
        words[i] = (texts[i] or "").encode().split()
        removed[i] = set()
        for s in range(len(words[i]) - window + 1):
            key = tuple(words[i][s:s + window])
            if seen.setdefault(key, (i, s)) != (i, s):
                removed[i].update(range(s, s + window))
    return {i: (len(words[i]), len(removed[i]), b" ".join(w for k, w in enumerate(words[i]) if k not in removed[i]).decode()) for i in texts}


@pytest.mark.parametrize("hot, shard_words", [(200, 250_000), (1, 500)])
def test_substrings_equal_brute_force(spark, hot, shard_words):
    rng = random.Random(4)
    vocabulary = ["the", "of", "a", "cat", "dog", "é", "漢", "runs", "x"]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(8, 60))) for _ in range(12)]
    texts = ["  \n".join(rng.choice([rng.choice(passages), " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))]) for _ in range(rng.randint(1, 6)))
             for _ in range(150)]
    texts += [*AWKWARD, "a " * 300, "a b " * 100, "a " * 300, texts[0], passages[0], "the " * 20]
    docs = documents(spark, texts, id=1, start="x", words=2, gone=3).repartition(5)
    rows = substrings.remove_repeats(docs, window=10, anchor=4, hot=hot, shard_words=shard_words).collect()
    want = plain_removed(dict(enumerate(texts)), 10)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in rows} == want and len(rows) == len(texts)


def test_substring_rows_without_a_defined_id(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = documents(spark, [text, text, None]).withColumn("doc_id", F.when(F.col("doc_id") == 1, None).otherwise(F.col("doc_id")))
    rows = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_removed"]) for r in substrings.remove_repeats(docs).collect())
    assert rows == [(False, 0, 0), (True, 0, 40), (True, 2, 0)]
    twice = documents(spark, [text]).union(documents(spark, [text]))
    assert [r["n_removed"] for r in substrings.remove_repeats(twice).collect()] == [0, 0]
    other = documents(spark, [f"x {text} y", f"z {text} u"])
    removed = [(r["doc_id"], r["n_removed"]) for r in substrings.remove_repeats(other.union(other), hot=1).collect()]
    assert sorted(removed) == [(0, 0), (0, 0), (1, 40), (1, 40)]
    assert substrings.remove_repeats(docs.filter("false")).count() == 0


def test_different_texts_without_an_id_keep_their_own_words(spark):
    """A passage at one word offset in two texts without an id goes from the second one; nothing else goes from either."""
    passage = " ".join(f"w{i}" for i in range(30))
    texts = [f"{passage} ends here alone", f"{passage} and goes on otherwise", "clean words of a third text " * 3, passage]
    docs = documents(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") < 3, None).otherwise(F.col("doc_id")))
    rows = substrings.remove_repeats(docs).collect()
    kept = sorted(r["kept_text"] for r in rows if r["doc_id"] is None)
    assert kept[2 if kept[2].startswith("w0") else 1].startswith("w0") and sum(k.startswith("w0") for k in kept) == 1
    assert sorted(r["n_removed"] for r in rows) == [0, 0, 30, 30] and " ".join(texts[2].split()) in kept


def test_fm_index_matching_statistics():
    rng = np.random.default_rng(2)
    texts = [rng.integers(10, 14, rng.integers(1, 60)).astype(np.uint64) for _ in range(30)]
    index = fm_index.FMIndex(texts)
    stream = rng.integers(10, 15, 200).astype(np.uint64)
    ends = np.arange(1, 201)
    length, low, high = index.search(index.codes(stream), ends, np.minimum(ends, 12))
    flat = [t.tolist() for t in texts]
    for e, n, a, b in zip(ends, length, low, high):
        count = lambda m: sum(t[i:i + m] == stream[e - m:e].tolist() for t in flat for i in range(len(t) - m + 1))
        assert n == 0 or b - a == count(n) > 0
        assert n == min(e, 12) or count(n + 1) == 0


# ---------------------------------------------------------------- top-k

def plain_topk(vectors, queries, k):
    out = []
    for q, x in queries:
        scored = sorted((-sum(a * b for a, b in zip(x, y)), v) for v, y in vectors if v != q)
        out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scored[:k])]
    return sorted(out)


def test_topk_with_ties_and_bad_vectors(spark):
    rng = random.Random(8)
    good = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(400)] + [[0.5] * 6] * 50 + [[0.0] * 6] * 5
    bad = [None, [], [0.1] * 5 + [None], [0.1] * 5 + [float("nan")], [float("inf")] + [0.0] * 5, [0.1] * 4]
    rows = [(i, v, 0) for i, v in enumerate(good + bad)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")
    vectors = table.select("vec_id", topk.scaled(F.col("embedding")).alias("v"), "rank")
    index = topk.build(vectors, "vec_id", "v", n_pivots=5, n_rings=4, sample=100)
    got = topk.search(index, vectors.filter("vec_id % 10 = 0"), "vec_id", "v", 10).collect()
    whole = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in enumerate(good)]
    assert sorted(map(tuple, got)) == plain_topk(whole, [w for w in whole if w[0] % 10 == 0], 10)
    few = vectors.filter("vec_id < 4")
    got = topk.search(topk.build(few, "vec_id", "v"), few, "vec_id", "v", 10).collect()
    assert sorted(map(tuple, got)) == plain_topk(whole[:4], whole[:4], 10)
    assert topk.build(vectors.filter("false"), "vec_id", "v") is None
    assert topk.search(index, vectors.filter("false"), "vec_id", "v").count() == 0


def test_the_sample_of_an_index_reaches_the_driver_once(spark):
    many = spark.range(0, 64 * 200, 1, 64).select("id", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (F.col("id") * 31 + i * i) % 97).alias("v"))
    equal = spark.range(3000).select(F.lit(-1).cast("bigint").alias("id"), F.array_repeat(F.lit(5).cast("bigint"), 64).alias("v"))
    vectors = many.union(equal)
    conf = spark.sparkContext._jsc.sc().conf()
    before = conf.get("spark.driver.maxResultSize", "1g")
    conf.set("spark.driver.maxResultSize", "2m")  # 200 rows are 0.1 MB; 200 of each task are 6.7 MB
    try:
        index = topk.build(vectors, "id", "v", n_pivots=4, n_rings=2, sample=200)
        got = topk.smallest_hashes(vectors, 200)
    finally:
        conf.set("spark.driver.maxResultSize", before)
    assert int(index.rings["n"].sum()) == 64 * 200 + 3000
    hashed = sorted(map(tuple, vectors.select(F.xxhash64("id", "v"), "v").collect()))
    assert got == [v for _, v in hashed[:200]]


def test_the_sample_counts_equal_rows(spark):
    rows = [(i % 3, [i % 3, 1]) for i in range(300)] + [(i, [i, 2]) for i in range(20)]
    table = spark.createDataFrame(rows, "id bigint, v array<bigint>").repartition(5)
    hashed = sorted(map(tuple, table.select(F.xxhash64("id", "v"), "v").collect()))
    for n in (0, 1, 7, 110, 250, 319, 320, 500):
        assert topk.smallest_hashes(table, n) == [v for _, v in hashed[:n]]
    assert topk.smallest_hashes(table.filter("false"), 5) == []


# ---------------------------------------------------------------- Jaccard join

def plain_join(texts, threshold=0.8):
    sets = {}
    for i, t in texts.items():
        w = (t or "").split()
        sets[i] = frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) or " ".join(w)
    owner = {}
    for i in sorted(sets):
        owner.setdefault(sets[i], i)
    links, root = Counter(), {m: m for m in owner.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    heads = [(m, s) for s, m in owner.items() if not isinstance(s, str)]
    for x, (a, s) in enumerate(heads):
        for b, t in heads[x + 1:]:
            common = len(s & t)
            if common >= threshold * (len(s) + len(t) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (find(owner[s]), owner[s], links[owner[s]]) for i, s in sets.items()}


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("small, block", [(24, 192), (3, 7)])
def test_join_equals_brute_force(spark, small, block):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(300)}"
    texts = []
    for _ in range(25):
        texts += near_copies(rng, [word() for _ in range(rng.randint(30, 200))], rng.randint(1, 5), 4)
    texts += near_copies(rng, [word() for _ in range(150)], 60, 3) + [" ".join(word() for _ in range(6)) for _ in range(10)]
    texts += [*AWKWARD, "one two", "one  two", "a b c d e", "a b c d e", *texts[:10]]
    docs = documents(spark, texts, member=1, size="x", keys=2, class_id=3).repartition(4)
    rows = jaccard.join(docs, small=small, block=block).collect()
    assert {r["doc_id"]: (r["class_id"], r["copy_of"], r["n_links"]) for r in rows} == plain_join(dict(enumerate(texts)))
    assert len(rows) == len(texts)


def test_join_without_ids_and_without_rows(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f", None]).withColumn("doc_id", F.when(F.col("doc_id") == 0, None).otherwise(F.col("doc_id")))
    rows = sorted((r["doc_id"] or -1, r["class_id"] or -1, r["n_links"]) for r in jaccard.join(docs).collect())
    assert rows == [(-1, -1, 0), (1, -1, 0), (2, 2, 0)]
    assert jaccard.join(docs.filter("false")).count() == 0


def test_recall_at_the_threshold():
    """Pairs just above 0.8 share a path through all levels in one of the runs."""
    rng = np.random.default_rng(3)
    runs, found, n = jaccard.runs_for(jaccard.RECALL, 0.8, jaccard.DEPTH), 0, 400
    for _ in range(n):
        shared = rng.integers(0, 1 << 63, 160).astype(np.uint64)
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, 20).astype(np.uint64)])) for _ in range(2))
        found += bool((jaccard.paths(a, runs, jaccard.DEPTH)[:, -1] == jaccard.paths(b, runs, jaccard.DEPTH)[:, -1]).any())
    assert found >= 0.99 * n


def test_paths_do_not_depend_on_how_many_tokens_are_hashed_at_once(monkeypatch):
    sets = [jaccard.shingles(" ".join(f"w{i % k}" for i in range(n)).encode()) for k, n in ((7, 30), (500, 400), (90, 1000))]
    whole = [jaccard.paths(s, 14, 4) for s in sets]
    monkeypatch.setattr(jaccard, "_TOKENS", 13)
    assert all((jaccard.paths(s, 14, 4) == w).all() for s, w in zip(sets, whole))


# ---------------------------------------------------------------- mixing

def test_marginals_meet_their_targets(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(5, 60)) + rng.choice(["", " license", " a@b.c"]), rng.choice("abc"), rng.choice(["x", "x", "y"]), 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, tokens int")
    mixed = mixing.mix(docs, temper=0.5, iterations=12).toPandas()
    mixed["mass"] = mixed["_weight"] * mixed["_tokens"]
    for column in ("source", "lang", "_topic"):
        natural = mixed.groupby(column)["_tokens"].sum() / mixed["_tokens"].sum()
        want = natural ** 0.5 / (natural ** 0.5).sum()
        assert np.allclose(mixed.groupby(column)["mass"].sum() / mixed["mass"].sum(), want, atol=1e-4)
    expected = (mixed["_probability"] * mixed["_tokens"]).sum()
    assert abs(mixed.loc[mixed["_drawn"], "_tokens"].sum() - expected) < 0.08 * expected and mixed["_probability"].max() == pytest.approx(1)


def test_mixing_awkward_rows(spark):
    docs = documents(spark, AWKWARD, weight=1, topic="x", _value=2).withColumn("lang", F.when(F.col("doc_id") < 3, None).otherwise(F.col("lang")))
    docs = docs.withColumn("source", F.when(F.col("doc_id") == 4, None).otherwise(F.col("source")))
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["_probability"] <= 1 for r in rows)
    assert mixing.mix(docs.filter("false")).count() == 0
    assert len(mixing.mix(documents(spark, [None, ""])).collect()) == 2


def test_a_rare_cell_does_not_decide_what_is_kept(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(5, 60)), rng.choice(["en", "en", "de"]), rng.choice("abbb")) for i in range(2000)]
    docs = spark.createDataFrame([*rows, (-1, "two words", "zz", "rare")], "doc_id bigint, text string, lang string, source string")
    mixed = mixing.mix(docs, kept=0.9, temper=0.5, iterations=4).toPandas()
    expected = mixed["_probability"] * mixed["_tokens"]
    assert expected.sum() == pytest.approx(0.9 * mixed["_tokens"].sum()) and mixed["_drawn"].mean() > 0.85
    assert mixed["_probability"].between(0, 1).all() and mixed.loc[mixed["source"] == "rare", "_drawn"].all()
    # Targets in reach of the kept share are met, although cells that are taken whole stand in their way.
    reach = spark.createDataFrame([("source", "a", 0.3), ("source", "b", 0.7), ("lang", "en", 0.6), ("lang", "de", 0.4), ("topic", "prose", 1.0)],
                                  "dimension string, value string, share double")
    mixed = mixing.mix(spark.createDataFrame(rows, docs.schema), targets=reach, kept=0.8, iterations=6).toPandas()
    mixed["mass"] = mixed["_probability"] * mixed["_tokens"]
    assert mixed["mass"].sum() == pytest.approx(0.8 * mixed["_tokens"].sum()) and mixed["_probability"].max() == 1
    assert mixed.groupby("source")["mass"].sum()["a"] / mixed["mass"].sum() == pytest.approx(0.3, abs=1e-2)
    assert mixed.groupby("lang")["mass"].sum()["de"] / mixed["mass"].sum() == pytest.approx(0.4, abs=1e-2)
