"""Sources, ingest, shards, batches, predictions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from loomwork.functions.tokenizers import get_tokenizer
from loomwork.operators import batching, encode, ingest, predictions, vocabulary
from loomwork.schemas import SFT
from loomwork.sources import logs, plugins, sft


def csv(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_splits_and_mapping(spark, tmp_path):
    train = csv(tmp_path / "train.csv", 'question,answer,query\n"line one\nline ""two""",yes,\n12,34,more\n ,x,\n,gone,\n')
    evaluation = csv(tmp_path / "eval.csv", "question,answer\nq,a\n")
    rows = sft.read_splits(spark, train, evaluation, {"instruction": "question", "response": "answer"})
    assert dict(rows.dtypes)["instruction"] == "string"
    built = ingest.build_examples(rows, ["split"])
    got = {(r.split, r["query"], r.response) for r in ingest.filter_valid(built).collect()}
    assert got == {("train", 'line one\nline "two"', "yes"), ("train", "12\nmore", "34"), ("train", " ", "x"),
                   ("evaluation", "q", "a")}
    assert [(r.response, r.reason) for r in ingest.rejects(built).collect()] == [("gone", "empty query")]
    assert sft.read_splits(spark, train).select("split").distinct().collect() == [("train",)]
    assert plugins.load_dataset(spark, "csv", train).count() == 4
    plugins.register_dataset("two", lambda s, p: s.range(2))
    assert plugins.load_dataset(spark, "two").count() == 2
    with pytest.raises(ValueError, match="plug-in"):
        plugins.load_dataset(spark, "none")


def test_two_sources_for_one_target_are_refused(spark):
    df = spark.createDataFrame([("a", "b", "c")], "instruction string, output string, answer string")
    with pytest.raises(ValueError, match="both become"):
        ingest.map_columns(df, {"response": "answer"})
    assert ingest.map_columns(df).columns == ["instruction", "response", "answer"]


def test_nested_table_and_shards(spark, tmp_path):
    rows = [(f"i{i}", None, f"r{i}", [("q", "a")] if i % 2 else None, None) for i in range(37)]
    spark.createDataFrame(rows, SFT).write.json(str(tmp_path / "nested"))
    df = sft.read_sft_table(spark, str(tmp_path / "nested"), "json")
    examples = ingest.build_examples(df, ["instruction"])
    encoded = encode.encode_sft(examples, "vicuna", 256, keep=["instruction"])
    sharded = batching.assign_shards(encoded, 3, "instruction")
    path = str(tmp_path / "shards")
    sft.write_shards(sharded, path, "instruction", files_per_shard=2)
    back = spark.read.parquet(path)
    assert {r.instruction for r in back.collect()} == {r[0] for r in rows}
    assert sum(sft.read_shard(spark, path, s).count() for s in range(3)) == 37
    plan = {r.shard: (r.n_rows, r.steps_per_epoch) for r in batching.shard_plan(back, 4).collect()}
    batched = batching.assign_batches(back, 4, "instruction", hot_rows=5)
    sizes = {}
    for r in batched.groupBy("shard", "batch_id").count().collect():
        sizes.setdefault(r.shard, []).append((r.batch_id, r["count"]))
    for shard, found in sizes.items():
        n, steps = plan[shard]
        assert [b for b, _ in sorted(found)] == list(range(steps)) and steps == -(-n // 4)
        assert sorted(c for _, c in found)[::-1] == [4] * (n // 4) + ([n % 4] if n % 4 else [])
    whole = batching.assign_batches(back, 4, "instruction")
    key = ["shard", "batch_id", "instruction"]
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(map(tuple, batched.select(*key).collect()))
    for side in ("right", "left"):
        padded = batching.collate(batched, 0, side=side).collect()
        for r in padded:
            assert r.padded_length % 4 == 0
            assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == r.padded_length
            ids = [i for i, m in zip(r.input_ids, r.attention_mask) if m]
            assert (r.input_ids[:len(ids)] if side == "right" else r.input_ids[len(r.input_ids) - len(ids):]) == ids


def test_integer_keys_are_batched_with_and_without_a_width(spark):
    df = batching.assign_shards(spark.range(0, 500, 3).withColumnRenamed("id", "key"), 2, "key")
    want = {(r.key, r.batch_id) for r in batching.assign_batches(df, 7, "key").collect()}
    for kwargs in ({"width": 20.0, "hot_rows": 5}, {"hot_rows": 5}):
        assert {(r.key, r.batch_id) for r in batching.assign_batches(df, 7, "key", **kwargs).collect()} == want


def test_predictions(spark, tmp_path):
    tok = get_tokenizer("codepoint", "vanilla")
    ids = [ord(c) for c in "Hé , it 's"]
    rows = [("r", 2, [9, 9, *ids, tok.eos_id], [-100, *ids, tok.eos_id]), ("s", 5, [1, 2], [7])]
    df = spark.createDataFrame(rows, "run string, prompt_len int, generated array<int>, label_ids array<int>")
    texts = predictions.prediction_texts(df, tok, ["run"])
    assert texts.filter("run = 'r'").first()[1:] == ("Hé, it's", "Hé, it's")
    assert texts.filter("run = 's'").first().predict == ""
    fitted = {r.run: r.label_ids for r in predictions.fit_labels(df, 0).collect()}
    assert fitted == {"r": [-100, ids[0]], "s": [0, 0, 0, 0, 7]}
    padded = {r.run: (len(r.generated), len(r.label_ids)) for r in predictions.pad_generated(df, tok, 5, 20).collect()}
    assert padded == {"r": (21, 21), "s": (5, 5)}
    logs.write_predictions(texts, str(tmp_path))
    part = next((tmp_path / "generated_predictions.jsonl").glob("part-*"))
    lines = [json.loads(x) for p in (tmp_path / "generated_predictions.jsonl").glob("part-*")
             for x in p.read_text(encoding="utf-8").splitlines()]
    assert {"label": "Hé, it's", "predict": "Hé, it's"} in lines and part.exists()
    assert "é" in "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "generated_predictions.jsonl").glob("part-*"))
    assert logs.read_predictions(spark, str(tmp_path)).count() == 2


def test_a_feed_is_read_in_parts_and_followed(spark, tmp_path):
    def parts(folder):  # inside, so that workers get them by value
        from pathlib import Path
        return sorted(str(p) for p in Path(folder).glob("*.log"))

    def lines(folder, name):
        import pyarrow as pa
        with open(name) as f:
            found = f.read().splitlines()
        yield pa.RecordBatch.from_pydict({"uid": [name.rsplit("/", 1)[1]] * len(found), "line": found})

    plugins.register_feed(spark, "log_folder", plugins.Feed("uid string, line string", parts, lines))
    for i in range(3):
        (tmp_path / f"{i}.log").write_text(f"first {i}\nsecond {i}\n")
    rows = plugins.load_dataset(spark, "log_folder", str(tmp_path))
    assert rows.rdd.getNumPartitions() == 3 and sorted(r.line for r in rows.collect()) == sorted(f"{w} {i}" for w in ("first", "second") for i in range(3))
    assert rows.filter("uid = '1.log'").select("line").count() == 2
    empty = tmp_path / "empty"
    empty.mkdir()
    assert plugins.load_dataset(spark, "log_folder", str(empty)).count() == 0
    stream = spark.readStream.format("log_folder").option("parameters", str(tmp_path)).option("maxPartsPerTrigger", 2).load()
    seen = []

    def follow():
        # Python sources know no trigger that drains and stops.
        query = stream.writeStream.foreachBatch(lambda df, i: seen.append(sorted(r.line for r in df.collect()))) \
            .option("checkpointLocation", str(tmp_path / "checkpoint")).start()
        query.processAllAvailable()
        query.stop()
    follow()
    (tmp_path / "3.log").write_text("late\n")
    follow()
    assert sorted(x for batch in seen for x in batch) == sorted(["late", *(f"{w} {i}" for w in ("first", "second") for i in range(3))])
    assert max(map(len, seen)) <= 4


def test_words_tokenizer(spark):
    df = spark.createDataFrame([(1, "b a  b"), (2, "c a b"), (3, ""), (4, None)], "id int, text string")
    vocab = vocabulary.build_vocabulary(df, ["text"], 2).persist()
    assert sorted(map(tuple, vocab.collect())) == [("a", 2, 2), ("b", 1, 3)]
    encoded = {r.id: r.ids for r in vocabulary.encode_words(df, "id", "text", vocab).collect()}
    assert encoded == {1: [1, 2, 1], 2: [0, 2, 1], 3: [], 4: []}
    tok = vocabulary.words_tokenizer(spark, vocab, bos=None)
    examples = spark.createDataFrame([("a b", "b z")], "query string, response string")
    row = encode.encode_sft(examples, "vanilla", 16, tok).first()
    assert row.input_ids == [2, 1, 1, 0, 3] and row.labels == [-100, -100, 1, 0, 3]
    whole = vocabulary.build_vocabulary(df, ["text"])
    assert sorted(map(tuple, whole.collect())) == [("a", 2, 2), ("b", 1, 3), ("c", 3, 1)]
    joined = {r.id: r.ids for r in vocabulary.encode_words(df, "id", "text", whole).collect()}
    assert joined == {1: [1, 2, 1], 2: [3, 2, 1], 3: [], 4: []}
    for limit in ({"max_pieces": 2}, {"max_bytes": 2}):
        with pytest.raises(ValueError):
            vocabulary.words_tokenizer(spark, whole, **limit)


@pytest.mark.parametrize("frequent", [0, 3, 4096])
@pytest.mark.parametrize("template", ["vanilla", "chatml", "baichuan2", "xverse"])
def test_a_dictionary_nobody_holds_gives_the_same_examples(spark, monkeypatch, template, frequent):
    """Over ten pieces no worker may hold them; with the join the ids are those of the tokenizer that does."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)] + ["Human:", "wörter", "x" * 200]
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", " ".join(rng.choice(words) for _ in range(rng.randrange(30))) or "w1")
            for c in range(12) for t in range(2 * rng.randrange(1, 5))]
    rows += [(99, 0, "user", "\t \n"), (99, 1, "assistant", "a third of all rows has this word " + "w0 " * 300)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    monkeypatch.setattr(vocabulary, "FREQUENT", frequent)
    vocab = vocabulary.build_vocabulary(df.filter("conv_id % 3 <> 1"), ["text"])  # the others hold unknown pieces
    with pytest.raises(ValueError):
        vocabulary.words_tokenizer(spark, vocab, max_pieces=10)
    encoded = lambda tok: encode.encode_conversations(df, template, 48, tok)
    as_rows = lambda out: sorted(map(str, out.select("conv_id", "input_ids", "labels", "attention_mask").collect()))
    assert as_rows(vocabulary.encode_examples(encoded, ["conv_id"], vocab)) == as_rows(encoded(vocabulary.words_tokenizer(spark, vocab)))


def test_examples_of_nested_rows_and_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b", "b z", [("b", "a")]), (2, " \n", "a", []), (3, "a", "a", None)],
                               "id int, query string, response string, history array<struct<query:string,response:string>>")
    vocab = vocabulary.build_vocabulary(df, ["query", "response"])
    for settings in ({}, {"bos": None}):
        encoded = lambda tok: encode.encode_sft(df.drop("history"), "vanilla", 16, tok, keep=["id"])
        want = encoded(vocabulary.words_tokenizer(spark, vocab, **settings)).collect()
        got = vocabulary.encode_examples(encoded, ["id"], vocab, **settings).collect()
        assert sorted((r.id, r.input_ids, r.labels) for r in got) == sorted((r.id, r.input_ids, r.labels) for r in want)
    nested = vocabulary.encode_examples(lambda tok: encode.encode_sft(df, "llama2", 64, tok, keep=["id"]), ["id"], vocab).collect()
    assert sorted(r.id for r in nested) == [1, 2, 3] and all(len(r.input_ids) == len(r.labels) for r in nested)
    empty = vocabulary.build_vocabulary(df.limit(0), ["query"])
    assert empty.count() == 0 and vocabulary.encode_words(df, "id", "query", empty).filter("exists(ids, x -> x <> 0)").count() == 0


def test_vocabulary_is_numbered_in_order_without_rdds(spark):
    rows = [(" ".join(f"w{i}" for i in range(200) if k % (i + 1) == 0),) for k in range(1, 400)]
    df = spark.createDataFrame(rows, "text string").repartition(6)
    vocab = vocabulary.build_vocabulary(df, ["text"])
    got = [(r.n, r.piece) for r in sorted(vocab.collect(), key=lambda r: r.id)]
    assert got == sorted(got, key=lambda r: (-r[0], r[1])) and sorted(r.id for r in vocab.collect()) == list(range(1, len(got) + 1))
    assert vocabulary.build_vocabulary(df, ["text"], 5).count() == 5
    assert "ExistingRDD" not in vocab.select("piece")._jdf.queryExecution().optimizedPlan().toString()


def test_a_word_is_the_same_everywhere(spark):
    texts = ["a\u3000b a\u00a0b", "\x0ba\x0cb\x1cc\x85d\re", " é  漢 \n"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    words = {i: vocabulary.split_words(t) for i, t in enumerate(texts)}
    assert {r.id: r.w for r in df.select("id", vocabulary.pieces("text").alias("w")).collect()} == words
    vocab = vocabulary.build_vocabulary(df, ["text"])
    ids = {r.piece: r.id for r in vocab.collect()}
    tok = vocabulary.words_tokenizer(spark, vocab, bos=None)
    by_tokenizer = {r.id: r.ids for r in df.select("id", tok.encode(F.col("text")).alias("ids")).collect()}
    by_column = {r.id: r.ids for r in vocabulary.encode_words(df, "id", "text", vocab).collect()}
    assert by_column == by_tokenizer == {i: [ids[w] for w in found] for i, found in words.items()}
