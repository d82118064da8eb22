"""The stages of the corpus pipeline, each against a plain version of its decision."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from loomwork.llm import mixing
from test_corpus import check_packed, crc, plain_ids, plain_join
from test_per_row import AWKWARD, documents, plain_secrets

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        rows = docs.collect()
        if name == "pack":
            lengths = defaultdict(int)
            for r in rows:
                lengths[r["doc_id"]] += r["length"]
            assert lengths == {i: len(plain_ids(r["text"])) for i, r in before.items()}
            assert all(r["ids_crc32"] == crc(plain_ids(before[r["doc_id"]]["text"])[r["start"]:r["start"] + r["length"]]) for r in rows)
            check_packed(rows, 2048)
            break
        assert docs.columns == COLUMNS and len({r["doc_id"] for r in rows}) == len(rows)
        after = {r["doc_id"]: r for r in rows}
        if name == "language_id":
            assert all(i in after for i, r in before.items() if len(r["text"] or "") > 100)
            assert all(re.search(r"[^\W\d_]", r["text"]) for r in rows)
        if name == "near_duplicates":
            plain = plain_join({i: r["text"] for i, r in before.items()})
            assert after.keys() == {i for i, (first, _, _) in plain.items() if i == first}
        if name == "redact_secrets":
            assert after.keys() == before.keys()
            for i, r in after.items():
                assert not plain_secrets(r["text"]) and r["n_chars"] == len(r["text"])
                assert plain_secrets(before[i]["text"]) or r["text"] == before[i]["text"]
        if name == "mix_sources":
            mixed = {r["doc_id"]: r["_drawn"] for r in mixing.mix(spark.read.parquet(f"{tmp_path}/{number - 1}")).collect()}
            assert after.keys() == {i for i, drawn in mixed.items() if drawn} and len(after) > 0.05 * len(before)
        before = after
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(rows)


def test_stages_take_awkward_and_empty_tables(spark):
    text = "the cat and the dog run in the park all day long"
    docs = documents(spark, [*AWKWARD, text, text, None])
    docs = docs.union(docs)
    for table in (docs, docs.filter("false")):
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, table, SF).collect()
            assert table is docs or rows == [], name
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert [r["doc_id"] for r in kept if r["text"] == text] == [9] and [r["text"] for r in kept].count("same row") == 1


def test_language_stage_judges_words_only(spark):
    words = "the cat and the dog run in the park all day long while a small bird sings over the old house near the river".split()
    learned = [" ".join(words[(i * j) % len(words)] for j in range(3, 60)) + "." for i in range(1, 40)]
    clean = ["Cat. 19.37.233.111", 'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" +1 (168) 555-5254 bird', learned[4].upper(), "A.", "B2 x9"]
    foreign = ["быстрая коричневая лиса прыгает через ленивую собаку и убегает в лес", "nopea ruskea kettu hyppaa laiskan koiran yli ja juoksee metsaan kun aurinko laskee ja kuu nousee taivaalle"]
    docs = documents(spark, [*learned, *clean, *foreign, "12 + 34"])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") < len(learned), F.col("lang")))
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    assert kept == {i: "en" for i in range(len(learned) + len(clean))}
