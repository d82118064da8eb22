"""One named query per operator, over its whole table with the production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import (
    jaccard, language, mixing, packing, periodic, pii, quality, resampling, secrets, substrings, token_files, topk, toxicity)
from loomwork.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", "text", language.held_out(F.col("doc_id")).alias("held_out"))
    return language.identify(rows, model, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select("doc_id", *[count(kind).alias(f"n_{kind}") for kind in secrets.BASE],
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(table(spark, sf_dir, "documents"), f"{scratch_path(spark, 'token-files')}/ids")
    return token_files.read(files)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("lost")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.scaled(F.col("embedding")).alias("v"))
    index = topk.build(vectors, "vec_id", "v")
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return topk.search(index, vectors.filter("vec_id % 100 = 0"), "vec_id", "v", 10)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.cut_pieces(table(spark, sf_dir, "documents")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id", "source", "lang"])
    return mixed.select("doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
                        F.round("_probability", 6).alias("probability"), F.col("_drawn").alias("drawn"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    return pii.extract(table(spark, sf_dir, "documents")).select(
        "doc_id", *[pii.count_of(spans, kind).alias(f"n_{kind}") for kind in pii.KINDS], pii.digest(spans).alias("base_sha256"),
        pii.joined(spans).alias("spans"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", "text", toxicity.held_out(F.col("doc_id")).alias("held_out"))
    return toxicity.score(rows, machine, keep=["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= toxicity.LIMIT).cast("int"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or for a tenth of the ids its words with one stretch of them repeated to the end."""
    words = F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    # Bound as a lambda's variable, the words are split once a text.
    of = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeat(w))), F.lit(0))
    return F.when(h % 10 == 0, F.coalesce(of, text)).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic.collapse(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")), keep=["doc_id"])
    runs = F.col("runs")
    above = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    even = lambda a, b: a["length"] * b["period"] == b["length"] * a["period"]
    # Runs come by start, then period, so of equal exponents the first one stays.
    best = F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda a, b: F.when(
        a.isNull() | above(b, a) | (even(b, a) & (F.struct(b["start"], b["period"]) < F.struct(a["start"], a["period"]))), b).otherwise(a))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    chosen = found.select("doc_id", F.size(runs).cast("bigint").alias("n_runs"), best.alias("b"), lines.alias("lines"), "collapsed")
    return chosen.select("doc_id", "n_runs", "b.start", "b.length", "b.period",
                         F.floor(1000 * F.col("b.length") / F.col("b.period")).alias("exponent_milli"),
                         F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in (
    op1_language, op2_secrets, op3_token_files, op4_substring_dedup, op5_line_quality, op6_topk, op7_packing, op8_mixing, op9_jaccard,
    op10_personal_data, op11_toxicity, op12_resampling, op13_periodic_runs)}
