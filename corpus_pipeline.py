"""From raw documents to packed training sequences: every stage reads what the former one wrote.

Stages take (spark, docs, sf_dir), docs having the columns of ``documents``, and return a table; all but the last return those
columns again; stages that send texts to Python bound the batches of the session. Nulls, empty texts and repeated rows are treated as the operators' modules say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import jaccard, language, mixing, packing, secrets
from loomwork.session import bound_batches, scratch_path

#: A text whose words are this long, in bytes, and cost this many bits a byte more in the best language than by the frequencies of
#: their own bytes is in no language the model knows. Below the length there is too little to tell.
MIN_BYTES, MAX_EXCESS_BITS = 100, 2.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; a missing label is filled in. Without anything to learn from none can be told apart and all stay."""
    bound_batches(spark)
    # Words alone are learned and judged: digits, marks, capitals and secrets cost much in every language and say nothing.
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))), words_only=True)
    if model is None:
        return docs
    foreign = (F.col("_bytes") >= MIN_BYTES) & (F.col("_bits") > F.col("_own_bits") + MAX_EXCESS_BITS)
    named = language.identify(docs, model, words_only=True).toDF(*docs.columns, "_pred", "_score", "_bits", "_own_bits", "_bytes")
    known = named.filter((F.col("_pred") != language.UNDETERMINED) & ~foreign)
    return known.withColumn("lang", F.coalesce("lang", "_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every class of near copies; of repeated rows one. Texts without an id cannot be named and stay, once each."""
    bound_batches(spark)
    first = jaccard.join(docs).filter("class_id = doc_id").select("doc_id").distinct()
    marked = docs.withColumn("_text", F.xxhash64("text"))
    # One shuffle by doc_id serves the join and the search for repeated rows.
    kept = marked.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "_text"])
    nameless = marked.filter(F.col("doc_id").isNull()).dropDuplicates(["_text"])
    return kept.unionByName(nameless).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, its secrets are replaced and its length is set anew."""
    bound_batches(spark)
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the probabilities that meet the target marginals."""
    return mixing.mix(docs).filter("_drawn").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    bound_batches(spark)
    return packing.pack(packing.cut_pieces(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("near_duplicates", near_duplicates), ("redact_secrets", redact_secrets),
    ("mix_sources", mix_sources), ("pack", pack)]

#: Language models and packing are no SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{number}-{name}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
