"""The named queries. Each reads whole tables and returns one flat DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow.dataset as pa_dataset
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork import schemas
from loomwork.functions import arrays, maps, text
from loomwork.functions.templates import TEMPLATES
from loomwork.functions.tokenizers import CodepointTokenizer, get_tokenizer
from loomwork.operators import (batching, conversations, encode, ingest, predictions, registry, rollup, scoring,
                                telemetry, timeseries, vocabulary)
from loomwork.plans import tables as t
from loomwork.session import scratch_path
from loomwork.sources import appends, logs, plugins, sft
from loomwork.streaming import jobs as streams
from loomwork.streaming import tables as versions

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 4
BATCH = 8
DAY_MS = 86_400_000
FIRST_MS = 1_704_067_200_000  # 2024-01-01


def joined(ids: Column | str) -> Column:
    return F.array_join(text.col(ids).cast("array<string>"), " ")


def flat_encoded(encoded: DataFrame, key: str) -> DataFrame:
    return encoded.select(
        key, F.size("input_ids").cast("bigint").alias("n"), arrays.count_unmasked("labels").cast("bigint").alias("n_target"),
        joined("input_ids").alias("ids"), joined("labels").alias("labels"))


# ---------------------------------------------------------------- conversations and encoding

def pair_turns(spark, sf):
    return conversations.pair_turns(t.messages(spark, sf)).drop("system")


def assemble_conversations(spark, sf):
    rows = conversations.assemble_conversations(t.messages(spark, sf))
    past = F.transform("history", lambda h: F.concat(h["query"], F.lit("\x1f"), h["response"]))
    return rows.select("conv_id", "system", F.size("history").cast("bigint").alias("n_history"),
                       F.array_join(past, "\x1e").alias("history"), "query", "response")


def encode_with(template: str) -> Query:
    def query(spark, sf):
        return flat_encoded(encode.encode_conversations(t.messages(spark, sf), template), "conv_id")
    return query


def encode_nested(spark, sf):
    """The nested path: conversations on one row each, then one projection."""
    rows = conversations.assemble_conversations(t.messages(spark, sf))
    return flat_encoded(encode.encode_sft(rows, "chatml", keep=["conv_id"]), "conv_id")


def nested_source(spark, sf):
    """Assembled conversations written as a nested table, read back with the declared schema and encoded."""
    path = scratch_path(spark, "nested")
    rows = conversations.assemble_conversations(t.messages(spark, sf))
    rows.select(F.lit(None).cast("string").alias("instruction"), "query", "history", "system", "response",
                F.col("conv_id")).write.parquet(path)
    back = sft.read_sft_table(spark, path)
    encoded = flat_encoded(encode.encode_sft(back.select("query", "response", "history", "system"), "chatml", keep=["query"]), "query")
    return encoded.groupBy("n", "n_target", "ids", "labels").agg(F.count(F.lit(1)).alias("n_rows"))


def long_conversations(spark, sf) -> DataFrame:
    """All messages chained to three conversations."""
    return t.messages(spark, sf).select(
        F.pmod("conv_id", F.lit(3)).alias("conv_id"), (F.col("conv_id") * 1000 + F.col("turn")).alias("turn"), "role", "text")


def encode_long(spark, sf):
    """Very long conversations, from message rows."""
    return flat_encoded(encode.encode_conversations(long_conversations(spark, sf), "chatml"), "conv_id")


def encode_long_nested(spark, sf):
    """The same through the nested form."""
    rows = conversations.assemble_conversations(long_conversations(spark, sf))
    return flat_encoded(encode.encode_sft(rows, "chatml", keep=["conv_id"]), "conv_id")


def preview(spark, sf):
    """The first example with its texts."""
    encoded = encode.encode_conversations(t.messages(spark, sf), "vanilla").orderBy("conv_id")
    return encode.preview(encoded, "vanilla", n=1).select("conv_id", "inputs", "label_text")


def encode_words(spark, sf):
    """Conversations in ids of a vocabulary counted from all messages."""
    rows = t.messages(spark, sf)
    vocab = vocabulary.build_vocabulary(rows, ["text"])
    encoded = vocabulary.encode_examples(lambda tok: encode.encode_conversations(rows, "vanilla", 64, tok), ["conv_id"], vocab)
    return flat_encoded(encoded, "conv_id")


def token_quantiles(spark, sf):
    """Lengths of encoded conversations."""
    rows = encode.encode_conversations(t.messages(spark, sf), "llama2").withColumn("part", F.pmod("conv_id", F.lit(4)))
    stats = encode.corpus_stats(rows, ["part"], quantiles=[0.5, 0.9])
    return stats.select("part", "n_examples", "n_tokens", "n_targets", "n_at_cutoff", joined("token_quantiles").alias("quantiles"))


def dataset_plugin(spark, sf):
    """Instruction rows through a plug-in that takes the folder as its parameters."""
    plugins.register_dataset("documents", lambda session, folder: t.instruction_rows(session, folder))
    rows = ingest.map_columns(plugins.load_dataset(spark, "documents", sf), {"instruction": "question", "response": "answer"})
    return ingest.filter_valid(ingest.build_examples(rows, ["doc_id"])).select("doc_id", "query", "response")


def _row_groups(path: str) -> list:
    """A feed's parts: row groups of a Parquet table that Python opens, cut so that no part has more than 256 rows."""
    files = pa_dataset.dataset(path, format="parquet").files
    return [[f, g, at] for f in files for g in range(pq.ParquetFile(f).num_row_groups)
            for at in range(0, pq.ParquetFile(f).metadata.row_group(g).num_rows, 256)]


def _read_row_group(path: str, part: list):
    name, group, at = part
    table = pq.ParquetFile(name).read_row_group(group, columns=["doc_id", "text", "lang", "source"])
    yield from table.slice(at, 256).to_batches()


def feed_source(spark, sf):
    """Documents through a feed, a format of the session's own with a partitioned reader, to instruction rows."""
    plugins.register_feed(spark, "row_groups", plugins.Feed("doc_id bigint, text string, lang string, source string", _row_groups, _read_row_group))
    docs = spark.read.format("row_groups").option("parameters", f"{sf}/documents.parquet").load()
    rows = ingest.map_columns(t.instructions(docs), {"instruction": "question", "response": "answer"})
    return ingest.filter_valid(ingest.build_examples(rows, ["doc_id"])).select("doc_id", "query", "response")


def encode_bytes(spark, sf):
    return flat_encoded(
        encode.encode_conversations(t.messages(spark, sf), "llama2", 256, "utf8_bytes"), "conv_id")


def encode_oneturn(spark, sf):
    rows = conversations.assemble_conversations(t.messages(spark, sf))
    return encode.encode_oneturn(rows, "default", keep=["conv_id"]).select(
        "conv_id", joined("prompt_ids").alias("prompt_ids"), joined("answer_ids").alias("answer_ids"))


def render_chat(spark, sf):
    """Every turn in every template, in one pass over the pairs."""
    rows = conversations.pair_turns(t.messages(spark, sf))

    def one(template):
        system = F.coalesce(text.blank_to_null("system"), F.lit(template.system))
        return F.struct(F.lit(template.name).alias("template"), encode.render_turn(
            template, F.col("t"), F.col("query"), F.col("response"), system, "</s>").alias("text"))
    return rows.select("conv_id", "t", F.explode(F.array(*map(one, TEMPLATES.values()))).alias("_r")) \
        .select("conv_id", "t", "_r.template", "_r.text")


def decode_labels(spark, sf):
    encoded = encode.encode_conversations(t.messages(spark, sf), "vanilla")
    return encode.decode(encoded, "labels", "vanilla").select("conv_id", "text")


def sft_rows(spark, sf) -> DataFrame:
    mapped = ingest.map_columns(t.instruction_rows(spark, sf), {"instruction": "question", "response": "answer"})
    return ingest.build_examples(mapped, ["doc_id", "lang", "source"])


def word_ids(spark, sf):
    """Documents in ids of a vocabulary counted from them."""
    docs = t.table(spark, sf, "documents").select("doc_id", "text")
    vocab = vocabulary.build_vocabulary(docs, ["text"])
    return vocabulary.encode_words(docs, "doc_id", "text", vocab).select("doc_id", F.size("ids").cast("bigint").alias("n"), joined("ids").alias("ids"))


def sft_examples(spark, sf):
    return ingest.filter_valid(sft_rows(spark, sf)).select("doc_id", "query", "response")


def read_splits(spark, sf):
    """The documents written as CSV, labelled ones as training data, and read back as examples."""
    folder = scratch_path(spark, "csv")
    rows = t.instruction_rows(spark, sf)
    labelled = t.table(spark, sf, "labels").select("doc_id")
    for split, how in (("train", "left_semi"), ("evaluation", "left_anti")):
        rows.join(labelled, "doc_id", how).write.options(header=True, escape='"', quoteAll=True).csv(f"{folder}/{split}")
    back = sft.read_splits(spark, f"{folder}/train", f"{folder}/evaluation", {"instruction": "question", "response": "answer"},
                           columns=rows.columns)
    examples = ingest.filter_valid(ingest.build_examples(back, ["doc_id", "split"]))
    return examples.select(F.col("doc_id").cast("bigint").alias("doc_id"), "split", "query", "response")


def sft_rejects(spark, sf):
    return ingest.rejects(sft_rows(spark, sf)).select("doc_id", "reason")


def encode_documents(spark, sf):
    return flat_encoded(encode.encode_sft(sft_rows(spark, sf), "alpaca", keep=["doc_id"]), "doc_id")


def corpus_stats(spark, sf):
    counts = encode.count_tokens(sft_rows(spark, sf), "alpaca", keep=["lang", "source"])
    return encode.corpus_stats(counts, ["lang", "source"])


# ---------------------------------------------------------------- shards and batches

def shards(spark, sf) -> DataFrame:
    encoded = encode.encode_conversations(t.messages(spark, sf), "chatml", 512)
    return batching.assign_shards(encoded, SHARDS, "conv_id")


def merged_stats(spark, sf):
    """Statistics written per shard and merged per language; the sketched median must stand within its error of the true one."""
    path = scratch_path(spark, "shard-stats")
    counts = encode.count_tokens(sft_rows(spark, sf), "alpaca", keep=["doc_id", "lang"])
    encode.shard_stats(batching.assign_shards(counts, 8, "doc_id"), ["shard", "lang"]).write.parquet(path)
    merged = encode.length_quantiles(encode.merge_stats(spark.read.parquet(path), ["lang"]), [0.5])
    median = F.get("token_quantiles", F.lit(0))
    ranks = counts.join(merged.select("lang", median.alias("median")), "lang").groupBy("lang").agg(
        F.avg((F.col("n_tokens") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("n_tokens") <= F.col("median")).cast("double")).alias("upto"))
    near = (F.col("below") <= 0.5 + 2 * encode.RANK_ERROR) & (F.col("upto") >= 0.5 - 2 * encode.RANK_ERROR)
    return merged.join(ranks, "lang").select("lang", "n_examples", "n_tokens", "max_tokens", "n_targets", "n_at_cutoff", near.alias("near"))


def shard_plan(spark, sf):
    return batching.shard_plan(shards(spark, sf), BATCH)


def assign_batches(spark, sf):
    rows = batching.assign_shards(t.instruction_rows(spark, sf), SHARDS, "doc_id")
    return batching.assign_batches(rows, BATCH, "doc_id", width=1_000_000.0).select("doc_id", "shard", "batch_id")


def collate(spark, sf):
    """Encoded shards are written once, as workers read them; batches are formed from the written table."""
    tok = get_tokenizer("codepoint", "chatml")
    folder = scratch_path(spark, "shards")
    sft.write_shards(shards(spark, sf), folder, "conv_id", files_per_shard=2)
    batched = batching.assign_batches(spark.read.parquet(folder), BATCH, "conv_id", ("split", "shard"), 1_000_000.0)
    return batching.collate(batched, tok.pad_id, by=("split", "shard", "batch_id")).select(
        "conv_id", "shard", "batch_id", "padded_length", joined("input_ids").alias("ids"),
        joined("labels").alias("labels"), joined("attention_mask").alias("mask"))


# ---------------------------------------------------------------- registry

def resolve_splits(spark, sf):
    rows = registry.resolve_splits(t.datasets(spark, sf))
    return rows.select("name", text.strip_bucket("train_path", "bucket").alias("train_path"), "evaluation_path")


def features(spark, sf):
    rows = t.datasets(spark, sf).withColumn("_json", maps.features_json("features"))
    inverse = maps.invert_map(maps.parse_columns("_json"))
    return rows.select("name", F.col("_json").alias("columns_text"),
                       F.array_join(F.sort_array(F.map_keys(inverse)), ",").alias("sources"))


def resolve_runs(spark, sf):
    rows = registry.resolve_runs(t.runs(spark, sf), t.datasets(spark, sf), t.hyperparameters(spark, sf),
                                 t.models(spark, sf))
    return rows.select("name", F.col("dataset_row").isNotNull().alias("has_dataset"),
                       F.col("hyperparameter_row.parameters.lora_r").alias("lora_r"),
                       F.col("model_row.spec").alias("model_spec"))


def merge_overrides(spark, sf):
    rows = t.runs(spark, sf).join(
        t.hyperparameters(spark, sf).withColumnRenamed("name", "hyperparameter"), ["namespace", "hyperparameter"], "left")
    return registry.merge_overrides(rows).select("name", "merged.*")


def run_configs(spark, sf):
    filled = registry.fill_run_defaults(t.runs(spark, sf), "base:1")
    rows = registry.run_configs(filled, t.datasets(spark, sf), t.hyperparameters(spark, sf), t.models(spark, sf))
    return rows.select("name", "uid", "config.model_name_or_path", "config.train_path", "config.evaluation_path",
                       "config.columns_text", "config.quantization", "config.num_workers",
                       F.col("config.parameters.epochs").alias("epochs"),
                       encode.effective_cutoff(F.col("config.parameters.block_size")).alias("cutoff"))


def missing_deps(spark, sf):
    rows = registry.missing_deps(t.runs(spark, sf), t.datasets(spark, sf), t.hyperparameters(spark, sf),
                                 t.models(spark, sf))
    return rows.select("name", F.array_join("missing", ",").alias("missing"), "state")


def validate_runs(spark, sf):
    rows = t.table(spark, sf, "lineitem").selectExpr(
        f"concat('run-', {t.LINE_KEY}) AS name",
        "CASE WHEN l_returnflag = 'A' THEN 'int4' WHEN l_returnflag = 'R' THEN 'int2' END AS quantization",
        "l_linenumber + 1 AS quantization_bit", "CASE WHEN l_linenumber = 5 THEN 'fp8' ELSE 'nf4' END AS quantization_type",
        "CASE WHEN l_linenumber = 6 THEN 'adapter' ELSE 'lora' END AS finetuning_type",
        "CASE WHEN l_linestatus = 'F' THEN 'sft' ELSE 'xx' END AS stage",
        "CASE WHEN l_linenumber = 2 THEN 'cubic' WHEN l_linenumber = 3 THEN 'linear' END AS rope_scaling",
        "CASE WHEN l_quantity > 40 THEN '' ELSE 's3/out' END AS storage_path",
        "CASE WHEN l_quantity < 10 THEN NULL ELSE 'train.csv' END AS train_path",
        "l_linenumber < 3 AS split_special_tokens", "l_linestatus = 'F' AS use_fast_tokenizer")
    return registry.validate_runs(rows).select("name", F.array_join("errors", "; ").alias("errors"))


def checkpoints(spark, sf):
    rows = registry.checkpoints(t.runs(spark, sf), t.datasets(spark, sf), t.hyperparameters(spark, sf),
                                t.models(spark, sf))
    return rows.select(
        "name", "model.ref", F.col("model.spec.spec").alias("model_spec"),
        F.col("dataset.ref").alias("dataset"), F.col("hyperparameter.ref").alias("hyperparameter"),
        F.col("hyperparameter.spec.parameters.epochs").alias("base_epochs"),
        F.col("hyperparameter.merged.epochs").alias("merged_epochs"),
        F.col("image.name").alias("image"),
        text.checkpoint_path(text.strip_bucket("checkpoint_path", "bucket")).alias("checkpoint_path"))


def append_absent(spark, sf):
    """Checkpoints appended to a registry table twice; the second time adds nothing."""
    path = scratch_path(spark, "checkpoints")
    rows = checkpoints(spark, sf).withColumn("namespace", F.lit("default"))
    for _ in range(2):
        appends.append_absent(spark, rows, path)
    return appends.read_table(spark, path, rows.schema).groupBy("dataset").agg(F.count(F.lit(1)).alias("n_checkpoints"))


def create_if_absent(spark, sf):
    """Jobs wanted by the listing experiments that do not exist yet."""
    wanted = t.listed_experiments(spark, sf).select("namespace", F.explode("jobs").alias("name"))
    existing = t.jobs(spark, sf).select("namespace", F.concat(F.lit("job-"), F.split("name", "-")[1]).alias("name"))
    return registry.create_if_absent(existing, wanted).select("name")


def references(spark, sf):
    return registry.references(t.runs(spark, sf)).select("kind", "name", "run")


def add_references(spark, sf):
    """References of runs that did not fail, and then those of all runs."""
    runs = t.runs(spark, sf)
    refs = registry.add_references(registry.references(runs.filter("state <> 'FAILED'")), runs)
    return registry.reference_counts(refs).select("kind", "name", "n_runs")


def drop_reference(spark, sf):
    refs = registry.references(t.runs(spark, sf))
    failed = t.run_states(spark, sf).filter(F.col("state") == "FAILED")
    return registry.reference_counts(registry.drop_reference(refs, failed)).select("kind", "name", "n_runs")


def with_owner(spark, sf):
    return registry.with_owner(t.jobs(spark, sf), t.experiments(spark, sf), "owner_experiment", ["state"]) \
        .select("name", "owner_experiment", "owner_state")


def first_by(spark, sf):
    return registry.first_by(t.order_jobs(spark, sf), ["owner_experiment"], "created") \
        .select("owner_experiment", "first_name")


def text_functions(spark, sf):
    """The scalar functions over orders and their customers' numbers."""
    o = t.table(spark, sf, "orders")
    path = F.concat_ws("/", F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderkey").cast("string"))
    return o.select(
        "o_orderkey",
        text.parse_score(F.substring_index("o_orderpriority", "-", 1)).alias("score"),
        text.parse_score("o_orderpriority").alias("no_score"),
        text.strip_bucket(path, "F").alias("path"),
        text.format_duration(F.col("o_totalprice")).alias("duration"),
        text.percent(F.col("o_orderkey") % 100, F.col("o_custkey") % 8 * 100).alias("percent"),
        text.replace_first("o_orderpriority", "O", F.lit("{{O}}")).alias("replaced"),
        text.epoch_ms("o_orderdate").alias("epoch_ms"), text.day_tag("o_orderdate").alias("day"),
        text.stamp("o_orderdate").alias("stamp"),
        F.array_join(text.split_list(F.concat_ws(" , ", F.col("o_orderstatus"), F.col("o_orderpriority"))), "|").alias("items"))


def map_functions(spark, sf):
    """Labels of each part, merged under the labels its brand fixes."""
    p = t.table(spark, sf, "part")
    fixed = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string"))
    own = F.create_map(F.lit("brand"), F.lit("own"), F.lit("type"), F.col("p_type"), F.lit("name"), F.col("p_name"))
    merged = F.sort_array(F.map_entries(maps.merge_maps(fixed, own)))
    return p.select("p_partkey", F.array_join(F.transform(
        merged, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("labels"))


# ---------------------------------------------------------------- states and ranks

def rollup_runs(spark, sf):
    return rollup.rollup_runs(t.runs(spark, sf)).select("name", "state")


def rollup_jobs(spark, sf):
    return rollup.rollup_jobs(t.jobs_in_progress(spark, sf), t.run_states(spark, sf)) \
        .select("name", "state", "serving", "stalled")


def rollup_experiments(spark, sf):
    return rollup.rollup_experiments(t.experiments_of_orders(spark, sf), t.jobs(spark, sf)).select("name", "state")


def rank_jobs(spark, sf):
    return rollup.rank_jobs(t.jobs(spark, sf)).select("owner_experiment", "name", "points", "rank")


def top_runs(spark, sf):
    return rollup.top_runs(t.jobs(spark, sf), 2).select("owner_experiment", "name", "rank")


def best_version(spark, sf):
    runs = t.runs(spark, sf).filter("model <> 'm-0'")  # the runs of some jobs are gone
    rows = rollup.best_version(t.experiments_of_orders(spark, sf), t.jobs(spark, sf), runs)
    return rows.drop("namespace")


def job_status_list(spark, sf):
    rows = rollup.job_status_list(t.listed_experiments(spark, sf), t.order_jobs(spark, sf))
    return rows.select("name", F.array_join(F.transform(
        "jobs_status", lambda j: F.concat(j["name"], F.lit("="), F.coalesce(j["state"], F.lit("")))), ",").alias("jobs_status"))


def apply_pause(spark, sf):
    after, kept, removed = rollup.apply_pause(t.experiments(spark, sf), t.jobs(spark, sf))
    parts = [after.select(F.lit("experiment").alias("what"), "name", "state"),
             kept.select(F.lit("kept").alias("what"), "name", "state"),
             removed.select(F.lit("removed").alias("what"), "name", "state")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- logs

def numbered_logs(spark, sf) -> DataFrame:
    """Log rows with their step number, the run's length and its start."""
    rows = telemetry.number_steps(t.logs(spark, sf), "uid", "ts")
    facts = t.logs(spark, sf).groupBy("uid").agg(
        F.count(F.lit(1)).alias("total_steps"), F.min("ts").alias("started_at"))
    return rows.join(facts, "uid").withColumn("epoch", F.col("current_steps") / 10)


def progress(spark, sf):
    rows = telemetry.progress(numbered_logs(spark, sf))
    return rows.select("uid", "event_id", "current_steps", "elapsed_seconds", "remaining_seconds", "percentage",
                       "elapsed_time", "remaining_time")


def train_logs(spark, sf):
    return telemetry.normalize_logs(numbered_logs(spark, sf))[0]


def eval_logs(spark, sf):
    rows = telemetry.normalize_logs(numbered_logs(spark, sf))[1]
    return rows.withColumn("eval_perplexity", F.round("eval_perplexity", 9))


def eval_metrics(spark, sf):
    rows = telemetry.eval_metrics(t.logs(spark, sf).filter("eval_loss IS NOT NULL"), ["uid"])
    return rows.select("uid", F.round("eval_loss", 9).alias("eval_loss"),
                       F.round("eval_perplexity", 6).alias("eval_perplexity"))


def eval_speed(spark, sf):
    rows = numbered_logs(spark, sf).withColumn("runtime", telemetry.seconds_between("started_at", "ts"))
    return telemetry.eval_speed(rows, ["uid"], 4, 2)


def run_summary(spark, sf):
    rows = telemetry.run_summary(numbered_logs(spark, sf))
    return rows.withColumn("mean_loss", F.round("mean_loss", 9))


def curve(spark, sf):
    rows = telemetry.curve(numbered_logs(spark, sf).filter("loss IS NOT NULL"), "loss", 5, 2)
    return rows.withColumn("value", F.round("value", 9)).withColumn("smoothed", F.round("smoothed", 9))


def state_changes(spark, sf):
    rows = telemetry.state_changes(t.logs(spark, sf), "uid", "ts", ["event_type"])
    return rows.select("uid", "event_id", "event_type", F.col("previous.event_type").alias("previous"))


def log_files(spark, sf):
    """Log rows written to the two JSON-lines streams in two appends and read back."""
    folder = scratch_path(spark, "log-files")
    rows = numbered_logs(spark, sf)
    half = F.col("current_steps") * 2 <= F.col("total_steps")
    for part in (half, ~half):
        logs.write_logs(rows.filter(part), folder)
    train, evaluation = logs.read_logs(spark, folder)
    cols = ["uid", "current_steps", "percentage", "elapsed_time"]
    return train.select(F.lit("train").alias("kind"), *cols, F.col("loss").alias("value")).unionByName(
        evaluation.select(F.lit("eval").alias("kind"), *cols, F.col("eval_loss").alias("value")))


# ---------------------------------------------------------------- time series

def flat_series(series: DataFrame) -> DataFrame:
    pairs = F.transform("labels", lambda x: F.concat(x["name"], F.lit("="), x["value"]))
    return series.select(F.array_join(pairs, ",").alias("labels"),
                         F.col("samples")[0]["timestamp"].alias("timestamp"), F.col("samples")[0]["value"].alias("value"))


def train_series_rows(spark, sf) -> DataFrame:
    return timeseries.train_series(numbered_logs(spark, sf).filter("loss IS NOT NULL"))


def train_series(spark, sf):
    """Train rows as series, written to the series table and read back."""
    path = scratch_path(spark, "series")
    logs.write_timeseries(train_series_rows(spark, sf), path)
    return flat_series(logs.read_timeseries(spark, path))


def eval_series(spark, sf):
    rows = numbered_logs(spark, sf).filter("eval_loss IS NOT NULL").withColumn("eval_loss", F.col("eval_loss") * 100)
    # A perplexity that both engines print alike: every other row has none.
    perplexity = F.when(F.col("event_id") % 2 == 0, F.col("event_id") / 100)
    return flat_series(timeseries.eval_series(rows.withColumn("eval_perplexity", perplexity)))


def match_series(spark, sf):
    m = timeseries.Matcher
    kept = timeseries.match_series(train_series_rows(spark, sf), [
        m("EQ", "__name__", "train_metrics"), m("RE", "uid", "1|[2-5][0-9]?"), m("NRE", "current_steps", ".*0"),
        m("NEQ", "total_steps", "60"), m("EQ", "absent", "")])
    return flat_series(kept)


def uid_series(spark, sf) -> DataFrame:
    """One series per run and kind of event, the value as the sample."""
    def label(name, value):
        return F.struct(F.lit(name).alias("name"), value.alias("value"))
    return t.table(spark, sf, "events").select(
        F.array(label("uid", F.col("user_id").cast("string")), label("kind", F.col("event_type"))).alias("labels"),
        F.array(F.struct(F.col("value").alias("value"), text.epoch_ms("ts").alias("timestamp"))).alias("samples"))


def select_range(spark, sf):
    return flat_series(timeseries.select_range(
        train_series_rows(spark, sf), FIRST_MS + 3 * DAY_MS, FIRST_MS + 9 * DAY_MS))


def group_series(spark, sf):
    rows = timeseries.group_series(uid_series(spark, sf), 5 * DAY_MS)
    names = F.transform("labels", lambda x: F.concat(x["name"], F.lit("="), x["value"]))
    points = F.transform("samples", lambda s: F.concat(s["timestamp"].cast("string"), F.lit("="), s["value"].cast("string")))
    return rows.select(F.array_join(names, ",").alias("labels"), "part_start", F.size("samples").cast("bigint").alias("n"),
                       F.array_join(points, ",").alias("samples"))


def sample_points(spark, sf) -> DataFrame:
    return t.logs(spark, sf).filter("loss IS NOT NULL").select(
        "uid", text.epoch_ms("ts").alias("timestamp"), F.col("loss").alias("value"))


def downsample(spark, sf):
    """Every aggregate of the same steps, side by side."""
    funcs = list(timeseries.STEP_FUNCTIONS)
    wide = timeseries.downsample_all(sample_points(spark, sf), ["uid"], DAY_MS // 2, funcs, FIRST_MS)
    return wide.select("uid", "bucket_ms", *(F.round(F.col(f).cast("double"), 6).alias(f) for f in funcs)) \
        .unpivot(["uid", "bucket_ms"], funcs, "func", "value")


def run_query(spark, sf):
    query = timeseries.Query(FIRST_MS + DAY_MS, FIRST_MS + 20 * DAY_MS,
                             (timeseries.Matcher("RE", "kind", "click|view"),), DAY_MS, "max")
    rows = timeseries.run_query(uid_series(spark, sf), query)
    names = F.transform("labels", lambda x: F.concat(x["name"], F.lit("="), x["value"]))
    return rows.select(F.array_join(names, ",").alias("labels"), "bucket_ms", "value")


def unpivot_metrics(spark, sf):
    return timeseries.unpivot_metrics(t.logs(spark, sf), ["loss", "eval_loss", "learning_rate"])


# ---------------------------------------------------------------- predictions and scores

def predictions_raw(spark, sf) -> DataFrame:
    """Generated ids: the encoded prompt of a turn, then the characters of its question."""
    rows = conversations.pair_turns(t.messages(spark, sf))
    tok = get_tokenizer("codepoint", "vanilla")
    encoded = encode.encode_turn_rows(rows, "vanilla", tok)
    masked = F.concat(F.array_repeat(F.lit(arrays.IGNORE_INDEX), F.size("encoded.src")), F.col("encoded.tgt"))
    return encoded.select(
        "conv_id", "t", F.size("encoded.src").alias("prompt_len"),
        F.concat("encoded.src", tok.encode(F.col("query")), F.lit([tok.eos_id])).alias("generated"),
        masked.alias("label_ids"))


def prediction_texts(spark, sf):
    tok = get_tokenizer("codepoint", "vanilla")
    return predictions.prediction_texts(predictions_raw(spark, sf), tok, ["conv_id", "t"])


def prediction_files(spark, sf):
    """The same pairs through the JSON-lines file."""
    folder = scratch_path(spark, "predictions")
    logs.write_predictions(prediction_texts(spark, sf), folder)
    return logs.read_predictions(spark, folder)


def fit_labels(spark, sf):
    tok = get_tokenizer("codepoint", "vanilla")
    rows = predictions_raw(spark, sf)
    fitted = predictions.fit_labels(rows, tok.pad_id)
    return fitted.select("conv_id", "t", joined("label_ids").alias("label_ids"))


def pad_generated(spark, sf):
    tok = get_tokenizer("codepoint", "vanilla")
    rows = predictions.pad_generated(predictions_raw(spark, sf), tok, 600, 1200)
    return rows.select("conv_id", "t", F.size("generated").alias("n_generated"), F.size("label_ids").alias("n_labels"),
                       joined("generated").alias("generated"))


def pairs_to_score(spark, sf) -> DataFrame:
    """Answers as predictions of their questions; conversations are spread over eight runs."""
    return conversations.pair_turns(t.messages(spark, sf)).select(
        F.concat(F.lit("run-"), F.pmod("conv_id", F.lit(8))).alias("run"), "conv_id", "t",
        F.col("response").alias("predict"), F.col("query").alias("label"))


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 9).alias(c) if kind == "double" else c for c, kind in df.dtypes))


def text_scores(spark, sf):
    return rounded(scoring.text_scores(pairs_to_score(spark, sf), ["run"]))


def document_pairs(spark, sf) -> DataFrame:
    """Each document against the next one by id, whole texts; the last one against nothing."""
    docs = t.table(spark, sf, "documents")
    labels = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("label"))
    return docs.select("doc_id", "lang", F.col("text").alias("predict")).join(labels, "doc_id", "left") \
        .withColumn("label", F.coalesce("label", F.lit("")))


def document_scores(spark, sf):
    return rounded(scoring.text_scores(document_pairs(spark, sf), ["lang"]))


def document_ngram_scores(spark, sf):
    return rounded(scoring.text_scores(document_pairs(spark, sf), ["lang"], subsequence=False))


def score_runs(spark, sf):
    return scoring.score_runs(pairs_to_score(spark, sf))


def plugin_scores(spark, sf):
    """A named scorer: the share of answers that are at least as long as the parameter says, in percent."""
    scoring.register_scorer("longer", lambda pairs, parameters: pairs.groupBy("run").agg(F.floor(
        100 * F.avg((F.length("predict") >= int(parameters)).cast("double"))).cast("string").alias("score")))
    return scoring.score_runs(pairs_to_score(spark, sf), "longer", "40")


def compare_runs(spark, sf):
    outputs = pair_turns(spark, sf).select(
        F.concat_ws("-", "conv_id", "t").alias("example_id"),
        F.explode(F.create_map(F.lit("echo"), F.col("query"), F.lit("answer"), F.col("response"),
                               F.lit("loud"), F.upper("query"))).alias("run", "predict"))
    return scoring.compare_runs(outputs, ["answer", "echo"])


# ---------------------------------------------------------------- streams over the events

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark, sf) -> DataFrame:
    """The events as six files, each with rows from the whole time span, read one file per micro-batch."""
    folder = scratch_path(spark, "event-files")
    events = t.table(spark, sf, "events")
    events.repartition(6, F.xxhash64("event_id")).write.parquet(folder)
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(folder)


def _drain(query) -> None:
    query.awaitTermination()


def _ingested(spark, sf) -> str:
    """Log lines written as JSON text and ingested as a stream; the folder of the result."""
    folder = scratch_path(spark, "stream-logs")
    lines = numbered_logs(spark, sf).select(F.to_json(F.struct(
        "uid", "current_steps", "total_steps", "started_at", "ts", "loss", "learning_rate", "epoch",
        *(F.when(F.col("eval_loss").isNotNull(), F.col(c)).alias(c) for c in ("eval_loss", "eval_perplexity"))),
        {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value"))
    lines.repartition(4).write.text(f"{folder}/in")
    _drain(streams.stream_logs(streams.read_lines(spark, f"{folder}/in", 1), f"{folder}/out", f"{folder}/checkpoint"))
    return f"{folder}/out"


def stream_logs(spark, sf):
    """The train table of ingested log lines."""
    rows = versions.read_appended(spark, f"{_ingested(spark, sf)}/train", schemas.TRAIN_LOG)
    return rows.select("uid", "current_steps", "total_steps", "loss", "learning_rate", "epoch", "percentage",
                       "elapsed_time", "remaining_time")


def stream_eval_logs(spark, sf):
    """The evaluation table of the same."""
    rows = versions.read_appended(spark, f"{_ingested(spark, sf)}/eval", schemas.EVAL_LOG)
    return rows.select("uid", "current_steps", "total_steps", "eval_loss", F.round("eval_perplexity", 9).alias("eval_perplexity"),
                       "epoch", "percentage", "elapsed_time", "remaining_time")


def arriving_events(spark, sf, hours: int = 12) -> DataFrame:
    """The events in six files by the time they arrive, which is up to ``hours`` behind their own time; one file per micro-batch."""
    folder = scratch_path(spark, "arriving-events")
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(hours * 3_600_000_000))
    events = t.table(spark, sf, "events").withColumn("_arrival", arrival)
    begin, end = events.agg(F.min("_arrival"), F.max("_arrival")).first()
    step = ((end or 0) - (begin or 0)) // 6 + 1
    for i in range(6):  # files are read in the order they were written
        part = events.filter(F.floor((F.col("_arrival") - F.lit(begin)) / step) == i).drop("_arrival")
        part.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(folder)


def stream_state_changes(spark, sf):
    folder = scratch_path(spark, "stream-changes")
    events = arriving_events(spark, sf)
    what = ("user_id", "ts", ["event_type"])
    _drain(streams.stream_state_changes(events, *what, f"{folder}/out", f"{folder}/checkpoint", "13 hours"))
    rows, _ = streams.read_changes(spark, f"{folder}/out", events.schema, *what)
    return rows.select("user_id", F.unix_micros("ts").alias("us"), "event_type", F.col("previous_event_type").alias("previous"))


def upsert_status(spark, sf):
    folder = scratch_path(spark, "stream-status")
    events = event_stream(spark, sf).select("user_id", "ts", "event_type", "value")
    _drain(streams.stream_status(events, f"{folder}/table", f"{folder}/checkpoint", ["user_id"], "ts"))
    return streams.read_status(spark, f"{folder}/table", events.schema, ["user_id"]).select("user_id", "event_type", "value")


def user_experiments(spark, sf) -> DataFrame:
    """Three users to an experiment as its jobs; every fifth lists one more that does not exist."""
    users = t.table(spark, sf, "events").select(F.floor(F.col("user_id") / 3).alias("e")).distinct()
    return users.select(
        F.lit("default").alias("namespace"), F.concat(F.lit("exp-"), "e").alias("name"), F.lit("").alias("state"), F.lit(False).alias("pending"),
        F.transform(F.sequence(F.lit(0), F.when(F.col("e") % 5 == 0, F.lit(3)).otherwise(F.lit(2))),
                    lambda i: F.when(i < 3, F.concat(F.lit("job-"), F.col("e") * 3 + i)).otherwise(F.lit("job-none"))).alias("jobs"))


def stream_rollup(spark, sf):
    """Users as jobs; the latest event of a user is the job's state."""
    folder = scratch_path(spark, "stream-rollup")
    events = event_stream(spark, sf).select(
        F.lit("default").alias("namespace"), F.concat(F.lit("job-"), "user_id").alias("name"),
        F.when(F.col("event_type").isin("error", "view"), "FAILED").otherwise("SUCCESSFUL").alias("state"), "ts")
    experiments = user_experiments(spark, sf)
    _drain(streams.stream_rollup(experiments, events, folder, f"{folder}/checkpoint"))
    return streams.read_rollup(spark, folder, experiments).select("name", "state")


def windowed_loss(spark, sf):
    rows = t.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("uid"), "ts", F.col("value").alias("loss"))
    return _flat_windows(streams.windowed_loss(rows, "2 days", "1 day"))


def _flat_windows(rows: DataFrame) -> DataFrame:
    return rows.select("uid", F.unix_seconds("window_start").alias("start_s"), F.unix_seconds("window_end").alias("end_s"),
                       "n", F.round("mean_loss", 9).alias("mean_loss"), "min_loss", "max_loss")


def stream_curve(spark, sf):
    """The same windows from the stream of events."""
    folder = scratch_path(spark, "stream-curve")
    events = event_stream(spark, sf).select(F.col("user_id").cast("string").alias("uid"), "ts", F.col("value").alias("loss"))
    schema = streams.windowed_loss(events, "2 days", "1 day").schema
    _drain(streams.stream_curve(events, f"{folder}/out", f"{folder}/checkpoint", "2 days", "1 day"))
    return _flat_windows(streams.read_curve(spark, f"{folder}/out", schema))


def in_utc(query: Query) -> Query:
    """Times in the given tables carry no zone; they are UTC."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {
    f"encode_{name}": in_utc(encode_with(name)) for name in TEMPLATES
} | {q.__name__: in_utc(q) for q in (
    pair_turns, assemble_conversations, encode_nested, nested_source, encode_long, encode_long_nested, preview, encode_words, token_quantiles,
    dataset_plugin, feed_source, encode_bytes, encode_oneturn, render_chat, decode_labels,
    word_ids, sft_examples, read_splits, sft_rejects, encode_documents, corpus_stats, merged_stats, shard_plan, assign_batches, collate,
    resolve_splits, features, resolve_runs, merge_overrides, run_configs, missing_deps, validate_runs, checkpoints,
    append_absent, create_if_absent, references, add_references, drop_reference, with_owner, first_by, text_functions,
    map_functions,
    rollup_runs, rollup_jobs, rollup_experiments, rank_jobs, top_runs, best_version, job_status_list, apply_pause,
    progress, train_logs, eval_logs, log_files, eval_metrics, eval_speed, run_summary, curve, state_changes,
    train_series, eval_series, match_series, select_range, group_series, downsample, run_query, unpivot_metrics,
    prediction_texts, prediction_files, fit_labels, pad_generated, text_scores, document_scores, document_ngram_scores, score_runs, plugin_scores,
    compare_runs, stream_logs, stream_eval_logs, stream_state_changes, upsert_status, stream_rollup, windowed_loss, stream_curve,
)}
