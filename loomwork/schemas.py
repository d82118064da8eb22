"""Explicit schemas of every record the library reads or writes. Nothing is inferred."""

from pyspark.sql import types as T

TURN = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("response", T.StringType()),
])

SFT = T.StructType([
    T.StructField("instruction", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("history", T.ArrayType(TURN)),
    T.StructField("system", T.StringType()),
])

MESSAGES = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
])


def _fields(kind: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names.split()]


# Column names and order of the two log streams.
TRAIN_LOG = T.StructType(
    _fields(T.StringType(), "uid")
    + _fields(T.IntegerType(), "current_steps total_steps")
    + _fields(T.DoubleType(), "loss eval_loss val_perplexity eval_rouge_1 eval_rouge_2 eval_rouge_l eval_bleu_4 "
                              "predict_loss reward learning_rate epoch percentage")
    + _fields(T.StringType(), "elapsed_time remaining_time")
)

EVAL_LOG = T.StructType(
    _fields(T.StringType(), "uid")
    + _fields(T.IntegerType(), "current_steps total_steps")
    + _fields(T.DoubleType(), "eval_loss eval_perplexity eval_rouge_1 eval_rouge_2 eval_rouge_l eval_bleu_4 "
                              "epoch percentage")
    + _fields(T.StringType(), "elapsed_time remaining_time")
)

# A raw log line as the training loop emits it, with the run context beside the metrics.
RAW_LOG = T.StructType(
    _fields(T.StringType(), "uid")
    + _fields(T.IntegerType(), "current_steps total_steps")
    + _fields(T.TimestampType(), "started_at ts")
    + _fields(T.DoubleType(), "loss eval_loss eval_perplexity eval_rouge-1 eval_rouge-2 eval_rouge-l eval_bleu-4 "
                              "predict_loss reward learning_rate epoch")
)

LABEL = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()),
])

SAMPLE = T.StructType([
    T.StructField("value", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

TIME_SERIES = T.StructType([
    T.StructField("labels", T.ArrayType(LABEL)),
    T.StructField("samples", T.ArrayType(SAMPLE)),
])

PREDICTION = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("predict", T.StringType()),
])

# The 17 hyperparameters of a run. Numbers that travel as text stay text.
PARAMETERS = T.StructType([
    T.StructField("scheduler", T.StringType()),
    T.StructField("optimizer", T.StringType()),
    T.StructField("int4", T.BooleanType()),
    T.StructField("int8", T.BooleanType()),
    T.StructField("lora_r", T.StringType()),
    T.StructField("lora_alpha", T.StringType()),
    T.StructField("lora_dropout", T.StringType()),
    T.StructField("learning_rate", T.StringType()),
    T.StructField("epochs", T.IntegerType()),
    T.StructField("block_size", T.IntegerType()),
    T.StructField("batch_size", T.IntegerType()),
    T.StructField("warmup_ratio", T.StringType()),
    T.StructField("weight_decay", T.StringType()),
    T.StructField("grad_acc_steps", T.IntegerType()),
    T.StructField("trainer_type", T.StringType()),
    T.StructField("peft", T.BooleanType()),
    T.StructField("fp16", T.BooleanType()),
])

FEATURE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("map_to", T.StringType()),
])

SUBSET = T.StructType([
    T.StructField("splits", T.StructType([
        T.StructField("train", T.StructType([T.StructField("file", T.StringType())])),
        T.StructField("validate", T.StructType([T.StructField("file", T.StringType())])),
    ])),
])

KEY = [T.StructField("namespace", T.StringType()), T.StructField("name", T.StringType())]

DATASETS = T.StructType(KEY + [
    T.StructField("subsets", T.ArrayType(SUBSET)),
    T.StructField("features", T.ArrayType(FEATURE)),
])

HYPERPARAMETERS = T.StructType(KEY + [T.StructField("parameters", PARAMETERS)])

MODELS = T.StructType(KEY + [T.StructField("spec", T.StringType())])

IMAGE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("pull_policy", T.StringType()),
])

RUNS = T.StructType(KEY + [
    T.StructField("uid", T.StringType()),
    T.StructField("owner_job", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("hyperparameter", T.StringType()),
    T.StructField("overrides", PARAMETERS),
    T.StructField("image", IMAGE),
    T.StructField("node", T.IntegerType()),
    T.StructField("state", T.StringType()),
    T.StructField("backing_status", T.StringType()),
    T.StructField("checkpoint", T.StructType([
        T.StructField("ref", T.StringType()),
        T.StructField("path", T.StringType()),
    ])),
])

JOBS = T.StructType(KEY + [
    T.StructField("owner_experiment", T.StringType()),
    T.StructField("run", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("build_completed_at", T.TimestampType()),
    T.StructField("service_status", T.StringType()),
    T.StructField("deployment_status", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("image", T.StringType()),
])

EXPERIMENTS = T.StructType(KEY + [
    T.StructField("pending", T.BooleanType()),
    T.StructField("jobs", T.ArrayType(T.StringType())),
    T.StructField("state", T.StringType()),
])
