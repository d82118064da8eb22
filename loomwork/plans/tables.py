"""The given tables read as the records the operators work on.

Conversations are chats and documents are instruction rows as they stand. Events are training logs
(user = run), line items are runs and jobs, orders are experiments, parts are datasets, suppliers
are hyperparameter sets, nations are base models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line as the question, the rest as the answer, the source as extra text unless English."""
    return instructions(table(spark, sf_dir, "documents"))


def instructions(docs: DataFrame) -> DataFrame:
    return docs.selectExpr(
        "doc_id", "lang", "source",
        "substring_index(text, '\n', 1) AS question",
        "substr(text, length(substring_index(text, '\n', 1)) + 2) AS answer",
        "CASE WHEN lang = 'en' THEN '' ELSE source END AS query",
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log rows without step numbers; ``error`` events are evaluations."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id AS string) AS uid", "event_id", "ts", "event_type",
        "CASE WHEN event_type <> 'error' THEN value END AS loss",
        "CASE WHEN event_type = 'error' THEN value / 100 END AS eval_loss",
        "CASE WHEN event_type = 'error' THEN exp(value / 100) END AS eval_perplexity",
        "CASE WHEN event_type = 'error' THEN value / 2 END AS `eval_rouge-1`",
        "CASE WHEN event_type = 'error' THEN value / 4 END AS `eval_bleu-4`",
        "event_id / 100 AS learning_rate",
    )


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "'default' AS namespace", "concat('ds-', p_partkey) AS name",
        """array(named_struct('splits', named_struct(
             'train', named_struct('file', concat('bucket/', p_brand, '/', p_partkey, '.csv')),
             'validate', CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN named_struct('file', '')
                              ELSE named_struct('file', concat('bucket/eval/', p_partkey, '.csv')) END))) AS subsets""",
        """CASE WHEN p_size % 4 = 0 THEN NULL
                WHEN p_size % 4 = 1 THEN array(named_struct('name', 'extra', 'map_to', p_name))
                ELSE array(named_struct('name', 'response', 'map_to', p_name),
                           named_struct('name', 'extra', 'map_to', p_brand),
                           named_struct('name', 'instruction', 'map_to', p_type),
                           named_struct('name', 'response', 'map_to', p_brand)) END AS features""",
    )


def hyperparameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "'default' AS namespace", "concat('hp-', s_suppkey) AS name",
        """named_struct(
             'scheduler', CASE WHEN s_nationkey < 12 THEN 'cosine' ELSE 'linear' END, 'optimizer', 'adamw_torch',
             'int4', s_suppkey % 2 = 0, 'int8', s_suppkey % 5 = 0,
             'lora_r', cast(8 + s_nationkey AS string), 'lora_alpha', '32', 'lora_dropout', '0.1',
             'learning_rate', concat(s_nationkey, 'e-5'),
             'epochs', s_nationkey + 1, 'block_size', 1024, 'batch_size', 4,
             'warmup_ratio', '0.03', 'weight_decay', '0.01', 'grad_acc_steps', 1,
             'trainer_type', 'sft', 'peft', true, 'fp16', s_suppkey % 2 = 1) AS parameters""",
    )


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "'default' AS namespace", "concat('m-', n_nationkey) AS name", "n_name AS spec")


LINE_KEY = ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
            "cast(floor(l_extendedprice) AS bigint))")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as runs; some name objects that do not exist."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "'default' AS namespace", f"concat('run-', {LINE_KEY}) AS name", f"concat('uid-', {LINE_KEY}) AS uid",
        f"concat('job-', {LINE_KEY}) AS owner_job",
        "concat('ds-', CASE WHEN l_returnflag = 'R' THEN l_partkey + 100 ELSE l_partkey END) AS dataset",
        "concat('hp-', CASE WHEN l_linenumber = 7 THEN l_suppkey + 10 ELSE l_suppkey END) AS hyperparameter",
        "concat('m-', l_orderkey % 27) AS model",
        """named_struct(
             'scheduler', CASE WHEN l_returnflag = 'A' THEN '' WHEN l_returnflag = 'N' THEN NULL ELSE 'constant' END,
             'optimizer', '', 'int4', CASE WHEN l_returnflag = 'R' THEN false END,
             'int8', CASE WHEN l_linenumber = 1 THEN true END,
             'lora_r', CASE WHEN l_linenumber > 4 THEN cast(cast(l_quantity AS int) AS string) END,
             'lora_alpha', cast(NULL AS string), 'lora_dropout', cast(NULL AS string),
             'learning_rate', CASE WHEN l_returnflag = 'A' THEN '' END,
             'epochs', l_linenumber - 1, 'block_size', CASE WHEN l_linenumber < 3 THEN 0 ELSE 512 END,
             'batch_size', cast(NULL AS int), 'warmup_ratio', cast(NULL AS string), 'weight_decay', '0',
             'grad_acc_steps', 0, 'trainer_type', cast(NULL AS string), 'peft', CASE WHEN l_linenumber = 2 THEN false END,
             'fp16', cast(NULL AS boolean)) AS overrides""",
        """named_struct('name', CASE WHEN l_returnflag = 'N' THEN '' ELSE concat('img-', l_suppkey) END,
             'path', CASE WHEN l_linenumber = 3 THEN NULL ELSE concat('/models/', l_orderkey % 27) END,
             'pull_policy', 'Always') AS image""",
        "l_linenumber - 2 AS node",
        "CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN 'FAILED' ELSE 'RUNNING' END AS state",
        """CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL WHEN l_returnflag = 'A' THEN 'SUCCEEDED'
                WHEN l_returnflag = 'R' THEN 'STOPPED' ELSE 'RUNNING' END AS backing_status""",
        "l_linenumber = 4 AS create_failed",
        """named_struct('ref', cast(NULL AS string),
             'path', CASE WHEN l_linestatus = 'F' THEN concat('bucket/ckpt/', l_orderkey, '/', l_linenumber) ELSE '' END
           ) AS checkpoint""",
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as jobs of their order, scored by price; some scores are no numbers."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "'default' AS namespace", f"concat('job-', {LINE_KEY}) AS name",
        "concat('exp-', l_orderkey) AS owner_experiment", f"concat('run-', {LINE_KEY}) AS run",
        "CASE WHEN l_linestatus = 'F' THEN 'SUCCESSFUL' ELSE 'FAILED' END AS state",
        """CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_linenumber = 6 THEN concat(' ', cast(floor(l_tax) AS bigint))
                ELSE cast(cast(floor(l_extendedprice / 1000) AS bigint) AS string) END AS score""",
        "concat('img-', l_partkey) AS image",
    )


def jobs_in_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same jobs with the facts of their later stages."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "'default' AS namespace", f"concat('job-', {LINE_KEY}) AS name", f"concat('run-', {LINE_KEY}) AS run",
        "CASE WHEN l_linenumber = 1 THEN 'INIT' WHEN l_linenumber = 2 THEN 'SERVE' ELSE 'FINETUNE' END AS state",
        "CASE WHEN l_quantity > 25 THEN cast(l_shipdate AS timestamp) END AS build_completed_at",
        "CASE WHEN l_quantity > 30 THEN 'RUNNING' END AS service_status",
        "CASE WHEN l_tax > 0.03 THEN 'HEALTHY' ELSE 'UPDATING' END AS deployment_status",
        "CASE WHEN l_quantity > 45 THEN cast(cast(floor(l_extendedprice) AS bigint) AS string) END AS score",
    )


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "'default' AS namespace", f"concat('run-', {LINE_KEY}) AS name",
        "CASE WHEN l_returnflag = 'R' THEN 'FAILED' WHEN l_returnflag = 'A' THEN 'SUCCESSFUL' ELSE 'RUNNING' END AS state",
        f"""named_struct('ref', CASE WHEN l_linenumber = 5 THEN '' WHEN l_linenumber <> 6 THEN concat('ckpt-', {LINE_KEY}) END,
                         'path', 'bucket/ckpt') AS checkpoint""")


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "'default' AS namespace", "concat('exp-', o_orderkey) AS name", "o_orderpriority = '5-LOW' AS pending",
        "CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'PROCESSING' END AS state")


def listed_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as experiments that list ten orders each as their jobs."""
    return table(spark, sf_dir, "customer").selectExpr(
        "'default' AS namespace", "concat('exp-', c_custkey) AS name",
        "transform(sequence(0, 9), i -> concat('job-', c_custkey * 10 + 9 - i)) AS jobs")


def experiments_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as experiments that list all their line items as jobs; every eleventh lists one more that does not exist."""
    # Numbers cross the shuffle, names are made of them behind it.
    parts = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    name = LINE_KEY
    for part in parts:
        name = name.replace(part, f"x.{part}")
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(*parts)).alias("_lines")).select(
        "l_orderkey", F.expr(f"sort_array(transform(_lines, x -> concat('job-', {name})))").alias("jobs"))
    return table(spark, sf_dir, "orders").join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").selectExpr(
        "'default' AS namespace", "concat('exp-', o_orderkey) AS name", "o_orderpriority = '5-LOW' AS pending",
        "CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'PROCESSING' END AS state",
        "concat(coalesce(jobs, array()), CASE WHEN o_orderkey % 11 = 0 THEN array('job-none') ELSE array() END) AS jobs")


def order_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "'default' AS namespace", "concat('job-', o_orderkey) AS name", "o_orderstatus AS state",
        "concat('exp-', o_custkey) AS owner_experiment", "cast(o_orderdate AS timestamp) AS created")
