"""Joins over the registry: runs with their datasets, hyperparameters and models.

Keys are ``(namespace, name)``. No join is forced to broadcast: Spark broadcasts a side it has
measured below its threshold, and otherwise a sort-merge join with AQE splits the hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.maps import features_json, features_map
from loomwork.functions.text import blank_to_null, checkpoint_key, is_blank
from loomwork.schemas import PARAMETERS

KEY = ["namespace", "name"]
# The kinds of objects a run names.
KINDS = ("dataset", "hyperparameter", "model")

# What counts as "not overridden" per parameter; the others use null.
EMPTY_TEXT_IS_UNSET = ["scheduler", "optimizer"]
ZERO_IS_UNSET = ["epochs", "block_size", "batch_size", "grad_acc_steps"]

# Accepted settings of a run.
ACCEPTED = {
    "quantization": ["int4", "int8"],
    "quantization_bit": [4, 8],
    "quantization_type": ["fp4", "nf4"],
    "finetuning_type": ["lora", "freeze", "full", "none"],
    "stage": ["pt", "sft", "rm", "ppo", "dpo"],
    "rope_scaling": ["linear", "dynamic"],
}
REQUIRED = ["storage_path", "train_path", "model_name_or_path"]
# Fixed value: where a run finds its model if it names none.
DEFAULT_MODEL_PATH = "/tmp/llama2-7b/"


def quantization(int8: Column, int4: Column) -> Column:
    return F.when(int8, F.lit("int8")).when(int4, F.lit("int4"))


def merged_parameter(base: Column, overrides: Column, name: str) -> Column:
    o = overrides[name]
    if name in EMPTY_TEXT_IS_UNSET:
        o = F.nullif(o, F.lit(""))
    elif name in ZERO_IS_UNSET:
        o = F.nullif(o, F.lit(0))
    return F.coalesce(o, base[name])


def merged_parameters(base: Column, overrides: Column) -> Column:
    """Base parameters with the overrides laid on top, each field by its own unset rule."""
    return F.struct(*(merged_parameter(base, overrides, f.name).alias(f.name) for f in PARAMETERS))


def merge_overrides(df: DataFrame, base: str = "parameters", overrides: str = "overrides",
                    out: str = "merged") -> DataFrame:
    return df.withColumn(out, merged_parameters(F.col(base), F.col(overrides)))


def fill_run_defaults(runs: DataFrame, base_image: str, model_path: str = DEFAULT_MODEL_PATH) -> DataFrame:
    """Base image and model path for runs that name none."""
    return runs.withColumn("image", F.struct(
        F.coalesce(blank_to_null("image.name"), F.lit(base_image)).alias("name"),
        F.coalesce(blank_to_null("image.path"), F.lit(model_path)).alias("path"),
        F.col("image.pull_policy").alias("pull_policy"),
    ))


def resolve_splits(datasets: DataFrame) -> DataFrame:
    """``train_path`` and ``evaluation_path`` (null when there is none) of the first subset."""
    first = F.try_element_at("subsets", F.lit(1))
    return datasets.withColumn("train_path", first["splits"]["train"]["file"]).withColumn(
        "evaluation_path", blank_to_null(first["splits"]["validate"]["file"]))


def _side(table: DataFrame, ref: str, out: str) -> DataFrame:
    """A registry table as key columns plus one struct of everything else."""
    rest = [c for c in table.columns if c not in KEY]
    return table.select(F.col("namespace"), F.col("name").alias(ref), F.struct(*rest).alias(out))


def _attach(runs: DataFrame, table: DataFrame, kind: str, how: str = "left") -> DataFrame:
    """Runs with ``<kind>_row``, the object they name in ``kind``."""
    return runs.join(_side(table, kind, f"{kind}_row"), ["namespace", kind], how)


def resolve_runs(runs: DataFrame, datasets: DataFrame, hyperparameters: DataFrame, models: DataFrame,
                 how: str = "left") -> DataFrame:
    """Runs with ``dataset_row``, ``hyperparameter_row`` and ``model_row``, null where missing.

    Three separate joins: objects of different kinds may share one name. The widest rows come last, so that no further join
    shuffles them.
    """
    found = runs
    for kind, table in (("model", models), ("hyperparameter", hyperparameters), ("dataset", datasets)):
        found = _attach(found, table, kind, how)
    # Nested joins put their keys first.
    refs = ["namespace", "model", "hyperparameter", "dataset"]
    return found.select(*refs, *(c for c in runs.columns if c not in refs), "dataset_row", "hyperparameter_row", "model_row")


def run_configs(runs: DataFrame, datasets: DataFrame, hyperparameters: DataFrame, models: DataFrame) -> DataFrame:
    """``config`` struct per run: merged parameters, split files, columns map, quantization, workers."""
    # Columns maps are built once per dataset, not once per run.
    described = (
        resolve_splits(datasets).withColumn("columns", features_map("features"))
        .withColumn("columns_text", features_json("features"))
        .select(*KEY, "train_path", "evaluation_path", "columns", "columns_text")
    )
    # Everything but the datasets' part is settled field by field before they are joined. The struct below then only names columns, so
    # fields nobody asks for are pruned and cross no shuffle.
    known = runs.select(*KEY, "uid", "dataset", "hyperparameter", "model", "overrides", F.col("image.path").alias("_path"), "node")
    known = _attach(_attach(known, models, "model"), hyperparameters, "hyperparameter")
    base, overrides = F.col("hyperparameter_row.parameters"), F.col("overrides")
    merged = {f.name: merged_parameter(base, overrides, f.name) for f in PARAMETERS}
    known = known.select(
        *KEY, "uid", "dataset", "_path", quantization(merged["int8"], merged["int4"]).alias("_quantization"),
        F.when(F.col("node") > 0, F.col("node")).otherwise(F.lit(1)).alias("_workers"), *(c.alias(f"_{name}") for name, c in merged.items()))
    return _attach(known, described, "dataset").select(
        *KEY, "uid",
        F.struct(
            F.col("_path").alias("model_name_or_path"),
            F.col("dataset_row.train_path").alias("train_path"),
            F.col("dataset_row.evaluation_path").alias("evaluation_path"),
            F.col("dataset_row.columns").alias("columns"),
            F.coalesce(F.col("dataset_row.columns_text"), F.lit("")).alias("columns_text"),
            F.col("_quantization").alias("quantization"),
            F.col("_workers").alias("num_workers"),
            F.struct(*(F.col(f"_{name}").alias(name) for name in merged)).alias("parameters"),
        ).alias("config"),
    )


def missing_deps(runs: DataFrame, datasets: DataFrame, hyperparameters: DataFrame, models: DataFrame) -> DataFrame:
    """Runs lacking a dependency: which ones, and whether that makes the run PENDING."""
    def mark(table: DataFrame, ref: str) -> DataFrame:
        return table.select("namespace", F.col("name").alias(ref), F.lit(True).alias(f"_has_{ref}"))

    kinds = {"dataset": datasets, "hyperparameter": hyperparameters, "model": models}
    found = runs.select(*KEY, *kinds)
    for ref, table in kinds.items():
        found = found.join(mark(table, ref), ["namespace", ref], "left")
    absent = F.filter(F.array(*(F.when(F.col(f"_has_{ref}").isNull(), F.lit(ref)) for ref in kinds)),
                      lambda x: x.isNotNull())
    return (
        found.select(*KEY, absent.alias("missing"))
        .filter(F.size("missing") > 0)
        .withColumn("state", F.when(F.arrays_overlap(
            "missing", F.array(F.lit("dataset"), F.lit("hyperparameter"))), F.lit("PENDING")))
    )


def validate_runs(df: DataFrame) -> DataFrame:
    """Add ``errors``: the name of every rule a run configuration breaks. Absent columns are not checked."""
    def has(*names: str) -> bool:
        return all(n in df.columns for n in names)

    rules = [F.when(F.col(name).isNotNull() & ~F.col(name).isin(values), F.lit(name))
             for name, values in ACCEPTED.items() if has(name)]
    rules += [F.when(is_blank(name), F.lit(f"{name} required")) for name in REQUIRED if has(name)]
    rules += [F.when(is_blank(F.col(f"image.{part}")), F.lit(f"image {part} required"))
              for part in ("name", "path") if has("image")]
    if has("split_special_tokens", "use_fast_tokenizer"):
        rules.append(F.when(F.col("split_special_tokens") & F.col("use_fast_tokenizer"),
                            F.lit("split_special_tokens needs a slow tokenizer")))
    if has("state", "checkpoint_path"):
        rules.append(F.when((F.col("state") == "SUCCESSFUL") & is_blank("checkpoint_path"),
                            F.lit("checkpoint_path required")))
    return df.withColumn("errors", F.filter(F.array(*rules), lambda e: e.isNotNull()) if rules
                         else F.array().cast("array<string>"))


def checkpoints(runs: DataFrame, datasets: DataFrame, hyperparameters: DataFrame, models: DataFrame) -> DataFrame:
    """Provenance of finished runs: copies of everything that went in, under a key of its own.

    Holds the base hyperparameters and the merged ones.
    """
    done = runs.filter(~is_blank("checkpoint.path"))
    rows = resolve_runs(done, datasets, hyperparameters, models, "inner")
    key = F.concat_ws("/", "namespace", "name")
    return rows.select(
        "namespace",
        F.coalesce(blank_to_null("checkpoint.ref"), checkpoint_key("name", key)).alias("name"),
        F.struct(F.col("model").alias("ref"), F.col("model_row").alias("spec")).alias("model"),
        F.struct(F.col("dataset").alias("ref"), F.col("dataset_row").alias("spec")).alias("dataset"),
        F.struct(F.col("hyperparameter").alias("ref"), F.col("hyperparameter_row").alias("spec"),
                 merged_parameters(F.col("hyperparameter_row.parameters"), F.col("overrides")).alias("merged"))
        .alias("hyperparameter"),
        "image",
        F.col("checkpoint.path").alias("checkpoint_path"),
    )


def create_if_absent(existing: DataFrame, desired: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Desired rows whose key is not there yet; of several with one key, one is kept."""
    return desired.join(existing.select(*keys), keys, "left_anti").dropDuplicates(keys)


def with_owner(children: DataFrame, parents: DataFrame, owner: str, keep: list[str]) -> DataFrame:
    """Child rows with columns of the parent named in ``owner``, prefixed ``owner_``."""
    side = parents.select("namespace", F.col("name").alias(owner), *(F.col(c).alias(f"owner_{c}") for c in keep))
    return children.join(side, ["namespace", owner], "inner")


def _exploded(sets: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """``kind, namespace, name, run`` rows of one array column per kind."""
    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("name")))

    uses = F.explode(F.concat(*map(tagged, kinds))).alias("_use")
    return sets.select("namespace", "run", uses).filter(~is_blank("_use.name")).select(
        F.col("_use.kind").alias("kind"), "namespace", F.col("_use.name").alias("name"), "run")


def references(runs: DataFrame) -> DataFrame:
    """Which runs use which object: distinct ``(kind, namespace, name, run)`` rows.

    Kept as rows, not as a list per object: a popular base model is used by any number of runs.
    """
    # One row per run crosses the shuffle; what is distinct within a run is distinct altogether.
    sets = runs.groupBy("namespace", F.col("name").alias("run")).agg(*(F.collect_set(kind).alias(kind) for kind in KINDS))
    return _exploded(sets, KINDS)


def add_references(refs: DataFrame, runs: DataFrame) -> DataFrame:
    """The references there are and those of the runs, each once.

    Both meet as rows of a run, combined on the map side, so its name crosses the shuffle once and not with every object.
    """
    use = F.struct("kind", "name")
    one = refs.select("namespace", "run", F.array(use).alias("_uses"))
    uses = F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("name")) for kind in KINDS))
    # Objects without a name are no references, but a stored one stays as it is.
    named = runs.select("namespace", F.col("name").alias("run"), F.filter(uses, lambda x: ~is_blank(x["name"])).alias("_uses"))
    sets = one.unionByName(named).groupBy("namespace", "run").agg(F.collect_set("_uses").alias("_sets"))
    # All rows of a run are in one task now, so telling them apart needs no further shuffle.
    rows = sets.select("namespace", "run", F.explode("_sets").alias("_uses")).select("namespace", "run", F.explode("_uses").alias("_use"))
    return rows.select("_use.kind", "namespace", "_use.name", "run").distinct().select(*refs.columns)


def drop_reference(refs: DataFrame, removed: DataFrame) -> DataFrame:
    """References without those of the removed runs; an untracked run changes nothing."""
    gone = removed.select("namespace", F.col("name").alias("run"))
    return refs.join(gone, ["namespace", "run"], "left_anti").select(*refs.columns)


def reference_counts(refs: DataFrame) -> DataFrame:
    return refs.groupBy("kind", "namespace", "name").agg(F.count(F.lit(1)).alias("n_runs"))


def first_by(df: DataFrame, keys: list[str], ts: str, name: str = "name") -> DataFrame:
    """Earliest row's name per key; equal times go to the smaller name."""
    return df.groupBy(*keys).agg(F.min_by(name, F.struct(ts, name)).alias(f"first_{name}"))
