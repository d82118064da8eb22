import pytest
from pyspark.sql import functions as F

from loomwork.operators import registry, rollup, scoring
from loomwork.schemas import DATASETS, EXPERIMENTS, HYPERPARAMETERS, JOBS, MODELS, RUNS
from loomwork.sources import appends

BASE = dict(scheduler="cosine", optimizer="adamw", int4=True, int8=True, lora_r="8", lora_alpha="32", lora_dropout="0.1",
            learning_rate="1e-4", epochs=3, block_size=512, batch_size=4, warmup_ratio="0", weight_decay="0",
            grad_acc_steps=2, trainer_type="t", peft=True, fp16=True)


def run(name, **over):
    row = dict(namespace="ns", name=name, uid=f"u-{name}", owner_job=f"j-{name}", dataset="same", model="same",
               hyperparameter="same", overrides=None, image=dict(name="", path=None, pull_policy=None), node=0, state="",
               backing_status=None, checkpoint=None)
    return {**row, **over}


@pytest.fixture(scope="module")
def tables(spark):
    subsets = [dict(splits=dict(train=dict(file="b/t.csv"), validate=dict(file="")))]
    datasets = spark.createDataFrame([
        dict(namespace="ns", name="same", subsets=subsets, features=[dict(name="instruction", map_to="q")]),
        dict(namespace="ns", name="bare", subsets=[], features=None)], DATASETS)
    hypers = spark.createDataFrame([dict(namespace="ns", name="same", parameters=BASE)], HYPERPARAMETERS)
    models = spark.createDataFrame([dict(namespace="ns", name="same", spec="{}")], MODELS)
    return datasets, hypers, models


def test_overrides_use_three_unset_rules(spark, tables):
    nothing = {k: None for k in BASE}
    over = {**nothing, "scheduler": "", "optimizer": "sgd", "int4": False, "epochs": 0, "batch_size": 9, "lora_r": "",
            "learning_rate": "2"}
    rows = spark.createDataFrame([run("a", overrides=over), run("b")], RUNS)
    configs = {r.name: r.config for r in registry.run_configs(
        registry.fill_run_defaults(rows, "base:1"), *tables).collect()}
    p = configs["a"].parameters
    assert (p.scheduler, p.optimizer, p.int4, p.int8, p.epochs, p.batch_size, p.lora_r, p.learning_rate) == \
        ("cosine", "sgd", False, True, 3, 9, "", "2")
    assert configs["b"].parameters.asDict() == BASE
    assert configs["a"].quantization == "int8" and configs["a"].num_workers == 1
    assert configs["a"].train_path == "b/t.csv" and configs["a"].evaluation_path is None
    assert configs["a"].columns == {"instruction": "q"} and configs["a"].model_name_or_path == "/tmp/llama2-7b/"


def test_parameters_nobody_asks_for_cross_no_shuffle(spark, tables):
    rows = spark.createDataFrame([run("a"), run("b", dataset="x", hyperparameter="x")], RUNS)
    configs = registry.run_configs(rows, *tables).select("name", "config.quantization", "config.parameters.epochs")
    assert "lora_r" not in configs._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, configs.collect())) == [("a", "int8", 3), ("b", None, None)]


def test_missing_dependencies_and_same_names(spark, tables):
    rows = spark.createDataFrame([run("ok"), run("nods", dataset="x"), run("nomodel", model="x"), run("bare", dataset="bare")], RUNS)
    got = {r.name: (r.missing, r.state) for r in registry.missing_deps(rows, *tables).collect()}
    assert got == {"nods": (["dataset"], "PENDING"), "nomodel": (["model"], None)}
    config = registry.run_configs(rows.filter("name = 'bare'"), *tables).first().config
    assert config.train_path is None and config.columns is None and config.columns_text == ""


def test_checkpoints_are_created_once(spark, tables, tmp_path):
    rows = spark.createDataFrame([run("a", checkpoint=dict(ref=None, path="p")), run("b", checkpoint=dict(ref="k", path="p")),
                                  run("c", checkpoint=dict(ref=None, path="")), run("d")], RUNS)
    made = registry.checkpoints(rows, *tables)
    names = sorted(r.name for r in made.collect())
    assert len(names) == 2 and names[1] == "k" and names[0].startswith("a-")
    assert made.first().hyperparameter.spec.parameters.epochs == 3
    path = str(tmp_path / "checkpoints")
    for _ in range(2):
        appends.append_absent(spark, made, path)
        assert appends.read_table(spark, path, made.schema).count() == 2
    more = made.unionByName(made.withColumn("name", F.concat("name", F.lit("x"))))
    appends.append_absent(spark, more.unionByName(more), path)
    assert appends.read_table(spark, path, made.schema).count() == 4


def named(spark, names):
    return spark.createDataFrame([("ns", n, i) for i, n in enumerate(names)], "namespace string, name string, value int")


@pytest.mark.parametrize("others", [["b", "c"], ["x"], ["a", "b"]])
def test_interleaved_appends_add_each_key_once(spark, tmp_path, monkeypatch, others):
    """The second writer runs from start to end between the first one's rows and its claim, twice."""
    path, plain = str(tmp_path / "t"), appends.claim
    appends.append_absent(spark, named(spark, ["old"]), path)
    rounds = [others, ["late"]]

    def claim(session, *what):
        monkeypatch.setattr(appends, "claim", plain)
        if rounds:
            appends.append_absent(session, named(session, rounds.pop(0)), path)
            if rounds:
                monkeypatch.setattr(appends, "claim", claim)
        return plain(session, *what)
    monkeypatch.setattr(appends, "claim", claim)
    wanted = named(spark, ["a", "b", "old", "late"])
    assert appends.append_absent(spark, wanted, path) == 3
    rows = [r.name for r in appends.read_table(spark, path, wanted.schema).collect()]
    assert sorted(rows) == sorted({"old", "a", "b", "late", *others})


def test_a_number_is_claimed_once_and_lost_writers_leave_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    named(spark, ["lost"]).write.parquet(f"{path}/rows/lost")
    appends.claim(spark, path, 0, "x")
    with pytest.raises(appends.Taken):
        appends.claim(spark, path, 0, "y")
    assert [p.rsplit("/", 1)[1] for p in appends.committed(spark, path)] == ["x"]
    assert [p.name for p in (tmp_path / "t" / "_commits").iterdir()] == ["000000000000"]


def test_references(spark, tables):
    rows = spark.createDataFrame([run("a"), run("b"), run("b"), run("c", dataset="", model="m2")], RUNS)
    refs = registry.references(rows)
    counts = {(r.kind, r.name): r.n_runs for r in registry.reference_counts(refs).collect()}
    assert counts == {("dataset", "same"): 2, ("hyperparameter", "same"): 3, ("model", "same"): 2, ("model", "m2"): 1}
    left = registry.drop_reference(refs, rows.filter("name in ('a', 'nobody')"))
    assert {r.run for r in left.collect()} == {"b", "c"}
    assert registry.drop_reference(left, rows.filter("name = 'a'")).count() == left.count()
    assert registry.add_references(left, rows).count() == refs.count()


def test_added_references_are_those_of_the_plain_union(spark):
    rows = spark.createDataFrame(
        [run("a"), run("b"), run("b", dataset="other"), run("c", dataset="", model=None), run(None), run(None, dataset="other")], RUNS)
    given = spark.createDataFrame(
        [("r1", "other-kind", "ns", "x"), ("a", "dataset", "ns", "same"), ("a", "dataset", "ns", "same"), ("b", "model", None, ""),
         (None, "model", "ns", None)], "run string, kind string, namespace string, name string")
    added = registry.add_references(given, rows)
    # One shuffle by run, besides any that the given references need.
    assert added._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert added.columns == given.columns
    plain = given.unionByName(registry.references(rows)).distinct()
    assert sorted(map(str, added.collect())) == sorted(map(str, plain.collect()))


def test_validation(spark):
    df = spark.createDataFrame(
        [("int4", 4, "lora", "s", "t", False, True, "SUCCESSFUL", "p"), ("int2", 3, "x", "", None, True, True, "SUCCESSFUL", ""),
         (None, None, "none", "s", "t", True, False, "FAILED", "")],
        "quantization string, quantization_bit int, finetuning_type string, storage_path string, train_path string, "
        "split_special_tokens boolean, use_fast_tokenizer boolean, state string, checkpoint_path string")
    errors = [r.errors for r in registry.validate_runs(df).collect()]
    assert errors[0] == [] and errors[2] == [] and errors[1] == [
        "quantization", "quantization_bit", "finetuning_type", "storage_path required", "train_path required",
        "split_special_tokens needs a slow tokenizer", "checkpoint_path required"]


def test_run_states(spark):
    ck = dict(ref="k", path="p")
    cases = {"init": run("x"), "pending": run("x", create_failed=True), "sticky": run("x", state="FAILED", backing_status="RUNNING"),
             "running": run("x", backing_status=""), "active": run("x", backing_status="PENDING"),
             "failed": run("x", backing_status="STOPPED"), "done": run("x", backing_status="SUCCEEDED", checkpoint=ck),
             "waiting": run("x", backing_status="SUCCEEDED")}
    rows = spark.createDataFrame([{**{k: v for k, v in c.items() if k != "create_failed"}, "name": n} for n, c in cases.items()], RUNS) \
        .withColumn("create_failed", F.col("name") == "pending")
    got = {r.name: r.state for r in rollup.rollup_runs(rows).collect()}
    assert got == {"init": "INIT", "pending": "PENDING", "sticky": "FAILED", "running": "RUNNING", "active": "RUNNING",
                   "failed": "FAILED", "done": "SUCCESSFUL", "waiting": "RUNNING"}


def job(name, exp="e", state="SUCCESSFUL", score="1", **more):
    return {**dict(namespace="ns", name=name, owner_experiment=exp, run=f"r-{name}", state=state, score=score,
                   build_completed_at=None, service_status=None, deployment_status=None, image=f"img-{name}"), **more}


def test_job_stages_only_move_forward(spark):
    from datetime import datetime
    now = datetime(2024, 1, 1)
    rows = [job("a", state="", score=None), job("b", state="SERVE", score=None), job("c", state="INIT", score="5", build_completed_at=now),
            job("d", state="INIT", score=None), job("e", state="INIT", score=None, build_completed_at=now), job("f", state="INIT", score=None),
            job("g", state="FINETUNE", score=None), job("h", state="FINETUNE", score=None),
            job("i", state="SERVE", score=None, service_status="RUNNING", deployment_status="HEALTHY"),
            job("j", state="FINETUNE", score=None, service_status="RUNNING", deployment_status="HEALTHY")]
    ck = dict(ref="k", path="p")
    runs = spark.createDataFrame([run("r-a", state="RUNNING"), run("r-b", state="SUCCESSFUL"), run("r-c", state="SUCCESSFUL"),
                                  run("r-d", state="FAILED"), run("r-e", state="SUCCESSFUL"), run("r-g", state="SUCCESSFUL"),
                                  run("r-h", state="SUCCESSFUL", checkpoint=ck)], RUNS)
    rolled = rollup.rollup_jobs(spark.createDataFrame(rows, JOBS), runs).collect()
    # A run without a checkpoint object does not start the image build; only a job in SERVE serves.
    assert {r.name: (r.state, r.stalled) for r in rolled} == {
        "a": ("FINETUNE", False), "b": ("SERVE", False), "c": ("SUCCESSFUL", False), "d": ("FAILED", False), "e": ("SERVE", False),
        "f": ("INIT", False), "g": ("FINETUNE", False), "h": ("BUILDIMAGE", True), "i": ("SERVE", False), "j": ("FINETUNE", False)}
    assert [r.name for r in rolled if r.serving] == ["i"]


def experiments(spark):
    rows = [dict(namespace="ns", name=n, pending=p, jobs=j, state=s) for n, p, j, s in [
        ("good", False, ["a", "b"], ""), ("bad", False, ["c"], "PROCESSING"), ("mixed", False, ["d", "e"], ""),
        ("part", False, ["a", "b", "gone"], "PROCESSING"), ("lost", False, ["gone"], ""), ("empty", False, [], "PROCESSING"), ("paused", True, ["f"], "PROCESSING"), ("resumed", False, [], "PENDING")]]
    return spark.createDataFrame(rows, EXPERIMENTS)


def jobs(spark):
    return spark.createDataFrame([
        job("b", "good", score="7"), job("a", "good", score="7"), job("z", "good", score=" 9 "), job("c", "bad", "FAILED"),
        job("d", "mixed"), job("e", "mixed", "FAILED"), job("f", "paused")], JOBS)


def test_experiment_states_and_best_version(spark):
    got = {r.name: r.state for r in rollup.rollup_experiments(experiments(spark), jobs(spark)).collect()}
    # A listed job without a row decides nothing: the state stays.
    assert got == {"good": "SUCCESS", "bad": "FAILED", "mixed": "PROCESSING", "part": "PROCESSING", "lost": "PROCESSING", "empty": "PROCESSING",
                   "paused": "PENDING", "resumed": "PROCESSING"}
    runs = spark.createDataFrame([run("r-a", dataset="d1"), run("r-b")], RUNS)
    best = rollup.best_version(experiments(spark), jobs(spark), runs).collect()
    assert [(r.experiment, r.job, r.score, r.dataset) for r in best] == [("good", "a", "7", "d1")]


def test_best_version_shuffles_a_name_once(spark):
    runs = spark.createDataFrame([run("r-a"), run("r-b")], RUNS)
    best = rollup.best_version(experiments(spark), jobs(spark).withColumn("score", F.lit("n/a")), runs)
    assert "min_by" not in best._jdf.queryExecution().executedPlan().toString()
    assert [(r.experiment, r.job, r.score, r.image) for r in best.collect()] == [("good", "a", "n/a", jobs(spark).filter("name = 'a'").first().image)]


def test_kept_and_removed_jobs_share_a_shuffle(spark):
    nameless = [{**r.asDict(), "name": None} for r in experiments(spark).filter("name = 'paused'").collect()]
    orphan = [{**r.asDict(), "name": "orphan", "owner_experiment": None} for r in jobs(spark).filter("name = 'f'").collect()]
    listed = spark.createDataFrame(experiments(spark).collect() + nameless, EXPERIMENTS)
    owned = spark.createDataFrame(jobs(spark).collect() + orphan, JOBS)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        _, kept, removed = rollup.apply_pause(listed, owned)
        both = kept.withColumn("_kept", F.lit(True)).unionByName(removed.withColumn("_kept", F.lit(False)))
        plan = both._jdf.queryExecution().executedPlan().toString()
        rows = both.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("ReusedExchange") == 2 and kept.columns == removed.columns == owned.columns
    # Nobody is paused for being null: a job without an owner stays.
    assert sorted((r.name, r._kept) for r in rows) == sorted([(n, True) for n in "abcdez"] + [("f", False), ("orphan", True)])


def test_status_list_and_pause(spark):
    lists = {r.name: [tuple(x) for x in r.jobs_status] for r in rollup.job_status_list(experiments(spark), jobs(spark)).collect()}
    assert lists["good"] == [("a", "SUCCESSFUL"), ("b", "SUCCESSFUL")] and "empty" not in lists
    before = rollup.job_status_list(experiments(spark), jobs(spark))
    later = jobs(spark).withColumn("state", F.when(F.col("name") == "c", "SUCCESSFUL").otherwise(F.col("state")))
    changed = rollup.job_status_list(experiments(spark), later, before).filter("changed")
    assert [r.name for r in changed.collect()] == ["bad"]
    with_list = experiments(spark).join(before, ["namespace", "name"], "left")
    after, kept, removed = rollup.apply_pause(with_list, jobs(spark))
    states = {r.name: (r.state, r.jobs_status) for r in after.collect()}
    assert states["paused"] == ("PENDING", []) and states["resumed"][0] == "PROCESSING" and states["good"][1]
    assert [r.name for r in removed.collect()] == ["f"] and kept.count() == 6


def test_predicates(spark):
    row = spark.range(1).select(
        rollup.is_serving(F.lit("RUNNING"), F.lit("HEALTHY")).alias("a"), rollup.is_serving(F.lit("RUNNING"), F.lit(None)).alias("b"),
        rollup.is_built(F.lit(None)).alias("c"), rollup.is_scored(F.lit("")).alias("d"),
        rollup.status_class(F.lit("PENDING")).alias("e"), rollup.status_class(F.lit("STOPPED")).alias("f"),
        rollup.status_class(F.lit("SUCCEEDED")).alias("g")).first()
    assert tuple(row) == (True, False, False, True, "active", "failed", None)


def test_first_by_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("j", "b", 1), ("j", "a", 1), ("j", "c", 0), ("k", "z", 5)], "job string, name string, created int")
    assert {r.job: r.first_name for r in registry.first_by(df, ["job"], "created").collect()} == {"j": "c", "k": "z"}


# ---------------------------------------------------------------- scores

def slow_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_lcs_and_matches_against_brute_force():
    import random
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(90))] for _ in range(2))
        assert scoring.lcs_length(a, b) == slow_lcs(a, b)


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_lcs_does_not_depend_on_the_blocks(block):
    import random
    rng = random.Random(4)
    for _ in range(60):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(120))] for _ in range(2))
        assert scoring.lcs_length(a, b, block) == slow_lcs(a, b)


def test_lcs_of_two_long_texts_needs_one_block_at_a_time():
    import random
    import tracemalloc
    rng = random.Random(5)
    a, b = ([rng.randrange(40_000) for _ in range(40_000)] for _ in range(2))
    tracemalloc.start()
    length = scoring.lcs_length(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert length == scoring.lcs_length(a, b, 50_000) and peak < 16 << 20


def test_matches_against_brute_force(spark):
    import random
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(400)]
    pairs = list(zip([None, "", "a", *texts[:200]], ["a", "", "a", *texts[200:]]))
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(pairs)], "id int, predict string, label string")
    rows = scoring.with_overlap(df).orderBy("id").collect()
    for row, (p, r) in zip(rows, pairs):
        got = row.overlap
        a, b = (p or "").split(), (r or "").split()
        assert (got.n_predict, got.n_label) == (len(a), len(b))
        for n in range(1, 5):
            left = [tuple(b[j:j + n]) for j in range(len(b) - n + 1)]
            hits = 0
            for j in range(len(a) - n + 1):
                if tuple(a[j:j + n]) in left:
                    left.remove(tuple(a[j:j + n]))
                    hits += 1
            assert got[f"match_{n}"] == hits


def test_document_scores_against_brute_force(spark):
    import math

    from loomwork.plans.queries import document_scores
    rows = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    want = {}
    for i, r in rows.items():
        if i + 1 in rows:
            a, b = r.text.split(), rows[i + 1].text.split()
            # Short texts only for the quadratic reading; the Spark side always reads them whole.
            if len(a) * len(b) < 40_000:
                want.setdefault(i, 2 * slow_lcs(a, b) / (len(a) + len(b)) if a or b else 0.0)
    pairs = [(i, rows[i].text, rows[i + 1].text) for i in want]
    df = spark.createDataFrame(pairs, "id long, predict string, label string")
    got = {r.id: r.rouge_l for r in scoring.text_scores(df, ["id"]).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], abs_tol=1e-12) for i in want)
    assert document_scores(spark, "/root/testdata/sf0.001").count() == 4


def test_scores_and_plugins(spark):
    pairs = spark.createDataFrame([("r", "the cat sat on the mat", "the cat sat on the mat"), ("s", "a b", "c d"), ("s", "", ""),
                                   ("s", None, "x")], "run string, predict string, label string")
    got = {r.run: r for r in scoring.text_scores(pairs, ["run"]).collect()}
    assert (got["r"].rouge_1, got["r"].rouge_2, got["r"].rouge_l, got["r"].bleu_4, got["r"].exact_match) == (1, 1, 1, 1, 1)
    assert (got["s"].rouge_1, got["s"].rouge_l, got["s"].bleu_4, got["s"].n_pairs) == (0, 0, 0, 3)
    assert {r.run: r.score for r in scoring.score_runs(pairs).collect()} == {"r": "100", "s": "0"}
    scoring.register_scorer("fixed", lambda p, value: p.select("run").distinct().withColumn("score", F.lit(value)))
    assert {r.score for r in scoring.score_runs(pairs, "fixed", "42").collect()} == {"42"}
    with pytest.raises(ValueError):
        scoring.score_runs(pairs, "unknown")
    preds = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "z"), (2, "c", "w")], "example_id int, run string, predict string")
    assert {tuple(r) for r in scoring.compare_runs(preds, ["a", "b"]).collect()} == {(1, "x", "y"), (2, "z", None)}
