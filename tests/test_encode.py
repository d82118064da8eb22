import pytest
from pyspark.sql import functions as F

import plain
from loomwork.functions.templates import TEMPLATES, get_template
from loomwork.functions.tokenizers import CodepointTokenizer, get_tokenizer
from loomwork.operators import conversations, encode
from loomwork.schemas import MESSAGES, SFT

ROWS = [
    ("hi", None, "hello there", None, None),
    ("what {{query}} {{idx}} {{system}}", "more", "é😀 answer", None, ""),
    ("third", None, "ok", [("q0", "r0"), ("q1 {{idx}}", "r1 long enough to be cut")], "be kind"),
    ("", None, "dropped", None, None),
    ("dropped", None, "", None, None),
    ("blank kept", None, "  ", [], "  "),
    ("x" * 90, None, "y" * 70, [("a" * 40, "b" * 40)], None),
    ("last", None, "one", [("", "")], None),
]


def sft(spark):
    return spark.createDataFrame([(q, x, r, h, s) for q, x, r, h, s in ROWS], SFT) \
        .withColumn("row", F.monotonically_increasing_id()).withColumn("query", F.col("instruction"))


def messages(spark):
    rows = []
    for c, (q, _, r, h, s) in enumerate(ROWS):
        talk = ([("system", s)] if s is not None else []) + [("assistant", "greeting")]
        for a, b in (h or []) + [(q, r)]:
            talk += [("user", "unanswered"), ("user", a), ("assistant", b), ("assistant", "again")]
        rows += [(c, i, role, text) for i, (role, text) in enumerate(talk + [("user", "end")])]
    return rows, spark.createDataFrame(rows, MESSAGES)


@pytest.mark.parametrize("name, cutoff", [(n, 37) for n in TEMPLATES] + [("llama2", 4096), ("chatml", 4096)])
def test_nested_and_message_rows_match_the_plain_rules(spark, name, cutoff):
    template, tok = get_template(name), get_tokenizer("codepoint", name)
    got = {tuple(r.query for _ in [0]) + (r.system,): (r.input_ids, r.labels, r.attention_mask)
           for r in encode.encode_sft(sft(spark), name, cutoff, keep=["query", "system"]).collect()}
    want = {}
    for q, _, r, h, s in ROWS:
        example = plain.encode_example(template, tok, (h or []) + [(q, r)], s, cutoff)
        if example:
            want[(q, s or template.system)] = example
    assert {k: v[:2] for k, v in got.items()} == want
    for ids, labels, mask in got.values():
        assert len(ids) == len(labels) == len(mask) <= cutoff and set(mask) <= {1}
        for i, x in zip(ids, labels):
            assert x in (-100, i) or (template.efficient_eos and x == tok.eos_id)

    rows, df = messages(spark)
    # Two messages per block and no more than two rows for an ordinary key: every seam is crossed.
    seams = encode.encode_conversations(df, name, cutoff, width=2, hot_rows=2)
    whole = [encode.encode_conversations(df, name, cutoff)] if cutoff > 37 else []
    by_conv = {}
    for c, turn, role, text in rows:
        by_conv.setdefault(c, []).append((turn, role, text))
    want = {}
    for c, talk in by_conv.items():
        system, pairs = plain.pair_up(talk)
        example = plain.encode_example(template, tok, pairs, system, cutoff)
        if example:
            want[c] = example
    for result in [seams, *whole]:
        assert {r.conv_id: (r.input_ids, r.labels) for r in result.collect()} == want


def test_empty_turns_fall_back_to_the_running_length(spark):
    from loomwork.functions.templates import ChatTemplate
    bare = ChatTemplate("bare", (), ("{{query}}",), (), "", efficient_eos=True)
    tok = get_tokenizer(CodepointTokenizer(bos=None), bare)
    talk = []
    for i in range(40):
        talk += [("user", "" if i % 3 else "ab"), ("assistant", "" if i % 2 else "c")]
    talk += [("user", "z"), ("assistant", "z")]
    rows = [(1, i, role, text) for i, (role, text) in enumerate(talk)]
    for cutoff in (5, 20, 500):
        got = encode.encode_conversations(spark.createDataFrame(rows, MESSAGES), bare, cutoff, tok,
                                          width=4, hot_rows=3).first()
        pairs = plain.pair_up([(t, r, x) for _, t, r, x in rows])[1]
        assert (got.input_ids, got.labels) == plain.encode_example(bare, tok, pairs, None, cutoff)


def test_byte_tokenizer_agrees_on_ascii_and_counts_bytes(spark):
    df = spark.createDataFrame([("hi", "there", None), ("é", "😀" * 30, "s")], "query string, response string, system string")
    rows = encode.encode_sft(df, "chatml", 50, "utf8_bytes", keep=["query"]).collect()
    tok = get_tokenizer("utf8_bytes", "chatml")
    for r in rows:
        assert max(r.input_ids) <= max(tok.specials.values()) and len(r.input_ids) <= 50
    text = encode.decode(encode.encode_sft(df.limit(1), "chatml", 500, "utf8_bytes"), "input_ids", "chatml",
                         "utf8_bytes").first().text
    assert text.startswith("<s><|im_start|>system\nYou are a helpful assistant.<|im_end|>\n<s><|im_start|>user\nhi") or \
        text.startswith("<s><|im_start|>system\nYou are a helpful assistant.<|im_end|>\n<|im_start|>user\nhi")


def test_pandas_tokenizer_runs_in_batches(spark):
    from loomwork.functions.tokenizers import PandasTokenizer

    def load():
        return (lambda texts: [[len(w) for w in t.split()] for t in texts],
                lambda rows: [" ".join(map(str, r)) for r in rows])

    tok = PandasTokenizer(base=1000, load=load)
    df = spark.createDataFrame([("aa bbb", "c", None)], "query string, response string, system string")
    row = encode.encode_sft(df, "vanilla", 100, tok).first()
    assert row.input_ids == [1000, 2, 3, 1, 1001] and row.labels == [-100, -100, -100, 1, 1001]
    assert encode.decode(encode.encode_sft(df, "vanilla", 100, tok), "input_ids", "vanilla", tok,
                         skip_special=True).first().text == "2 3 1"


def test_oneturn_puts_all_but_the_last_answer_into_the_prompt(spark):
    for name in ("llama2", "chatml", "default"):
        tok = get_tokenizer("codepoint", name)
        for r, row in zip(ROWS, encode.encode_oneturn(sft(spark), name, keep=["row"]).orderBy("row").collect()):
            pairs = plain.encode_pairs(get_template(name), tok, (r[3] or []) + [(r[0], r[2])], r[4])
            flat = [x for a, b in pairs[:-1] for x in a + b]
            assert row.prompt_ids == flat + pairs[-1][0] and row.answer_ids == pairs[-1][1]


@pytest.mark.parametrize("name", ["vanilla", "llama2", "starchat", "chatglm2", "openchat"])
def test_rendered_text_is_the_decoded_ids(spark, name):
    df = sft(spark).filter("query != '' and response != ''")
    tok = get_tokenizer(CodepointTokenizer(bos=None), name)
    eos = "" if get_template(name).efficient_eos else "</s>"
    encoded = encode.encode_turns(encode.with_turns(df, name), name, tok)
    flat = F.flatten(F.transform("encoded", lambda x: F.concat(x["src"], x["tgt"])))
    ids = encode.decode(encoded.withColumn("all", flat), "all", name, tok).orderBy("row").collect()
    texts = encode.render_chat(df, name, eos or "</s>").orderBy("row").collect()
    assert [r.text for r in ids] == [r.text for r in texts]


def test_preview_and_string_history(spark):
    encoded = encode.encode_sft(sft(spark), "vanilla", 64)
    row = encode.preview(encoded, "vanilla").first()
    assert row.inputs.startswith("<s>") and "</s>" in row.label_text
    with pytest.raises(ValueError, match="empty"):
        encode.preview(encoded.filter("false"), "vanilla")
    with pytest.raises(ValueError, match="history"):
        encode.encode_sft(sft(spark).withColumn("history", F.lit("[]")), "llama2")


def test_assembled_conversations_hold_all_pairs_in_order(spark):
    rows, df = messages(spark)
    by_conv = {}
    for c, turn, role, text in rows:
        by_conv.setdefault(c, []).append((turn, role, text))
    want = {c: plain.pair_up(t)[1] for c, t in by_conv.items()}
    for nested in (conversations.assemble_conversations(df), conversations.assemble_conversations(df, width=2, hot_rows=2)):
        assert {r.conv_id: [tuple(h) for h in r.history] + [(r.query, r.response)] for r in nested.collect()} == want


def test_a_long_conversation_is_one_example_on_every_path(spark):
    n = 1100
    rows = [(7, 0, "system", "sys")] + [(7, i + 1, "assistant" if i % 2 else "user", chr(97 + i % 20)) for i in range(2 * n)]
    df = spark.createDataFrame(rows, MESSAGES)
    nested = conversations.assemble_conversations(df)
    row = nested.first()
    assert nested.count() == 1 and len(row.history) == n - 1
    # Turns of four ids: the cutoff lies behind turn 1024.
    by_rows = encode.encode_conversations(df, "vanilla", 5000).collect()
    by_nest = encode.encode_sft(nested, "vanilla", 5000, keep=["conv_id"]).collect()
    assert len(by_rows) == len(by_nest) == 1 and by_rows[0].input_ids == by_nest[0].input_ids and by_rows[0].labels == by_nest[0].labels
    assert encode.encode_oneturn(nested, "default", keep=["conv_id"]).count() == 1


@pytest.mark.parametrize("cutoff", [1, 2])
@pytest.mark.parametrize("name", ["chatglm3", "llama2", "intern", "vanilla"])
def test_tiny_cutoffs_give_the_same_on_every_path(spark, name, cutoff):
    _, df = messages(spark)
    by_rows = encode.encode_conversations(df, name, cutoff).collect()
    by_nest = encode.encode_sft(conversations.assemble_conversations(df), name, cutoff, keep=["conv_id"]).collect()
    assert {r.conv_id: (r.input_ids, r.labels) for r in by_rows} == {r.conv_id: (r.input_ids, r.labels) for r in by_nest}


def test_core_plan_has_no_python_and_no_unpartitioned_window(spark):
    _, df = messages(spark)
    plan = encode.encode_conversations(df, "chatml")._jdf.queryExecution().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "SinglePartition" not in plan
    plan = encode.encode_sft(sft(spark), "chatml")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_token_counts_need_no_encoding(spark):
    rows = sft(spark).drop("history")
    for name in ("llama2", "chatml", "vanilla", "aquila"):
        for cutoff in (20, 150, 4096):
            counts = {r.row: (r.n_tokens, r.n_targets) for r in encode.count_tokens(rows, name, cutoff, keep=["row"]).collect()}
            encoded = encode.encode_sft(rows, name, cutoff, keep=["row"]).collect()
            assert counts == {r.row: (len(r.input_ids), sum(x != -100 for x in r.labels)) for r in encoded}
    encoded = encode.encode_sft(rows, "llama2", 150, keep=["row"]).withColumn("g", F.lit(1))
    counts = encode.count_tokens(rows, "llama2", 150, keep=["row"]).withColumn("g", F.lit(1))
    assert encode.corpus_stats(encoded, ["g"], 150, [0.5]).collect() == encode.corpus_stats(counts, ["g"], 150, [0.5]).collect()
    whole = {r.row: len(r.input_ids) for r in encode.encode_sft(rows, "llama2", 10**6, keep=["row"]).collect()}
    assert {r.row: r.truncated for r in counts.collect()} == {k: n > 150 for k, n in whole.items()}
    assert "transform" not in counts._jdf.queryExecution().toString()


def test_merged_statistics_are_those_of_one_pass(spark):
    counts = spark.range(30_000).select(
        (F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("shard"), F.pmod(F.xxhash64("id"), F.lit(5000)).alias("n_tokens"), (F.col("id") % 11).alias("n_targets"))
    once = {r.g: r for r in encode.corpus_stats(counts, ["g"], 4000).collect()}
    stored = encode.shard_stats(counts, ["shard", "g"], 4000)
    few = encode.merge_stats(stored.filter("shard < 3"), ["g"])
    merged = encode.merge_stats(few.unionByName(encode.merge_stats(stored.filter("shard >= 3"), ["g"])), ["g"])
    quantiles = [0.01, 0.5, 0.9, 1.0]
    lengths = {g: sorted(r.n_tokens for r in rows) for g, rows in ((g, counts.filter(f"g = {g}").collect()) for g in range(3))}
    for row in encode.length_quantiles(merged, quantiles).collect():
        exact = once[row.g]
        assert all(row[c] == exact[c] for c in ("n_examples", "n_tokens", "max_tokens", "n_targets", "max_targets", "n_at_cutoff"))
        for q, found in zip(quantiles, row.token_quantiles):
            ranks = [sum(x < found for x in lengths[row.g]), sum(x <= found for x in lengths[row.g])]
            assert ranks[0] / exact.n_examples - 2 * encode.RANK_ERROR <= q <= ranks[1] / exact.n_examples + 2 * encode.RANK_ERROR
    assert encode.merge_stats(encode.shard_stats(counts.limit(0), ["shard", "g"]), ["g"]).count() == 0


def test_python_tokenizer_on_message_rows(spark):
    from loomwork.operators import vocabulary
    rows = [(1, 0, "user", "a b"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "a a")]
    df = spark.createDataFrame(rows, MESSAGES)
    vocab = vocabulary.build_vocabulary(df, ["text"])
    tok = vocabulary.words_tokenizer(spark, vocab)
    ids = {r.piece: r.id for r in vocab.collect()}
    row = encode.encode_conversations(df, "xverse", 64, tok).first()
    bos, eos = 4, 5
    # No template word is in the vocabulary: 0 each.
    assert ids == {"a": 1, "b": 2, "c": 3}
    assert row.input_ids == [bos, 0, 1, 2, 0, 2, eos, bos, 0, 3, 0, 1, 1, eos]
    assert row.labels == [-100] * 5 + [2, eos] + [-100] * 4 + [1, 1, eos]


def test_ordinary_conversations_are_shuffled_once(spark):
    _, df = messages(spark)
    plan = encode.encode_conversations(df, "llama2")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(conv_id") == 1 and plan.count("Exchange") == 1


def test_frequent_words_of_a_text_stay_together(spark):
    from loomwork.operators import vocabulary

    df = spark.createDataFrame([(k, " ".join(f"w{i % 50}" for i in range(400))) for k in range(8)] + [(8, ""), (9, None)], "k int, text string")
    vocab = vocabulary.build_vocabulary(df, ["text"])
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = df.select("k", F.posexplode_outer(vocabulary.pieces("text")).alias("_pos", "_piece"))
        found = vocabulary._with_ids(rows, ["k"], vocab)
        tasks = found.withColumn("_task", F.spark_partition_id()).select("k", "_task").distinct().collect()
        ids = {r.k: r.ids for r in vocabulary.encode_words(df, "k", "text", vocab).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # Ids are known before the shuffle by piece; there neither the words nor more than one task a text are needed.
    assert "_piece" not in found.columns and sorted(r.k for r in tasks) == list(range(10))
    known = {r.piece: r.id for r in vocab.collect()}
    assert ids == {**{k: [known[f"w{i % 50}"] for i in range(400)] for k in range(8)}, 8: [], 9: []}
