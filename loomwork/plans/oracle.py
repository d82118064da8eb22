"""DuckDB SQL with the results the named queries must have, written from the rules and not from the Spark code."""

from __future__ import annotations

from loomwork.functions.templates import TEMPLATES, ChatTemplate, Special, get_template
from loomwork.functions.tokenizers import get_tokenizer


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PAIRS = """
ordered AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (
  SELECT conv_id, text AS query, next_text AS response,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS t
  FROM ordered WHERE role = 'user' AND next_role = 'assistant'),
systems AS (
  SELECT conv_id, arg_min(text, turn) AS system FROM conversations WHERE role = 'system' GROUP BY conv_id),
last_pair AS (SELECT conv_id, max(t) AS last_t FROM pairs GROUP BY conv_id)
"""


WORDS = "list_filter(string_split_regex({}, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')"


# ---------------------------------------------------------------- encoding

def chars(text: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '(?s).'), lambda ch: unicode(ch))"


def utf8(text: str) -> str:
    """Byte values of a text."""
    h = f"hex(encode({text}))"
    return (f"list_transform(range(0, CAST(octet_length(encode({text})) AS BIGINT)), lambda i: "
            f"CAST(('0x' || substr({h}, CAST(2 * i + 1 AS BIGINT), 2)) AS INTEGER))")


def piece_sql(piece: str, slots: dict[str, str]) -> str:
    """A text piece as a SQL string: the first of each slot is filled, the rest stays."""
    parts, left, rest = [], dict(slots), piece
    while True:
        hits = sorted((rest.index("{{%s}}" % s), s) for s in left if "{{%s}}" % s in rest)
        if not hits:
            break
        at, slot = hits[0]
        parts += [lit(rest[:at]), left.pop(slot)]
        rest = rest[at + len(slot) + 4:]
    return "concat(" + ", ".join([*parts, lit(rest), "''"]) + ")"


def part_sql(part, slots: dict[str, str], specials: dict[str, int], encode=chars) -> list[str]:
    return [f"[{specials[p.token]}]" if isinstance(p, Special) else encode(piece_sql(p, slots)) for p in part]


def cat(parts: list[str]) -> str:
    out = "CAST([] AS INTEGER[])"
    for p in parts:
        out = f"list_concat({out}, CAST({p} AS INTEGER[]))"
    return out


def turn_sql(template: ChatTemplate, tokenizer: str) -> tuple[str, str]:
    """Source and target ids of a turn over ``t, query, response, system``."""
    tok = get_tokenizer(tokenizer, template)
    encode = chars if tokenizer == "codepoint" else utf8
    specials, bos = tok.specials, [f"[{i}]" for i in tok.bos_ids]
    if template.system_in_query:
        opening = piece_sql(template.prefix[0], {"system": "system"})
        query = f"CASE WHEN t = 0 THEN concat({opening}, query) ELSE query END"
        src = cat(bos + part_sql(template.prompt, {"query": query}, specials, encode))
    else:
        prompt = part_sql(template.prompt, {"query": "query", "idx": "CAST(t AS VARCHAR)"}, specials, encode)
        prefix = cat(part_sql(template.prefix, {"system": "system"}, specials, encode))
        sep = part_sql(template.sep, {}, specials, encode)
        first = cat(bos + [f"CASE WHEN len({prefix}) > 0 THEN {cat([prefix] + sep)} ELSE CAST([] AS INTEGER[]) END"])
        later = cat(sep + bos)
        src = cat([f"CASE WHEN t = 0 THEN {first} ELSE {later} END"] + prompt)
    tgt = cat([encode("response")] + ([] if template.efficient_eos else [f"[{tok.eos_id}]"]))
    return src, tgt


def encode_sql(ctes: str, key: str, template: str, cutoff: int = 1024, tokenizer: str = "codepoint") -> str:
    """``ctes`` must end in ``turns(key, t, query, response, system)`` with valid examples only."""
    tpl = get_template(template)
    eos = get_tokenizer(tokenizer, tpl).eos_id
    src, tgt = turn_sql(tpl, tokenizer)
    mask = "list_transform(src, lambda x: -100)"
    if tpl.efficient_eos:
        mask = f"CASE WHEN t > 0 THEN list_transform(src, lambda x, i: CASE WHEN i = 1 THEN {eos} ELSE -100 END) ELSE {mask} END"
    tail = f"[{eos}]" if tpl.efficient_eos else "CAST([] AS INTEGER[])"
    return f"""WITH {ctes},
coded AS (SELECT {key}, t, {src} AS src, {tgt} AS tgt FROM turns),
shares AS (SELECT {key}, t,
  src[1:CAST(trunc({cutoff} * (len(src) / (len(src) + len(tgt)))) AS BIGINT)] AS src,
  tgt[1:CAST(trunc({cutoff} * (len(tgt) / (len(src) + len(tgt)))) AS BIGINT)] AS tgt FROM coded),
labelled AS (SELECT {key}, t, list_concat(src, tgt) AS ids, list_concat({mask}, tgt) AS labels FROM shares),
examples AS (SELECT {key},
  list_concat(flatten(list(ids ORDER BY t)), {tail})[1:{cutoff}] AS ids,
  list_concat(flatten(list(labels ORDER BY t)), {tail})[1:{cutoff}] AS labels
  FROM labelled GROUP BY {key})"""


FLAT = """
SELECT {key}, len(ids) AS n, len(list_filter(labels, lambda x: x <> -100)) AS n_target,
       array_to_string(ids, ' ') AS ids, array_to_string(labels, ' ') AS labels FROM examples"""


def conversation_turns(template: str) -> str:
    tpl = get_template(template)
    number, keep = ("p.t", "") if tpl.use_history else ("0 AS t", "AND p.t = last_t")
    return PAIRS + f""", turns AS (
  SELECT p.conv_id, {number}, query, response, coalesce(nullif(system, ''), {lit(tpl.system)}) AS system
  FROM pairs p JOIN last_pair USING (conv_id) LEFT JOIN systems USING (conv_id) WHERE true {keep})"""


def conversation_sql(template: str, cutoff: int = 1024, tokenizer: str = "codepoint") -> str:
    return encode_sql(conversation_turns(template), "conv_id", template, cutoff, tokenizer)


SFT = """
split_docs AS (
  SELECT doc_id, lang, source,
         CASE WHEN strpos(text, chr(10)) = 0 THEN text ELSE substr(text, 1, strpos(text, chr(10)) - 1) END AS instruction,
         CASE WHEN strpos(text, chr(10)) = 0 THEN '' ELSE substr(text, strpos(text, chr(10)) + 1) END AS response,
         CASE WHEN lang = 'en' THEN '' ELSE source END AS extra FROM documents),
built AS (
  SELECT doc_id, lang, source, response,
         CASE WHEN extra = '' THEN instruction ELSE instruction || chr(10) || extra END AS query FROM split_docs)
"""

DOC_TURNS = SFT + f""", turns AS (
  SELECT doc_id, 0 AS t, query, response, {lit(TEMPLATES['alpaca'].system)} AS system
  FROM built WHERE query <> '' AND response <> '')"""


def render_sql() -> str:
    parts = []
    for tpl in TEMPLATES.values():
        def text(part, slots):
            return "concat(" + ", ".join(
                [lit(p.token) if isinstance(p, Special) else piece_sql(p, slots) for p in part] + ["''"]) + ")"
        system = f"coalesce(nullif(system, ''), {lit(tpl.system)})"
        if tpl.system_in_query:
            query = f"CASE WHEN t = 0 THEN concat({piece_sql(tpl.prefix[0], {'system': system})}, query) ELSE query END"
            before, prompt = "''", text(tpl.prompt, {"query": query})
        else:
            prefix, sep = text(tpl.prefix, {"system": system}), text(tpl.sep, {})
            before = (f"CASE WHEN t > 0 THEN {sep} WHEN {prefix} = '' THEN '' ELSE concat({prefix}, {sep}) END")
            prompt = text(tpl.prompt, {"query": "query", "idx": "CAST(t AS VARCHAR)"})
        eos = "''" if tpl.efficient_eos else "'</s>'"
        parts.append(f"SELECT conv_id, t, {lit(tpl.name)} AS template, concat({before}, {prompt}, response, {eos}) AS text "
                     "FROM pairs LEFT JOIN systems USING (conv_id)")
    return f"WITH {PAIRS} " + " UNION ALL ".join(parts)


def oneturn_sql() -> str:
    src, tgt = turn_sql(get_template("default"), "codepoint")
    return f"""WITH {conversation_turns('default')},
coded AS (SELECT conv_id, t, {src} AS src, {tgt} AS tgt FROM turns),
flat AS (SELECT conv_id, max(t) AS last_t,
  flatten(list(list_concat(src, tgt) ORDER BY t)) AS everything, arg_max(tgt, t) AS answer FROM coded GROUP BY conv_id)
SELECT conv_id, array_to_string(everything[1:len(everything) - len(answer)], ' ') AS prompt_ids,
       array_to_string(answer, ' ') AS answer_ids FROM flat"""


PAD = get_tokenizer("codepoint", "chatml").pad_id

def long_sql(sql: str) -> str:
    """The same over all messages chained to three conversations."""
    return sql.replace("FROM conversations", "FROM (SELECT conv_id % 3 AS conv_id, conv_id * 1000 + turn AS turn, role, text FROM conversations)")


# Words in ids by frequency, then the start and the end token; the last pair, cut at 64.
WORD_EXAMPLES = f"""WITH {PAIRS}, vocab AS (
  SELECT piece, row_number() OVER (ORDER BY count(*) DESC, encode(piece)) AS id
  FROM (SELECT unnest({WORDS.format('text')}) AS piece FROM conversations) GROUP BY piece),
size AS (SELECT count(*) AS v FROM vocab),
last AS (SELECT conv_id, query, response FROM pairs JOIN last_pair USING (conv_id) WHERE t = last_t AND query <> '' AND response <> ''),
words AS (SELECT conv_id, 'q' AS side, unnest({WORDS.format('query')}) AS piece, generate_subscripts({WORDS.format('query')}, 1) AS pos FROM last
  UNION ALL SELECT conv_id, 'r', unnest({WORDS.format('response')}), generate_subscripts({WORDS.format('response')}, 1) FROM last),
lists AS (SELECT conv_id, list(id ORDER BY pos) FILTER (side = 'q') AS q, list(id ORDER BY pos) FILTER (side = 'r') AS r
  FROM words JOIN vocab USING (piece) GROUP BY conv_id),
whole AS (SELECT conv_id, list_concat([v + 1], coalesce(q, [])) AS src, list_concat(coalesce(r, []), [v + 2]) AS tgt
  FROM last LEFT JOIN lists USING (conv_id), size),
cut AS (SELECT conv_id, src[1:CAST(trunc(64 * (len(src) / (len(src) + len(tgt)))) AS BIGINT)] AS src,
  tgt[1:CAST(trunc(64 * (len(tgt) / (len(src) + len(tgt)))) AS BIGINT)] AS tgt FROM whole),
examples AS (SELECT conv_id, list_concat(src, tgt) AS ids, list_concat(list_transform(src, lambda x: -100), tgt) AS labels FROM cut)"""

ENCODING = {f"encode_{name}": conversation_sql(name) + FLAT.format(key="conv_id") for name in TEMPLATES} | {
    "pair_turns": f"WITH {PAIRS} SELECT conv_id, t, query, response FROM pairs",
    "assemble_conversations": f"""WITH {PAIRS}
SELECT p.conv_id, any_value(system) AS system, count(*) - 1 AS n_history,
       coalesce(string_agg(query || chr(31) || response, chr(30) ORDER BY t) FILTER (t < last_t), '') AS history,
       arg_max(query, t) AS query, arg_max(response, t) AS response
FROM pairs p JOIN last_pair USING (conv_id) LEFT JOIN systems USING (conv_id) GROUP BY p.conv_id""",
    "encode_nested": conversation_sql("chatml") + FLAT.format(key="conv_id"),
    "nested_source": "SELECT n, n_target, ids, labels, count(*) AS n_rows FROM (" + conversation_sql("chatml") + FLAT.format(key="conv_id") + ") GROUP BY ALL",
    "encode_long": long_sql(conversation_sql("chatml")) + FLAT.format(key="conv_id"),
    "encode_long_nested": long_sql(conversation_sql("chatml")) + FLAT.format(key="conv_id"),
    "preview": conversation_sql("vanilla") + """, shown AS (
  SELECT conv_id, list_transform(ids, lambda x: CASE WHEN x < 1114112 THEN chr(x) WHEN x = 1114112 THEN '<s>' ELSE '</s>' END) AS texts, labels
  FROM examples ORDER BY conv_id LIMIT 1)
SELECT conv_id, array_to_string(texts, '') AS inputs,
  array_to_string(list_transform(list_filter(range(1, len(texts) + 1), lambda i: labels[i] <> -100), lambda i: texts[i]), '') AS label_text FROM shown""",
    "encode_words": WORD_EXAMPLES + FLAT.format(key="conv_id"),
    "token_quantiles": conversation_sql("llama2") + """
SELECT conv_id % 4 AS part, count(*) AS n_examples, CAST(sum(len(ids)) AS BIGINT) AS n_tokens,
  CAST(sum(len(list_filter(labels, lambda x: x <> -100))) AS BIGINT) AS n_targets, count(*) FILTER (len(ids) >= 1024) AS n_at_cutoff,
  concat(list_sort(list(len(ids)))[CAST(ceil(count(*) * 0.5) AS BIGINT)], ' ', list_sort(list(len(ids)))[CAST(ceil(count(*) * 0.9) AS BIGINT)]) AS quantiles
FROM examples GROUP BY part""",
    "dataset_plugin": f"WITH {SFT} SELECT doc_id, query, response FROM built WHERE query <> '' AND response <> ''",
    "feed_source": f"WITH {SFT} SELECT doc_id, query, response FROM built WHERE query <> '' AND response <> ''",
    "encode_bytes": conversation_sql("llama2", 256, "utf8_bytes") + FLAT.format(key="conv_id"),
    "encode_oneturn": oneturn_sql(),
    "render_chat": render_sql(),
    # The last answer is what the labels keep; one character per id, the end token at its end.
    "decode_labels": conversation_sql("vanilla") + """
SELECT conv_id, array_to_string(list_transform(list_filter(labels, lambda x: x <> -100),
       lambda x: CASE WHEN x < 1114112 THEN chr(x) ELSE '</s>' END), '') AS text FROM examples""",
    "word_ids": f"""WITH words AS (
  SELECT doc_id, unnest({WORDS.format('text')}) AS piece, generate_subscripts({WORDS.format('text')}, 1) AS pos FROM documents),
vocab AS (SELECT piece, row_number() OVER (ORDER BY count(*) DESC, encode(piece)) AS id FROM words GROUP BY piece),
coded AS (SELECT doc_id, count(*) AS n, string_agg(CAST(coalesce(id, 0) AS VARCHAR), ' ' ORDER BY pos) AS ids
  FROM words LEFT JOIN vocab USING (piece) GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n, coalesce(ids, '') AS ids FROM documents LEFT JOIN coded USING (doc_id)""",
    "sft_examples": f"WITH {SFT} SELECT doc_id, query, response FROM built WHERE query <> '' AND response <> ''",
    "read_splits": f"""WITH {SFT} SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'train' ELSE 'evaluation' END AS split,
  query, response FROM built WHERE query <> '' AND response <> ''""",
    "sft_rejects": f"""WITH {SFT} SELECT doc_id, CASE WHEN query = '' AND response = '' THEN 'empty query and response'
  WHEN query = '' THEN 'empty query' ELSE 'empty response' END AS reason FROM built WHERE query = '' OR response = ''""",
    "encode_documents": encode_sql(DOC_TURNS, "doc_id", "alpaca") + FLAT.format(key="doc_id"),
    "corpus_stats": encode_sql(DOC_TURNS, "doc_id", "alpaca") + """
SELECT lang, source, count(*) AS n_examples, CAST(sum(len(ids)) AS BIGINT) AS n_tokens, max(len(ids)) AS max_tokens,
       CAST(sum(len(list_filter(labels, lambda x: x <> -100))) AS BIGINT) AS n_targets,
       max(len(list_filter(labels, lambda x: x <> -100))) AS max_targets,
       count(*) FILTER (len(ids) >= 1024) AS n_at_cutoff
FROM examples JOIN documents USING (doc_id) GROUP BY lang, source""",
    "merged_stats": encode_sql(DOC_TURNS, "doc_id", "alpaca") + """
SELECT lang, count(*) AS n_examples, CAST(sum(len(ids)) AS BIGINT) AS n_tokens, max(len(ids)) AS max_tokens,
       CAST(sum(len(list_filter(labels, lambda x: x <> -100))) AS BIGINT) AS n_targets,
       count(*) FILTER (len(ids) >= 1024) AS n_at_cutoff, true AS near
FROM examples JOIN documents USING (doc_id) GROUP BY lang""",
    "shard_plan": f"""WITH {PAIRS}
SELECT CAST(conv_id % 4 AS INTEGER) AS shard, count(*) AS n_rows, CAST(ceil(count(*) / 8) AS BIGINT) AS steps_per_epoch
FROM last_pair GROUP BY conv_id % 4""",
    "assign_batches": """SELECT doc_id, CAST(doc_id % 4 AS INTEGER) AS shard,
  (row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) - 1) // 8 AS batch_id FROM documents""",
    "collate": conversation_sql("chatml", 512) + f""",
placed AS (SELECT *, conv_id % 4 AS shard,
  (row_number() OVER (PARTITION BY conv_id % 4 ORDER BY conv_id) - 1) // 8 AS batch_id FROM examples),
sized AS (SELECT *, CAST(ceil(max(len(ids)) OVER (PARTITION BY shard, batch_id) / 4) * 4 AS INTEGER) AS padded_length FROM placed)
SELECT conv_id, CAST(shard AS INTEGER) AS shard, batch_id, padded_length,
  array_to_string(list_concat(ids, list_transform(range(len(ids), padded_length), lambda i: {PAD})), ' ') AS ids,
  array_to_string(list_concat(labels, list_transform(range(len(ids), padded_length), lambda i: -100)), ' ') AS labels,
  array_to_string(list_transform(range(0, padded_length), lambda i: CASE WHEN i < len(ids) THEN 1 ELSE 0 END), ' ') AS mask
FROM sized""",
}


# ---------------------------------------------------------------- registry

LINE_KEY = ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
            "CAST(floor(l_extendedprice) AS BIGINT))")

RUNS = f"""
runs AS (
  SELECT concat('run-', {LINE_KEY}) AS name, concat('uid-', {LINE_KEY}) AS uid,
         CASE WHEN l_returnflag = 'R' THEN l_partkey + 100 ELSE l_partkey END AS ds,
         CASE WHEN l_linenumber = 7 THEN l_suppkey + 10 ELSE l_suppkey END AS hp,
         l_orderkey % 27 AS mo, *
  FROM lineitem)
"""

# Parameters of a run after merging: a field keeps its base value where the line sets nothing.
MERGED = """
       CASE WHEN l_returnflag = 'R' THEN 'constant' WHEN s_nationkey < 12 THEN 'cosine' ELSE 'linear' END AS scheduler,
       'adamw_torch' AS optimizer,
       CASE WHEN l_returnflag = 'R' THEN false ELSE s_suppkey % 2 = 0 END AS int4,
       CASE WHEN l_linenumber = 1 THEN true ELSE s_suppkey % 5 = 0 END AS int8,
       CASE WHEN l_linenumber > 4 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
            ELSE CAST(8 + s_nationkey AS VARCHAR) END AS lora_r,
       '32' AS lora_alpha, '0.1' AS lora_dropout,
       CASE WHEN l_returnflag = 'A' THEN '' ELSE concat(s_nationkey, 'e-5') END AS learning_rate,
       CAST(CASE WHEN l_linenumber > 1 THEN l_linenumber - 1 ELSE s_nationkey + 1 END AS INTEGER) AS epochs,
       CAST(CASE WHEN l_linenumber >= 3 THEN 512 ELSE 1024 END AS INTEGER) AS block_size,
       CAST(4 AS INTEGER) AS batch_size, '0.03' AS warmup_ratio, '0' AS weight_decay, CAST(1 AS INTEGER) AS grad_acc_steps,
       'sft' AS trainer_type, l_linenumber <> 2 AS peft, s_suppkey % 2 = 1 AS fp16
"""
# The same where there may be no base: only what the line sets is left then.
MERGED_ALONE = """
       CASE WHEN l_returnflag = 'R' THEN 'constant' WHEN s_nationkey < 12 THEN 'cosine' WHEN s_nationkey >= 12 THEN 'linear' END AS scheduler,
       CASE WHEN s_suppkey IS NOT NULL THEN 'adamw_torch' END AS optimizer,
       CASE WHEN l_returnflag = 'R' THEN false ELSE s_suppkey % 2 = 0 END AS int4,
       CASE WHEN l_linenumber = 1 THEN true ELSE s_suppkey % 5 = 0 END AS int8,
       CASE WHEN l_linenumber > 4 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
            ELSE CAST(8 + s_nationkey AS VARCHAR) END AS lora_r,
       CASE WHEN s_suppkey IS NOT NULL THEN '32' END AS lora_alpha, CASE WHEN s_suppkey IS NOT NULL THEN '0.1' END AS lora_dropout,
       CASE WHEN l_returnflag = 'A' THEN '' WHEN s_suppkey IS NOT NULL THEN concat(s_nationkey, 'e-5') END AS learning_rate,
       CAST(CASE WHEN l_linenumber > 1 THEN l_linenumber - 1 ELSE s_nationkey + 1 END AS INTEGER) AS epochs,
       CAST(CASE WHEN l_linenumber >= 3 THEN 512 WHEN s_suppkey IS NOT NULL THEN 1024 END AS INTEGER) AS block_size,
       CAST(CASE WHEN s_suppkey IS NOT NULL THEN 4 END AS INTEGER) AS batch_size, CASE WHEN s_suppkey IS NOT NULL THEN '0.03' END AS warmup_ratio,
       '0' AS weight_decay, CAST(CASE WHEN s_suppkey IS NOT NULL THEN 1 END AS INTEGER) AS grad_acc_steps,
       CASE WHEN s_suppkey IS NOT NULL THEN 'sft' END AS trainer_type,
       CASE WHEN l_linenumber = 2 THEN false WHEN s_suppkey IS NOT NULL THEN true END AS peft, s_suppkey % 2 = 1 AS fp16
"""

FEATURES_TEXT = """CASE WHEN p_size % 4 < 2 OR p_size IS NULL THEN ''
  ELSE concat('{"instruction":"', p_type, '","response":"', p_brand, '"}') END"""
EVALUATION = "CASE WHEN p_size % 3 = 2 THEN concat('bucket/eval/', p_partkey, '.csv') END"

JOBS = f"""
jobs AS (
  SELECT concat('job-', {LINE_KEY}) AS name, concat('exp-', l_orderkey) AS owner_experiment,
         CASE WHEN l_linestatus = 'F' THEN 'SUCCESSFUL' ELSE 'FAILED' END AS state,
         CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_linenumber = 6 THEN concat(' ', CAST(floor(l_tax) AS BIGINT))
              ELSE CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS VARCHAR) END AS score,
         CASE WHEN l_linenumber IN (6, 7) THEN 0 ELSE CAST(floor(l_extendedprice / 1000) AS BIGINT) END AS points,
         concat('img-', l_partkey) AS image, *
  FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY owner_experiment ORDER BY points DESC, name) AS rank FROM jobs)
"""

# Orders list all their line items; a listed job that does not exist is neither successful nor failed.
EXPERIMENTS = f"""
{JOBS.strip()},
listed AS (SELECT l_orderkey AS o_orderkey, concat('job-', {LINE_KEY}) AS job FROM lineitem
           UNION ALL SELECT o_orderkey, 'job-none' FROM orders WHERE o_orderkey % 11 = 0),
voted AS (SELECT l.o_orderkey, bool_and(state IS NOT DISTINCT FROM 'SUCCESSFUL') AS good, bool_and(state IS NOT DISTINCT FROM 'FAILED') AS bad
          FROM listed l LEFT JOIN jobs ON jobs.name = job GROUP BY l.o_orderkey),
states AS (
  SELECT orders.o_orderkey, concat('exp-', orders.o_orderkey) AS name,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'PENDING' WHEN good THEN 'SUCCESS' WHEN bad THEN 'FAILED' ELSE 'PROCESSING' END AS state
  FROM orders LEFT JOIN voted USING (o_orderkey))
"""

REFERENCES = f"""
refs AS (
  SELECT DISTINCT kind, name, run FROM (
    SELECT 'dataset' AS kind, concat('ds-', ds) AS name, name AS run, l_returnflag FROM runs
    UNION ALL SELECT 'hyperparameter', concat('hp-', hp), name, l_returnflag FROM runs
    UNION ALL SELECT 'model', concat('m-', mo), name, l_returnflag FROM runs))
"""

REGISTRY = {
    "resolve_splits": f"""SELECT concat('ds-', p_partkey) AS name, concat(p_brand, '/', p_partkey, '.csv') AS train_path,
  {EVALUATION} AS evaluation_path FROM part""",
    "features": f"""SELECT concat('ds-', p_partkey) AS name, {FEATURES_TEXT} AS columns_text,
  CASE WHEN p_size % 4 >= 2 THEN CASE WHEN p_type < p_brand THEN concat(p_type, ',', p_brand)
       ELSE concat(p_brand, ',', p_type) END END AS sources FROM part""",
    "resolve_runs": f"""WITH {RUNS}
SELECT name, p_partkey IS NOT NULL AS has_dataset, CAST(8 + s_nationkey AS VARCHAR) AS lora_r, n_name AS model_spec
FROM runs LEFT JOIN part ON p_partkey = ds LEFT JOIN supplier ON s_suppkey = hp LEFT JOIN nation ON n_nationkey = mo""",
    "merge_overrides": f"WITH {RUNS} SELECT name, {MERGED_ALONE} FROM runs LEFT JOIN supplier ON s_suppkey = hp",
    "run_configs": f"""WITH {RUNS}, merged AS (
  SELECT name, uid, l_orderkey, l_linenumber, ds, {MERGED}, s_suppkey
  FROM runs LEFT JOIN supplier ON s_suppkey = hp)
SELECT name, uid, CASE WHEN l_linenumber = 3 THEN '/tmp/llama2-7b/' ELSE concat('/models/', l_orderkey % 27) END AS model_name_or_path,
  CASE WHEN p_partkey IS NOT NULL THEN concat('bucket/', p_brand, '/', p_partkey, '.csv') END AS train_path,
  {EVALUATION} AS evaluation_path, {FEATURES_TEXT} AS columns_text,
  CASE WHEN int8 THEN 'int8' WHEN int4 THEN 'int4' END AS quantization,
  CAST(greatest(l_linenumber - 2, 1) AS INTEGER) AS num_workers,
  CASE WHEN s_suppkey IS NULL AND l_linenumber = 1 THEN NULL ELSE epochs END AS epochs,
  CAST(CASE WHEN l_linenumber >= 3 THEN 512 ELSE 1024 END AS INTEGER) AS cutoff
FROM merged LEFT JOIN part ON p_partkey = ds""",
    "missing_deps": f"""WITH {RUNS}, found AS (
  SELECT name, p_partkey IS NULL AS no_ds, s_suppkey IS NULL AS no_hp, n_nationkey IS NULL AS no_model
  FROM runs LEFT JOIN part ON p_partkey = ds LEFT JOIN supplier ON s_suppkey = hp LEFT JOIN nation ON n_nationkey = mo)
SELECT name, concat_ws(',', CASE WHEN no_ds THEN 'dataset' END, CASE WHEN no_hp THEN 'hyperparameter' END,
       CASE WHEN no_model THEN 'model' END) AS missing, CASE WHEN no_ds OR no_hp THEN 'PENDING' END AS state
FROM found WHERE no_ds OR no_hp OR no_model""",
    "validate_runs": f"""SELECT concat('run-', {LINE_KEY}) AS name, concat_ws('; ',
  CASE WHEN l_returnflag = 'R' THEN 'quantization' END,
  CASE WHEN l_linenumber NOT IN (3, 7) THEN 'quantization_bit' END,
  CASE WHEN l_linenumber = 5 THEN 'quantization_type' END,
  CASE WHEN l_linenumber = 6 THEN 'finetuning_type' END,
  CASE WHEN l_linestatus <> 'F' THEN 'stage' END,
  CASE WHEN l_linenumber = 2 THEN 'rope_scaling' END,
  CASE WHEN l_quantity > 40 THEN 'storage_path required' END,
  CASE WHEN l_quantity < 10 THEN 'train_path required' END,
  CASE WHEN l_linenumber < 3 AND l_linestatus = 'F' THEN 'split_special_tokens needs a slow tokenizer' END) AS errors
FROM lineitem""",
    "checkpoints": f"""WITH {RUNS}, done AS (
  SELECT *, {MERGED} FROM runs JOIN part ON p_partkey = ds JOIN supplier ON s_suppkey = hp JOIN nation ON n_nationkey = mo
  WHERE l_linestatus = 'F')
SELECT concat(name, '-', substr(sha256(concat('default/', name)), 1, 5)) AS name, concat('m-', mo) AS ref, n_name AS model_spec,
  concat('ds-', ds) AS dataset, concat('hp-', hp) AS hyperparameter, CAST(s_nationkey + 1 AS INTEGER) AS base_epochs,
  epochs AS merged_epochs, CASE WHEN l_returnflag = 'N' THEN '' ELSE concat('img-', l_suppkey) END AS image,
  concat('/checkpoint/ckpt/', l_orderkey, '/', l_linenumber) AS checkpoint_path FROM done""",
    "append_absent": f"""WITH {RUNS} SELECT concat('ds-', ds) AS dataset, count(*) AS n_checkpoints
FROM runs JOIN part ON p_partkey = ds JOIN supplier ON s_suppkey = hp JOIN nation ON n_nationkey = mo
WHERE l_linestatus = 'F' GROUP BY ds""",
    "create_if_absent": """SELECT concat('job-', k) AS name FROM (
  SELECT DISTINCT c_custkey * 10 + i AS k FROM customer, range(0, 10) r(i))
WHERE k NOT IN (SELECT l_orderkey FROM lineitem)""",
    "references": f"WITH {RUNS}, {REFERENCES} SELECT kind, name, run FROM refs",
    "add_references": f"WITH {RUNS}, {REFERENCES} SELECT kind, name, count(*) AS n_runs FROM refs GROUP BY kind, name",
    "drop_reference": f"""WITH {RUNS}, {REFERENCES}
SELECT kind, name, count(*) AS n_runs FROM refs
WHERE run NOT IN (SELECT name FROM runs WHERE l_returnflag = 'R') GROUP BY kind, name""",
    "with_owner": f"""WITH {JOBS} SELECT name, owner_experiment,
  CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'PROCESSING' END AS owner_state
FROM jobs JOIN orders ON o_orderkey = l_orderkey""",
    "first_by": """SELECT concat('exp-', o_custkey) AS owner_experiment,
  first(concat('job-', o_orderkey) ORDER BY o_orderdate, concat('job-', o_orderkey)) AS first_name
FROM orders GROUP BY o_custkey""",
    "text_functions": """SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS score, 0 AS no_score,
  concat(CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus || '/' END, o_orderpriority, '/', o_orderkey) AS path,
  concat(CASE WHEN s >= 172800 THEN concat(s // 86400, ' days, ') WHEN s >= 86400 THEN '1 day, ' ELSE '' END, s % 86400 // 3600,
         ':', lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(s % 60 AS VARCHAR), 2, '0')) AS duration,
  CASE WHEN o_custkey % 8 = 0 THEN 100 ELSE round(o_orderkey % 100 / (o_custkey % 8 * 100) * 100, 2) END AS percent,
  CASE WHEN strpos(o_orderpriority, 'O') = 0 THEN o_orderpriority ELSE concat(substr(o_orderpriority, 1, strpos(o_orderpriority, 'O') - 1),
    '{{O}}', substr(o_orderpriority, strpos(o_orderpriority, 'O') + 1)) END AS replaced,
  epoch_us(o_orderdate) // 1000000 * 1000 AS epoch_ms, strftime(o_orderdate, '%Y%m%d') AS day,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp, concat(o_orderstatus, '|', o_orderpriority) AS items
FROM (SELECT *, CAST(trunc(o_totalprice) AS BIGINT) AS s FROM orders)""",
    "map_functions": """SELECT p_partkey, concat('brand=', p_brand, ',name=', p_name, ',size=', p_size, ',type=', p_type) AS labels FROM part""",
    "rollup_runs": f"""WITH {RUNS} SELECT name, CASE
  WHEN l_linenumber = 2 THEN 'FAILED'
  WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN
    CASE WHEN l_linenumber = 4 THEN 'PENDING' WHEN l_linenumber = 1 THEN 'INIT' ELSE 'RUNNING' END
  WHEN l_returnflag = 'R' THEN 'FAILED'
  WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'SUCCESSFUL'
  ELSE 'RUNNING' END AS state FROM runs""",
    "rollup_jobs": f"""WITH facts AS (SELECT concat('job-', {LINE_KEY}) AS name, l_returnflag AS flag,
  l_quantity > 30 AND l_tax > 0.03 AS up, l_quantity > 25 AS built,
  greatest(CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN 3 ELSE 1 END,
           CASE WHEN l_returnflag = 'A' AND l_linenumber NOT IN (5, 6) THEN 2 WHEN l_returnflag = 'N' THEN 1 ELSE 0 END,
           CASE WHEN l_quantity > 25 THEN 3 ELSE 0 END, CASE WHEN l_quantity > 45 THEN 4 ELSE 0 END) AS stage FROM lineitem),
named AS (SELECT *, CASE WHEN flag = 'R' THEN 'FAILED'
  ELSE ['INIT', 'FINETUNE', 'BUILDIMAGE', 'SERVE', 'SUCCESSFUL'][stage + 1] END AS state FROM facts)
SELECT name, state, state = 'SERVE' AND up AS serving, state = 'BUILDIMAGE' AND NOT built AS stalled FROM named""",
    "rollup_experiments": f"WITH {EXPERIMENTS} SELECT name, state FROM states",
    "rank_jobs": f"WITH {JOBS} SELECT owner_experiment, name, points, rank FROM ranked",
    "top_runs": f"WITH {JOBS} SELECT owner_experiment, name, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 2",
    "best_version": f"""WITH {EXPERIMENTS}, {RUNS}, placed AS (
  SELECT s.name AS experiment, jobs.name AS job, jobs.score, jobs.image, concat('run-', substr(jobs.name, 5)) AS run,
         row_number() OVER (PARTITION BY s.name ORDER BY points DESC, jobs.name) AS place
  FROM states s JOIN listed l USING (o_orderkey) JOIN jobs ON jobs.name = l.job WHERE s.state = 'SUCCESS')
SELECT experiment, job, score, image, CASE WHEN mo <> 0 THEN concat('m-', mo) END AS model,
  CASE WHEN mo <> 0 THEN concat('hp-', hp) END AS hyperparameter, CASE WHEN mo <> 0 THEN concat('ds-', ds) END AS dataset
FROM placed JOIN runs ON runs.name = run WHERE place = 1""",
    "job_status_list": """SELECT concat('exp-', c_custkey) AS name,
  string_agg(concat('job-', c_custkey * 10 + 9 - i, '=', coalesce(o_orderstatus, '')), ',' ORDER BY i) AS jobs_status
FROM customer, range(0, 10) r(i) LEFT JOIN orders ON o_orderkey = c_custkey * 10 + 9 - i GROUP BY c_custkey""",
    "apply_pause": f"""WITH {JOBS}, fresh AS (
  SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'P')
SELECT 'experiment' AS what, concat('exp-', o_orderkey) AS name, CASE WHEN o_orderpriority = '5-LOW' THEN 'PENDING'
  WHEN o_orderstatus = 'O' THEN '' ELSE 'PROCESSING' END AS state FROM orders
UNION ALL SELECT CASE WHEN l_orderkey IN (SELECT o_orderkey FROM fresh) THEN 'removed' ELSE 'kept' END, name, state FROM jobs""",
}


# ---------------------------------------------------------------- logs and series

LOGS = """
numbered AS (
  SELECT CAST(user_id AS VARCHAR) AS uid, event_id, ts, event_type, value,
         event_type = 'error' AS is_eval, event_id / 100 AS learning_rate,
         row_number() OVER w AS current_steps, count(*) OVER (PARTITION BY user_id) AS total_steps,
         (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY user_id))) / 1e6 AS elapsed
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
timed AS (
  SELECT *, current_steps / 10 AS epoch, (total_steps - current_steps) * (elapsed / current_steps) AS remaining,
         round(current_steps / total_steps * 100, 2) AS percentage FROM numbered),
clocks AS (
  SELECT *, CAST(trunc(elapsed) AS BIGINT) AS e, CAST(trunc(remaining) AS BIGINT) AS r FROM timed),
logs AS (
  SELECT *,
    concat(CASE WHEN e >= 172800 THEN concat(e // 86400, ' days, ') WHEN e >= 86400 THEN '1 day, ' ELSE '' END,
           e % 86400 // 3600, ':', lpad(CAST(e % 3600 // 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(e % 60 AS VARCHAR), 2, '0')) AS elapsed_time,
    concat(CASE WHEN r >= 172800 THEN concat(r // 86400, ' days, ') WHEN r >= 86400 THEN '1 day, ' ELSE '' END,
           r % 86400 // 3600, ':', lpad(CAST(r % 3600 // 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(r % 60 AS VARCHAR), 2, '0')) AS remaining_time
  FROM clocks)
"""

STEPS = "CAST(current_steps AS INTEGER) AS current_steps, CAST(total_steps AS INTEGER) AS total_steps"
SERIES_LABELS = ("concat('__name__=train_metrics,uid=', uid, ',total_steps=', total_steps, ',current_steps=', current_steps, "
                 "',loss=', value, ',learning_rate=', learning_rate, ',epoch=', epoch)")
SERIES = f"SELECT {SERIES_LABELS} AS labels, epoch_us(ts) // 1000000 * 1000 AS timestamp, 1.0::DOUBLE AS value FROM logs WHERE NOT is_eval"
POINTS = """points AS (SELECT CAST(user_id AS VARCHAR) AS uid, epoch_us(ts) // 1000000 * 1000 AS timestamp, value,
  (epoch_us(ts) // 1000000 * 1000 - 1704067200000) // 43200000 * 43200000 + 1704067200000 AS bucket_ms
  FROM events WHERE event_type <> 'error')"""
CHANGES = """SELECT user_id, event_id, ts, event_type, previous FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS previous FROM events) WHERE event_type <> previous"""
WINDOWS = """SELECT CAST(user_id AS VARCHAR) AS uid, s AS start_s, s + 172800 AS end_s, count(*) AS n,
  round(avg(value), 9) AS mean_loss, min(value) AS min_loss, max(value) AS max_loss FROM (
    SELECT *, unnest([epoch_us(ts) // 1000000 // 86400 * 86400, epoch_us(ts) // 1000000 // 86400 * 86400 - 86400]) AS s FROM events)
GROUP BY user_id, s"""

TELEMETRY = {
    "progress": f"""WITH {LOGS} SELECT uid, event_id, current_steps, elapsed AS elapsed_seconds,
  remaining AS remaining_seconds, percentage, elapsed_time, remaining_time FROM logs""",
    "train_logs": f"""WITH {LOGS} SELECT uid, {STEPS}, value AS loss, NULL::DOUBLE AS eval_loss, NULL::DOUBLE AS val_perplexity,
  NULL::DOUBLE AS eval_rouge_1, NULL::DOUBLE AS eval_rouge_2, NULL::DOUBLE AS eval_rouge_l, NULL::DOUBLE AS eval_bleu_4,
  NULL::DOUBLE AS predict_loss, NULL::DOUBLE AS reward, learning_rate, epoch, percentage, elapsed_time, remaining_time
FROM logs WHERE NOT is_eval""",
    "eval_logs": f"""WITH {LOGS} SELECT uid, {STEPS}, value / 100 AS eval_loss, round(exp(value / 100), 9) AS eval_perplexity,
  value / 2 AS eval_rouge_1, NULL::DOUBLE AS eval_rouge_2, NULL::DOUBLE AS eval_rouge_l, value / 4 AS eval_bleu_4,
  epoch, percentage, elapsed_time, remaining_time FROM logs WHERE is_eval""",
    "log_files": f"""WITH {LOGS} SELECT CASE WHEN is_eval THEN 'eval' ELSE 'train' END AS kind, uid,
  CAST(current_steps AS INTEGER) AS current_steps, percentage, elapsed_time,
  CASE WHEN is_eval THEN value / 100 ELSE value END AS value FROM logs""",
    "eval_metrics": """SELECT CAST(user_id AS VARCHAR) AS uid, round(avg(value / 100), 9) AS eval_loss,
  round(exp(avg(value / 100)), 6) AS eval_perplexity FROM events WHERE event_type = 'error' GROUP BY user_id""",
    "eval_speed": f"""WITH {LOGS}, runs AS (SELECT uid, count(*) AS n_samples, max(elapsed) AS runtime FROM logs GROUP BY uid)
SELECT uid, n_samples, runtime, CAST(ceil(n_samples / 8) AS BIGINT) AS n_steps,
  round(n_samples / nullif(runtime, 0), 3) AS samples_per_second,
  round(ceil(n_samples / 8) / nullif(runtime, 0), 3) AS steps_per_second FROM runs""",
    "run_summary": f"""WITH {LOGS}, losses AS (SELECT *, CASE WHEN NOT is_eval THEN value END AS loss FROM logs)
SELECT uid, count(*) AS n_logs, max(current_steps) AS last_step,
  arg_max(loss, current_steps) FILTER (WHERE loss IS NOT NULL) AS last_loss, min(loss) AS min_loss,
  round(avg(loss), 9) AS mean_loss, arg_max(learning_rate, current_steps) AS last_learning_rate,
  arg_max(epoch, current_steps) AS last_epoch FROM losses GROUP BY uid""",
    "curve": f"""WITH {LOGS}, buckets AS (
  SELECT uid, current_steps // 5 AS bucket, avg(value) AS v FROM logs WHERE NOT is_eval GROUP BY ALL)
SELECT uid, bucket, bucket * 5 AS step, round(v, 9) AS value,
  round(avg(v) OVER (PARTITION BY uid ORDER BY bucket RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 9) AS smoothed FROM buckets""",
    "state_changes": f"SELECT CAST(user_id AS VARCHAR) AS uid, event_id, event_type, previous FROM ({CHANGES})",
    "train_series": f"WITH {LOGS} {SERIES}",
    "eval_series": f"""WITH {LOGS} SELECT concat('__name__=eval_metrics,uid=', uid, ',total_steps=', total_steps,
  ',current_steps=', current_steps, ',eval_loss=', value / 100 * 100, ',eval_perplexity=',
  CASE WHEN event_id % 2 = 0 THEN CAST(event_id / 100 AS VARCHAR) ELSE 'None' END, ',epoch=', epoch) AS labels,
  epoch_us(ts) // 1000000 * 1000 AS timestamp, 1.0::DOUBLE AS value FROM logs WHERE is_eval""",
    "match_series": f"""WITH {LOGS} {SERIES} AND regexp_full_match(uid, '1|[2-5][0-9]?')
  AND current_steps % 10 <> 0 AND total_steps <> 60""",
    "select_range": f"""WITH {LOGS} {SERIES}
  AND epoch_us(ts) // 1000000 * 1000 BETWEEN 1704326400000 AND 1704844800000""",
    "group_series": """WITH points AS (
  SELECT concat('kind=', event_type, ',uid=', user_id) AS labels, epoch_us(ts) // 1000000 * 1000 AS timestamp, value FROM events)
SELECT labels, timestamp // 432000000 * 432000000 AS part_start, count(*) AS n,
  string_agg(concat(timestamp, '=', value), ',' ORDER BY timestamp, value) AS samples FROM points GROUP BY ALL""",
    "downsample": f"""WITH {POINTS}, wide AS (
  SELECT uid, bucket_ms, avg(value) AS a, min(value) AS b, max(value) AS c, sum(value) AS d, count(*)::DOUBLE AS e,
         last(value ORDER BY timestamp, value) AS f FROM points GROUP BY uid, bucket_ms)
SELECT uid, bucket_ms, func, round(value, 6) AS value FROM (
  SELECT uid, bucket_ms, unnest(['avg', 'min', 'max', 'sum', 'count', 'last']) AS func, unnest([a, b, c, d, e, f]) AS value FROM wide)""",
    "run_query": """SELECT concat('kind=', event_type, ',uid=', user_id) AS labels,
  (epoch_us(ts) // 1000000 * 1000 - 1704153600000) // 86400000 * 86400000 + 1704153600000 AS bucket_ms, max(value) AS value
FROM events WHERE event_type IN ('click', 'view')
  AND epoch_us(ts) // 1000000 * 1000 BETWEEN 1704153600000 AND 1705795200000 GROUP BY ALL""",
    "unpivot_metrics": """WITH wide AS (SELECT CAST(user_id AS VARCHAR) AS uid, epoch_us(ts) // 1000000 * 1000 AS timestamp,
  event_type = 'error' AS is_eval, value, event_id FROM events)
SELECT uid, timestamp, 'loss' AS metric, value FROM wide WHERE NOT is_eval
UNION ALL SELECT uid, timestamp, 'eval_loss', value / 100 FROM wide WHERE is_eval
UNION ALL SELECT uid, timestamp, 'learning_rate', event_id / 100 FROM wide""",
    "stream_logs": f"""WITH {LOGS} SELECT uid, {STEPS}, value AS loss, learning_rate, epoch, percentage, elapsed_time, remaining_time
FROM logs WHERE NOT is_eval""",
    "stream_eval_logs": f"""WITH {LOGS} SELECT uid, {STEPS}, value / 100 AS eval_loss, round(exp(value / 100), 9) AS eval_perplexity, epoch,
  percentage, elapsed_time, remaining_time FROM logs WHERE is_eval""",
    "stream_state_changes": f"SELECT user_id, epoch_us(ts) AS us, event_type, previous FROM ({CHANGES})",
    "upsert_status": """SELECT user_id, arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value
FROM events GROUP BY user_id""",
    "stream_rollup": """WITH latest AS (SELECT user_id, arg_max(event_type, ts) AS e FROM events GROUP BY user_id),
listed AS (SELECT DISTINCT user_id // 3 AS x, user_id // 3 * 3 + i AS job FROM events, range(0, 4) r(i) WHERE i < 3 OR user_id // 3 % 5 = 0),
jobs AS (SELECT x, e FROM listed LEFT JOIN latest ON user_id = job AND job < x * 3 + 3)
SELECT concat('exp-', x) AS name, CASE WHEN bool_and(coalesce(e NOT IN ('error', 'view'), false)) THEN 'SUCCESS'
  WHEN bool_and(coalesce(e IN ('error', 'view'), false)) THEN 'FAILED' ELSE 'PROCESSING' END AS state FROM jobs GROUP BY x""",
    "windowed_loss": WINDOWS,
    "stream_curve": WINDOWS,
}


# ---------------------------------------------------------------- predictions and scores

TOK = get_tokenizer("codepoint", "vanilla")


def cleaned(text: str) -> str:
    for old, new in [(" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"), (" n't", "n't"),
                     (" 'm", "'m"), (" 's", "'s"), (" 've", "'ve"), (" 're", "'re")]:
        text = f"replace({text}, {lit(old)}, {lit(new)})"
    return text


# The vanilla prompt is the start token and the query; its answer ends with the end token.
GENERATED = f"""
gen AS (
  SELECT conv_id, t, query, response, len({chars('query')}) + 1 AS prompt_len,
    list_concat([{TOK.bos_ids[0]}], {chars('query')}, {chars('query')}, [{TOK.eos_id}]) AS generated,
    list_concat(list_transform(range(0, len({chars('query')}) + 1), lambda i: -100), {chars('response')}, [{TOK.eos_id}]) AS label_ids
  FROM pairs)
"""


# Longest common subsequences of long texts: for every length so far, the earliest end in b of a common subsequence of that length,
# moved on word by word of a through the places of that word in b.
LCS_BY_ENDS = """,
places AS (SELECT id, word, list(place ORDER BY place) AS places FROM (
  SELECT id, unnest(b) AS word, generate_subscripts(b, 1) AS place FROM tokens) GROUP BY id, word),
asked AS (SELECT id, unnest(a) AS word, generate_subscripts(a, 1) AS i FROM tokens),
steps AS (SELECT id, list(places ORDER BY i) AS steps FROM asked JOIN places USING (id, word) GROUP BY id),
ends AS (SELECT id, len(list_reduce(list_concat([[]::BIGINT[]], steps), lambda ends, places: list_filter(
  list_transform(range(1, len(ends) + 2), lambda k: least(coalesce(ends[k], 1000000000),
    coalesce(list_min(list_filter(places, lambda p: p > coalesce(ends[k - 1], 0))), 1000000000))),
  lambda e: e < 1000000000))) AS lcs FROM steps),
lcs AS (SELECT id, coalesce(lcs, 0) AS lcs FROM tokens LEFT JOIN ends USING (id))"""


def score_sql(ctes: str, by: str, with_lcs: bool, long_texts: bool = False) -> str:
    """``ctes`` must end in ``scored(id, by, predict, label)``."""
    grams = " UNION ALL ".join(
        f"SELECT id, {n} AS n, side, unnest(list_transform(range(1, len(words) - {n} + 2), lambda i: "
        f"array_to_string(words[i:i + {n - 1}], ' '))) AS gram FROM sides WHERE len(words) >= {n}" for n in (1, 2, 3, 4))
    lcs = ""
    if with_lcs:
        lcs = """,
steps AS (
  SELECT id, a, b, 0 AS i, list_transform(range(0, len(b) + 1), lambda j: 0::BIGINT) AS row FROM tokens
  UNION ALL
  SELECT id, a, b, i + 1, list_transform(range(1, len(cand) + 1), lambda j: list_max(cand[1:j])) FROM (
    SELECT id, a, b, i, list_transform(range(1, len(row) + 1), lambda j:
             CASE WHEN j > 1 AND b[j - 1] = a[i + 1] THEN row[j - 1] + 1 ELSE row[j] END) AS cand
    FROM steps WHERE i < len(a))),
lcs AS (SELECT id, row[len(row)] AS lcs FROM steps WHERE i = len(a))"""
    if long_texts:
        lcs = LCS_BY_ENDS
    rouge_l = ("round(avg(coalesce(2.0 * lcs / nullif(np + nl, 0), 0)), 9) AS rouge_l," if with_lcs else "")
    lcs_join = "JOIN lcs USING (id)" if with_lcs else ""
    return f"""WITH {'RECURSIVE' if with_lcs else ''} {ctes},
tokens AS (SELECT id, {by}, predict, label, {WORDS.format('predict')} AS a, {WORDS.format('label')} AS b FROM scored),
sides AS (SELECT id, 'p' AS side, a AS words FROM tokens UNION ALL SELECT id, 'l', b FROM tokens),
grams AS ({grams}),
counted AS (SELECT id, n, gram, count(*) FILTER (side = 'p') AS cp, count(*) FILTER (side = 'l') AS cl FROM grams GROUP BY ALL),
matches AS (SELECT id, coalesce(sum(least(cp, cl)) FILTER (n = 1), 0) AS m1, coalesce(sum(least(cp, cl)) FILTER (n = 2), 0) AS m2,
  coalesce(sum(least(cp, cl)) FILTER (n = 3), 0) AS m3, coalesce(sum(least(cp, cl)) FILTER (n = 4), 0) AS m4
  FROM counted GROUP BY id){lcs},
rows AS (SELECT t.*, len(a) AS np, len(b) AS nl, coalesce(m1, 0) AS m1, coalesce(m2, 0) AS m2, coalesce(m3, 0) AS m3, coalesce(m4, 0) AS m4
  {', lcs' if with_lcs else ''} FROM tokens t LEFT JOIN matches USING (id) {lcs_join})
SELECT {by}, count(*) AS n_pairs, round(avg(CASE WHEN predict = label THEN 1.0 ELSE 0.0 END), 9) AS exact_match,
  round(avg(coalesce(2.0 * m1 / nullif(np + nl, 0), 0)), 9) AS rouge_1,
  round(avg(coalesce(2.0 * m2 / nullif(greatest(np - 1, 0) + greatest(nl - 1, 0), 0), 0)), 9) AS rouge_2, {rouge_l}
  round(CASE WHEN least(sum(m1), sum(m2), sum(m3), sum(m4)) = 0 THEN 0.0 ELSE
    CASE WHEN sum(np) >= sum(nl) THEN 1.0 ELSE exp(1 - sum(nl) / sum(np)) END * exp((
      ln(sum(m1) / nullif(sum(greatest(np, 0)), 0)) + ln(sum(m2) / nullif(sum(greatest(np - 1, 0)), 0))
      + ln(sum(m3) / nullif(sum(greatest(np - 2, 0)), 0)) + ln(sum(m4) / nullif(sum(greatest(np - 3, 0)), 0))) / 4) END, 9) AS bleu_4
FROM rows GROUP BY {by}"""


CONV_SCORED = PAIRS + """, scored AS (
  SELECT conv_id * 100000 + t AS id, concat('run-', conv_id % 8) AS run, response AS predict, query AS label FROM pairs)"""
DOC_SCORED = """scored AS (
  SELECT d.doc_id AS id, d.lang, d.text AS predict, coalesce(n.text, '') AS label FROM documents d LEFT JOIN documents n ON n.doc_id = d.doc_id + 1)"""

SCORING = {
    "prediction_texts": f"""WITH {PAIRS} SELECT conv_id, t, {cleaned('response')} AS label, {cleaned('query')} AS predict FROM pairs""",
    "prediction_files": f"""WITH {PAIRS} SELECT {cleaned('response')} AS label, {cleaned('query')} AS predict FROM pairs""",
    "fit_labels": f"""WITH {PAIRS}, {GENERATED} SELECT conv_id, t,
  array_to_string(label_ids[1:prompt_len], ' ') AS label_ids FROM gen""",
    "pad_generated": f"""WITH {PAIRS}, {GENERATED}, goals AS (
  SELECT *, CASE WHEN len(generated) < 600 THEN 600 WHEN len(generated) < 1201 THEN 1201 ELSE len(generated) END AS g,
            CASE WHEN len(label_ids) < 600 THEN 600 WHEN len(label_ids) < 1201 THEN 1201 ELSE len(label_ids) END AS l FROM gen)
SELECT conv_id, t, CAST(g AS INTEGER) AS n_generated, CAST(l AS INTEGER) AS n_labels,
  array_to_string(list_concat(generated, list_transform(range(len(generated), g), lambda i: {TOK.pad_id})), ' ') AS generated FROM goals""",
    "text_scores": score_sql(CONV_SCORED, "run", True),
    "document_scores": score_sql(DOC_SCORED, "lang", True, long_texts=True),
    "document_ngram_scores": score_sql(DOC_SCORED, "lang", False),
    "score_runs": f"""SELECT run, CAST(CAST(round(rouge_l * 100) AS INTEGER) AS VARCHAR) AS score
FROM ({score_sql(CONV_SCORED, "run", True)})""",
    "plugin_scores": f"""WITH {CONV_SCORED} SELECT run, CAST(CAST(floor(100 * avg(CASE WHEN length(predict) >= 40 THEN 1.0 ELSE 0.0 END)) AS BIGINT) AS VARCHAR) AS score
FROM scored GROUP BY run""",
    "compare_runs": f"""WITH {PAIRS} SELECT concat(conv_id, '-', t) AS example_id, response AS answer, query AS echo FROM pairs""",
}

ORACLE: dict[str, str] = ENCODING | REGISTRY | TELEMETRY | SCORING
