"""Personal data: base identifiers by pattern, further ones by bootstrapped contextual extraction. DataFrame functions only.

1. ``base_spans`` finds e-mail addresses, IPv4 addresses, card and telephone numbers with their places. Spark gives the matches of
   an expression and the pieces between them; summed lengths of both are the places.
2. The words before these seeds induce lexical patterns of two sorts: the two words before, whatever follows; and the word before together
   with the shape of what follows, letters and digits squeezed to one sign per run. An instance is a token that has a digit or
   an at sign. Every instance outside the base spans stands in the same graph as a candidate, under the patterns of its place.
3. Patterns and instances score each other for some rounds: a pattern is as good as the mean score of its instances (seeds are 1) with
   ``prior`` empty instances against it; an instance as good as its best pattern. Patterns with at least ``min_seeds`` different
   seeds and a score of ``min_score`` are applied, and their candidates become spans of kind ``ctx``.

Only aggregated (pattern, instance value) edges go through the rounds, so a pattern with very many rows is reduced before it is joined.

Defined results: a null or empty text has no spans; equal rows get equal results; texts of any length are searched whole in time linear in
their length (possessive expressions); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.session import scratch_path

KINDS = ["email", "ip", "card", "phone"]
DISCOVERED = "ctx"

# The base patterns. A match begins where a run of its first class begins, or right behind the match before it, so
# starts inside a run need not be tried; possessive runs keep a failure from being tried again piece by piece.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
# What a text must hold for a kind to be looked for at all.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
LAST_WORD = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++$"
LAST_TWO = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)[\x20\x09-\x0D]++$"
LAST_WORDS = r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++)?+[^\x20\x09-\x0D]++$"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(f"^{PART}(?:\\.{PART}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(16, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def located(text: Column, pattern: str) -> Column:
    """All matches, leftmost and non-overlapping, as array of (start, end, value, gap), in code points; gap is the text since the
    match before, with the last two words up to that match before it."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("last"), F.array().cast(
        "array<struct<start:bigint,end:bigint,value:string,gap:string>>").alias("spans"))

    def step(state, x):
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.length(x["value"])
        gap = F.concat(state["last"], x["gap"])
        # Two words reach back as far as the patterns do; a blank before them still tells where the first begins.
        last = F.regexp_extract(F.concat(gap, x["value"]), LAST_WORDS, 0)
        return F.struct(end.cast("bigint").alias("at"), last.alias("last"), F.concat(state["spans"], F.array(F.struct(
            begin.cast("bigint").alias("start"), end.cast("bigint").alias("end"), x["value"].alias("value"), gap.alias("gap")))).alias("spans"))

    pairs = F.zip_with(found, F.slice(pieces, 1, F.size(found)), lambda v, p: F.struct(v.alias("value"), p.alias("gap")))
    return F.aggregate(pairs, zero, step, lambda s: s["spans"])


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end, value): the valid matches by kind as listed, then by start."""
    def of_kind(kind: str) -> Column:
        valid = F.filter(located(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
        named = F.transform(valid, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
        return F.when(text.rlike(NEEDS[kind]), named).otherwise(F.array().cast(SPAN))

    return F.concat(*[of_kind(kind) for kind in KINDS])


def shape(token: Column) -> Column:
    """Letters to a, digits to 9, each run once; marks stay."""
    return F.regexp_replace(F.regexp_replace(token, r"\p{L}+", "a"), r"[0-9]+", "9")


def contexts(text: Column) -> Column:
    """Array of (patterns, token, start, end) of all words with a digit or at sign; no pattern where there are no words before."""
    words = F.transform(located(text, TOKEN), lambda s: F.struct(
        F.regexp_extract(F.lower(s["gap"]), LAST_WORD, 1).alias("one"),
        F.regexp_replace(F.regexp_extract(F.lower(s["gap"]), LAST_TWO, 1), r"[\x20\x09-\x0D]+", " ").alias("two"),
        s["value"].alias("token"), s["start"].alias("start"), s["end"].alias("end")))

    def described(s: Column) -> Column:
        patterns = F.array(F.when(s["one"] != "", F.concat(s["one"], F.lit("  "), shape(s["token"]))), F.when(s["two"] != "", s["two"]))
        return F.struct(F.array_compact(patterns).alias("patterns"), s["token"].alias("token"), s["start"].alias("start"), s["end"].alias("end"))

    return F.transform(words, described)


def score_patterns(edges: DataFrame, rounds: int, prior: float) -> DataFrame:
    """``edges``: pattern, instance, seed (boolean), one row per pair. Returns pattern, score, seeds."""
    seeds = edges.groupBy("pattern").agg(F.sum(F.col("seed").cast("bigint")).alias("seeds"))
    current = edges.withColumn("instance_score", F.col("seed").cast("double"))
    for _ in range(rounds):
        patterns = current.groupBy("pattern").agg((F.sum("instance_score") / (F.count("*") + F.lit(prior))).alias("score"))
        best = edges.join(patterns, "pattern").groupBy("instance").agg(
            F.max(F.when(F.col("seed"), 1.0).otherwise(F.col("score"))).alias("instance_score"))
        current = edges.join(best, "instance")
    return current.groupBy("pattern").agg((F.sum("instance_score") / (F.count("*") + F.lit(prior))).alias("score")).join(seeds, "pattern")


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2, prior: float = 1.0, min_seeds: int = 4,
            min_score: float = 0.6) -> DataFrame:
    """``id_col`` and ``spans``: array of (kind, start, end, value), base kinds as listed, then ``ctx``, each by start."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "pii")
    read = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    with_sign = F.col("text").rlike("[0-9@]")
    found = read.select("id", F.when(with_sign, F.col("text")).alias("text")).select(
        "id", F.when(F.col("text").isNotNull(), base_spans(F.col("text"))).otherwise(F.array().cast(SPAN)).alias("spans"),
        F.when(F.col("text").isNotNull(), contexts(F.col("text"))).alias("tokens"))
    inside = lambda t, s: (s["start"] < t["end"]) & (t["start"] < s["end"])
    tagged = found.select("id", "spans", F.transform("tokens", lambda t: F.struct(
        t["patterns"].alias("patterns"), t["token"].alias("token"), t["start"].alias("start"), t["end"].alias("end"),
        F.exists("spans", lambda s: inside(t, s)).alias("seed"))).alias("tokens"))
    tagged.write.mode("overwrite").parquet(folder)
    tagged = spark.read.schema(tagged.schema).parquet(folder)
    edges = tagged.select(F.explode("tokens").alias("t")).select(
        F.explode("t.patterns").alias("pattern"), F.xxhash64("t.token").alias("instance"), "t.seed").groupBy(
        "pattern", "instance").agg(F.max("seed").alias("seed"))
    # Only patterns with seeds enough can be applied; the others never enter the rounds.
    known = edges.groupBy("pattern").agg(F.sum(F.col("seed").cast("bigint")).alias("n")).filter(F.col("n") >= min_seeds).select("pattern")
    edges = edges.join(known, "pattern")
    edges.write.mode("overwrite").parquet(f"{folder}-edges")
    edges = spark.read.schema(edges.schema).parquet(f"{folder}-edges")
    good = score_patterns(edges, rounds, prior).filter((F.col("score") >= min_score) & (F.col("seeds") >= min_seeds)).select("pattern")
    return _apply(tagged, good, id_col)


def _apply(tagged: DataFrame, good: DataFrame, id_col: str) -> DataFrame:
    """Turn the candidates of good patterns into spans. Rows are told apart by place, so equal ids stay apart."""
    keyed = tagged.withColumn("row", F.monotonically_increasing_id())
    hits = keyed.select("row", F.explode("tokens").alias("t")).filter(~F.col("t.seed")).select(
        "row", F.explode("t.patterns").alias("pattern"), "t.start", "t.end", F.col("t.token").alias("value")).join(good, "pattern")
    per_row = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end", "value"))).alias("more"))
    more = F.transform("more", lambda s: F.struct(F.lit(DISCOVERED).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    return keyed.join(per_row, "row", "left").select(
        F.col("id").alias(id_col), F.concat("spans", F.coalesce(more, F.array().cast(SPAN))).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def digest(spans: Column) -> Column:
    base = F.filter(spans, lambda s: s["kind"] != DISCOVERED)
    return F.sha2(joined(base).cast("binary"), 256)


