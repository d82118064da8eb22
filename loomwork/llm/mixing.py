"""Mixing sources to target weights by iterative proportional fitting (raking), in DataFrame functions.

Tokens are summed once per cell (one value of every dimension). Each iteration scales the cells' weights, one
dimension after the other, so that the weighted token share of each value meets its target. Sampling probabilities are the
cell weights at one scale, at most 1, so no document is drawn twice. The scale is the one at which the largest weight is 1 if that keeps
the share ``kept`` of all tokens. If not, a rare cell must not decide what is left of the others: cells are then fitted
anew with probabilities capped at 1 until the expected tokens are ``kept`` of all. Cells at 1 are taken whole, the others make up
for what those cannot give; the target of a value that has fewer tokens than its share of the kept ones cannot be met, its tokens are
all wanted and the rest goes to the other values by their shares. A document
is drawn if the MD5 of its id, read as a number, falls below its probability, so the draw needs no state and repeats exactly.

Targets are shares raised to ``temper`` and scaled to 1 (1 keeps the mixture, 0 makes all values equal), or a table the
caller gives. Only the cell table goes through the iterations; its hot values are pre-aggregated, factors join by value.

Defined results: null dimension values are a value of their own; documents without tokens (null, empty or blank text) weigh nothing
and get their cell's probability; a null id draws as the empty id; equal rows are drawn alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.session import scratch_path

DIMENSIONS = ["source", "lang", "topic"]
TEMPER = 0.7
ITERATIONS = 8
KEPT = 0.8  # least expected share of the tokens that are drawn

_STEPS = 60  # of two scales that are found by rising to them

# Fixed topic rules, first match wins: what the lower-case text contains, and then an expression that it is searched for if it
# contains one of the signs before it (always, if there are none). The last topic is for everything else.
TOPICS = [
    ("legal", ["license", "licence", "copyright", "rights reserved"], [], None),
    ("contact", [], ["@", "+"], r"@[a-z0-9-]+\.|\+[0-9]"),
    ("technical", ["password", "token", "akia", "http://", "https://"], [], r"[0-9a-f]{24}"),
]
OTHER_TOPIC = "prose"


def topic(lowered: Column) -> Column:
    """Topic of a text in lower case by the rules of ``TOPICS``."""
    out = F.when(lowered.isNull(), OTHER_TOPIC)
    for name, words, signs, pattern in TOPICS:
        hit = F.lit(False)
        for word in words:
            hit = hit | lowered.contains(word)
        if pattern:
            near = F.lit(not signs)
            for sign in signs:
                near = near | lowered.contains(sign)
            hit = hit | (near & lowered.rlike(pattern))
        out = out.when(hit, name)
    return out.otherwise(OTHER_TOPIC)


def n_tokens(text: Column) -> Column:
    """White-space words, the token weight of a document."""
    blanks = r"[\x20\x09-\x0D]+"
    return F.coalesce(F.size(F.filter(F.split(text, blanks), lambda w: w != "")), F.lit(0)).cast("bigint")


def target_shares(cells: DataFrame, dimensions: list[str], temper: float = TEMPER) -> DataFrame:
    """``dimension, value, share``: tempered token shares of every value."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    parts = None
    for d in dimensions:
        values = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("t")).select(
            F.lit(d).alias("dimension"), "value",
            F.when(F.col("t") > 0, F.pow(F.col("t") / F.lit(float(max(1, total))), F.lit(temper))).otherwise(0.0).alias("p"))
        parts = values if parts is None else parts.unionByName(values)
    sums = parts.groupBy("dimension").agg(F.sum("p").alias("s"))
    return parts.join(sums, "dimension").select("dimension", "value", F.when(F.col("s") > 0, F.col("p") / F.col("s")).otherwise(0.0).alias("share"))


def rake(cells: DataFrame, targets: DataFrame, dimensions: list[str], iterations: int = ITERATIONS, cap: float | None = None) -> DataFrame:
    """``cells`` with ``weight``; the weighted tokens of all cells sum to 1, or to that of the targets.

    With a ``cap`` weights go on from those that ``cells`` have, and a weight above it counts as ``cap``. Targets are written once and weights after each dimension, so every step is one small plan over two small tables.
    """
    spark = cells.sparkSession
    folder = scratch_path(spark, "raking")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    targets = stored(targets.select("dimension", F.col("value").alias("_value"), "share"), "targets")
    current = cells.withColumn("weight", F.lit(1.0)) if cap is None else cells
    others = [c for c in cells.columns if c != "weight"]
    counted = F.col("weight") if cap is None else F.least(F.col("weight"), F.lit(cap))
    for i in range(iterations):
        for d in dimensions:
            mass = current.groupBy(F.col(d).alias("_have")).agg(F.sum(counted * F.col("tokens")).alias("_mass"))
            factor = mass.join(targets.filter(F.col("dimension") == d), F.col("_have").eqNullSafe(F.col("_value"))).select(
                "_have", F.when(F.col("_mass") > 0, F.col("share") / F.col("_mass")).otherwise(F.lit(0.0)).alias("_factor"))
            current = stored(current.join(factor, F.col(d).eqNullSafe(F.col("_have"))).select(
                *others, (F.col("weight") * F.col("_factor")).alias("weight")), f"{i}-{d}")
    return current


def _room(cells: DataFrame, targets: DataFrame, dimensions: list[str], budget: float) -> DataFrame:
    """``dimension, value, share``: expected tokens per value, in proportion to the targets but no more than the value has."""
    parts = None
    for d in dimensions:
        values = cells.groupBy(F.col(d).alias("_have")).agg(F.sum("tokens").alias("_all")).join(
            targets.filter(F.col("dimension") == d), F.col("_have").eqNullSafe(F.col("value"))).select("dimension", "value", "share", "_all")
        parts = values if parts is None else parts.unionByName(values)
    # Every step below is one small job over this table.
    path = scratch_path(cells.sparkSession, "room")
    parts.write.parquet(path)
    parts = cells.sparkSession.read.schema(parts.schema).parquet(path)
    levels = dict.fromkeys(dimensions, 0.0)

    def wanted() -> Column:
        level = F.create_map(*[x for d in dimensions for x in (F.lit(d), F.lit(levels[d]))])[F.col("dimension")]
        return F.col("share") * level

    # Values that are taken whole only become more, so the levels rise until they stand.
    for _ in range(_STEPS):
        whole = wanted() >= F.col("_all")
        sums = parts.groupBy("dimension").agg(F.sum(F.when(whole, F.col("_all")).otherwise(0)).alias("full"),
                                              F.sum(F.when(whole, 0.0).otherwise(F.col("share"))).alias("open")).collect()
        found = levels | {r["dimension"]: max(levels[r["dimension"]], (budget - r["full"]) / r["open"]) for r in sums if r["open"] > 0}
        if all(found[d] <= levels[d] * (1 + 1e-12) for d in dimensions):
            break
        levels = found
    else:
        raise ArithmeticError(f"levels still rise after {_STEPS} steps")
    return parts.select("dimension", "value", F.least(wanted(), F.col("_all").cast("double")).alias("share"))


def _scale(cells: DataFrame, budget: float) -> float:
    """The factor of all weights at which the expected tokens, at probabilities of at most 1, are ``budget``."""
    factor = 0.0
    for _ in range(_STEPS):
        whole = F.col("weight") * F.lit(factor) >= 1
        full, rest = cells.agg(F.sum(F.when(whole, F.col("tokens")).otherwise(0)), F.sum(F.when(whole, 0.0).otherwise(F.col("weight") * F.col("tokens")))).first()
        found = (budget - (full or 0)) / rest if rest else factor
        if found <= factor * (1 + 1e-12):
            return factor
        factor = found
    raise ArithmeticError(f"the scale still rises after {_STEPS} steps")


def probabilities(cells: DataFrame, targets: DataFrame, dimensions: list[str], kept: float = KEPT, iterations: int = ITERATIONS) -> DataFrame:
    """``cells`` of ``rake`` with ``probability``."""
    total, mass, top = cells.agg(F.sum("tokens"), F.sum(F.col("weight") * F.col("tokens")), F.max("weight")).first()
    top = top or 1.0
    budget = kept * (total or 0)
    if not mass or mass / top >= budget:
        return cells.withColumn("probability", F.col("weight") / F.lit(float(top)))
    start = cells.withColumn("_fitted", F.col("weight")).withColumn("weight", F.col("weight") * F.lit(budget / mass))
    capped = rake(start, _room(cells, targets, dimensions, budget), dimensions, iterations, cap=1.0)
    factor = _scale(capped, budget)
    return capped.select(*[c for c in cells.columns if c != "weight"], F.col("_fitted").alias("weight"),
                         F.least(F.lit(1.0), F.col("weight") * F.lit(factor)).alias("probability"))


def draw(id_col: Column) -> Column:
    """A number in [0, 1) from the MD5 of the id (its first eight hexadecimal digits)."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
        targets: DataFrame | None = None, temper: float = TEMPER, iterations: int = ITERATIONS, keep: list[str] | None = None,
        kept: float = KEPT) -> DataFrame:
    """``keep`` columns (default: all) and ``_tokens, _topic, _weight, _probability, _drawn`` for every row."""
    keep = docs.columns if keep is None else keep
    named = [f"_k{i}" for i in range(len(keep))]
    read = docs.select(*[docs[c].alias(n) for c, n in zip(keep, named)], docs[source_col].alias("_source"), docs[lang_col].alias("_lang"),
                       draw(docs[id_col]).alias("_draw"), docs[text_col].alias("_text"), F.lower(docs[text_col]).alias("_lowered"))
    folder = scratch_path(docs.sparkSession, "mixing")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return docs.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    # Texts are read for topics and tokens once.
    rows = stored(read.select(*named, "_source", "_lang", "_draw", topic(F.col("_lowered")).alias("_topic"), n_tokens(F.col("_text")).alias("_tokens")), "rows")
    cells = stored(rows.groupBy(F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic")).agg(
        F.sum("_tokens").alias("tokens"), F.count("*").alias("n_docs")), "cells")
    targets = target_shares(cells, DIMENSIONS, temper) if targets is None else targets
    fitted = probabilities(rake(cells, targets, DIMENSIONS, iterations), targets, DIMENSIONS, kept, iterations)
    weights = fitted.select(F.col("source").alias("_s"), F.col("lang").alias("_l"), F.col("topic").alias("_t"), F.col("weight").alias("_weight"),
                            F.col("probability").alias("_probability"))
    joined = rows.join(weights, F.col("_source").eqNullSafe(F.col("_s")) & F.col("_lang").eqNullSafe(F.col("_l")) & (F.col("_topic") == F.col("_t")), "left")
    return joined.select(*[F.col(n).alias(c) for n, c in zip(named, keep)], "_tokens", "_topic", "_weight", "_probability", (F.col("_draw") < F.col("_probability")).alias("_drawn"))
