"""Text scores of predictions, scorer plug-ins, side-by-side comparison.

Tokens are the words of ``vocabulary.pieces``, case kept. ROUGE follows Lin (2004) with the F1 of each
pair averaged per group; BLEU-4 follows Papineni et al. (2002) on the counts of the whole group.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.operators.vocabulary import pieces, split_words

MAX_NGRAM = 4
# Words of one side compared at once: a table of bit sets of this many bits is what a pair needs besides its words.
LCS_BLOCK = 8192


# ---------------------------------------------------------------- longest common subsequence

def lcs_length(a: list, b: list, block: int = LCS_BLOCK) -> int:
    """Longest common subsequence, bit-parallel (Crochemore et al., 2001), a block of ``b`` at a time.

    A block is one integer that every word of ``a`` updates by an addition. What the addition carries out of the
    block, one bit per word of ``a``, goes into the next one, so the memory is that of ``a`` and one block.
    """
    carried, length = bytearray(len(a)), 0
    for begin in range(0, len(b), block):
        part = b[begin:begin + block]
        where: dict = {}
        for i, token in enumerate(part):
            where[token] = where.get(token, 0) | (1 << i)
        width = len(part)
        full = (1 << width) - 1
        row = full
        for i, token in enumerate(a):
            hit = where.get(token, 0) & row
            if hit or carried[i]:
                total = row + hit + carried[i]
                carried[i] = total >> width
                row = (total & full) | (row & ~where.get(token, 0))
        length += width - row.bit_count()
    return length


@F.pandas_udf(T.IntegerType())
def common_subsequence(predict: pd.Series, label: pd.Series) -> pd.Series:
    """Words in the longest common subsequence; its own function, so only those who ask for ROUGE-L pay for it."""
    return pd.Series([lcs_length(split_words(a or ""), split_words(b or "")) for a, b in zip(predict, label)], dtype="int32")


# ---------------------------------------------------------------- n-grams

def longer(grams: Column, words: Column, n: int) -> Column:
    """Hashes of the runs of ``n`` words from those of ``n - 1`` and of the single words."""
    many = F.greatest(F.size(words) - (n - 1), F.lit(0))
    return F.zip_with(F.slice(grams, F.lit(1), many), F.slice(words, F.lit(n), many), lambda g, w: F.xxhash64(g, w))


def repeats(ordered: Column) -> Column:
    """Of items in order those that equal the one before: every item once less than it was there."""
    return F.when(F.size(F.array_distinct(ordered)) < F.size(ordered), F.filter(ordered, lambda x, i: x == F.get(ordered, i - 1))) \
        .otherwise(F.array().cast("array<bigint>"))


def clipped_matches(a: Column, b: Column) -> Column:
    """Items of one array found in the other, each at most as often as that has it, in one pass over both in order.

    The lowest bit of an item tells its side, so equal items of ``a`` stand right before those of ``b``. The pass counts
    those of ``a`` that are still free and takes one for every one of ``b``.
    """
    tagged = lambda items, side: F.transform(items, lambda x: x.bitwiseAND(F.lit(-2)).bitwiseOR(F.lit(side)))
    both = F.sort_array(F.concat(tagged(a, 0), tagged(b, 1)))
    start = F.struct(F.lit(0).cast("bigint").alias("item"), F.lit(0).alias("free"), F.lit(0).alias("found"))

    def step(state: Column, x: Column) -> Column:
        item, of_a = x.bitwiseAND(F.lit(-2)), x.bitwiseAND(F.lit(1)) == 0
        free = F.when(state["item"] == item, state["free"]).otherwise(F.lit(0))
        taken = ~of_a & (free > 0)
        return F.struct(item.alias("item"), F.when(of_a, free + 1).when(taken, free - 1).otherwise(free).alias("free"),
                        F.when(taken, state["found"] + 1).otherwise(state["found"]).alias("found"))
    # Most texts share no repeated n-gram.
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0)).otherwise(F.aggregate(both, start, step, lambda state: state["found"]))


def with_overlap(pairs: DataFrame) -> DataFrame:
    """Add ``overlap``: word counts and clipped n-gram matches of each pair.

    The multisets need the two whole texts of one row and nothing else, so they are array expressions of the row:
    exploding n-grams would shuffle several times the corpus instead. N-grams are 64-bit hashes; two of one pair are
    taken for one by a chance of their number squared in 2^64. A match is a common n-gram, counted once by an
    intersection of sets, and once more for each repeat that both sides have left.
    """
    sides = {"a": "predict", "b": "label"}
    # One step after another, since Spark evaluates a column once that several later ones use.
    rows = pairs.select("*", *(F.transform(F.coalesce(pieces(text), F.array().cast("array<string>")), lambda w: F.xxhash64(w)).alias(f"_1{side}")
                               for side, text in sides.items()))
    for n in range(2, MAX_NGRAM + 1):
        rows = rows.select("*", *(longer(F.col(f"_{n - 1}{side}"), F.col(f"_1{side}"), n).alias(f"_{n}{side}") for side in sides))
    each = range(1, MAX_NGRAM + 1)
    rows = rows.select(*pairs.columns, F.size("_1a").alias("_na"), F.size("_1b").alias("_nb"),
                       *(F.size(F.array_intersect(f"_{n}a", f"_{n}b")).alias(f"_m{n}") for n in each),
                       *(F.sort_array(f"_{n}{side}").alias(f"_{n}{side}") for n in each for side in sides))
    rows = rows.select(*pairs.columns, "_na", "_nb", *(f"_m{n}" for n in each), *(repeats(F.col(f"_{n}{side}")).alias(f"_{n}{side}") for n in each for side in sides))
    matches = [(F.col(f"_m{n}") + clipped_matches(F.col(f"_{n}a"), F.col(f"_{n}b"))).alias(f"match_{n}") for n in each]
    return rows.select(*pairs.columns, F.struct(F.col("_na").alias("n_predict"), F.col("_nb").alias("n_label"), *matches).alias("overlap"))


def f1(match: Column, n_a: Column, n_b: Column) -> Column:
    """Harmonic mean of match/n_a and match/n_b; 0 when there is nothing to match."""
    total = F.greatest(n_a, F.lit(0)) + F.greatest(n_b, F.lit(0))
    return F.coalesce(2.0 * match / F.nullif(total, F.lit(0)), F.lit(0.0))


def text_scores(pairs: DataFrame, by: list[str], subsequence: bool = True) -> DataFrame:
    """``n_pairs, exact_match, rouge_1, rouge_2, rouge_l, bleu_4`` per group of ``(predict, label)`` rows.

    ``rouge_l`` is the one measure that is quadratic in a text; leave it out with ``subsequence=False``.
    """
    o = {name: F.col(f"overlap.{name}") for name in ["n_predict", "n_label", *(f"match_{n}" for n in range(1, MAX_NGRAM + 1))]}
    sums = [F.sum(o[f"match_{n}"]).alias(f"_m{n}") for n in range(1, MAX_NGRAM + 1)]
    sums += [F.sum(F.greatest(o["n_predict"] - (n - 1), F.lit(0))).alias(f"_g{n}") for n in range(1, MAX_NGRAM + 1)]
    counted = with_overlap(pairs)
    longest = []
    if subsequence:
        counted = counted.withColumn("_lcs", common_subsequence("predict", "label"))
        longest = [F.avg(f1(F.col("_lcs"), o["n_predict"], o["n_label"])).alias("rouge_l")]
    grouped = counted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg((F.col("predict") == F.col("label")).cast("double")).alias("exact_match"),
        F.avg(f1(o["match_1"], o["n_predict"], o["n_label"])).alias("rouge_1"),
        F.avg(f1(o["match_2"], o["n_predict"] - 1, o["n_label"] - 1)).alias("rouge_2"),
        *longest, F.sum(o["n_predict"]).alias("_c"), F.sum(o["n_label"]).alias("_r"), *sums,
    )
    log_precision = sum((F.log(F.col(f"_m{n}") / F.nullif(F.col(f"_g{n}"), F.lit(0)))
                         for n in range(1, MAX_NGRAM + 1)), F.lit(0.0)) / MAX_NGRAM
    any_zero = F.least(*(F.col(f"_m{n}") for n in range(1, MAX_NGRAM + 1))) == 0
    brevity = F.when(F.col("_c") >= F.col("_r"), F.lit(1.0)).otherwise(
        F.exp(1.0 - F.col("_r") / F.nullif(F.col("_c"), F.lit(0))))
    return grouped.withColumn("bleu_4", F.when(any_zero, F.lit(0.0)).otherwise(brevity * F.exp(log_precision))) \
        .select(*by, "n_pairs", "exact_match", "rouge_1", "rouge_2", *["rouge_l"] * subsequence, "bleu_4")


# ---------------------------------------------------------------- plug-ins

Scorer = Callable[[DataFrame, str], DataFrame]


def built_in_scorer(pairs: DataFrame, parameters: str = "") -> DataFrame:
    """Whole-number score per run: 100 times the ROUGE-L of its pairs, as text."""
    return text_scores(pairs, ["run"]).select("run", F.round(F.col("rouge_l") * 100).cast("int").cast("string").alias("score"))


SCORERS: dict[str, Scorer] = {}


def register_scorer(name: str, scorer: Scorer) -> None:
    """``scorer(pairs, parameters)`` gets ``(run, predict, label)`` rows and returns ``(run, score)``."""
    SCORERS[name] = scorer


def score_runs(pairs: DataFrame, plugin: str | None = None, parameters: str = "") -> DataFrame:
    """Scores by the named plug-in, or by the built-in scorer when none is configured."""
    if plugin and plugin not in SCORERS:
        raise ValueError(f"no scorer named {plugin!r}")
    return (SCORERS[plugin] if plugin else built_in_scorer)(pairs, parameters)


def compare_runs(predictions: DataFrame, runs: list[str], example: str = "example_id") -> DataFrame:
    """One row per example with the prediction of each named run beside the others."""
    return predictions.filter(F.col("run").isin(runs)).groupBy(example).pivot("run", runs).agg(F.max("predict"))
