"""Line-first cleaning with rules of punctuation, navigation and boilerplate, in DataFrame functions.

Each line is judged by itself, failing lines go, and a document that loses more than ``max_loss`` of its word
characters is rejected. The base measures (word characters, symbols, equal lines, repeated five-word windows)
are of the whole text. Everything is computed inside the row: no shuffle, no Python.

Defined results: a null or empty text has no words, all measures 0, ``base_failed`` true and ``kept`` false; an empty
table gives an empty table; equal rows get equal results; columns other than the text are passed through by ``keep``.
Repeated windows are compared by a 64-bit hash inside one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Blanks of the word pattern, counted symbols.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

TERMINAL = r"""[.!?:;…。！？]["')\]»”’]*[\x20\x09-\x0D]*$"""
NAVIGATION = r"(?i)^[\x20\x09-\x0D]*(home|menu|about( us)?|contact( us)?|login|log in|sign (in|up)|subscribe|next|previous|back to top|share|skip to content)[\x20\x09-\x0D]*[.:]?[\x20\x09-\x0D]*$"
SEPARATORS = r"([|»>•·][^|»>•·]*){3,}"
BOILERPLATE = (r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie policy|use of cookies|accept cookies|"
               r"enable javascript|lorem ipsum|click here|powered by)")
MIN_BARE_WORDS = 5


def words(text: Column) -> Column:
    """Array of words ``[^\\x20\\x09-\\x0D]+``."""
    return F.filter(F.split(text, BLANK_CLASS), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, BLANKS, "")).cast("bigint")


def line_fails(line: Column) -> Column:
    """Navigation, boilerplate, or a short line with no punctuation at its end. Blank lines never fail."""
    bare = ~line.rlike(TERMINAL) & (F.size(words(line)) < MIN_BARE_WORDS)
    return line.rlike(WORD_CLASS) & (bare | line.rlike(NAVIGATION) | line.rlike(SEPARATORS) | line.rlike(BOILERPLATE))


def clean_lines(docs: DataFrame, text_col: str = "text", out: str = "clean_text") -> DataFrame:
    """Add ``out``: the text without its failing lines (null stays null)."""
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda line: ~line_fails(line))
    return docs.withColumn(out, F.array_join(kept, "\n"))


def _equal_neighbours(numbered: Column) -> Column:
    """Places of the entries of (hash, place), sorted by hash, whose hash stands beside them once more; sorted by place."""
    none = F.array(F.lit(None).cast("bigint"))
    before = F.concat(none, F.slice(numbered["g"], 1, F.size(numbered) - 1))
    after = F.concat(F.slice(numbered["g"], 2, F.size(numbered) - 1), none)
    rows = F.arrays_zip(numbered["g"].alias("g"), numbered["i"].alias("i"), before.alias("b"), after.alias("a"))
    same = F.filter(rows, lambda x: F.coalesce(x["g"] == x["b"], F.lit(False)) | F.coalesce(x["g"] == x["a"], F.lit(False)))
    return F.array_sort(F.transform(same, lambda x: x["i"]))


def _covered(places: Column) -> Column:
    """Words under windows that begin at these sorted places: up to the next one, ``WINDOW`` at most."""
    gaps = F.zip_with(places, F.slice(places, 2, F.size(places)),
                      lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    return F.aggregate(gaps, F.lit(0), lambda total, x: total + x).cast("bigint")


def measure(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, max_loss: float = 0.5) -> DataFrame:
    """``keep`` columns and ``n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed lost kept``."""
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    named = [docs[c].alias(f"_k{i}") for i, c in enumerate(keep)]
    carried = [f"_k{i}" for i in range(len(keep))]
    text = F.col("_text")
    split = docs.select(*named, F.coalesce(docs[text_col], F.lit("")).alias("_text")).select(
        *carried, "_text", words(text).alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CLASS)).alias("_lines"))
    w = F.col("_words")
    grams = F.when(F.size(w) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        *carried, F.size(w).cast("bigint").alias("n_words"), word_chars(text).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        grams.alias("_grams"),
        word_chars(F.array_join(F.filter("_lines", line_fails), "\n")).alias("_lost"))
    # One projection per step, so that no sort is computed twice; texts without equal windows skip it.
    g, counts = F.col("_grams"), ["n_words", "word_chars", "n_symbols", "n_dup_lines", "_lost"]
    numbered = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
    equal = counted.select(*carried, *counts, F.when(F.size(F.array_distinct(g)) < F.size(g), numbered).alias("_numbered"))
    placed = equal.select(*carried, *counts, F.when(F.col("_numbered").isNotNull(), _equal_neighbours(F.col("_numbered"))).alias("_at"))
    measured = placed.select(
        *carried, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("_at").isNotNull(), _covered(F.col("_at"))).otherwise(F.lit(0).cast("bigint")).alias("n_repeat_words"),
        F.when(F.col("word_chars") > 0, F.col("_lost") / F.col("word_chars")).otherwise(F.lit(0.0)).alias("lost"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.select(
        *[F.col(k).alias(c) for k, c in zip(carried, keep)], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "lost", (~failed & (F.col("lost") <= max_loss)).alias("kept"))
