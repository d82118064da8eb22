"""Generated id arrays to text pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions import arrays
from loomwork.functions.text import col
from loomwork.functions.tokenizers import Tokenizer

# Spaces a decoder takes back before punctuation and English contractions, in order.
SPACE_CLEANUPS = [
    (" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"),
    (" n't", "n't"), (" 'm", "'m"), (" 's", "'s"), (" 've", "'ve"), (" 're", "'re"),
]


def clean_spaces(text: Column | str) -> Column:
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), SPACE_CLEANUPS, col(text))


def fit_labels(df: DataFrame, pad_id: int, labels: str = "label_ids", prompt_len: str = "prompt_len") -> DataFrame:
    """Bring labels to the prompt length: left-pad a shorter array, cut a longer one."""
    return df.withColumn(labels, arrays.fit_left(labels, F.col(prompt_len), pad_id))


def blank_prompt(df: DataFrame, pad_id: int, generated: str = "generated", prompt_len: str = "prompt_len") -> DataFrame:
    """Overwrite the prompt part of the generated ids."""
    return df.withColumn(generated, arrays.blank_head(generated, F.col(prompt_len), pad_id))


def pad_to(ids: Column | str, n: Column | int, pad_id: int) -> Column:
    return arrays.pad_right(ids, n, pad_id)


def pad_generated(df: DataFrame, tok: Tokenizer, max_length: int, max_new_tokens: int | None = None,
                  columns: tuple[str, ...] = ("generated", "label_ids")) -> DataFrame:
    """Right-pad to ``max_length``; ids that long already go to ``max_new_tokens + 1``."""
    for name in columns:
        size = F.size(name)
        goal = F.when(size < max_length, F.lit(max_length))
        if max_new_tokens is not None:
            goal = goal.when(size < max_new_tokens + 1, F.lit(max_new_tokens + 1))
        df = df.withColumn(name, pad_to(name, goal.otherwise(size), tok.pad_id))
    return df


def prediction_texts(df: DataFrame, tok: Tokenizer, keep: list[str] | None = None) -> DataFrame:
    """``label`` and ``predict`` texts: prompt blanked, ignored labels padded, specials skipped."""
    blanked = blank_prompt(df, tok.pad_id)

    def text(name: str) -> Column:
        return clean_spaces(tok.decode(arrays.unmask(name, tok.pad_id), skip_special=True))

    return blanked.select(*(keep or []), text("label_ids").alias("label"), text("generated").alias("predict"))
