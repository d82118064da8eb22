"""Id-array Column functions: padding, masking, cutting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwork.functions.text import col

# Fixed value: the label of a position the loss ignores.
IGNORE_INDEX = -100


def literal(ids: list[int]) -> Column:
    """An id list as one constant; a long list costs one call instead of one per id."""
    return F.expr(f"array({', '.join(map(str, ids))})") if ids else F.array().cast("array<int>")


def _int(value: Column | int) -> Column:
    return F.lit(value) if isinstance(value, int) else value


def head(ids: Column | str, n: Column | int) -> Column:
    return F.slice(col(ids), F.lit(1), F.greatest(_int(n), F.lit(0)))


def pad_right(ids: Column | str, n: Column | int, value: Column | int) -> Column:
    """Extend to length ``n``; longer arrays stay as they are."""
    a = col(ids)
    return F.concat(a, F.array_repeat(_int(value), F.greatest(_int(n) - F.size(a), F.lit(0))))


def pad_left(ids: Column | str, n: Column | int, value: Column | int) -> Column:
    a = col(ids)
    return F.concat(F.array_repeat(_int(value), F.greatest(_int(n) - F.size(a), F.lit(0))), a)


def fit_left(ids: Column | str, n: Column | int, value: Column | int) -> Column:
    """Exactly ``n`` items: left-pad a shorter array, keep the head of a longer one."""
    return pad_left(head(ids, n), n, value)


def blank_head(ids: Column | str, n: Column | int, value: Column | int) -> Column:
    """Overwrite the first ``n`` items."""
    a = col(ids)
    k = F.least(_int(n), F.size(a))
    return F.concat(F.array_repeat(_int(value), k), F.slice(a, k + F.lit(1), F.size(a)))


def unmask(ids: Column | str, value: Column | int) -> Column:
    """Replace ignored positions by a real id."""
    return F.transform(col(ids), lambda x: F.when(x == IGNORE_INDEX, _int(value)).otherwise(x))


def drop_masked(ids: Column | str) -> Column:
    return F.filter(col(ids), lambda x: x != IGNORE_INDEX)


def count_unmasked(ids: Column | str) -> Column:
    return F.size(drop_masked(ids))
