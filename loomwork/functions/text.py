"""Scalar Column functions. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """Null and the empty string are one thing here; blank-only text is not empty."""
    return F.coalesce(col(c), F.lit("")) == ""


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def parse_score(c: Column | str) -> Column:
    """Whole text as a signed 64-bit integer, else 0. No trimming, no decimals."""
    s = col(c)
    return F.when(s.rlike(r"^[+-]?[0-9]+\z"), F.coalesce(s.try_cast("bigint"), F.lit(0))).otherwise(F.lit(0)) \
        .cast("bigint")


def strip_bucket(path: Column | str, bucket: Column | str) -> Column:
    """Drop the first path segment when it equals the bucket name."""
    p = col(path)
    b = F.lit(bucket) if isinstance(bucket, str) else bucket
    return F.when(F.substring_index(p, "/", 1) == b, F.substr(p, F.length(b) + F.lit(2))).otherwise(p)


def format_duration(seconds: Column | str) -> Column:
    """``[N day(s), ]H:MM:SS`` of the whole seconds; hours are not zero-padded."""
    s = col(seconds).cast("bigint")
    days = F.floor(s / 86400).cast("bigint")
    rest = s - days * 86400
    clock = F.format_string(
        "%d:%02d:%02d",
        F.floor(rest / 3600).cast("bigint"), F.floor(rest % 3600 / 60).cast("bigint"), rest % 60,
    )
    unit = F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, "))
    return F.when(days == 0, clock).otherwise(F.concat(days.cast("string"), unit, clock))


def percent(current: Column | str, maximum: Column | str) -> Column:
    """Share of ``maximum`` in percent with two decimals; 100 when the maximum is 0."""
    m = col(maximum)
    return F.when(m == 0, F.lit(100.0)).otherwise(F.round(col(current) / F.nullif(m, F.lit(0)) * 100, 2))


def replace_first(text: Column | str, what: str, value: Column) -> Column:
    """Replace the first occurrence of a literal; the inserted text is not looked at again."""
    t = col(text)
    at = F.instr(t, what)
    return F.when(at == 0, t).otherwise(
        F.concat(F.substr(t, F.lit(1), at - 1), value, F.substr(t, at + F.lit(len(what)))))


def epoch_ms(ts: Column | str) -> Column:
    """Whole epoch seconds as milliseconds."""
    return F.unix_seconds(col(ts).cast("timestamp")) * 1000


def day_tag(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyyMMdd")


def stamp(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd HH:mm:ss")


def checkpoint_key(run: Column | str, key: Column | str | None = None) -> Column:
    """``<run>-<5 characters>``; the suffix is a digest, so a rerun gives the same key."""
    r = col(run)
    return F.concat(r, F.lit("-"), F.substr(F.sha2(col(key) if key is not None else r, 256), F.lit(1), F.lit(5)))


def checkpoint_path(path: Column | str) -> Column:
    return F.concat(F.lit("/checkpoint/"), col(path))


def split_list(c: Column | str) -> Column:
    """Comma list to trimmed items."""
    return F.transform(F.split(col(c), ","), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))


def label_text(c: Column | str) -> Column:
    """Label value of any column; a missing value prints as ``None``."""
    return F.coalesce(col(c).cast("string"), F.lit("None"))
