from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loomwork.functions import arrays, maps, text


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


@pytest.mark.parametrize("given, score", [
    ("5", 5), ("-3", -3), ("+7", 7), ("", 0), ("abc", 0), ("5.7", 0), (" 5 ", 0), ("5\n", 0), ("1_0", 0),
    ("99999999999999999999", 0), (None, 0)])
def test_parse_score(spark, given, score):
    assert one(spark, s=text.parse_score(F.lit(given).cast("string"))).s == score


@pytest.mark.parametrize("s", [0, 59, 3600, 86399, 86400, 172801, 1e7, 59.9])
def test_durations_print_like_timedelta(spark, s):
    assert one(spark, d=text.format_duration(F.lit(float(s)))).d == str(timedelta(seconds=int(s)))


def test_text(spark):
    ts = F.lit(datetime(2024, 2, 3, 4, 5, 6, 789000))
    row = one(
        spark, a=text.strip_bucket(F.lit("b/x/y"), "b"), b=text.strip_bucket(F.lit("b"), "b"),
        c=text.strip_bucket(F.lit("bb/x"), "b"), d=text.percent(F.lit(1), F.lit(3)), e=text.percent(F.lit(5), F.lit(0)),
        f=text.replace_first(F.lit("a{{x}}b{{x}}"), "{{x}}", F.lit("{{x}}")), g=text.split_list(F.lit(" q , v")),
        h=text.epoch_ms(ts), i=text.day_tag(ts), j=text.stamp(ts), k=text.checkpoint_key(F.lit("r")),
        l=text.checkpoint_key(F.lit("r")), m=text.checkpoint_path(F.lit("p/q")), n=text.label_text(F.lit(None).cast("int")),
        o=text.label_text(F.lit(0.71)), p=text.replace_first(F.lit("plain"), "{{x}}", F.lit("no")))
    assert row[:8] == ("x/y", "", "bb/x", 33.33, 100.0, "a{{x}}b{{x}}", ["q", "v"], 1706933106000)
    assert (row.i, row.j, row.m, row.n, row.o, row.p) == (
        "20240203", "2024-02-03 04:05:06", "/checkpoint/p/q", "None", "0.71", "plain")
    assert row.k == row.l and len(row.k) == 7


def test_maps(spark):
    feature = "named_struct('name', '{}', 'map_to', '{}')"
    many = F.expr("array(" + ",".join(feature.format(*p) for p in [
        ("response", "x"), ("extra", "y"), ("response", "q"), ("instruction", "w")]) + ")")
    none = F.expr("array(" + feature.format("extra", "y") + ")")
    row = one(
        spark, a=maps.merge_maps(F.expr("map('a','1')"), F.expr("map('a','2','b','3')")),
        b=maps.invert_map(F.expr("map('a','1','b','1','c','2')")), c=maps.features_map(many), d=maps.features_json(many),
        e=maps.features_map(none), f=maps.features_json(none),
        g=maps.parse_columns(F.lit('{"instruction":"w"}')), h=maps.merge_maps(F.lit(None).cast("map<string,string>"), F.expr("map('k','v')")))
    assert row.a == {"a": "1", "b": "3"} and row.b == {"1": "b", "2": "c"}
    assert row.c == {"response": "q", "instruction": "w"} and row.d == '{"instruction":"w","response":"q"}'
    assert row.e is None and row.f == "" and row.g == {"instruction": "w"} and row.h == {"k": "v"}


def test_arrays(spark):
    a = F.lit([1, 2, 3])
    row = one(
        spark, a=arrays.pad_right(a, 5, 0), b=arrays.pad_left(a, 5, 0), c=arrays.fit_left(a, 2, 0),
        d=arrays.fit_left(a, 4, 9), e=arrays.blank_head(a, 2, 7), f=arrays.blank_head(a, 9, 7),
        g=arrays.unmask(F.lit([-100, 4]), 8), h=arrays.drop_masked(F.lit([-100, 4])), i=arrays.pad_right(a, 2, 0),
        j=arrays.head(a, -1))
    assert tuple(row) == ([1, 2, 3, 0, 0], [0, 0, 1, 2, 3], [1, 2], [9, 1, 2, 3], [7, 7, 3], [7, 7, 7],
                          [8, 4], [4], [1, 2, 3], [])
