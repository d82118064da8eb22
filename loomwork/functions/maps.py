"""Map and JSON Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwork.functions.text import col


def merge_maps(base: Column | str, custom: Column | str) -> Column:
    """Union of two maps in which the base wins."""
    b = F.coalesce(col(base), F.create_map().cast("map<string,string>"))
    c = F.coalesce(col(custom), F.create_map().cast("map<string,string>"))
    return F.map_concat(b, F.map_filter(c, lambda k, v: ~F.map_contains_key(b, k)))


def last_entries(entries: Column) -> Column:
    """Keep the last entry of each key in an array of ``struct<key,value>``."""
    return F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + F.lit(2), F.size(entries)), lambda later: later["key"] == e["key"]),
    )


def invert_map(m: Column | str) -> Column:
    """Swap keys and values; of several keys with one value the last wins."""
    swapped = F.transform(F.map_entries(col(m)), lambda e: F.struct(e["value"].alias("key"), e["key"].alias("value")))
    return F.map_from_entries(last_entries(swapped))


def features_map(features: Column | str) -> Column:
    """``array<struct<name,map_to>>`` to a map of the two mapped columns, null when neither is there."""
    wanted = F.filter(col(features), lambda f: f["name"].isin("instruction", "response"))
    pairs = F.transform(
        wanted, lambda f: F.struct(f["name"].alias("key"), F.coalesce(f["map_to"], F.lit("")).alias("value")))
    return F.when(F.size(pairs) > 0, F.map_from_entries(last_entries(pairs)))


def features_json(features: Column | str) -> Column:
    """The features map as JSON text with keys in alphabetical order; empty text when there is none."""
    m = features_map(features)
    ordered = F.map_from_entries(F.sort_array(F.map_entries(m)))
    return F.coalesce(F.to_json(ordered), F.lit(""))


def parse_columns(text: Column | str) -> Column:
    """The text form of a columns map back to a map."""
    return F.from_json(col(text), "map<string,string>")
