"""Raw instruction tables to training examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.functions.text import is_blank

# The columns of an instruction table and what they are called afterwards.
BASE_COLUMNS = {"instruction": "instruction", "output": "response"}


def map_columns(df: DataFrame, features: dict[str, str] | None = None) -> DataFrame:
    """Rename by the base map, overlaid by the inverse of ``features`` (``{feature: source}``)."""
    renames = {**BASE_COLUMNS, **{source: feature for feature, source in (features or {}).items()}}
    targets: dict[str, str] = {}
    for name in df.columns:
        target = renames.get(name, name)
        if target in targets:
            raise ValueError(f"columns {targets[target]!r} and {name!r} both become {target!r}")
        targets[target] = name
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns and k != v})


def build_examples(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``instruction[\\nquery]`` and ``response``, with ``history`` and ``system`` where present."""
    query = F.col("instruction")
    if "query" in df.columns:
        query = F.when(is_blank("query"), query).otherwise(F.concat(query, F.lit("\n"), F.col("query")))
    optional = [c for c in ("history", "system") if c in df.columns]
    return df.select(*(keep or []), query.alias("query"), "response", *optional)


def filter_valid(df: DataFrame) -> DataFrame:
    """Rows whose query and response are not empty. Blank-only text passes."""
    return df.filter((F.col("query") != "") & (F.col("response") != ""))


def rejects(df: DataFrame) -> DataFrame:
    """The rows ``filter_valid`` drops, with the reason."""
    no_query, no_response = is_blank("query"), is_blank("response")
    return df.filter(no_query | no_response).withColumn(
        "reason",
        F.when(no_query & no_response, "empty query and response").when(no_query, "empty query")
        .otherwise("empty response"))
