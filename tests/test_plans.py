"""No named query may plan a cross join, a window over everything, or Python where it is not meant to run."""

import pytest

from loomwork.functions.templates import TEMPLATES
from loomwork.plans.oracle import ORACLE
from loomwork.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"

# The longest common subsequence alone runs in Python.
SCORED = {"text_scores", "document_scores", "score_runs"}
# Its reader is Python; what follows is not.
FED = {"feed_source"}
# One row, or one row per list of queries that is at most as long as its limit.
ONE_ROW = {"preview"}


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_") and n != "upsert_status"])
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert name in ONE_ROW or "SinglePartition" not in plan
    assert name in SCORED | FED or not any(x in plan for x in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow"))


@pytest.mark.parametrize("name", ["word_ids", "downsample", "best_version", "references"])
def test_shuffles_and_scans_are_as_few_as_planned(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # The documents once, the vocabulary for its frequent and its other pieces.
    scans, exchanges = plan.count("FileScan"), plan.count("Exchange hashpartitioning")
    most_scans, most_exchanges = {"word_ids": (3, 3), "downsample": (1, 1), "best_version": (5, 5), "references": (1, 1)}[name]
    assert scans <= most_scans and exchanges <= most_exchanges


def test_every_template_has_its_query():
    assert {f"encode_{name}" for name in TEMPLATES} <= set(QUERIES)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
