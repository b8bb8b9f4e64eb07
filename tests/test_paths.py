"""Steps of long paths, counted in several tasks."""

from collections import Counter

import pytest

import __spark_entry__ as entry_points
from paneloom.operators import windows as W


@pytest.mark.parametrize("batch,steps", [("10000", W.STEPS), ("1", 2), ("7", 8)])
def test_path_steps_across_tasks(spark, monkeypatch, batch, steps):
    """A path that holds nearly all rows is counted in several tasks, none of which gets all of it, and alike
    whatever the batches and however often a task passes on its counts."""
    monkeypatch.setattr(W, "STEPS", steps)
    turns = [(1, t, "abc"[t * t % 3]) for t in range(4000)] + [(2, 0, "a"), (2, 1, None), (2, 2, "c"), (3, 0, "z"), (None, 1, "x"), (None, 2, "y")]
    expected = Counter()
    for key in (1, 2, 3, None):
        path = [n for k, _, n in turns if k == key]
        expected.update((a, b) for a, b in zip(path, path[1:]) if b is not None)
    df = spark.createDataFrame(turns, "k long, t long, node string").repartition(7)
    chosen = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": batch}
    before = {c: spark.conf.get(c) for c in chosen}
    for c, v in chosen.items():
        spark.conf.set(c, v)
    try:
        found = W.path_steps(df, "k", ["t"], "node")
        plan = found._jdf.queryExecution().toString()
        assert "collect_list" not in plan and "collect_set" not in plan
        assert {(r["src"], r["dst"]): r["n"] for r in found.collect()} == dict(expected)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert W.path_steps(df.limit(0), "k", ["t"], "node").count() == 0


def test_query_gathers_no_path(spark):
    plan = entry_points.queries()["path_edges"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "collect_list" not in plan
