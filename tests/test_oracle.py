"""Every registered query against its SQL check on the smallest tables, and the shape of all plans."""

import re

import pytest

from conftest import SMALL
from salesloom.checks.compare import connect, differences, normal
from salesloom.checks.oracle import SQL
from salesloom.plans.registry import callables

QUERIES = callables()
ROWS_ONLY = {"r2_r3_cluster_scores", "r4_r7_segments", "r5_k08_segment_profile", "r6_segment_labels", "v10a_recency_monetary",
             "i15_reactivation_value", "s09_segment_csv"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_check_or_is_a_model():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython", plan)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    assert got[1], "no rows"
    if name in SQL:
        result = duck.execute(SQL[name])
        want = normal([d[0] for d in result.description], result.fetchall())
        assert not differences(got, want)


def test_entry_works_without_the_training_operators(monkeypatch, capsys):
    """A folder that is gone and one that can't be imported both cost only their own queries."""
    import sys

    import __spark_entry__ as entry
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("salesloom.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)  # importing it raises ImportError
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(SQL)
    assert "left out: salesloom.llm.queries" in capsys.readouterr().err
