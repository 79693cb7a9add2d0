"""Every registered query against its SQL twin, and what its plan may not contain."""

import os
import shutil
import subprocess
import sys

import pytest
from oracle import compare, connect

from retainframe.queries import all_queries, all_sql

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, sf_dir, con):
    equal, message = compare(QUERIES[name](spark, sf_dir), con, SQL[name])
    assert equal, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() >= 0


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["visit_features", "churn_label", "knn_neighbours", "retrieve_topk", "publish_queue", "post_report_totals"])
def test_no_cross_join(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("gone", ["retainframe/llm corpus_pipeline.py", "retainframe/llm", "corpus_pipeline.py"])
def test_entry_point_without_training_data_operators(tmp_path, gone):
    """The other queries stay registered where the subpackage, the pipeline or both are left out."""
    left_out = shutil.ignore_patterns(".git", "__pycache__", "tests", *(os.path.basename(g) for g in gone.split()))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=left_out)
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), any(q.startswith('op') for q in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""}, timeout=120)
    assert out.returncode == 0, out.stderr
    operators = "retainframe/llm" not in gone and os.path.isdir(os.path.join(ROOT, "retainframe", "llm"))
    number, pipeline, others = out.stdout.split()
    assert int(number) >= len(QUERIES) and pipeline == "False" and others == str(operators)
