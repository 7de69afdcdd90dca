"""The driver's entry points, with and without the training-data operators."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_points

ROOT = Path(__file__).parent.parent


def test_sql_belongs_to_queries():
    queries, sql = entry_points.queries(), entry_points.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 60 and all(isinstance(s, str) for s in sql.values())


def test_the_rest_imports_without_the_operators():
    code = "import sys; sys.modules['logloom.llm'] = sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert len(e.queries()) > 50 and not [q for q in e.queries() if q.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


@pytest.mark.skipif(not Path(entry_points.ENTRY_DIR).exists(), reason="no test data here")
def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0
