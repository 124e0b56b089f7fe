"""Every registered query against its SQL on the smallest tables, and its plan.

``AIRLAKE_QUERIES`` names some to run instead of all. Queries of optional parts have
tests of their own.
"""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from airlake.scratch import sweep
from check import compare, connect

FOLDER = Path("/root/testdata/sf0.001")
OPTIONAL = {name for name, run in entry.queries().items() if not run.__module__.startswith("airlake.plans.")}
NAMES = os.environ.get("AIRLAKE_QUERIES", "").split() or sorted(set(entry.queries()) - OPTIONAL)

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def connection():
    return connect(str(FOLDER))


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, connection, plan, name):
    frame = entry.queries()[name](spark, str(FOLDER))
    shown = plan(frame)
    for unwanted in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas"):
        assert unwanted not in shown
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert compare(frame, connection, sql).startswith("ok")
    sweep(spark)


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("pipeline_stays", [False, True])
def test_the_rest_stands_alone(tmp_path, pipeline_stays):
    """Without the optional parts all other queries are there, with the same SQL."""
    root = Path(entry.__file__).parent
    hidden = ["llm", "tests", "__pycache__", ".git", *([] if pipeline_stays else ["corpus_pipeline.py"])]
    alone = tmp_path / "alone"
    shutil.copytree(root, alone, ignore=shutil.ignore_patterns(*hidden))
    told = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"],
        cwd=alone, env={**os.environ, "PYTHONPATH": str(alone)}, capture_output=True, text=True, check=True,
    )
    queries, oracles = (line.split() for line in told.stdout.splitlines()[-2:])
    assert queries == sorted(set(entry.queries()) - OPTIONAL)
    assert oracles == sorted(set(entry.oracle_sql()) - OPTIONAL)
