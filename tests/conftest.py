from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tools"):
    sys.path.insert(0, str(folder))

from airlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        cpus=4, memory="4g",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a small frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


@pytest.fixture
def plan(capsys):
    """The executed plan of a frame as text."""

    def text(df) -> str:
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


@pytest.fixture
def tiny(spark):
    """Nine vertices whose paths and components are known by hand."""
    from airlake.graph import Graph

    country = {1: "A", 2: "A", 5: "B", 6: "B"}
    vertices = [(i, str(i), f"City {i}", country.get(i, "C")) for i in range(1, 10)]
    edges = [
        (1, 5, 10.0, 1), (1, 3, 4.0, 1), (3, 5, 3.0, 1), (2, 3, 5.0, 1), (3, 4, 2.0, 1),
        (4, 6, 6.0, 1), (4, 1, 1.0, 1), (7, 8, 1.0, 1), (8, 7, 1.0, 1), (9, 7, 2.0, 1),
    ]
    return Graph(
        spark.createDataFrame(vertices, "id BIGINT, code STRING, city STRING, country STRING"),
        spark.createDataFrame(edges, "src BIGINT, dst BIGINT, distance_km DOUBLE, airlines BIGINT"),
    )


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


pytest.tuples = tuples
