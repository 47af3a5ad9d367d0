from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from perkmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]", "tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply a column function to texts: ``values(texts, function) -> list``."""
    def apply(texts, function):
        from pyspark.sql import functions as F
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        rows = frame.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()
        return [r.v for r in rows]

    return apply


@pytest.fixture
def raw_frame(spark):
    """Rows given as dicts, completed with NULL, in the schema of a raw relation."""
    from perkmill.schemas import RAW

    def build(relation, rows):
        names = RAW[relation].names
        filled = [
            tuple(row.get(n, {"source_file": "fixture", "source_row_number": str(i)}.get(n)) for n in names)
            for i, row in enumerate(rows, start=2)
        ]
        return spark.createDataFrame(filled, RAW[relation])

    return build
