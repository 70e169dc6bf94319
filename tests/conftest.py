import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from textwarden.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "textwarden-tests", "local[8]", spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false", spark_driver_memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def run_text(spark):
    """Apply a stage to texts; rows in order, as dictionaries."""

    def run(stage, texts, **columns):
        rows = [(i, t, *[values[i] for values in columns.values()]) for i, t in enumerate(texts)]
        names = ["id", "text", *columns]
        kinds = {"id": "long", "text": "string"}
        schema = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)
        out = stage(spark.createDataFrame(rows, schema)).orderBy("id")
        return [r.asDict(recursive=True) for r in out.collect()]

    return run
