import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from repolume.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false", spark_driver_memory="4g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame(schema, row, row, ...)``: rows are dicts; keys that are absent are NULL."""

    def fill(kind, value):
        from pyspark.sql import types as T

        if value is None:
            return None
        if isinstance(kind, T.StructType):
            return {f.name: fill(f.dataType, value.get(f.name)) for f in kind}
        if isinstance(kind, T.ArrayType):
            return [fill(kind.elementType, item) for item in value]
        return value

    def make(schema, *rows):
        from pyspark.sql import types as T

        if isinstance(schema, str):
            schema = T._parse_datatype_string(schema)
        return spark.createDataFrame([fill(schema, row) for row in rows], schema)

    return make


def rows(df, *columns):
    """Rows as tuples, in a stable order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)
