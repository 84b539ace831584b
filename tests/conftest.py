import sys
from pathlib import Path

import pyarrow as pa
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

# Few tasks do for few rows.
TEST_CONF = {"spark.sql.shuffle.partitions": "2"}


def _table(create):
    """createDataFrame over Arrow, which needs no Python workers to read a few rows back."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    def build(rows, schema):
        kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        arrow = to_arrow_schema(kind)
        plain = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in row) for row in rows]
        columns = list(zip(*plain)) or [[] for _ in kind]
        return create(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), kind)

    return build


@pytest.fixture(scope="session")
def spark():
    from arborsync.session import build_session

    session = build_session("tests", cores=8, **TEST_CONF)
    session.createDataFrame = _table(session.createDataFrame)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a column expression to Python values: evaluate(values, lambda col: ...)."""
    from pyspark.sql import functions as F

    def run(values, expression, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        out = df.select("i", expression(F.col("v")).alias("r")).collect()
        return [r["r"] for r in sorted(out, key=lambda r: r["i"])]

    return run
