from __future__ import annotations

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardlens import schemas  # noqa: E402
from wardlens.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", app_name="wardlens-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def make(spark):
    """make(table, rows) -> DataFrame with the model schema; missing fields null."""
    def _make(name, rows):
        schema = schemas.MODEL[name]
        data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
        return spark.createDataFrame(data, schema)
    return _make


def fresh(spark, name):
    """A folder in the shared folder that no earlier run has written to."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex}")


def rows(df, *cols):
    """Collect selected columns as a sorted list of tuples."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
