import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

MSG = "struct<role:string,content:string,reasoning_content:string,tool_calls:array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>,tool_call_id:string,name:string>"


def message(role, content=None, calls=None, answers=None, reasoning=None):
    """A message; calls as (id, name, arguments)."""
    made = None if calls is None else [(i, "function", (n, a)) for i, n, a in calls]
    return (role, content, reasoning, made, answers, None)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tracewright.session import local_session

    s = local_session(4, "tests")
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sessions(spark):
    """Builds (id, messages, ...) rows: sessions([(1, [message(...)]), ...])."""

    def make(rows, key="sample_id", extra=(), extra_schema=""):
        return spark.createDataFrame(rows, f"{key} bigint, messages array<{MSG}>" + extra_schema)

    return make
