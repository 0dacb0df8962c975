import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from airshed.session import build_session

    s = build_session("local[*]", app="airshed-tests", **{"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


@pytest.fixture(autouse=True)
def small_writes(request, spark):
    """Tests write very many small partitions: several tasks share them, as a larger table's would."""
    if "llm" in str(request.node.fspath):
        yield
        return
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    yield
    for k in sizes:
        spark.conf.unset(k)
