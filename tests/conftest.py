import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__))) + ":" + os.environ.get("PYTHONPATH", "")

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loomstead.session import local_session

    s = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "6g", "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"})
    yield s
    s.stop()


@pytest.fixture
def store(spark, tmp_path):
    from loomstead.sources.store import Store

    return Store(spark, str(tmp_path / "w"), sleep=lambda _: None)
