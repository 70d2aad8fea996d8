from __future__ import annotations

import pytest

from tidemark.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    at = tmp_path_factory.mktemp("spark")
    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": str(at / "checkpoints"), "spark.sql.warehouse.dir": str(at / "warehouse"), "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
