import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from attestor.session import build_session, ship

    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{folder}/checkpoints", "spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield ship(session)
    session.stop()
