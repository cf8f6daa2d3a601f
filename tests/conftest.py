import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from scoreloom.config import session

    spark = session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
