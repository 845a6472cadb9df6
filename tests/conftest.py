import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    settings = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": f"file://{folder}/checkpoints", "spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.ui.showConsoleProgress": "false",
    }
    s = SparkSession.builder.master("local[4]").config(map=settings).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.environment["PYTHONPATH"] = str(ROOT)
    yield s
    s.stop()
