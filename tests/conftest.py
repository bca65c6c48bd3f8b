from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"  # for Python workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": f"file://{base}/checkpoints", "spark.sql.warehouse.dir": f"{base}/warehouse", "spark.ui.showConsoleProgress": "false",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
