import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import session  # noqa: E402
from optionflow.operators import folds  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("4")
    yield s
    s.stop()


@pytest.fixture()
def small_batches(spark, monkeypatch):
    """Kernel calls of a few rows, so that every carry between calls is used."""
    monkeypatch.setattr(folds, "KERNEL_ROWS", 5)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "5")
    yield
    spark.conf.set(key, old)
