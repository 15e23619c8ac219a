import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def scratch():
    """A fresh scratch folder per test session (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="logcube-test-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    s = (
        SparkSession.builder.master("local[4]")
        .appName("logcube-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from logcube.plans.checkpoints import ensure_checkpoint_dir

    ensure_checkpoint_dir(s, os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as sorted tuples (None-safe)."""
    cols = order or df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))
