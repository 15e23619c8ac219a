"""Executor loss on a two-executor local cluster (spawns JVMs; opt in with
LOGCUBE_CLUSTER_TESTS=1).  Runs tools/executor_loss_check.py in its own
process, since a process holds one SparkContext."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.environ.get("LOGCUBE_CLUSTER_TESTS"), reason="set LOGCUBE_CLUSTER_TESTS=1")
def test_reports_survive_executor_loss():
    tool = os.path.join(ROOT, "tools", "executor_loss_check.py")
    out = subprocess.run(
        [sys.executable, tool, "/root/testdata/sf0.01"], capture_output=True, text=True, timeout=900
    )
    assert out.returncode == 0, out.stdout[-2000:] + out.stderr[-2000:]
    assert "DIFFERENT" not in out.stdout and out.stdout.strip().endswith("OK")
