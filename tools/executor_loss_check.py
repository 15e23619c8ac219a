"""Kill executors while reports run and check the results do not change.

Runs Spark in ``local-cluster[2,2,1024]`` mode (two executor JVMs), computes
the open v2 growth report once undisturbed, then
  1. materializes the enriched rows (reliable checkpoint in the scratch
     checkpoint folder, and a persisted copy), SIGKILLs one executor JVM, and
     recomputes the report from both;
  2. starts the report and SIGKILLs an executor JVM while it runs.
Every result must equal the undisturbed one.  Executor PIDs come from the
Python workers' parent chain (worker -> daemon -> executor JVM); nothing is
killed by name pattern.

usage: python tools/executor_loss_check.py [SF_DIR]
"""

from __future__ import annotations

import os
import signal
import sys
import tempfile
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from logcube.operators.cube import rollup_counts  # noqa: E402
from logcube.operators.growth import growth_report  # noqa: E402
from logcube.plans import reports  # noqa: E402
from logcube.plans.checkpoints import materialize  # noqa: E402
from logcube.plans.specs import SPECS  # noqa: E402
from logcube.sources import bridge  # noqa: E402


def executor_pids(spark) -> list[int]:
    def jvm_of_worker(_):
        import os as _os

        daemon = _os.getppid()
        with open(f"/proc/{daemon}/stat") as fh:
            yield int(fh.read().rsplit(")", 1)[1].split()[1])

    return sorted(set(spark.sparkContext.parallelize(range(32), 32).mapPartitions(jvm_of_worker).collect()))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="exec-loss-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local-cluster[2,2,1024]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spec = SPECS["open_v2"]
    facts, cat = bridge.facts(spark, sf), bridge.catalog(spark, sf)

    def report_from(rich):
        return growth_report(rollup_counts(rich, spec.keys, spec.grouping_sets), spec.keys, spec.key_names)

    expected = rows(reports.growth(facts, cat, spec))
    ok = True

    # 1. lineage cuts survive the loss of an executor
    rich = reports.enriched_for(facts, cat, spec, broadcast=True)
    checkpointed = materialize(rich)
    persisted = rich.persist()
    persisted.count()
    pids = executor_pids(spark)
    print("executor JVMs", pids)
    os.kill(pids[0], signal.SIGKILL)
    time.sleep(3)
    for label, frame in (("checkpointed", checkpointed), ("persisted", persisted)):
        got = rows(report_from(frame).drop("_day"))
        same = got == expected
        ok &= same
        print(f"after executor kill, report from {label} rows: {'same' if same else 'DIFFERENT'} ({len(got)} rows)")

    # 2. an executor dies while the report runs
    pids = executor_pids(spark)
    result = {}

    def run():
        result["rows"] = rows(reports.growth(facts, cat, spec))

    t = threading.Thread(target=run)
    t.start()
    time.sleep(1.0)
    os.kill(pids[-1], signal.SIGKILL)
    print("killed executor JVM", pids[-1], "during the job")
    t.join(600)
    same = result.get("rows") == expected
    ok &= same
    print(f"report with an executor killed mid-job: {'same' if same else 'DIFFERENT'}")
    spark.stop()
    print("OK" if ok else "FAILED")
    sys.exit(0 if ok else 1)


if __name__ == "__main__":
    main()
