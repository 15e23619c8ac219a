import datetime as dt
import tempfile

from logcube.sources.facts import read_facts
from logcube.streaming.ingest import start_ingest
from tests.fixtures import D0
from tests.test_io import ev, line, write_gz


def test_available_now_ingest_is_incremental(spark, scratch):
    root = tempfile.mkdtemp(prefix="slogs-", dir=scratch)
    facts = tempfile.mkdtemp(prefix="sfacts-", dir=scratch)
    ckpt = tempfile.mkdtemp(prefix="sckpt-", dir=scratch)
    write_gz(f"{root}/{D0}/h/a.gz", [line("u1", D0, download_fin=[ev("p1")]), line("u2", D0, app_open=[ev(None)])])
    q = start_ingest(spark, root, facts, ckpt, tz="UTC", fmt="parquet")
    q.awaitTermination(120)
    assert read_facts(spark, facts, fmt="parquet").count() == 2
    # a rerun with nothing new adds nothing; a new file adds only its rows
    q = start_ingest(spark, root, facts, ckpt, tz="UTC", fmt="parquet")
    q.awaitTermination(120)
    assert read_facts(spark, facts, fmt="parquet").count() == 2
    nxt = D0 + dt.timedelta(1)
    write_gz(f"{root}/{nxt}/h/b.gz", [line("u3", nxt, install_fin=[ev("p2")])])
    q = start_ingest(spark, root, facts, ckpt, tz="UTC", fmt="parquet")
    q.awaitTermination(120)
    got = read_facts(spark, facts, fmt="parquet")
    assert got.count() == 3
    assert {r["log_date"] for r in got.collect()} == {D0, nxt}


def test_replayed_batch_adds_nothing(spark, scratch):
    from logcube.sources.raw_logs import read_raw_logs
    from logcube.streaming.ingest import batch_writer

    root = tempfile.mkdtemp(prefix="rlogs-", dir=scratch)
    facts = tempfile.mkdtemp(prefix="rfacts-", dir=scratch)
    write_gz(f"{root}/{D0}/h/a.gz", [line("u1", D0, download_fin=[ev("p1")], install_fin=[ev("p2")])])
    write = batch_writer(facts, ["download_fin", "install_fin"], "UTC", fmt="parquet")
    write(read_raw_logs(spark, root, [D0]), 7)
    write(read_raw_logs(spark, root, [D0]), 7)  # the same micro-batch again after a failure
    write(read_raw_logs(spark, root, [D0]), 8)  # the same files under another checkpoint
    assert read_facts(spark, facts, fmt="parquet").count() == 2
    write_gz(f"{root}/{D0}/h/b.gz", [line("u2", D0, download_fin=[ev("p1")])])
    write(read_raw_logs(spark, root, [D0]), 9)  # an old and a new file: the new one counts
    got = read_facts(spark, facts, fmt="parquet")
    assert got.count() == 3 and got.select("run").distinct().count() == 2


def test_a_scope_deletes_its_intermediate_tables(spark):
    import os

    from logcube.plans.checkpoints import scratch_dir, scratch_scope

    with scratch_scope(spark) as folder:
        for name in ("a", "b"):
            spark.range(3).write.parquet(scratch_dir(spark, name))
        inside = folder.removeprefix("file:")
        assert len(os.listdir(inside)) == 2 and spark.read.parquet(*[f"{folder}/{n}" for n in os.listdir(inside)]).count() == 6
    assert not os.path.exists(inside) and not scratch_dir(spark, "c").startswith(folder)


def test_a_stream_reads_the_lines_of_new_files_only_and_once(spark, scratch, monkeypatch):
    """Files that the fact table knows are not opened: theirs cannot be read any more.
    Names with glob characters are names."""
    from logcube.plans import daily
    from logcube.streaming import ingest

    root, facts = (tempfile.mkdtemp(prefix="nlogs-", dir=scratch) for _ in range(2))
    write_gz(f"{root}/{D0}/h/a.gz", [line("u1", D0, download_fin=[ev("p1")])])
    daily.ingest_day(spark, root, facts, D0, tz="UTC", fmt="parquet")
    with open(f"{root}/{D0}/h/a.gz", "wb") as fh:
        fh.write(b"no gzip file")
    write_gz(f"{root}/{D0}/h/b[1]{{x}}.gz", [line("u2", D0, download_fin=[ev("p1")])])
    read, real = [], ingest.write_lines

    def counted(rows, *args, **kw):
        run, counts = real(rows, *args, **kw)
        read.append(counts["lines"])
        return run, counts

    monkeypatch.setattr(ingest, "write_lines", counted)
    for _ in range(2):  # the second one has a new checkpoint: all files are known
        checkpoint = tempfile.mkdtemp(prefix="nckpt-", dir=scratch)
        start_ingest(spark, root, facts, checkpoint, tz="UTC", fmt="parquet").awaitTermination(120)
    assert read == [1]
    got = read_facts(spark, facts, fmt="parquet").select("custom_uuid", "log_date").collect()
    assert sorted(map(tuple, got)) == [("u1", D0), ("u2", D0)]
