"""Several writers of the fact table, compaction, quarantine and replay, report
snapshots."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from logcube.operators.events import parse_events
from logcube.plans import daily, ingest
from logcube.schemas import EVENT_KINDS
from logcube.sources import facts, sinks, store
from logcube.sources.raw_logs import read_raw_logs
from logcube.streaming.ingest import batch_writer
from tests.fixtures import D0
from tests.test_io import ev, facts_of, line, write_gz

DAY = str(D0)


def folders(scratch, n=2):
    return [tempfile.mkdtemp(prefix="writers-", dir=scratch) for _ in range(n)]


def one(user):
    return (user, "download_fin", DAY)


def log(root, name, user):
    write_gz(f"{root}/{D0}/h/{name}.gz", [line(user, D0, download_fin=[ev()])])


def nightly(spark, root, fact_root):
    return daily.ingest_day(spark, root, fact_root, D0, tz="UTC", fmt="parquet")


def stream_batch(spark, root, fact_root, names=None):
    raw = read_raw_logs(spark, root, [D0])
    if names:
        raw = raw.where(F.regexp_extract("log_file", r"([^/]+)\.gz$", 1).isin(names))
    batch_writer(fact_root, EVENT_KINDS, "UTC", fmt="parquet")(raw, 0)


def between(monkeypatch, module, name, other):
    """Run ``other`` once, right before the next call of ``module.name``."""
    real, done = getattr(module, name), []

    def first(*args, **kw):
        if not done:
            done.append(1)
            other()
        return real(*args, **kw)

    monkeypatch.setattr(module, name, first)


def test_a_version_is_made_once_and_no_change_is_lost(spark, scratch):
    (where,) = folders(scratch, 1)
    assert store.put_new(spark, f"{where}/a.0000000001.json", "{}") and not store.put_new(spark, f"{where}/a.0000000001.json", "[]")
    seen = []

    def change(content):
        if not seen:  # another writer comes first
            seen.append(1)
            store.update(spark, where, "b", lambda c: {"n": (c or {"n": 0})["n"] + 10})
        return {"n": (content or {"n": 0})["n"] + 1}

    assert store.update(spark, where, "b", change) == {"n": 11}
    for _ in range(store.KEPT_VERSIONS + 3):
        store.update(spark, where, "b", lambda c: {"n": c["n"] + 1})
    assert store.current(spark, where, "b")[1] == {"n": 11 + store.KEPT_VERSIONS + 3}
    assert sum(n.startswith("b.") for n in store.names(spark, where)) <= store.KEPT_VERSIONS + 1
    assert not [n for n in store.names(spark, where) if n.startswith("_")]


def test_a_stream_batch_between_listing_and_commit_of_the_nightly_ingest(spark, scratch, monkeypatch):
    root, fact_root = folders(scratch)
    log(root, "a", "u1")

    def stream():
        log(root, "b", "u2")  # arrives after the nightly listing
        stream_batch(spark, root, fact_root, ["b"])

    between(monkeypatch, daily, "replace_days", stream)
    nightly(spark, root, fact_root)
    assert facts_of(spark, fact_root) == [one("u1"), one("u2")]
    nightly(spark, root, fact_root)  # now it parses both
    assert facts_of(spark, fact_root) == [one("u1"), one("u2")]


@pytest.mark.parametrize("names", [["a"], ["a", "b"]])
def test_a_stream_batch_with_files_of_the_nightly_ingest(spark, scratch, monkeypatch, names):
    """With the same files the nightly run replaces it; with more it starts again."""
    root, fact_root = folders(scratch)
    log(root, "a", "u1")

    def stream():
        log(root, "b", "u2")
        stream_batch(spark, root, fact_root, names)

    between(monkeypatch, daily, "replace_days", stream)
    nightly(spark, root, fact_root)
    stream_batch(spark, root, fact_root)
    assert facts_of(spark, fact_root) == [one("u1"), one("u2")]


def test_the_nightly_ingest_between_read_and_commit_of_a_batch(spark, scratch, monkeypatch):
    from logcube.streaming import ingest as stream_module

    root, fact_root = folders(scratch)
    log(root, "a", "u1")

    def night():
        nightly(spark, root, fact_root)  # parses a
        log(root, "c", "u3")  # and a third writer adds c
        stream_batch(spark, root, fact_root, ["c"])

    log(root, "b", "u2")
    real = read_raw_logs(spark, root, [D0]).where("log_file not like '%/c.gz'")
    os.rename(f"{root}/{D0}/h/b.gz", f"{root}/{D0}/h/b.later")  # the nightly listing misses b

    def both():
        night()
        os.rename(f"{root}/{D0}/h/b.later", f"{root}/{D0}/h/b.gz")

    os.rename(f"{root}/{D0}/h/b.later", f"{root}/{D0}/h/b.gz")
    rows = real.persist()
    rows.count()
    os.rename(f"{root}/{D0}/h/b.gz", f"{root}/{D0}/h/b.later")
    between(monkeypatch, stream_module, "add_days", both)
    batch_writer(fact_root, EVENT_KINDS, "UTC", fmt="parquet")(rows, 0)  # a and b
    assert facts_of(spark, fact_root) == [one("u1"), one("u2"), one("u3")]
    rows.unpersist()


def test_runs_of_a_day_are_compacted(spark, scratch):
    root, fact_root = folders(scratch)
    write = batch_writer(fact_root, EVENT_KINDS, "UTC", fmt="parquet")
    for i in range(12):  # a batch per file
        bad = ["{cut"] if i == 3 else []
        write_gz(f"{root}/{D0}/h/{i}.gz", [line(f"u{i}", D0, download_fin=[ev()], app_open=[ev()]), *bad])
        write(read_raw_logs(spark, root, [D0]).where(F.col("log_file").endswith(f"/{i}.gz")), i)
    before, bad = facts_of(spark, fact_root), facts.read_bad_lines(spark, fact_root).count()
    files = len(facts.read_facts(spark, fact_root, fmt="parquet").inputFiles())
    assert len(before) == 24 and bad == 1 and files >= 24
    assert facts.compact(spark, fact_root, [D0, "2030-01-01"], fmt="parquet") == [DAY]
    assert facts_of(spark, fact_root) == before and facts.read_bad_lines(spark, fact_root).count() == 1
    after = facts.read_facts(spark, fact_root, fmt="parquet")
    assert len(after.inputFiles()) <= files // 4 and after.select("run").distinct().count() == 1
    assert len(facts.unreferenced_runs(spark, fact_root)) == 12
    write(read_raw_logs(spark, root, [D0]), 3)  # replayed: all files are known
    assert facts_of(spark, fact_root) == before
    assert facts.compact(spark, fact_root, [D0], fmt="parquet") == []  # one run already


def test_compaction_beside_other_writers(spark, scratch, monkeypatch):
    root, fact_root = folders(scratch)
    for name in "ab":
        log(root, name, f"u{name}")
        stream_batch(spark, root, fact_root, [name])

    def more():
        log(root, "c", "uc")
        stream_batch(spark, root, fact_root, ["c"])

    between(monkeypatch, facts, "put_files", more)  # a run that comes meanwhile stays
    assert facts.compact(spark, fact_root, [D0], fmt="parquet") == [DAY]
    assert facts_of(spark, fact_root) == [one("ua"), one("ub"), one("uc")]
    assert len(facts.day_runs(spark, fact_root, [D0])[DAY]) == 2
    monkeypatch.undo()
    between(monkeypatch, facts, "put_files", lambda: nightly(spark, root, fact_root))  # runs that go meanwhile
    assert facts.compact(spark, fact_root, [D0], fmt="parquet") == []
    assert facts_of(spark, fact_root) == [one("ua"), one("ub"), one("uc")]


BAD = ['{"custom_uuid": "cut', json.dumps({"custom_uuid": "u9", "rec_time": line("u9", D0)["rectime"], "data": {"app_open": [ev()]}})]


@pytest.mark.parametrize("streamed", [False, True])
def test_bad_lines_are_stored_and_replayed_once(spark, scratch, streamed):
    root, fact_root = folders(scratch)
    write_gz(f"{root}/{D0}/h/a.gz", [line("u1", D0, download_fin=[ev()]), *BAD, ""])
    (stream_batch if streamed else nightly)(spark, root, fact_root)
    bad = facts.read_bad_lines(spark, fact_root)
    assert sorted((r.reason, r.line, str(r.log_date), r.log_file[-5:]) for r in bad.collect()) == [("corrupt", BAD[0], DAY, "/a.gz"), ("undated", BAD[1], DAY, "/a.gz")]
    undated = ("u9", "app_open", "None")
    assert facts_of(spark, fact_root) == [one("u1"), undated]

    def replay():
        return ingest.replay_bad_lines(spark, fact_root, [D0, "2030-01-01"], "UTC", repair=lambda text: F.replace(text, F.lit('"rec_time"'), F.lit('"rectime"')), fmt="parquet")

    assert replay() == [DAY]
    both = [one("u1"), ("u9", "app_open", DAY)]
    assert facts_of(spark, fact_root) == both
    assert [(r.reason, r.line) for r in facts.read_bad_lines(spark, fact_root).collect()] == [("corrupt", BAD[0])]
    replay()  # nothing new to read
    assert facts_of(spark, fact_root) == both and facts.read_bad_lines(spark, fact_root).count() == 1
    stream_batch(spark, root, fact_root)  # the file is known
    assert facts_of(spark, fact_root) == both
    nightly(spark, root, fact_root)  # a new ingest of the day replaces the replayed lines, too
    assert facts_of(spark, fact_root) == [one("u1"), undated] and facts.read_bad_lines(spark, fact_root).count() == 2
    facts_before = facts_of(spark, fact_root)
    ingest.replay_bad_lines(spark, fact_root, [D0], "UTC", fmt="parquet")  # without the mending
    assert facts_of(spark, fact_root) == facts_before and facts.read_bad_lines(spark, fact_root).count() == 2


def test_a_replay_that_is_overtaken_adds_nothing(spark, scratch, monkeypatch):
    root, fact_root = folders(scratch)
    write_gz(f"{root}/{D0}/h/a.gz", [line("u1", D0, download_fin=[ev()]), *BAD])
    nightly(spark, root, fact_root)
    between(monkeypatch, ingest.facts, "put_files", lambda: nightly(spark, root, fact_root))
    assert ingest.replay_bad_lines(spark, fact_root, [D0], "UTC", fmt="parquet") == []
    assert facts_of(spark, fact_root) == [one("u1"), ("u9", "app_open", "None")] and facts.read_bad_lines(spark, fact_root).count() == 2
    assert ingest.replay_bad_lines(spark, fact_root, ["2030-01-01"], "UTC") == []


def test_write_facts_tells_when_it_is_overtaken(spark, scratch, monkeypatch):
    root, fact_root = folders(scratch)
    log(root, "a", "u1")
    rows = parse_events(read_raw_logs(spark, root, [D0]), EVENT_KINDS, "UTC")
    files = daily.require_input(spark, root, [D0], daily.DEFAULT_LAYOUT)
    facts.write_facts(rows, fact_root, files, fmt="parquet")
    with pytest.raises(facts.Overtaken):
        facts.write_facts(rows, fact_root, files, replace=False, fmt="parquet")
    assert facts_of(spark, fact_root) == [one("u1")]


# --------------------------------------------------------------------- reports


def report(spark, *rows):
    return spark.createDataFrame(list(rows), "date int, n int")


def shown(df):
    return sorted((r["date"], r["n"]) for r in df.collect())


def test_a_report_is_executed_once(spark, scratch):
    path = folders(scratch, 1)[0] + "/r"
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = report(spark, (20240101, 1), (20240102, 2), (20240102, 3)).coalesce(1).mapInArrow(count, "date int, n int")
    sinks.write_report_files(df, path, days=["2024-01-01", "2024-01-03"])
    assert runs.value == 3
    assert shown(sinks.read_report_files(spark, path)) == shown(spark.read.parquet(path)) == [(20240101, 1), (20240102, 2), (20240102, 3)]
    assert shown(sinks.read_report_files(spark, path, days=["2024-01-02", "2030-01-01"])) == [(20240102, 2), (20240102, 3)]


def test_a_failure_before_the_commit_leaves_the_old_report(spark, scratch, monkeypatch):
    path = folders(scratch, 1)[0] + "/r"
    old = [(20240101, 1), (20240102, 2)]
    sinks.write_report_files(report(spark, *old), path)

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "commit_report", fail)
        with pytest.raises(OSError):
            sinks.write_report_files(report(spark, (20240101, 7)), path, days=["2024-01-01", "2024-01-02"])
    assert shown(sinks.read_report_files(spark, path)) == shown(spark.read.parquet(path)) == old
    with monkeypatch.context() as m:  # after the commit: all of the new one, and the plain folders are made good
        m.setattr(sinks, "export_days", fail)
        with pytest.raises(OSError):
            sinks.write_report_files(report(spark, (20240101, 7)), path, days=["2024-01-01", "2024-01-02"])
    assert shown(sinks.read_report_files(spark, path)) == [(20240101, 7)] and shown(spark.read.parquet(path)) == old
    sinks.export_days(spark, path)
    assert shown(spark.read.parquet(path)) == [(20240101, 7)]


def test_reports_of_several_writers_and_of_no_rows(spark, scratch, monkeypatch):
    path = folders(scratch, 1)[0] + "/r"
    with pytest.raises(FileNotFoundError):
        sinks.read_report_files(spark, path)
    between(monkeypatch, sinks, "commit_report", lambda: sinks.write_report_files(report(spark, (20240105, 5)), path))
    sinks.write_report_files(report(spark, (20240104, 4)), path)
    assert shown(sinks.read_report_files(spark, path)) == [(20240104, 4), (20240105, 5)]
    sinks.write_report_files(report(spark, (1, 1)).where("n > 1"), path, days=[dt.date(2024, 1, 4), dt.date(2024, 1, 5)])
    assert shown(sinks.read_report_files(spark, path)) == []
