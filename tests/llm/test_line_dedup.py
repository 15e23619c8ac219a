from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logcube.llm import line_dedup
from logcube.llm.line_dedup import drop_boilerplate, host_of_url
from tests.llm.conftest import SF


def expected(rows, ratio, pages):
    total, seen = defaultdict(int), defaultdict(int)
    for _, text, host in rows:
        total[host] += 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            seen[host, line] += 1
    out = []
    for d, text, host in rows:
        lines = (text or "").split("\n")
        bad = [x.strip(" ") != "" and seen[host, x.strip(" ")] >= pages and seen[host, x.strip(" ")] / total[host] > ratio for x in lines]
        out.append((d, host, len(lines), sum(bad), "\n".join(x for x, b in zip(lines, bad) if not b)))
    return sorted(out, key=str)


def got(docs, **more):
    return sorted(map(tuple, drop_boilerplate(docs, F.col("source"), **more).collect()), key=str)


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_lines_of_all_documents(spark, monkeypatch, broadcast):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", broadcast)  # 0: the salted join
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    want = expected(rows, 0.02, 3)
    assert got(docs, min_pages=3) == want
    assert sum(r[3] for r in want) > 0


def test_awkward_rows(spark, awkward, empty):
    rows = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    assert got(awkward, max_ratio=0.3, min_pages=2) == expected(rows, 0.3, 2)
    assert got(empty) == []


def test_ratio_is_relative_to_the_host(spark):
    rows = [(i, "menu\n" + f"own {i}\nmenu" if i % 10 == 0 or i >= 100 else f"own {i}", "big" if i < 100 else "small") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = got(docs, max_ratio=0.5, min_pages=2)
    assert found == expected(rows, 0.5, 2)
    assert {h for _, h, _, dropped, _ in found if dropped} == {"small"}


def test_host_of_a_url(spark):
    urls = spark.createDataFrame([("http://a.example.com/x?y",), ("no url",), (None,)], "url string")
    assert [r[0] for r in urls.select(host_of_url("url")).collect()] == ["a.example.com", None, None]
