from __future__ import annotations

from collections import Counter

import pytest
from parity import compare, duck, plan_of
from pyspark.sql import functions as F

from tillworks.llm import queries, warc
from tillworks.session import fresh_dir

SF_DIR = "/root/testdata/sf0.001"
LONG, OTHER = "<p>é</p>" * 200, "<i>" * 500
PAGES = [
    (1, "http://a/1", LONG), (2, "http://a/2", LONG), (2, "http://a/2", LONG), (None, "http://a/n", LONG),
    (3, "http://a/ü\r\nX-Row-ID: 9 100%", "short"), (4, None, "short"), (5, "", None), (6, "http://a/6", ""),
    (None, None, OTHER), (None, "u", OTHER), (-7, "u", "WARC/1.1\r\n\r\n" * 300),
]
SCHEMA = "page_id long, url string, html string"


def archive(spark, rows, **options):
    path = fresh_dir(spark, "warc-test")
    pages = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("row_id", "payload", "digest", "n")})
    warc.write_archives(warc.plan_records(pages), path, **options)
    return path


def expected(rows):
    groups = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 1000:
            groups.setdefault(html, []).append(i)
    out = []
    for i, url, html in rows:
        largest = max((x for x in groups.get(html, []) if x is not None), default=None)
        revisit = largest is not None and i != largest
        out.append((i, url, "revisit" if revisit else "response", largest if revisit else None, None if revisit else html or ""))
    return Counter(out)


@pytest.mark.parametrize("file_bytes", [warc.FILE_BYTES, 1])
def test_awkward_pages_round_trip(spark, file_bytes):
    rows = warc.read_archives(spark, archive(spark, PAGES, file_bytes=file_bytes), partition_bytes=500).collect()
    text = lambda r: bytes(r.payload).decode() if r.payload is not None else None
    assert Counter((r.row_id, r.target_uri, r.record_type, r.refers_to, text(r)) for r in rows) == expected(PAGES)


def test_predicates_are_pushed_and_payloads_skipped(spark, monkeypatch):
    path = archive(spark, PAGES)
    records = warc.read_archives(spark, path)
    assert records.filter("record_type = 'revisit'").count() == sum(k[2] == "revisit" for k in expected(PAGES).elements())
    assert {r.row_id for r in records.filter("row_id in (3, 6)").collect()} == {3, 6}
    assert records.filter("record_type = 'response' and payload_bytes > 1500").count() == 3

    reader = warc.WarcReader({"path": path}, spark.read.format("warc").load(path).schema)
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload",), b"")]))
    assert [f.attribute for f in left] == [("payload",)]
    monkeypatch.setattr(warc, "payload_of", lambda block: pytest.fail("a payload was decoded"))
    assert {r[0] for p in reader.partitions() for r in reader.read(p)} == {"revisit"}


def test_only_committed_files_count(spark):
    path = archive(spark, PAGES)
    before = warc.read_archives(spark, path).count()
    writer = warc.WarcWriter({"path": path})
    row = type("Row", (), dict(row_id=1, url=None, record_type="response", refers_to=None, payload_digest="00" * 20, payload_bytes=1, payload=b"x"))
    lost = writer.write(iter([row]))
    assert warc.read_archives(spark, path).count() == before
    writer.commit([lost])
    assert warc.read_archives(spark, path).count() == before + 1
    again = writer.write(iter([row]))
    writer.abort([again])
    assert warc.read_archives(spark, path).count() == before + 1


def test_empty_table(spark):
    assert warc.read_archives(spark, archive(spark, [])).collect() == []


def test_query_equals_sql(spark):
    name = "op5_warc_source"
    rows, problems = compare(queries.queries()[name](spark, SF_DIR), duck(SF_DIR), queries.oracle_sql()[name])
    assert rows and not problems


def test_query_reads_payloads_of_responses_alone(spark):
    plan = plan_of(queries.op5_warc_source(spark, SF_DIR))
    assert plan.count("BatchScan warc") == 2 and plan.count("payload#") >= 1
    revisits = plan[plan.rindex("BatchScan warc") :]
    assert "payload#" not in revisits.splitlines()[0]


def test_payloads_larger_than_the_read_buffer(spark):
    rows = [(i, f"http://a/{i}", f"{i}<é>" * size) for i, size in enumerate([1, 300_000, 5, 700_000])]
    rows += [(10 + i, "http://b", html) for i, (_, _, html) in enumerate(rows)]
    found = warc.read_archives(spark, archive(spark, rows)).collect()
    text = lambda r: bytes(r.payload).decode() if r.payload is not None else None
    assert Counter((r.row_id, r.target_uri, r.record_type, r.refers_to, text(r)) for r in found) == expected(rows)
