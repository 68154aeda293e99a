"""Records that only the second replica holds."""

from __future__ import annotations

from frames import rows, sentence

from tidemeter.llm.fixity import archived, audit_replicas


def test_records_of_the_second_replica_alone_are_listed(spark):
    pages = [(i, f"http://h/{i}", sentence(i, 5)) for i in range(1500)]
    more = [(1500, "http://h/1500", "appended"), (1499, "http://h/1499", "zz"), (5000, "http://h/5000", "whole archive"), (None, None, None)]
    frame = lambda data: archived(spark.createDataFrame(data, "page_id bigint, url string, html string"))
    first, second = frame(pages), frame(pages + more)
    places = {(r["archive"], r["seq"]): (r["digest"], r["at"]) for r in first.collect()}
    expected = [(*(r[n] for n in ("id", "archive", "seq", "at", "length", "digest")), False) for r in second.collect() if (r["archive"], r["seq"]) not in places]
    names = ["id", "archive", "seq", "at", "length", "digest", "intact"]
    found = audit_replicas(first, second)
    assert len(expected) == 4
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert rows(found.surplus, *names) == sorted(expected, key=key)
    assert found.records.count() == 1500 and found.records.where("NOT intact").count() <= 1
    assert audit_replicas(second, first).surplus.count() == 0
    alone = audit_replicas(frame(pages).limit(0), second)
    assert alone.records.count() == 0
    assert alone.surplus.where("NOT intact").count() == 1504
