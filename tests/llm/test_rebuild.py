import datetime as dt

import pytest

from tests.conftest import MSG, message
from tracewright.llm import rebuild as R

SCHEMA = f"record_id bigint, session_id string, timestamp string, request struct<model:string,messages:array<{MSG}>,tools:string>, response struct<message:{MSG},finish_reason:string>, ingested_at timestamp, at int, reason string"


def q(i, s, ts, *ms, ingested=0):
    return (i, s, ts, ("m", list(ms), None), None, dt.datetime(2026, 1, 1) + dt.timedelta(seconds=ingested), 1, "clash")


def a(i, s, ts, m, ingested=0):
    return (i, s, ts, None, (m, "stop"), dt.datetime(2026, 1, 1) + dt.timedelta(seconds=ingested), 1, "clash")


U = lambda t="hi": message("human", t)
A = lambda t="ok", calls=None: message("MODEL", t, calls)
CASES = {
    "fine": [q(1, "fine", "20260101-000001", message("developer", "s"), U()), a(2, "fine", "1767225602000", A())],
    "tools": [q(3, "tools", "20260101_000001", U()), a(4, "tools", "2026-01-01T01:00:02+01:00", A("", [("c", "read", "{}")])), q(5, "tools", "20260101 000003", message("Tool", "r", answers="c")), a(6, "tools", "20260101T000004", A())],
    "empty": [q(7, "empty", "20260101-000001", U("​ ﻿")), a(8, "empty", "20260101-000002", A())],
    "nothing": [q(9, "nothing", "n/a")],
    "unstamped": [q(10, "unstamped", None, U()), a(11, "unstamped", "20260101-000002", A())],
    "badmonth": [q(12, "badmonth", "20261301-000001", U()), a(13, "badmonth", "20260101-000002", A())],
    "answer first": [a(14, "answer first", "20260101-000001", A()), q(15, "answer first", "20260101-000002", U()), a(16, "answer first", "20260101-000003", A())],
    "twice": [q(17, "twice", "20260101-000001", U()), a(18, "twice", "20260101-000002", A()), a(19, "twice", "20260101-000003", A())],
    "system between": [q(20, "system between", "20260101-000001", U()), a(21, "system between", "20260101-000002", A()), q(22, "system between", "20260101-000003", message("system", "x")), a(23, "system between", "20260101-000004", A())],
    "orphan": [q(24, "orphan", "20260101-000001", U(), message("tool", "r", answers="zz")), a(25, "orphan", "20260101-000002", A())],
    "open call": [q(26, "open call", "20260101-000001", U()), a(27, "open call", "20260101-000002", A("", [("c", "read", "{}")])), q(28, "open call", "20260101-000003", U("x")), a(29, "open call", "20260101-000004", A())],
    "no reply": [q(30, "no reply", "20260101-000001", U()), a(31, "no reply", "20260101-000002", A()), q(32, "no reply", "20260101-000003", U("again"))],
    "failed reply": [q(33, "failed reply", "20260101-000001", U()), a(34, "failed reply", "20260101-000002", None)],
    "delivered twice": [q(35, "delivered twice", "20260101-000001", U()), a(36, "delivered twice", "20260101-000002", A()), a(36, "delivered twice", "20260101-000002", A(), ingested=99)],
    "out of order": [a(37, "out of order", "20260101-000002", A()), q(38, "out of order", "20260101-000001", U())],
}
WANT = {"empty": "empty", "nothing": "empty", "unstamped": "broken", "badmonth": "broken", "answer first": "broken", "twice": "broken", "system between": "broken", "orphan": "broken", "open call": "broken", "no reply": "missing_reply", "failed reply": "missing_reply"}


@pytest.fixture(scope="module")
def records(spark):
    rows = [r for c in CASES.values() for r in c] + [(None, "tools", None, None, None, None, 1, "")][:0] + [(99, None, "20260101-000001", None, None, None, 1, "")]
    return spark.createDataFrame(rows, SCHEMA)


def test_reasons(records):
    got = {r.session_id: r.reason for r in R.session_verdicts(records).collect()}
    assert {k: v for k, v in got.items() if v} == WANT and set(got) == set(CASES)


def test_conversations_are_ordered(records):
    rows = sorted((r.session_id, r.turn_no, r.role) for r in R.conversations(records).collect())
    assert [x[1:] for x in rows if x[0] == "tools"] == [(0, "user"), (1, "assistant"), (2, "tool"), (3, "assistant")]
    assert [x[1:] for x in rows if x[0] == "out of order"] == [(0, "user"), (1, "assistant")]
    assert {x[0] for x in rows} == set(CASES) - set(WANT)


def test_empty_table(records):
    assert R.session_verdicts(records.limit(0)).count() == 0


def test_long_session_over_many_chunks(spark):
    rows = []
    for k in range(3000):
        rows.append(q(2 * k, "long", str(1767225600000 + 2000 * k), U(f"q{k}")))
        rows.append(a(2 * k + 1, "long", str(1767225600000 + 2000 * k + 1000), A(f"a{k}")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.createDataFrame(rows, SCHEMA)
        assert [r.reason for r in R.session_verdicts(df).collect()] == [None]
        assert [r.reason for r in R.session_verdicts(df.where("record_id <> 2001")).collect()] == ["missing_reply"]
        turns = R.conversations(df).orderBy("turn_no").collect()
        assert [t.turn_no for t in turns] == list(range(6000)) and turns[4001].content == "a2000"
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_conversations_keep_rows_with_null_ids_and_null_ingestion(spark):
    late = lambda r: (*r[:5], None, *r[6:])
    rows = [q(None, "ids", "20260101-000001", U("one")), a(None, "ids", "20260101-000002", A("two")), late(q(3, "times", "20260101-000001", U("three"))), late(a(4, "times", "20260101-000002", A("four"))), late(a(5, "both", "20260101-000002", A("old"))), a(5, "both", "20260101-000002", A("new")), q(6, "both", "20260101-000001", U("six"))]
    got = sorted((r.session_id, r.turn_no, r.content) for r in R.conversations(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("both", 0, "six"), ("both", 1, "new"), ("ids", 0, "one"), ("ids", 1, "two"), ("times", 0, "three"), ("times", 1, "four")]
