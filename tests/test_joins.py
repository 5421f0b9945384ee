"""Pair counts and alert joins against brute force."""

import datetime as dt
import itertools
from collections import Counter

import numpy as np

from opstide.operators import joins as J

AS_OF = "2024-01-08 00:00:00"


def lock_rows(seed, n, seconds):
    rng = np.random.default_rng(seed)
    start = dt.datetime(2024, 1, 7)
    rows = []
    for i in range(n):
        # A third of all rows falls into one second.
        s = 0 if i % 3 == 0 else int(rng.integers(0, seconds))
        ts = start + dt.timedelta(seconds=s, milliseconds=int(rng.integers(0, 1000)))
        kind = "DEADLOCK" if rng.random() < 0.8 else "LOCK"
        rows.append((ts, ts.date(), kind, int(rng.integers(0, 6)), f"_T{rng.integers(0, 5)}"))
    return rows


SCHEMA = "event_datetime timestamp_ntz, event_date date, event_type string, session_id bigint, table_name string"


def test_conflict_pairs_match_brute_force(spark):
    rows = lock_rows(3, 300, 40)
    want = Counter()
    locks = [r for r in rows if r[2] == "DEADLOCK"]
    for a, b in itertools.permutations(locks, 2):
        if a[0].replace(microsecond=0) == b[0].replace(microsecond=0) and a[3] != b[3] and a[4] < b[4]:
            want[(a[4], b[4])] += 1
    got = J.conflict_pairs(spark.createDataFrame(rows, SCHEMA), "DEADLOCK", AS_OF).collect()
    assert {(r["table1"], r["table2"]): r["conflicts"] for r in got} == dict(want)
    top = J.conflict_pairs(spark.createDataFrame(rows, SCHEMA), "DEADLOCK", AS_OF, limit=3).collect()
    assert [r["conflicts"] for r in top] == sorted(want.values(), reverse=True)[:3]


def test_same_session_never_conflicts(spark):
    ts = dt.datetime(2024, 1, 7, 1)
    rows = [(ts, ts.date(), "LOCK", 1, "_A"), (ts, ts.date(), "LOCK", 1, "_B")]
    assert J.conflict_pairs(spark.createDataFrame(rows, SCHEMA), "LOCK", AS_OF).count() == 0


def test_status_and_inhibition(spark):
    days = spark.createDataFrame([(7.0,), (7.1,), (14.0,), (30.0,), (31.0,), (None,)], "d double")
    status = [r[0] for r in days.select(J.limit_status("d")).collect()]
    assert status == ["critical", "warning", "warning", "info", "normal", "normal"]
    alerts = spark.createDataFrame(
        [("a", "h1", "critical"), ("a", "h1", "warning"), ("a", "h2", "warning"), ("b", "h1", "info")],
        "alertname string, instance string, severity string",
    )
    kept = {tuple(r) for r in J.inhibit(alerts).collect()}
    assert kept == {("a", "h1", "critical"), ("a", "h2", "warning"), ("b", "h1", "info")}
