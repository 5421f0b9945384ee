"""Log lines with every kind of damage, as files and as frames."""

import datetime as dt
import gzip

from pyspark.sql import functions as F

from opstide.operators import parsing as P
from opstide.sources import logs

GOOD = '20260304 13:45:12.123 CALL,3,session=7,userName="Анна, К.",computerName="ws-1",duration=250,lockTime=5'
LOCK = '20260304 13:45:12.999,TTIMEOUT,5,session=8,tableName=_Acc1,lockType="Row",lockMode=X,lockWaitTime=900,dbpid=12'


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_session_fields_and_defaults(spark):
    row = P.parse_session_lines(lines(spark, f"  {GOOD}\t")).first()
    assert row["event_datetime"] == dt.datetime(2026, 3, 4, 13, 45, 12, 123000)
    assert (row["event_type"], row["session_id"], row["user_name"]) == ("CALL", 7, "Анна, К.")
    assert (row["duration"], row["lock_time"], row["lock_wait_time"]) == (250, 5, 0)
    assert (row["app_name"], row["is_deadlock"], row["is_exception"]) == ("", 0, 0)
    assert row["raw_line"] == GOOD


def test_rejects(spark):
    bad = ["", "   ", "no header", "20261304 13:45:12.123,CALL,", "20260230 10:00:00.000,CALL,", "20260304 25:00:00.000,X,"]
    assert P.parse_session_lines(lines(spark, *bad)).count() == 0


def test_odd_values(spark):
    huge = "20260304 00:00:00.000,CALL,session=99999999999999999999,duration=abc"
    row = P.parse_session_lines(lines(spark, huge)).first()
    assert (row["session_id"], row["duration"]) == (0, 0)
    untyped = P.parse_session_lines(lines(spark, "20260304 00:00:00.000 nothing here")).first()
    assert untyped["event_type"] == "UNKNOWN"


def test_flags_ignore_case(spark):
    row = P.parse_session_lines(lines(spark, "20260304 00:00:00.000,A,DeadLock and ERROR and tTimeout")).first()
    assert (row["is_deadlock"], row["is_exception"], row["is_timeout"]) == (1, 1, 1)


def test_whole_line_is_parsed_but_raw_line_is_cut(spark):
    text = "20260304 00:00:00.000,CALL," + "x" * 5000 + ",session=42"
    row = P.parse_session_lines(lines(spark, text)).first()
    assert row["session_id"] == 42 and len(row["raw_line"]) == 1000


def test_lock_lines_keep_lock_types_only(spark):
    rows = P.parse_lock_lines(lines(spark, GOOD, LOCK)).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["event_type"], row["table_name"], row["lock_type"]) == ("TTIMEOUT", "_Acc1", "Row")
    assert (row["lock_wait_time"], row["dbpid"], row["lock_name"]) == (900, 12, "")


def test_legacy_first_pattern_and_last_part_win(spark):
    text = "12:34:56.789,EXCP,duration=5 session=1,session=2,session=3,waitTime=x"
    row = P.parse_legacy_lines(lines(spark, text)).first()
    assert (row["hour"], row["minute"], row["second"], row["millisecond"]) == (12, 34, 56, 789)
    # The first part belongs to duration only; the last session part wins.
    assert (row["duration"], row["session"], row["wait_time"], row["user"]) == (5, 3, None, None)


def test_legacy_rejects(spark):
    few = "12:34:56.789,a,b,c"
    no_millis = "12:34:56,a,b,c,d"
    bad_clock = "xx:34:56.789,a,b,c,d"
    no_clock = "hello,a,b,c,session=4"
    rows = P.parse_legacy_lines(lines(spark, few, no_millis, bad_clock, no_clock)).collect()
    assert [(r["hour"], r["session"]) for r in rows] == [(None, 4)]


def test_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "26030413.log").write_bytes(GOOD.encode() + b"\nbro\xff\xfeken\n\n")
    with gzip.open(tmp_path / "deep" / "20260305.log.gz", "wt", encoding="utf-8") as f:
        f.write(LOCK + "\n" + GOOD + "\n")
    (tmp_path / "notes.txt").write_text("ignored")
    assert logs.gzip_spread(spark, str(tmp_path), "*.log.gz") == 1
    assert logs.read_log_lines(spark, str(tmp_path)).count() == 5
    read = logs.read_log_lines(spark, str(tmp_path), gzip_partitions=3)
    assert sorted(r["line"] for r in read.filter("file like '26%'").collect()) == ["", GOOD, "broken"][:1] + sorted([GOOD, "broken"])
    stats = {r["file"]: r for r in P.parse_stats(read).collect()}
    first = stats["26030413.log"]
    assert (first["lines"], first["parsed"], first["rejected"], first["blank"]) == (3, 1, 1, 1)
    named = logs.file_event_hour(read.select("file").distinct()).collect()
    found = {r["file"]: (r["file_date"], r["file_hour"]) for r in named}
    assert found["26030413.log"] == (dt.date(2026, 3, 4), 13)
    assert found["20260305.log.gz"] == (dt.date(2026, 3, 5), None)


def test_round_trip(inputs):
    parsed = P.parse_session_lines(inputs.log_lines)
    source = inputs.events.select("event_id", "user_id", F.upper("event_type").alias("kind"))
    joined = parsed.join(source, "event_id")
    assert joined.count() == inputs.events.count()
    assert joined.filter("session_id <> user_id or event_type <> kind").count() == 0
