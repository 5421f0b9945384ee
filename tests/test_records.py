"""Wrapped records against a plain loop over the lines of each file, for splits of any size."""

import gzip
import random
import re

import pytest

from opstide.operators import parsing as P
from opstide.sources import records as S

HEADER = re.compile(r"^[ \t\r\f\v]*\d{8} \d{2}:\d{2}:\d{2}\.\d{3}", re.A)

LOCK = '20260228 10:35:23.456 LOCK,3,server,processName=rmngr,userName="Ivanov",session=12345678,transaction=87654321,tableName="_InfoRg12345",lockType="Row",lockMode="S",lockWaitTime=0,lockTime=1250'
DEADLOCK = '20260228 10:35:23.456 DEADLOCK,3,server,processName=rmngr,session=12345678,transaction=87654321,tableName="_InfoRg12345",dbpid=12345,lockWaitTime=30000,lockTime=0'
TIMEOUT = '20260228 10:35:23.456 TTIMEOUT,3,server,processName=rmngr,session=12345678,tableName="_AccumRg6789",lockWaitTime=60000,lockTime=0'


def plain_records(text):
    """(first line number, number of lines, joined text)"""
    out = []
    lines = text.split("\n")
    if lines[-1] == "":
        lines.pop()
    for n, line in enumerate(lines):
        line = line.rstrip(" \t\r\f\v")
        if HEADER.match(line) or not out:
            out.append([n, 1, line])
        else:
            out[-1][1] += 1
            out[-1][2] += line.lstrip(" \t\r\f\v") if out[-1][2].endswith(",") else "\n" + line
    return [tuple(r) for r in out]


def random_log(rng, records):
    """Records of one to many lines, blank lines, lines of digits, wide characters, stray lines first."""
    lines = [] if rng.random() < 0.5 else ["stray", "20260101 but no time,", "more"]
    for i in range(records):
        lines.append(f"{rng.choice(['', ' '])}20260228 10:35:{i % 60:02}.{i % 1000:03} LOCK,3,session={i},")
        for _ in range(rng.choice([0, 0, 1, 2, 5, 20])):
            lines.append(rng.choice(["tableName=_T1,", "  lockMode=X, ", 'text="é中', "", "20260228", "20269999 99:99:99 x,", "x" * rng.randint(1, 90)]))
    return "\n".join(lines) + rng.choice(["", "\n"])


@pytest.fixture
def splits(spark):
    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield size
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("size", [80, 1000])
def test_records_do_not_depend_on_splits(spark, tmp_path, splits, size):
    rng = random.Random(size)
    files = {f"2402{n:02}10.log": random_log(rng, rng.choice([1, 3, 12])) for n in range(3)}
    files["24023010.log"] = "no header\n" * 20
    files["24023110.log"] = "20260228 10:35:23.456 LOCK,1,\n" + "y=1,\n" * 60
    files["24023210.log"] = ""
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    splits(size)
    lines = S.placed_lines(S._below(spark, "*.log").text(str(tmp_path)))
    pieces = S.materialise(S.pieces_of(lines), "test-pieces")
    got = S.numbered(S.stitched(pieces), pieces).collect()
    found = {name: sorted((r["line_no"], r["lines"], r["line"]) for r in got if r["file"] == name) for name in files}
    # what stands before any header is one record for each split
    stray = found.pop("24023010.log")
    assert "\n".join(r[2] for r in stray) == files.pop("24023010.log").strip() and sum(r[1] for r in stray) == 20
    assert found == {name: plain_records(text) for name, text in files.items()}
    if size == 80:
        assert pieces.select("path", "block").distinct().count() > 10


def test_wrapped_records_give_the_same_events(spark, tmp_path, splits):
    """The documented forms of all three kinds, wrapped and not, plain and gzip, across splits of 400 bytes."""
    whole = [LOCK, DEADLOCK, TIMEOUT] * 2
    wrapped = "\n".join(re.sub(r",(session|tableName|dbpid|lockType|lockWaitTime)=", r",\n\1=", line) for line in whole) + "\n"
    (tmp_path / "a.log").write_text(wrapped)
    (tmp_path / "b.log.gz").write_bytes(gzip.compress(wrapped.replace("\n", "\r\n").encode()))
    splits(400)
    records = S.read_log_records(spark, str(tmp_path), gzip_partitions=3)
    for parse in (P.parse_lock_lines, P.parse_session_lines):
        want = parse(spark.createDataFrame([(f, line) for f in ("a.log", "b.log.gz") for line in whole], "file string, line string"))
        got = parse(records)
        assert got.count() == 12
        assert got.select(*want.columns).exceptAll(want).count() == 0 and want.exceptAll(got.select(*want.columns)).count() == 0


def test_no_window_over_a_whole_file(spark, tmp_path):
    """Only border rows, one for each split, go through windows and joins; whole records pass by."""
    (tmp_path / "a.log").write_text(LOCK + "\n")
    pieces = S.materialise(S.pieces_of(S.placed_lines(S._below(spark, "*.log").text(str(tmp_path)))), "test-pieces")
    plan = S.stitched(pieces)._jdf.queryExecution().optimizedPlan().toString()
    whole = plan.split("Union")[1].split(":- Project")[1]
    assert "Window" not in whole and "Join" not in whole and "kind#" in whole
