"""Technical-log lines to typed events, entirely with built-in expressions.

Lines are trimmed, those without a valid header time are dropped, and every
field is the first match of its pattern.  ``regexp_extract`` yields an empty
string when a pattern is absent, so defaults are one ``coalesce`` away.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The log's field patterns.
HEADER = r"^\d{8} \d{2}:\d{2}:\d{2}\.\d{3}"
EVENT_TYPE = r"[ ,]([A-Z_]+),"
NUMBER = {
    "session_id": r"session=(\d+)",
    "transaction_id": r"transaction=(\d+)",
    "connection_id": r"connection=(\d+)",
    "duration": r"duration=(\d+)",
    "lock_wait_time": r"lockWaitTime=(\d+)",
    "lock_time": r"lockTime=(\d+)",
    "dbpid": r"dbpid=(\d+)",
}
TEXT = {
    "user_name": r'userName="([^"]*)"',
    "computer_name": r'computerName="([^"]*)"',
    "process_name": r"processName=([^,]+)",
    "app_name": r'app-id="([^"]*)"',
    "dbms": r'dbms="([^"]*)"',
    "func": r'func="([^"]*)"',
    "table_name": r'tableName="?([^",]+)"?',
    "lock_type": r'lockType="?([^",]+)"?',
    "lock_mode": r'lockMode="?([^",]+)"?',
    "lock_name": r'lockName="?([^",]+)"?',
}
FLAGS = {"is_deadlock": ["deadlock"], "is_exception": ["exception", "error"], "is_timeout": ["ttimeout"]}

SESSION_NUMBERS = ["session_id", "duration", "lock_wait_time", "lock_time", "connection_id", "transaction_id"]
SESSION_TEXTS = ["user_name", "computer_name", "process_name", "app_name", "dbms", "func"]
LOCK_KINDS = ["LOCK", "DEADLOCK", "TTIMEOUT", "SDBL"]
LOCK_NUMBERS = ["session_id", "transaction_id", "lock_wait_time", "lock_time", "dbpid"]
LOCK_TEXTS = ["user_name", "process_name", "table_name", "lock_type", "lock_mode", "lock_name"]

RAW_LIMIT = 1000
SPACE = " \t\r\n\f\x0b"


def _trimmed(line: str) -> Column:
    return F.btrim(F.col(line), F.lit(SPACE))


def _with_trimmed(lines: DataFrame, line: str) -> DataFrame:
    """Add the trimmed line as ``_line``.

    A one-element ``inline`` is a border the optimizer does not move filters
    across, so cleaning and trimming run once per line and not once per pattern.
    """
    return lines.select("*", F.inline(F.array(F.struct(_trimmed(line).alias("_line")))))


def header_time(line: Column) -> Column:
    """Header time as NTZ, NULL when the header is absent or not a real time."""
    iso = F.concat(
        F.substring(line, 1, 4), F.lit("-"), F.substring(line, 5, 2), F.lit("-"), F.substring(line, 7, 15)
    )
    return F.when(F.substring(line, 1, 21).rlike(HEADER), iso.try_cast("timestamp_ntz"))


def int_field(line: Column, pattern: str) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(line, pattern, 1), F.lit("")).try_cast("bigint"), F.lit(0))


def text_field(line: Column, pattern: str) -> Column:
    return F.regexp_extract(line, pattern, 1)


def event_type(line: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(line, EVENT_TYPE, 1), F.lit("")), F.lit("UNKNOWN"))


def line_flag(line: Column, words: list[str]) -> Column:
    """1 when any of the words occurs in the line, ignoring case."""
    lowered = F.lower(line)
    hits = [F.contains(lowered, F.lit(w)) for w in words]
    return reduce(lambda a, b: a | b, hits).cast("int")


def _time_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "event_date": F.to_date("event_datetime"),
            "event_hour": F.hour("event_datetime"),
            "event_minute": F.minute("event_datetime"),
        }
    )


def _fields(line: Column, numbers: list[str], texts: list[str]) -> dict[str, Column]:
    return {c: int_field(line, NUMBER[c]) for c in numbers} | {c: text_field(line, TEXT[c]) for c in texts}


def parse_session_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Session events; other input columns (file name, ids) are kept."""
    text = F.col("_line")
    dated = (
        _with_trimmed(lines, line)
        .withColumn("event_datetime", header_time(text))
        .filter(F.col("event_datetime").isNotNull())
    )
    columns = {"event_type": event_type(text)}
    columns |= _fields(text, SESSION_NUMBERS, SESSION_TEXTS)
    columns |= {c: line_flag(text, p) for c, p in FLAGS.items()}
    columns["raw_line"] = F.substring(text, 1, RAW_LIMIT)
    return _time_parts(dated).withColumns(columns).drop("_line", line)


def parse_lock_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lock events; lines of other types are dropped before any field is extracted."""
    text = F.col("_line")
    locks = (
        _with_trimmed(lines, line)
        .withColumn("event_type", event_type(text))
        .filter(F.col("event_type").isin(LOCK_KINDS))
        .withColumn("event_datetime", header_time(text))
        .filter(F.col("event_datetime").isNotNull())
    )
    return _time_parts(locks).withColumns(_fields(text, LOCK_NUMBERS, LOCK_TEXTS)).drop("_line", line)


# Fields of the older comma-separated format, in matching order.
LEGACY_NUMBERS = {
    "duration": r"duration=(\d+)",
    "wait_time": r"waitTime=(\d+)",
    "lock_time": r"lockTime=(\d+)",
    "transaction": r"transaction=(\d+)",
    "connection": r"connection=(\d+)",
    "session": r"session=(\d+)",
    "dbpid": r"dbpid=(\d+)",
}
# Fields of the legacy form, in the order in which a part is tried.
LEGACY_ORDER = [
    "duration", "wait_time", "lock_time", "transaction", "connection", "session", "user", "computer", "app_id",
    "data", "context", "dbms", "dbpid", "block", "func",
]
LEGACY_KEYS = {"app_id": "app-id"}


def _legacy_pattern(name: str) -> str:
    return LEGACY_NUMBERS.get(name) or f'{LEGACY_KEYS.get(name, name)}="([^"]*)"'


def parse_legacy_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Older format: each comma-separated part feeds the first field it matches,
    a later part for the same field wins, unseen fields stay NULL."""
    text = F.col("_line")
    parts = F.split(text, ",")
    clock = F.split(F.get(parts, 0), ":")
    seconds = F.split(F.get(clock, 2), r"\.")

    def owner(part: Column) -> Column:
        chosen = F.when(part.rlike(_legacy_pattern(LEGACY_ORDER[0])), LEGACY_ORDER[0])
        for name in LEGACY_ORDER[1:]:
            chosen = chosen.when(part.rlike(_legacy_pattern(name)), name)
        return chosen

    def field(name: str) -> Column:
        mine = F.filter("_owned", lambda p: p["name"] == name)
        value = F.regexp_extract(F.try_element_at(mine, F.lit(-1))["part"], _legacy_pattern(name), 1)
        return value.try_cast("bigint") if name in LEGACY_NUMBERS else value

    tagged = F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.struct(owner(p).alias("name"), p.alias("part")))
    has_clock = F.size(clock) >= 3
    time_columns = {
        "hour": F.get(clock, 0).try_cast("int"),
        "minute": F.get(clock, 1).try_cast("int"),
        "second": F.get(seconds, 0).try_cast("int"),
        "millisecond": F.get(seconds, 1).try_cast("int"),
    }
    valid = F.size(seconds) == 2
    for c in time_columns:
        valid = valid & F.col(c).isNotNull()
    return (
        _with_trimmed(lines, line)
        .filter(F.size(parts) >= 5)
        .withColumns({c: F.when(has_clock, e) for c, e in time_columns.items()})
        .filter(~has_clock | valid)
        .withColumn("_owned", tagged)
        .withColumns({name: field(name) for name in LEGACY_ORDER})
        .withColumn("raw_line", text)
        .drop("_owned", "_line", line)
    )


def parse_stats(lines: DataFrame, line: str = "line", key: str = "file") -> DataFrame:
    """Lines seen, parsed and rejected per file."""
    text = _trimmed(line)
    return lines.groupBy(key).agg(
        F.count("*").alias("lines"),
        F.count(header_time(text)).alias("parsed"),
        F.count_if((text != "") & header_time(text).isNull()).alias("rejected"),
        F.count_if(text == "").alias("blank"),
    )
