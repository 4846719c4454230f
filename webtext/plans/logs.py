"""Queries over log lines and events, retention and routing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from webtext.functions import logline
from webtext.operators import bindings, logs, retention
from webtext.plans import sql
from webtext.session import fresh_dir
from webtext.sources import collections as store
from webtext.sources import lines

NOW = datetime(2024, 1, 20)

# Fixed values of the test mapping: event type -> log level.
EVENT_LEVELS = {"error": "ERROR", "signup": "WARN", "purchase": "INFO"}


def _events(spark, folder):
    return store.table(spark, folder, "events")


def _level() -> Column:
    chain = None
    for kind, level in EVENT_LEVELS.items():
        test = F.col("event_type") == kind
        chain = F.when(test, F.lit(level)) if chain is None else chain.when(test, F.lit(level))
    return chain.otherwise("DEBUG")


def event_lines(spark, folder):
    """Events printed as log lines ``(event_id, value)``."""
    line = logline.format_line(
        F.col("ts"),
        _level(),
        F.concat(F.lit("user-"), F.col("user_id")),
        F.concat(F.lit("app."), F.col("event_type")),
        F.col("event_id") % 1000,
        F.concat_ws(" | ", "event_type", "props"),
    )
    return store.scan(spark, folder, "events").select("event_id", line.alias("value"))


def _parsed(spark, folder):
    return logs.parse_lines(event_lines(spark, folder))


def _routed(spark, folder):
    return logs.route_levels(_parsed(spark, folder))


def line_ingest(spark, folder):
    """Write the lines to a file folder, then ingest that as a line source."""
    files = fresh_dir(spark, "lines")
    event_lines(spark, folder).select("value").write.text(files)
    return lines.read_lines(spark, files, ("demo",)).select("message", F.array_join("tags", ",").alias("tags"))


def log_rotated(spark, folder):
    """The daily rotated sink: written by sink and day, then read back."""
    path = fresh_dir(spark, "rotated")
    logs.write_routed(_routed(spark, folder), path)
    return logs.read_routed(spark, path).select("event_id", "level", "msg", "sink", "day")


def _days(spark, folder):
    return _events(spark, folder).select(F.to_date("ts").alias("day")).distinct()


def retention_plan(spark, folder):
    names = F.explode(F.array(F.lit("logstash-"), F.lit("articles-")))
    catalogue = _days(spark, folder).select(
        names.alias("prefix"), "day"
    ).select(
        F.concat("prefix", F.date_format("day", "yyyy.MM.dd")).alias("name"),
        F.col("day").cast("timestamp_ntz").alias("creation_date"),
    )
    return retention.retention_plan(catalogue, NOW)


def time_buckets(spark, folder):
    events = _events(spark, folder).select("ts")
    chosen = store.scan_all({"logstash-a": events, "logstash-b": events, "other": events}, "logstash-")
    return logs.time_buckets(chosen)


def _messages(spark, folder):
    """Events as messages; one user in three publishes through a longer source name."""
    audit = F.when(F.col("user_id") % 3 == 0, ".audit").otherwise("")
    prefix = F.when(F.col("user_id") % 5 == 0, "myExchange.").otherwise("exchange.")
    return _events(spark, folder).select(
        "event_id",
        F.concat(prefix, F.col("event_type"), audit).alias("exchange"),
        F.col("event_type").alias("routing_key"),
    )


def _user_messages(spark, folder):
    """Events whose source name also has the user, and for some a further word."""
    audit = F.when(F.col("event_id") % 3 == 0, ".audit").otherwise("")
    return _events(spark, folder).select(
        "event_id", F.concat(F.lit("exchange."), "event_type", F.lit(".u"), "user_id", audit).alias("exchange")
    )


def _user_bindings(spark, folder):
    """A binding for each user, in four forms, and one for each type."""
    users = _events(spark, folder).select("user_id").distinct()
    word = F.concat(F.lit("u"), "user_id")
    form = F.col("user_id") % 4
    pattern = (
        F.when(form == 0, F.concat(F.lit("*.*."), word))
        .when(form == 1, F.concat(F.lit("#."), word))
        .when(form == 2, F.concat(F.lit("exchange.#."), word, F.lit(".audit")))
        .otherwise(F.concat(F.lit("#."), word, F.lit(".#")))
    )
    types = _events(spark, folder).select(F.concat(F.lit("exchange."), "event_type", F.lit(".#")).alias("pattern")).distinct()
    return users.select(pattern.alias("pattern")).unionByName(types)


def topic_bindings(spark, folder):
    return bindings.route_bindings(_user_messages(spark, folder), _user_bindings(spark, folder))


QUERIES = {
    "log_lines": lambda spark, folder: _parsed(spark, folder).drop("raw"),
    "line_ingest": line_ingest,
    "log_route": lambda spark, folder: _routed(spark, folder).select("event_id", "level", "sink"),
    "log_daily_counts": lambda spark, folder: logs.daily_sink_counts(_parsed(spark, folder)),
    "log_rotated": log_rotated,
    "time_buckets": time_buckets,
    "retention_plan": retention_plan,
    "topic_route": lambda spark, folder: logs.route_topic(_messages(spark, folder), "exchange.*"),
    "topic_route_all": lambda spark, folder: logs.route_topic(_messages(spark, folder), "exchange.#"),
    "topic_bindings": topic_bindings,
    "key_route": lambda spark, folder: logs.route_key(_messages(spark, folder), "click"),
}

_LEVELS_SQL = " ".join(f"WHEN '{kind}' THEN '{level}'" for kind, level in EVENT_LEVELS.items())
LINES_SQL = f"""lines AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ' | ' || rpad(level, 5, ' ') || ' | ' ||
    rpad(right('user-' || user_id, 10), 10, ' ') || ' | ' || rpad(right('app.' || event_type, 20), 20, ' ') || ':' ||
    rpad((event_id % 1000)::varchar, 5, ' ') || ' | ' || event_type || ' | ' || props AS value
  FROM (SELECT *, CASE event_type {_LEVELS_SQL} ELSE 'DEBUG' END AS level FROM events)
)"""
_PARSED_SQL = rf"""{LINES_SQL},
parsed AS (
  SELECT event_id, f.ts::timestamp AS ts, f.level, f.thread, rtrim(f.cls) AS cls, f.line::int AS line, f.msg
  FROM (SELECT event_id, regexp_extract(value,
    '^(\d{{4}}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{{3}}) \| (\w+)\s*\| (.*?)\s*\| (.*?):(\d+)\s*\| (.*)$',
    ['ts', 'level', 'thread', 'cls', 'line', 'msg']) AS f FROM lines)
)"""
_ROUTED_SQL = f"""{_PARSED_SQL},
ranks AS (SELECT unnest({list(logline.LEVELS)}) AS level, unnest(range({len(logline.LEVELS)})) AS r),
sinks AS (SELECT * FROM (VALUES ('DATA', 0, 3), ('ERROR', 0, 1), ('WARN', 2, 2), ('ALL', 0, 4)) s(sink, lo, hi)),
routed AS (SELECT parsed.*, sink FROM parsed JOIN ranks USING (level) JOIN sinks ON r BETWEEN lo AND hi)"""
_MESSAGES_SQL = """messages AS (
  SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 'myExchange.' ELSE 'exchange.' END || event_type ||
    CASE WHEN user_id % 3 = 0 THEN '.audit' ELSE '' END AS exchange, event_type AS routing_key FROM events
)"""

SQL = {
    "log_lines": f"WITH {_PARSED_SQL} SELECT * FROM parsed",
    "line_ingest": f"WITH {LINES_SQL} SELECT value AS message, 'demo' AS tags FROM lines",
    "log_route": f"WITH {_ROUTED_SQL} SELECT event_id, level, sink FROM routed",
    "log_daily_counts": f"WITH {_ROUTED_SQL} SELECT sink, ts::date AS day, count(*) AS lines FROM routed GROUP BY ALL",
    "log_rotated": f"WITH {_ROUTED_SQL} SELECT event_id, level, msg, sink, ts::date AS day FROM routed",
    "time_buckets": "SELECT date_trunc('hour', ts) AS bucket, 2 * count(*) AS events FROM events GROUP BY ALL",
    "retention_plan": """
SELECT DISTINCT 'logstash-' || strftime(ts, '%Y.%m.%d') AS name, ts::date::timestamp AS creation_date
FROM events WHERE ts::date < timestamp '2024-01-20' - INTERVAL 2 DAY""",
    "topic_route": rf"WITH {_MESSAGES_SQL} SELECT * FROM messages WHERE regexp_matches(exchange, '^exchange\.[^.]+$')",
    "topic_route_all": rf"WITH {_MESSAGES_SQL} SELECT * FROM messages WHERE starts_with(exchange, 'exchange.')",
    "key_route": f"WITH {_MESSAGES_SQL} SELECT * FROM messages WHERE routing_key = 'click'",
    "topic_bindings": r"""
WITH m AS (
  SELECT event_id, user_id, event_type,
    'exchange.' || event_type || '.u' || user_id || CASE WHEN event_id % 3 = 0 THEN '.audit' ELSE '' END AS exchange FROM events
),
u AS (
  SELECT DISTINCT user_id, 'u' || user_id AS w, CASE user_id % 4 WHEN 0 THEN '*.*.' || w WHEN 1 THEN '#.' || w
    WHEN 2 THEN 'exchange.#.' || w || '.audit' ELSE '#.' || w || '.#' END AS pattern,
    CASE user_id % 4 WHEN 0 THEN '[^.]+[.][^.]+[.]' || w WHEN 1 THEN '(.*[.])?' || w
    WHEN 2 THEN 'exchange[.](.*[.])?' || w || '[.]audit' ELSE '(.*[.])?' || w || '([.].*)?' END AS expression FROM events
)
SELECT event_id, exchange, pattern FROM m JOIN u USING (user_id) WHERE regexp_full_match(exchange, expression)
UNION ALL SELECT event_id, exchange, 'exchange.' || event_type || '.#' FROM m""",
}
