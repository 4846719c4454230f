from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from webtext.functions import logline
from webtext.operators import logs, retention
from webtext.sources import collections as store
from webtext.sources import lines

SAMPLE = "2013-04-03 07:37:51.993 | WARN  | main       | lnetgateway.Server:56    | My app is logging stuff"
FIELDS = ["ts", "level", "thread", "cls", "line", "msg"]


def parsed(spark, *values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return [tuple(r[f] for f in FIELDS) for r in logs.parse_lines(df).collect()]


def test_sample_line(spark):
    assert parsed(spark, SAMPLE) == [
        (datetime(2013, 4, 3, 7, 37, 51, 993000), "WARN", "main", "lnetgateway.Server", 56, "My app is logging stuff")
    ]


def test_message_may_hold_bars(spark):
    assert parsed(spark, SAMPLE + " | more | and: 7")[0][5] == "My app is logging stuff | more | and: 7"


@pytest.mark.parametrize(
    "line",
    [
        "no log line",
        "",
        None,
        SAMPLE.replace("04-03", "13-03"),
        SAMPLE.replace(".993", ""),
        SAMPLE.replace(":56 ", " 56 "),
        SAMPLE.replace("WARN ", "WA RN"),
        SAMPLE.rsplit(" | ", 1)[0],
    ],
)
def test_line_that_does_not_fit(spark, line):
    df = spark.createDataFrame([(line,)], "value string")
    row = logs.parse_lines(df).first()
    assert row["raw"] == line and all(row[f] is None for f in FIELDS)


def test_format_and_parse_are_inverse(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-02 03:04:05.678' ts, 'ERROR' level, 'worker-with-a-long-name' t, 'a.B' c, 7 n, 'm' m"
    )
    line = logline.format_line(*[F.col(c) for c in ("ts", "level", "t", "c", "n", "m")])
    text = df.select(line.alias("value"))
    assert text.first()[0] == "2024-01-02 03:04:05.678 | ERROR | -long-name | a.B                 :7     | m"
    row = logs.parse_lines(text).first()
    assert tuple(row)[1:] == (datetime(2024, 1, 2, 3, 4, 5, 678000), "ERROR", "-long-name", "a.B", 7, "m")


def test_routing_by_level(spark):
    df = spark.createDataFrame([(x,) for x in [*logline.LEVELS, "odd", None]], "level string")
    routed = {}
    for r in logs.route_levels(df).collect():
        routed.setdefault(r["level"], set()).add(r["sink"])
    assert routed == {
        "FATAL": {"DATA", "ERROR", "ALL"},
        "ERROR": {"DATA", "ERROR", "ALL"},
        "WARN": {"DATA", "WARN", "ALL"},
        "INFO": {"DATA", "ALL"},
        "DEBUG": {"ALL"},
    }


def test_routed_files_are_pruned_by_sink_and_day(spark, tmp_path):
    df = spark.createDataFrame([("ERROR",), ("INFO",)], "level string").withColumn("ts", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    routed = logs.route_levels(df)
    logs.write_routed(routed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    errors = back.filter("sink = 'ERROR' AND day = date'2024-01-01'")
    assert errors.count() == 1
    assert "PartitionFilters: [isnotnull(sink" in errors._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in logs.daily_counts(routed).select("sink", "lines").collect()} == {("DATA", 2), ("ERROR", 1), ("ALL", 2)}


def test_time_buckets_with_bounds(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, id * 20) AS ts FROM range(12)")
    got = logs.time_buckets(df, start=F.lit("2024-01-01 01:00:00").cast("timestamp"), end=F.lit("2024-01-01 03:00:00").cast("timestamp"))
    assert [r["events"] for r in got.orderBy("bucket").collect()] == [3, 3]


@pytest.mark.parametrize(
    "pattern, kept",
    [
        ("exchange.*", {"exchange.1", "exchange.other"}),
        ("exchange.#", {"exchange", "exchange.1", "exchange.other", "exchange.a.b"}),
        ("#.b", {"exchange.a.b", "b"}),
        ("*.a.b", {"exchange.a.b"}),
        ("exchange.#.b", {"exchange.a.b"}),
        ("#", {"exchange", "exchange.1", "exchange.other", "exchange.a.b", "myExchange", "b", "exchangeX1"}),
        ("myExchange", {"myExchange"}),
    ],
)
def test_topic_patterns(spark, pattern, kept):
    names = ["exchange", "exchange.1", "exchange.other", "exchange.a.b", "myExchange", "b", "exchangeX1"]
    df = spark.createDataFrame([(n, f"test {i}") for i, n in enumerate(names)], "exchange string, body string")
    assert {r["exchange"] for r in logs.route_topic(df, pattern).collect()} == kept


def test_direct_routing(spark):
    df = spark.createDataFrame([("a" if i % 2 else "b", f"test {i}") for i in range(1, 21)], "routing_key string, body string")
    assert logs.route_key(df, "a").count() == 10


NOW = datetime(2024, 1, 10)
CATALOGUE = [
    ("logstash-2024.01.05", datetime(2024, 1, 5)),
    ("logstash-2024.01.09", datetime(2024, 1, 9)),
    ("logstash-2024.01.08", datetime(2024, 1, 8)),
    ("articles", datetime(2024, 1, 1)),
]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_retention(spark, kind):
    df = spark.createDataFrame(CATALOGUE, "name string, creation_date timestamp_ntz").withColumn("creation_date", F.col("creation_date").cast(kind))
    plan = retention.retention_plan(df, NOW)
    assert retention.apply_retention(spark, plan) == ["logstash-2024.01.05"]
    assert retention.apply_retention(spark, retention.retention_plan(df.limit(0), NOW), apply=True) == []


def test_retention_drops_tables(spark):
    schema = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    for name in ("logstash_old", "logstash_new"):
        store.create_collection(spark, name, schema)
        store.create_collection(spark, name, schema)
    df = spark.createDataFrame([("logstash_old", datetime(2024, 1, 1)), ("logstash_new", NOW)], "name string, creation_date timestamp_ntz")
    plan = retention.retention_plan(df, NOW, prefix="logstash_")
    retention.apply_retention(spark, plan)
    assert spark.catalog.tableExists("logstash_old")
    retention.apply_retention(spark, plan, apply=True)
    assert not spark.catalog.tableExists("logstash_old") and spark.catalog.tableExists("logstash_new")
    spark.sql("DROP TABLE logstash_new")


def test_lines_to_events(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("one\ntwo | x\n\n")
    events = lines.read_lines(spark, str(tmp_path / "in"), ("docker",))
    lines.append_events(events, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["message"] for r in back.collect()) == ["", "one", "two | x"]
    assert back.filter("tags[0] <> 'docker' OR `@timestamp` IS NULL OR date IS NULL").count() == 0


def test_json_lines(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("broken",)], "value string")
    schema = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    rows = lines.json_line_events(df, schema).select("message", "a", "b").collect()
    assert [tuple(r)[1:] for r in rows] == [(1, "x"), (None, None)]
