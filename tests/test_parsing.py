from datetime import datetime, timezone

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sessionflow import schemas
from sessionflow.functions import parsing
from sessionflow.functions.envelope import envelope
from sessionflow.functions.timeconv import epoch_ms, floor_div, from_epoch_ms, from_wall_clock


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], schemas.LINES)


def test_vehicle(spark):
    good = ["{'vin':'A','createTime':1713258259878,'mileage':7}"]
    quoted = ["{'vin':'C','createTime':'1713258259878','mileage':'7'}"]
    bad = [
        "garbage",
        "",
        "{'mileage':7}",
        "{'vin':'','createTime':1,'mileage':7}",
        "{'vin':'B','createTime':1}",
        "{'vin':'B','createTime':null,'mileage':1}",
        "{'vin':'B','createTime':'x','mileage':1}",
        "{'vin':'B','createTime':9223372036854775807,'mileage':1}",
        "{'vin':'B','createTime':1,'mileage':7",
    ]
    parsed = parsing.parse_vehicle(lines(spark, *good, *quoted, *bad))
    kept = parsing.valid(parsed)
    assert kept.schema == schemas.VEHICLE
    assert rows(kept.select("vin", epoch_ms("createTime"), "mileage")) == [
        ("A", 1713258259878, 7),
        ("C", 1713258259878, 7),
    ]
    assert rows(parsing.quarantine(parsed)) == sorted([(b,) for b in bad], key=repr)


def test_null_line_is_quarantined(spark):
    parsed = parsing.parse_vehicle(spark.createDataFrame([(None,)], schemas.LINES))
    assert rows(parsing.quarantine(parsed)) == [(None,)]


def test_a_line_is_parsed_once(spark, capsys, tmp_path):
    parsing.valid(parsing.parse_vehicle(spark.read.text(str(tmp_path)))).explain()
    assert capsys.readouterr().out.count("from_json") == 1


def test_user_event_keeps_bad_times(spark):
    parsed = parsing.parse_user_event(
        lines(
            spark,
            "{'userId':'1','eventType':'click','eventTime':'2024-04-17 18:31:30'}",
            "{'userId':'1','eventType':'click','eventTime':'17.4.2024'}",
            "{'userId':'a,b','eventType':''}",
            "{'userId':'','eventType':'click','eventTime':'2024-04-17 18:31:30'}",
            "{'eventType':'click'}",
        )
    )
    kept = parsing.valid(parsed)
    assert kept.schema == schemas.USER_EVENT
    at = int(datetime(2024, 4, 17, 10, 31, 30, tzinfo=timezone.utc).timestamp() * 1000)
    assert rows(kept.select("userId", "eventType", epoch_ms("eventTime"))) == sorted(
        [("1", "click", at), ("1", "click", None), ("a,b", "", None)], key=repr
    )
    assert parsing.quarantine(parsed).count() == 2


def test_station(spark):
    parsed = parsing.parse_station(
        lines(
            spark,
            "{'station_id':'S','data_time':'2016-01-01 10:02:00'}",
            "{'station_id':'S','data_time':'yesterday'}",
            "{'data_time':'2016-01-01 10:02:00'}",
        )
    )
    assert parsing.valid(parsed).schema == schemas.STATION
    at = int(datetime(2016, 1, 1, 2, 2, tzinfo=timezone.utc).timestamp() * 1000)
    assert rows(parsing.valid(parsed).select("stationId", epoch_ms("dataTime"))) == [("S", at)]
    assert parsing.quarantine(parsed).count() == 2


def test_session_event(spark):
    parsed = parsing.parse_session_event(
        lines(
            spark,
            "{'id':1,'greet':'a','isLast':false}",
            "{'greet':'b','isLast':true}",
            "{'id':'x','greet':'c','isLast':true}",
            "{'id':2,'greet':'d'}",
            "nothing",
        )
    )
    assert parsing.valid(parsed).schema == schemas.SESSION_EVENT
    assert rows(parsing.valid(parsed)) == [(0, "b", True), (1, "a", False)]
    assert parsing.quarantine(parsed).count() == 3


def test_login(spark):
    parsed = parsing.parse_login(
        lines(
            spark,
            '{"event_time": "2018-01-01T00:00:00", "user_id": "mike"}',
            '{"event_time": "soon", "user_id": "mike"}',
            '{"event_time": "2018-01-01T00:00:00"}',
        )
    )
    assert parsing.valid(parsed).schema == schemas.LOGIN
    kept = parsing.valid(parsed).select(epoch_ms("event_time"), "user_id")
    assert rows(kept) == [(1514764800000, "mike")]
    assert parsing.quarantine(parsed).count() == 2


def test_read_json_expands_a_schema(spark):
    df = parsing.read_json(lines(spark, '{"a": 1, "b": "x"}', '{"b": "y"}'), "a INT, b STRING")
    assert df.columns == ["a", "b"]
    assert rows(df) == [(1, "x"), (None, "y")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_wall_clock_does_not_depend_on_the_session(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-04-17 18:31:30",), ("bad",), (None,)], "s string")
        got = [r[0] for r in df.select(F.unix_millis(from_wall_clock("s"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [1713349890000, None, None]


def test_times_and_division(spark):
    df = spark.createDataFrame([(-1,), (0,), (1713258259878,)], "ms long")
    got = df.select("ms", epoch_ms(from_epoch_ms("ms")), floor_div(F.col("ms"), 1000))
    assert rows(got) == [(-1, -1, -1), (0, 0, 0), (1713258259878, 1713258259878, 1713258259)]


def test_envelope(spark):
    df = spark.createDataFrame([(7, "a", None, True)], "id long, s string, n long, b boolean")
    assert rows(envelope(df, "id")) == [("7", '{"id":7,"s":"a","b":true}')]
    assert rows(envelope(df, "s", ["id"])) == [("a", '{"id":7}')]


def test_conform(spark):
    df = spark.createDataFrame([("5", 1, "x")], "mileage string, createTime long, vin string")
    bound = parsing.conform(df.withColumn("createTime", from_epoch_ms("createTime")), schemas.VEHICLE)
    assert bound.schema == schemas.VEHICLE
