import pytest
from helpers import rows

from sessionflow import schemas
from sessionflow.functions.envelope import envelope
from sessionflow.sources import lines, tables
from sessionflow.streaming import jobs, sinks
from sessionflow.streaming.runner import NO_DATA_BATCHES, STREAM_SETTINGS, run_available_now
from sessionflow.workdir import shared_dir


def test_socket_options(spark):
    assert lines.socket_options() == {"host": "localhost", "port": "3333"}
    stream = lines.socket_stream(spark, "example.org", 9)  # defined, not started
    assert stream.isStreaming and stream.columns == ["value"]


def test_kafka_options():
    assert lines.kafka_options() == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "test",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "40000",
        "failOnDataLoss": "false",
        "kafka.max.request.size": "4194304",
    }
    assert lines.kafka_options(topic="t", fail_on_data_loss=True)["failOnDataLoss"] == "true"


def test_text_table_and_stream(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    assert rows(lines.text_table(spark, str(tmp_path))) == [("x",), ("y",)]
    stream = lines.text_stream(spark, str(tmp_path))
    assert rows(run_available_now(stream, "lines", "append").select("value")) == [("x",), ("y",)]


def test_backlog_comes_with_live_lines(spark, tmp_path):
    for name, text in {"recorded": "old\n", "live": "new\n"}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.txt").write_text(text)
    both = lines.with_backlog(spark, f"{tmp_path}/recorded", f"{tmp_path}/live")
    with pytest.raises(ValueError):
        lines.with_backlog(spark, "/a/recorded", "/b/live")
    assert rows(run_available_now(both, "both", "append").select("value")) == [("new",), ("old",)]


def test_table_stream_of_a_folder_and_of_a_file(spark, tmp_path):
    spark.range(5).repartition(2).write.parquet(f"{tmp_path}/t.parquet")
    [file, *_] = (tmp_path / "t.parquet").glob("*.parquet")
    for path, n in ((f"{tmp_path}/t.parquet", 5), (str(file), spark.read.parquet(str(file)).count())):
        stream = tables.parquet_stream(spark, path, 1)
        assert run_available_now(stream, "table", "append").count() == n


def test_parquet_sink_replaces_a_repeated_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\n")
    out = str(tmp_path / "out")
    for run in range(2):  # a checkpoint that knows of no micro-batch makes the first one run again
        stream = lines.text_stream(spark, str(tmp_path / "in"))
        writer = sinks.parquet(stream, out, str(tmp_path / f"checkpoint{run}"), "append", {"availableNow": True})
        writer.start().awaitTermination()
    assert rows(sinks.read_batches(spark, out, stream.schema)) == [("x", 0)]


def test_nothing_was_written(spark, tmp_path):
    assert sinks.read_batches(spark, str(tmp_path / "none"), schemas.ENVELOPE).collect() == []


def test_complete_mode_gives_the_last_result(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.txt").write_text("x\n" * (i + 1))
    counted = lines.text_stream(spark, str(tmp_path), 1).groupBy("value").count()
    assert rows(run_available_now(counted, "complete", "complete").select("value", "count")) == [("x", 6)]


@pytest.mark.parametrize("known", ["spark.checkpoint.dir", "spark.sql.streaming.checkpointLocation", "spark.sql.warehouse.dir"])
def test_shared_dir_order(known):
    values = {known: "hdfs://host/place/", "spark.sql.warehouse.dir": "hdfs://host/place"}
    assert shared_dir(FakeSession(values, "spark://host"), "x").startswith("hdfs://host/place/sessionflow/x-")


def test_local_warehouse_is_refused_on_a_cluster():
    values = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}
    assert shared_dir(FakeSession(values, "local[2]"), "x").startswith("file:/tmp/warehouse/")
    with pytest.raises(ValueError):
        shared_dir(FakeSession(values, "spark://host"), "x")


class FakeSession:
    def __init__(self, values, master):
        self.conf, self.sparkContext = self, self
        self.values, self.master = values, master

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_console_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("{'userId':'1','eventType':'click','eventTime':'2024-04-17 18:31:30'}\n")
    stream = lines.text_stream(spark, f"{tmp_path}/in")
    query = jobs.start_on_console(jobs.counts, stream, f"{tmp_path}/checkpoint")
    query.processAllAvailable()
    progress = query.recentProgress
    query.stop()
    assert sum(p["numInputRows"] for p in progress) == 1
    assert "ConsoleTable" in progress[0]["sink"]["description"]


def test_jobs_keep_their_triggers():
    assert jobs.trip_status.trigger == {"processingTime": "10 seconds"}
    assert jobs.station_messages.trigger == {"processingTime": "5 seconds"}
    assert jobs.station_messages.name == "iot-status-query"
    assert jobs.trips.trigger == {} and jobs.spans.truncate


def test_settings_of_a_query_do_not_stay(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n")
    watched = [*STREAM_SETTINGS, NO_DATA_BATCHES]
    before = {k: spark.conf.get(k, None) for k in watched}
    run_available_now(lines.text_stream(spark, str(tmp_path)), "lines", "append", timeouts=False)
    assert {k: spark.conf.get(k, None) for k in watched} == before


def test_shared_dir_follows_the_cluster(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_kafka_messages_shape(spark):
    df = spark.createDataFrame([("S", 1)], "stationId string, n long")
    assert envelope(df, "stationId").schema.names == schemas.ENVELOPE.names


def test_session_settings(spark):
    from sessionflow.session import session

    same = session("again", spark__sql__shuffle__partitions="4")
    assert same.conf.get("spark.sql.session.timeZone") == "UTC"
    assert same.conf.get("spark.sql.shuffle.partitions") == "4"
