"""Sources, sinks and streams: awkward inputs, replays, and stream equals batch."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wxrisk.operators import models, cleaning, serving, views
from wxrisk.plans import batch
from wxrisk.schemas import DAILY, PAYLOAD, RAW, SERVING_BATCH, SERVING_COLUMNS, SERVING_STREAM
from wxrisk.session import scratch_path
from wxrisk.sinks import files as sinks
from wxrisk.sinks.tables import KeyedTable, last_per_key, write_with_fallback
from wxrisk.sources import files, fixtures, messages, payloads
from wxrisk.streaming import model_scoring, pipeline
from wxrisk.streaming.progress import ProgressCounter

NOON = dt.datetime(2024, 5, 1, 12)


def sent(spark, bodies):
    rows = [("k", b if isinstance(b, str) else json.dumps(b), i % 2, i, NOON) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "key string, value string, partition int, offset long, timestamp timestamp")
    return df.withColumn("value", F.col("value").cast("binary"))


def test_three_spellings_and_broken_text(spark):
    bodies = [
        {"District": "Bara", "Date": "2024-05-01", "MaxTemp_2m": 41.0, "Precip": 1, "Cloudiness": 7, "WeatherDesc": "x"},
        {"district": "Bara", "date": "2024-05-01", "max_temp": 41.0, "precipitation": 1, "cloudiness": 7, "weather_desc": "x"},
        {"District": "Bara", "Date": "2024-05-01", "MaxTemp_2m": 41.0, "Latitude": 27.0, "SolarRad": 3.5, "timestamp": "t"},
        {"District": "Bara", "MaxTemp_2m": "hot"},
        "not json",
    ]
    got = messages.decode_any(sent(spark, bodies)).collect()
    assert len(got) == 5
    assert got[0] == got[1] and got[0]["MaxTemp_2m"] == 41.0 and got[0]["Cloudiness"] == 7
    assert (got[2]["Latitude"], got[2]["SolarRad"]) == (27.0, 3.5)
    assert (got[3]["District"], got[3]["MaxTemp_2m"]) == ("Bara", None)
    assert got[4]["District"] is None
    strict = messages.decode(sent(spark, bodies)).collect()
    assert strict[0]["MaxTemp_2m"] == 41.0 and strict[1]["MaxTemp_2m"] is None and strict[4]["District"] is None
    placed = messages.decode_positions(sent(spark, bodies)).collect()
    assert [(r["kafka_partition"], r["kafka_offset"]) for r in placed] == [(0, 0), (1, 1), (0, 2), (1, 3), (0, 4)]


def test_storage_keeps_absent_and_null_apart(spark):
    bodies = [{"District": "Bara", "MaxTemp_2m": 30}, {"MaxTemp_2m": 30}, {"District": "Bara", "Precip": None},
              {"District": "Bara", "RH_2m": "wet"}, {"District": None}, "junk"]
    fields = messages.decode_fields(sent(spark, bodies), ("offset",))
    good, bad = cleaning.storage_record(fields, "fields", keep=("offset",))
    assert [(r["offset"], r["district"], r["max_temp"], r["precipitation"]) for r in good.collect()] == [
        (0, "Bara", 30.0, 0.0), (1, "Unknown", 30.0, 0.0)]
    assert sorted(r["offset"] for r in bad.collect()) == [2, 3, 4, 5]


PAYLOADS = [
    {"name": "N", "main": {"temp": 300.15, "humidity": 60}, "wind": {"speed": 2.0}, "clouds": {"all": 5},
     "rain": {"1h": 0, "3h": 2.0}, "weather": [{"main": "Rain", "description": "light rain"}],
     "sys": {"sunrise": 1704067200, "sunset": 0}, "coord": {"lat": 26.0, "lon": 85.0}},
    {"main": {"temp": 290.0, "temp_max": 295.0, "temp_min": 285.0}, "wind": {}, "clouds": {}, "weather": []},
    {},
]


def test_payload_shapes(spark):
    rows = [(json.dumps(p), "City", NOON, 26.0, 85.0) for p in PAYLOADS]
    df = spark.createDataFrame(rows, "payload string, city string, at timestamp, lat double, lon double")
    feed = payloads.to_feed(df, "city", "at").collect()
    assert [r["precipitation"] for r in feed] == [16.0, 0.0, 0.0]
    assert [r["temp_max"] for r in feed] == [27.0, 21.9, 0.0] and feed[1]["temp_range"] == 10.0
    assert [r["weather_main"] for r in feed] == ["Rain", "N/A", "N/A"]
    assert (feed[0]["sunrise"], feed[0]["sunset"]) == ("00:00", "N/A")
    assert (feed[2]["city_name"], feed[2]["latitude"], feed[2]["humidity"], feed[2]["pressure"]) == ("City", 27.0, 50, 1013)
    raw = payloads.to_raw(df, "city", "lat", "lon", "at")
    assert raw.columns == RAW.names and [f.dataType for f in raw.schema] == [f.dataType for f in RAW]
    assert [r["rain_1h"] for r in raw.collect()] == [0.0, 0.0, 0.0]
    assert raw.collect()[0]["sunset"] is None
    station = payloads.to_station(df, "city", "at").collect()
    assert [r["max_temp"] for r in station] == [300.15, 295.0, None] and station[0]["temp_range"] == 0.0
    assert [r["weather_desc"] for r in station] == ["light rain", "", ""]


def test_serving_types_match_the_tables(spark, folder):
    obs = fixtures.obs(spark, folder)
    batch = cleaning.serving_view(cleaning.transform_batch(obs))
    stream = cleaning.transform_stream(messages.decode(fixtures.message_values(obs)))
    for df, table in ((batch, SERVING_BATCH), (stream, SERVING_STREAM)):
        assert df.columns == SERVING_COLUMNS == table.names
        assert [f.dataType for f in df.schema] == [f.dataType for f in table]


def test_station_folder_names_the_district(spark):
    path = scratch_path(spark, "stations")
    measures = ",".join(c for c in DAILY.names if c != "District")
    rows = [(name, f"{measures}\n2024-05-0{i + 1},27,85,{40 + i},30,10,,50,1,2,3\n") for i, name in enumerate(["Bara", "East Side"])]
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, text in rows:
        out = fs.create(hadoop.Path(f"{path}/{name}.csv"))
        out.write(bytearray(text, "utf-8"))
        out.close()
    got = sorted((r["District"], str(r["Date"]), r["MaxTemp_2m"], r["Precip"]) for r in files.read_stations(spark, path).collect())
    assert got == [("Bara", "2024-05-01", 40.0, None), ("East Side", "2024-05-02", 41.0, None)]
    many = files.read_many_csv(spark, [f"{path}/Bara.csv", f"{path}/East Side.csv"])
    assert many.count() == 2 and dict(many.dtypes)["MaxTemp_2m"] in ("int", "double")


def test_missing_date_column_fails_at_once(spark):
    with pytest.raises(ValueError):
        files.with_date(spark.createDataFrame([(1,)], "x int"))


def test_no_records_keep_the_schema(spark):
    df = files.from_records(spark, [])
    assert df.schema == RAW and df.count() == 0


def test_last_of_very_many_copies(spark):
    hot = spark.range(3000).selectExpr("'a' as k", "id % 100 as version", "id % 100 as v")
    rows = hot.unionByName(spark.createDataFrame([("b", 1, 5)], "k string, version long, v long"))
    assert sorted(tuple(r) for r in last_per_key(rows, ["k"], ["version"]).collect()) == [("a", 99, 99), ("b", 1, 5)]


def test_upsert_replaces_and_repeats_safely(spark):
    schema = "district string, at int, v int"
    table = KeyedTable(spark, scratch_path(spark, "keyed"), ["district", "at"], ["district"], ["at"])
    table.upsert(spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 1, 1)], schema), ["v"], "0")
    second = spark.createDataFrame([("a", 2, 7), ("a", 2, 6), ("a", 3, 7)], schema)
    for _ in range(2):
        table.upsert(second, ["v"], "1")
        got = sorted((r["district"], r["at"], r["v"]) for r in table.read().collect())
        assert got == [("a", 1, 1), ("a", 2, 7), ("a", 3, 7), ("b", 1, 1)]


def test_upsert_cut_short_is_finished_from_staging(spark):
    """The stored partition is lost half way through putting the merged rows in place."""
    schema = "district string, at int, v int"
    path = scratch_path(spark, "keyed")
    table = KeyedTable(spark, path, ["district", "at"], ["district"])
    table.upsert(spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], schema), ["v"], "0")
    second = spark.createDataFrame([("a", 2, 2)], schema)
    write, calls = table._write, []

    def dies(df, where, mode):
        calls.append(where)
        spark.createDataFrame([("a", 9, 9)], schema).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("district").parquet(path)
        raise RuntimeError("driver lost")

    table._write = dies
    with pytest.raises(RuntimeError):
        table.upsert(second, ["v"], "1")
    table._write = write
    table.upsert(second, ["v"], "1")
    assert sorted((r["district"], r["at"], r["v"]) for r in table.read().collect()) == [("a", 1, 1), ("a", 2, 2), ("b", 1, 1)]


def test_fallback_only_when_the_primary_fails(spark):
    df, path = spark.range(3), scratch_path(spark, "fallback")
    assert write_with_fallback(df, lambda d: d.write.mode("overwrite").parquet(f"{path}/main"), f"{path}/spare") == "primary"
    assert write_with_fallback(df, lambda d: d.write.format("no.such").save(), f"{path}/spare") == "fallback"
    assert spark.read.parquet(f"{path}/spare").count() == 3


def test_history_rows_and_rejects(spark):
    rows = [("Bara", "2024-05-01 00:00", "41.5"), ("Bara", "soon", "1"), ("Bara", "2024-05-02", "x"), ("Bara", "2024-05-03", None)]
    df = spark.createDataFrame(rows, "District string, Date string, MaxTemp_2m string")
    good, bad = sinks.history_records(df)
    assert sorted((str(r["date"]), r["year"], r["max_temp"], r["precipitation"]) for r in good.collect()) == [
        ("2024-05-01", 2024, 41.5, 0.0), ("2024-05-03", 2024, None, 0.0)]
    assert sorted(r["Date"] for r in bad.collect()) == ["2024-05-02", "soon"]


def feed(spark, folder, parts):
    """Messages over the test events in several files, as a folder to stream from."""
    path = scratch_path(spark, "feed")
    values = fixtures.message_values(fixtures.obs(spark, folder)).drop("event_id")
    values.repartition(parts, "offset").write.parquet(path)
    return path, spark.read.parquet(path)


def test_stream_equals_batch_and_survives_replay(spark, folder):
    path, stored = feed(spark, folder, 4)
    root = scratch_path(spark, "run")
    table = KeyedTable(spark, f"{root}/serving", ["district", "fetch_time"], ["district"], ["fetch_time"])
    seen = []
    writers = pipeline.BatchWriters(
        {"lake": pipeline.lake_sink(f"{root}/lake"), "serving": pipeline.table_sink(table, ["etl_timestamp"])},
        audit=f"{root}/audit",
    )

    def twice(batch, batch_id):
        """Every micro-batch is delivered twice, as after a failure before the commit."""
        writers(batch, batch_id)
        writers(batch, batch_id)
        seen.append(batch_id)

    stream = pipeline.serving_stream(pipeline.replay_stream(spark, path, stored.schema, 1))
    query = pipeline.start(stream, twice, f"{root}/checkpoint", seconds=None)
    query.awaitTermination()
    assert len(seen) == 4
    expected = pipeline.serving_stream(stored).drop("etl_timestamp")
    for got in (files.read_lake(spark, f"{root}/lake").drop("batch_id"), table.read()):
        got = got.select(*SERVING_COLUMNS).drop("etl_timestamp")
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    audit = spark.read.parquet(f"{root}/audit").agg(F.sum("records_count")).first()[0]
    assert audit == expected.count()


def test_one_failing_sink_does_not_stop_the_others(spark):
    root = scratch_path(spark, "sinks")

    def fails(batch, batch_id):
        raise OSError("store is down")

    batch = spark.createDataFrame([("a", 1)], "district string, v int")
    with pytest.raises(RuntimeError):
        pipeline.BatchWriters({"bad": fails, "lake": pipeline.lake_sink(f"{root}/lake")}, audit=f"{root}/audit")(batch, 0)
    assert spark.read.parquet(f"{root}/lake").count() == 1
    assert spark.read.parquet(f"{root}/audit").first()["status"] == "error"
    pipeline.BatchWriters({"bad": fails}, fallback=f"{root}/spare")(batch, 0)
    assert spark.read.parquet(f"{root}/spare/bad").count() == 1
    called = []
    pipeline.BatchWriters({"x": lambda b, i: called.append(i)})(batch.limit(0), 1)
    assert called == []


def test_counter_over_several_batches(spark, folder):
    path, stored = feed(spark, folder, 3)
    root = scratch_path(spark, "counter")
    table = KeyedTable(spark, f"{root}/c", ["stat_date", "district", "hour"], ["stat_date"])
    rows = pipeline.serving_stream(pipeline.replay_stream(spark, path, stored.schema, 1))
    counted = pipeline.counter_stream(rows.select("district", "fetch_time"))
    pipeline.start(counted, pipeline.table_sink(table, ["record_count"]), f"{root}/k", seconds=None, mode="update").awaitTermination()
    expected = views.ingest_counter(pipeline.serving_stream(stored))
    got = table.read().select("stat_date", "district", "hour", "record_count")
    assert got.exceptAll(expected).count() == 0 and expected.count() == got.count()


def test_counter_keeps_late_hours(spark):
    root = scratch_path(spark, "late")
    for k, hour in enumerate((10, 20, 11, 12)):
        rows = spark.createDataFrame([("d",)] * 10, "district string").withColumn("fetch_time", F.lit(f"2024-01-01 {hour}:05:00").cast("timestamp"))
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in/{k}")
    table = KeyedTable(spark, f"{root}/c", ["stat_date", "district", "hour"], ["stat_date"])
    stream = pipeline.replay_stream(spark, f"{root}/in/*", "district string, fetch_time timestamp", 1)
    pipeline.start(pipeline.counter_stream(stream), pipeline.table_sink(table, ["record_count"]), f"{root}/k", seconds=None, mode="update").awaitTermination()
    assert sorted((r.hour, r.record_count) for r in table.read().collect()) == [(10, 10), (11, 10), (12, 10), (20, 10)]


def test_upserts_keep_rows_without_partition_or_key(spark):
    table = KeyedTable(spark, f"{scratch_path(spark, 'nulls')}/t", ["name", "place"], ["place"])
    kind = "name string, place string, v long"
    table.upsert(spark.createDataFrame([("a", None, 1), ("b", "x", 1), (None, None, 1), ("c", "y", 1)], kind), ["v"], "1")
    table.upsert(spark.createDataFrame([("d", None, 2), (None, None, 2), ("b", "x", 2)], kind), ["v"], "2")
    found = sorted(map(str, map(tuple, table.read().select("name", "place", "v").collect())))
    assert found == sorted(map(str, [("a", None, 1), ("b", "x", 2), ("c", "y", 1), ("d", None, 2), (None, None, 2)]))


def test_recent_buffer_and_checkpoint_choice(spark, folder):
    path, stored = feed(spark, folder, 3)
    root = scratch_path(spark, "buffer")
    buffer = pipeline.RecentBuffer(spark, f"{root}/b", 25, "timestamp", "offset")
    query = pipeline.start(pipeline.replay_stream(spark, path, stored.schema, 1), buffer, f"{root}/k", seconds=None)
    query.awaitTermination()
    expected = stored.orderBy(F.desc("timestamp"), F.desc("offset")).limit(25)
    assert buffer.read(query.lastProgress["batchId"]).exceptAll(expected).count() == 0
    assert pipeline.checkpoint_location(spark, f"{root}/k", "/fallback") == f"{root}/k"
    assert pipeline.checkpoint_location(spark, "nofs://host/x", "/fallback") == "/fallback"
    assert pipeline.checkpoint_location(spark, None, "/fallback") == "/fallback"


def test_progress_figures(spark, folder):
    path, stored = feed(spark, folder, 2)
    counter = ProgressCounter()
    spark.streams.addListener(counter)
    try:
        root = scratch_path(spark, "progress")
        writer = pipeline.BatchWriters({"lake": pipeline.lake_sink(f"{root}/l")})
        pipeline.start(pipeline.replay_stream(spark, path, stored.schema, 1), writer, f"{root}/k", seconds=None).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(counter)
    assert (counter.figures.batches, counter.figures.rows) == (2, stored.count())
    assert counter.figures.per_second > 0 and counter.figures.errors == 0
    assert 0 < counter.figures.mean_rate <= counter.figures.rate_peak


class _Progress:
    def __init__(self, number, rows, rate, query="q"):
        self.id, self.batchId, self.numInputRows, self.processedRowsPerSecond = query, number, rows, rate
        self.batchDuration, self.timestamp, self.progress = 500, f"t{number}", self


def test_progress_sums_survive_a_restart(spark):
    store = scratch_path(spark, "figures")
    first = ProgressCounter(spark, store)
    for report in (_Progress(0, 10, 4.0), _Progress(1, 0, 0.0), _Progress(2, 30, 8.0), _Progress(2, 30, 8.0)):
        first.onQueryProgress(report)
    again = ProgressCounter(spark, store)
    assert again.figures == first.figures and (again.figures.batches, again.figures.rows, again.figures.rate_peak) == (2, 40, 8.0)
    again.onQueryProgress(_Progress(2, 30, 8.0))
    again.onQueryProgress(_Progress(3, 2, 3.0))
    assert (again.figures.batches, again.figures.rows, again.figures.mean_rate) == (3, 42, 5.0)
    assert ProgressCounter(spark, store).figures == again.figures
    assert ProgressCounter(spark, scratch_path(spark, "nothing")).figures.batches == 0


def test_an_upsert_rewrites_only_the_days_it_touches(spark):
    path = scratch_path(spark, "days")
    table = KeyedTable(spark, path, ["district", "at"], ["district"], ["at"], derived={"part_day": F.to_date("at")})
    history = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("district"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("at"),
        F.lit(1).alias("v"))
    table.upsert(history, ["v"], "1")

    def files():
        return {f.split("/days")[1] for f in spark.read.parquet(path).inputFiles()}

    before = files()
    fresh = spark.createDataFrame([("a", dt.datetime(2024, 1, 3, 0), 2), ("b", dt.datetime(2024, 1, 3, 1), 2), ("a", dt.datetime(2024, 3, 1), 2)], "district string, at timestamp, v int")
    table.upsert(fresh, ["v"], "2")
    rewritten = {f.rsplit("/", 1)[0] for f in before - files()}
    assert len(rewritten) == 2 and all("part_day=2024-01-03" in f for f in rewritten)
    assert table.read().columns == ["at", "v", "district"] or set(table.read().columns) == {"district", "at", "v"}
    assert table.read().count() == 401 and table.read().where("v = 2").count() == 3


def _scored_feed(spark, folder, parts):
    path, stored = feed(spark, folder, parts)
    return pipeline.scored_stream(pipeline.replay_stream(spark, path, stored.schema, 1)), stored


def test_a_stream_takes_up_new_models_and_survives_broken_ones(spark, folder):
    stream, stored = _scored_feed(spark, folder, 5)
    root = scratch_path(spark, "versions")
    versions = model_scoring.ModelVersions(spark, f"{root}/models")
    data = spark.createDataFrame([(float(k), float(k % 7), int(k > 20)) for k in range(40)], "MaxTemp_2m double, Precip double, label int")
    model, card = models.train_trees(data, ["MaxTemp_2m", "Precip"], rounds=2)
    other, _ = models.train_trees(data.withColumnRenamed("Precip", "no_such_input"), ["no_such_input"], rounds=2)
    scorer = model_scoring.ScoreByNewestModel(versions, pipeline.lake_sink(f"{root}/out"))

    def write(batch, batch_id):
        scorer(batch, batch_id)
        if batch_id == 0:
            spark.createDataFrame([("no card",)], "card string").write.text(f"{root}/models/v=1/card")
        elif batch_id == 1:
            assert versions.publish(model, card) == 2
        elif batch_id == 3:
            versions.publish(other, models.ModelCard("trees", "heatwave", []))

    pipeline.start(stream, write, f"{root}/k", seconds=None).awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    used = {r.batch_id: (r.source, r.model_version) for r in out.select("batch_id", "source", "model_version").distinct().collect()}
    assert used == {0: ("rule", None), 1: ("rule", None), 2: ("model", 2), 3: ("model", 2), 4: ("rule", None)}
    assert out.count() == stored.count() and out.where("not heatwave_probability between 0 and 1").count() == 0
    assert set(scorer.broken) == {1, 3}


def test_unknown_hours_and_speed_first(spark):
    rows = [("Bara", NOON, 1), ("Bara", NOON - dt.timedelta(hours=5), 2), ("Parsa", NOON, 3)]
    df = spark.createDataFrame(rows, "district string, fetch_time timestamp, v int")
    got = serving.observations(df, "Bara", 10, hours=2, as_of=NOON).collect()
    assert [r["v"] for r in got] == [1]
    merged = serving.speed_over_batch(df.filter("v = 2"), df.filter("v in (1, 3)"))
    assert sorted((r["district"], r["layer"]) for r in merged.collect()) == [("Bara", "speed"), ("Parsa", "batch")]


def test_payload_schema_reads_both_rain_fields():
    assert PAYLOAD["rain"].dataType.names == ["1h", "3h"]


def test_load_reports_and_reloads(spark, folder):
    root = scratch_path(spark, "load")
    tables = batch.serving_tables(spark, f"{root}/serving")
    raw = fixtures.obs(spark, folder)
    first = batch.load(spark, raw, f"{root}/out", tables, "one")
    assert first.extracted == first.transformed == raw.count() and 0 < first.daily_summaries < first.extracted
    stored = {n: t.read().count() for n, t in tables.items()}
    assert stored["weather_transformed"] == raw.count() and stored["weather_alerts"] == first.alerts > 0
    assert batch.load(spark, raw.filter("event_id < 100"), f"{root}/again", tables, "two").extracted == 100
    assert tables["weather_transformed"].read().count() == raw.count()
    for table in tables.values():
        assert {f.name: f.dataType for f in table.read().schema} == {f.name: f.dataType for f in table.schema}


def test_message_load_and_rebuild(spark, folder):
    path, stored = feed(spark, folder, 2)
    root = scratch_path(spark, "messages")
    batch.start_load(spark, pipeline.replay_stream(spark, path, stored.schema, 1), root, seconds=None).awaitTermination()
    table = batch.serving_tables(spark, f"{root}/serving", "stream")["weather_transformed"]
    assert table.read().count() == stored.count()
    rebuilt = batch.rebuild_daily(spark, f"{root}/lake", f"{root}/daily")
    assert rebuilt.agg(F.sum("observation_count")).first()[0] == stored.count()
    log = spark.read.parquet(f"{root}/ingest_log")
    assert log.agg(F.sum("records_count")).first()[0] == stored.count() and "duration_ms" in log.columns


def test_payload_load(spark, folder):
    root = scratch_path(spark, "payloads")
    rows = fixtures.payloads(fixtures.obs(spark, folder)).selectExpr(
        "city", "fetch_time", "26.5D as latitude", "85.5D as longitude", "payload")
    rows.repartition(2).write.json(f"{root}/drops")

    def to_raw(df):
        return payloads.to_raw(df, "city", "latitude", "longitude", "fetch_time")

    batch.start_payload_load(spark, f"{root}/drops", root, to_raw, seconds=None).awaitTermination()
    assert batch.serving_tables(spark, f"{root}/serving")["weather_transformed"].read().count() == rows.count()


def test_upsert_over_many_partitions(spark):
    """Touched partitions are merged, the others stay."""
    schema = "district string, at int, v int"
    table = KeyedTable(spark, scratch_path(spark, "keyed"), ["district", "at"], ["district"])
    table.upsert(spark.createDataFrame([(d, 1, 1) for d in "abcdef"], schema), ["v"], "0")
    table.upsert(spark.createDataFrame([(d, 1, 2) for d in "abcd"] + [("a", 2, 2)], schema), ["v"], "1")
    got = sorted((r["district"], r["at"], r["v"]) for r in table.read().collect())
    assert got == [("a", 1, 2), ("a", 2, 2), ("b", 1, 2), ("c", 1, 2), ("d", 1, 2), ("e", 1, 1), ("f", 1, 1)]
