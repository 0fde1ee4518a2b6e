"""Queries over messages, payloads and files: decode, parse, store, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from wxrisk.operators import cleaning as C
from wxrisk.operators.alerts import fan_out_alerts
from wxrisk.operators import serving, views
from wxrisk.plans import batch
from wxrisk.plans import daily_queries as D
from wxrisk.plans import observation_queries as O
from wxrisk.plans import sql_inputs as Q
from wxrisk.plans.registry import plain_round_sql, query
from wxrisk.session import scratch_path
from wxrisk.sinks import files as SF
from wxrisk.sinks.tables import KeyedTable, write_with_fallback
from wxrisk.sources import files as RF
from wxrisk.sources import fixtures as X
from wxrisk.sources import messages as M
from wxrisk.sources import payloads as P

# --- messages --------------------------------------------------------------------------------

_MESSAGE = """"District", "Date", "MaxTemp_2m", "MinTemp_2m", "TempRange_2m", "Precip", "RH_2m", "WindSpeed_10m",
  "Pressure", "Cloudiness", "Visibility", "WeatherDesc", kafka_timestamp"""
_MESSAGE_NAMES = [c.strip().strip('"') for c in _MESSAGE.split(",")]
_MESSAGE_DOUBLES = "MaxTemp_2m MinTemp_2m TempRange_2m Precip RH_2m WindSpeed_10m Pressure Visibility"


@query(f"with {Q.M} select {_MESSAGE} from m", doubles=_MESSAGE_DOUBLES, times="kafka_timestamp")
def json_decode(spark, sf_dir):
    return M.decode(X.message_values(X.obs(spark, sf_dir))).select(*_MESSAGE_NAMES)


@query(f"with {Q.M} select {_MESSAGE}, kafka_partition, kafka_offset from m", doubles=_MESSAGE_DOUBLES,
       times="kafka_timestamp")
def json_decode_positions(spark, sf_dir):
    rows = M.decode_positions(X.message_values(X.obs(spark, sf_dir)))
    return rows.select(*_MESSAGE_NAMES, "kafka_partition", "kafka_offset")


@query(f"with {Q.M} select event_id, {_MESSAGE} from m", doubles=_MESSAGE_DOUBLES, times="kafka_timestamp")
def json_decode_both_spellings(spark, sf_dir):
    """Half of the messages use the snake-case spelling; all decode to the same vocabulary."""
    rows = X.obs(spark, sf_dir)
    training = X.message_values(rows.filter(F.col("event_id") % 2 == 0))
    snake = X.message_values(rows.filter(F.col("event_id") % 2 == 1), snake=True)
    return M.decode_any(training.unionByName(snake), ("event_id",)).select("event_id", *_MESSAGE_NAMES)


_STORED = f"""with {Q.M} select event_id, "District" as district, "Date" as date, "MaxTemp_2m" as max_temp,
  "MinTemp_2m" as min_temp, "TempRange_2m" as temp_range, coalesce("Precip", 0e0) as precipitation, "RH_2m" as humidity,
  coalesce("WindSpeed_10m", 0e0) as wind_speed, coalesce("Pressure", 0e0) as pressure,
  coalesce("Cloudiness", 0) as cloudiness, coalesce("Visibility", 0e0) as visibility, "WeatherDesc" as weather_desc,
  '' as sunrise, '' as sunset, 'openweathermap' as source from m"""


@query(_STORED, doubles="max_temp min_temp temp_range precipitation humidity wind_speed pressure visibility")
def storage_defaults(spark, sf_dir):
    """Fields a message lacks get their stand-in."""
    fields = M.decode_fields(X.message_values(X.obs(spark, sf_dir)), ("event_id",))
    return C.storage_record(fields, "fields", keep=("event_id",))[0]


@query(f"with {Q.OBS} select event_id from obs where event_id % 3 = 0 or rain_1h is null")
def storage_rejects(spark, sf_dir):
    """Fields that are null or not a number cannot be stored."""
    rain = F.when(F.col("event_id") % 3 == 0, F.lit("trace")).otherwise(F.col("rain_1h").cast("string"))
    fields = F.create_map(F.lit("District"), F.col("district"), F.lit("Precip"), rain)
    rows = X.obs(spark, sf_dir).select("event_id", fields.alias("fields"))
    return C.storage_record(rows, "fields", keep=("event_id",))[1].select("event_id")


@query(f"with {O._RECORDS} select {O._STANDARD} from r where precipitation is not null", doubles=O._STANDARD_DOUBLES)
def publish_roundtrip(spark, sf_dir):
    """Standardised records as keyed JSON messages, decoded again."""
    complete, _ = C.split_required(O.producer_records(spark, sf_dir))
    sent = SF.as_messages(C.standardise_producer(complete))
    received = sent.withColumn("timestamp", F.lit(None).cast("timestamp"))
    names = [c for c in C.standardise_producer(complete).columns]
    return M.decode_any(received, ("key",)).filter(F.col("key") == F.col("District")).select(*names)


# --- payloads --------------------------------------------------------------------------------

_SUN = """case when event_id % 11 <> 0 then {} end"""


def _sun(base: int) -> str:
    return _SUN.format(f"to_timestamp({base} + event_id * 60) at time zone 'UTC'")


def _short(base: int, missing: str) -> str:
    return f"coalesce(strftime({_sun(base)}, '%H:%M'), '{missing}')"


_RISE, _SET = 1704067200, 1704100000
_P = Q.OBS + """, p as (select event_id, district, fetch_time, date, temp,
  case when event_id % 5 <> 0 then temp_min end as low, case when event_id % 5 <> 0 then temp_max end as high,
  case when event_id % 8 <> 0 then pressure end as pressure, humidity, wind_speed, cast(event_id % 360 as int) as deg,
  clouds, visibility, case when event_id % 4 <> 0 then rain_1h end as rain1, rain_1h as rain3,
  case when event_id % 6 <> 0 then weather_main end as sky from obs)"""


def _payloads(spark, sf_dir, kelvin=False):
    return X.payloads(X.obs(spark, sf_dir), kelvin=kelvin)


@query(f"""with {_P}, {Q.PLACES} select event_id, p.district, latitude, longitude, fetch_time, date, temp, low as temp_min,
  high as temp_max, temp as feels_like, pressure, humidity, wind_speed, deg as wind_deg, clouds, visibility,
  coalesce(rain1, 0e0) as rain_1h, coalesce(rain3, 0e0) as rain_3h, 0e0 as snow_1h, sky as weather_main,
  lower(sky) as weather_description, {_sun(_RISE)} as sunrise, {_sun(_SET)} as sunset, 'openweathermap' as source
  from p join places on p.district = places.district""",
       doubles="latitude longitude temp temp_min temp_max feels_like wind_speed rain_1h rain_3h snow_1h",
       times="fetch_time sunrise sunset")
def payload_raw(spark, sf_dir):
    placed = serving.with_coordinates(
        _payloads(spark, sf_dir).withColumnRenamed("city", "district"), serving.dimension(spark)
    )
    return P.to_raw(placed, "district", "latitude", "longitude", "fetch_time", keep=("event_id",))


_K = "273.15e0"


def _c(x: str) -> str:
    return f"(({x} + {_K}) - {_K})"


_FEED = _P + f""", feed as (select event_id, district || ' station' as city_name, district, date,
  strftime(fetch_time, '%d %b %Y | %I:%M:%S %p') as datetime,
  case when event_id % 9 <> 0 then 26.5e0 else 27e0 end as latitude,
  case when event_id % 9 <> 0 then 85.5e0 else 85e0 end as longitude,
  {_c('temp')} as t, {_c('coalesce(high, temp)')} as hi, {_c('coalesce(low, temp)')} as lo, humidity,
  coalesce(pressure, 1013) as pressure, case when rain1 <> 0 then rain1 * 24 when rain3 <> 0 then rain3 * 8 else 0e0 end as rain,
  wind_speed, deg as wind_direction, clouds as cloudiness, coalesce(visibility, 10000) as visibility,
  coalesce(sky, 'N/A') as weather_main, coalesce(lower(sky), 'N/A') as weather_description,
  {_short(_RISE, 'N/A')} as sunrise, {_short(_SET, 'N/A')} as sunset from p)"""


def _r1(x: str) -> str:
    return plain_round_sql(x, 1)


@query(f"""with {_FEED} select event_id, city_name, district, date, datetime, latitude, longitude, {_r1('t')} as temperature,
  {_r1('hi')} as temp_max, {_r1('lo')} as temp_min, {_r1('t')} as feels_like, {_r1('hi - lo')} as temp_range, humidity,
  pressure, {_r1('rain')} as precipitation, {_r1('wind_speed')} as wind_speed, wind_direction, cloudiness, visibility,
  {_r1('visibility / 1000e0')} as visibility_km, weather_main, weather_description, sunrise, sunset,
  'openweathermap' as source from feed""")
def payload_feed(spark, sf_dir):
    return P.to_feed(_payloads(spark, sf_dir, kelvin=True), "city", "fetch_time", keep=("event_id",))


@query(f"""with {_P} select event_id, district, date, strftime(fetch_time, '%Y-%m-%dT%H:%M:%S.%f') as fetched_at,
  coalesce(high, temp) as max_temp, coalesce(low, temp) as min_temp, coalesce(high, 0) - coalesce(low, 0) as temp_range,
  coalesce(rain1, 0e0) as precipitation, cast(humidity as double) as humidity, wind_speed,
  cast(coalesce(pressure, 1013) as double) as pressure, clouds as cloudiness, coalesce(visibility, 10000) / 1000e0 as visibility,
  coalesce(lower(sky), '') as weather_desc, {_short(_RISE, '')} as sunrise, {_short(_SET, '')} as sunset,
  'openweathermap' as source from p""",
       doubles="max_temp min_temp temp_range precipitation humidity wind_speed pressure visibility")
def payload_station(spark, sf_dir):
    return P.to_station(_payloads(spark, sf_dir), "city", "fetch_time", keep=("event_id",))


@query(f"""with {_FEED} select district as "District", date as "Date", {_r1('hi')} as "MaxTemp_2m", {_r1('lo')} as "MinTemp_2m",
  {_r1('hi - lo')} as "TempRange_2m", {_r1('rain')} as "Precip", humidity as "RH_2m", {_r1('wind_speed')} as "WindSpeed_10m",
  pressure as "Pressure", cloudiness as "Cloudiness", {_r1('visibility / 1000e0')} as "Visibility",
  weather_description as "WeatherDesc", sunrise as "Sunrise", sunset as "Sunset", 'openweathermap' as source from feed""")
def api_vocabulary(spark, sf_dir):
    return C.api_to_training(P.to_feed(_payloads(spark, sf_dir, kelvin=True), "city", "fetch_time"))


@query(f"""with {_FEED} select event_id, district, date, latitude, longitude, {_r1('hi')} as max_temp, {_r1('lo')} as min_temp,
  {_r1('hi - lo')} as temp_range, {_r1('rain')} as precipitation, cast(humidity as double) as humidity,
  {_r1('wind_speed')} as wind_speed_10m, {_r1('wind_speed')} * 1.5e0 as wind_speed_50m from feed""",
       doubles="latitude longitude humidity wind_speed_50m")
def payload_records(spark, sf_dir):
    feed = P.to_feed(_payloads(spark, sf_dir, kelvin=True), "city", "fetch_time", keep=("event_id",))
    return P.feed_to_record(feed, ("event_id",))


# --- files and tables ------------------------------------------------------------------------

_DAILY_COLUMNS = """"District", "Date", "MaxTemp_2m", "MinTemp_2m", "TempRange_2m", "Precip", "RH_2m", "WindSpeed_10m",
  "WindSpeed_50m\""""
_DAILY_DOUBLES = "MaxTemp_2m MinTemp_2m TempRange_2m Precip RH_2m WindSpeed_10m WindSpeed_50m"
_DAILY_NAMES = [c.strip().strip('"') for c in _DAILY_COLUMNS.split(",")]


@query(f"with {Q.DAILY} select {_DAILY_COLUMNS} from daily", doubles=_DAILY_DOUBLES, days="Date")
def csv_history_scan(spark, sf_dir):
    """The history written as CSV with untidy headers and read back through the daily reader."""
    path = scratch_path(spark, "csv")
    rows = D.daily(spark, sf_dir).select(*_DAILY_NAMES)
    SF.write_files(rows.toDF(*[f" {c} " for c in rows.columns]), path, "csv")
    return RF.read_daily_csv(spark, path).select(*_DAILY_NAMES)


@query(f"with {Q.DAILY} select {_DAILY_COLUMNS} from daily", doubles=_DAILY_DOUBLES, days="Date")
def many_csv_scan(spark, sf_dir):
    """One folder of CSV per district, read in one scan with inferred types."""
    path = scratch_path(spark, "csv-many")
    SF.write_stations(D.daily(spark, sf_dir).select(*_DAILY_NAMES), path)
    return RF.read_many_csv(spark, [path]).select(*_DAILY_NAMES)


@query(f"with {Q.DAILY} select {_DAILY_COLUMNS} from daily", doubles=_DAILY_DOUBLES, days="Date")
def station_csv_scan(spark, sf_dir):
    """A folder with one CSV per district; the district comes from the file name."""
    path = scratch_path(spark, "stations")
    X.station_folder(D.daily(spark, sf_dir).select(*_DAILY_NAMES), path)
    return RF.read_stations(spark, path).select(*_DAILY_NAMES)


@query(f"with {Q.OBS} select event_id, district, date, temp, humidity, rain_1h from obs", doubles="temp rain_1h")
def json_file_scan(spark, sf_dir):
    """Observations as JSON files, read with the fixed RAW schema."""
    path = scratch_path(spark, "json") + "/obs.json"
    rows = X.obs(spark, sf_dir)
    SF.write_files(rows.withColumn("weather_description", F.col("event_id").cast("string")), path, "json")
    back = RF.read_observations(spark, path)
    return back.select(F.col("weather_description").cast("long").alias("event_id"), "district", "date", "temp",
                       "humidity", "rain_1h")


@query(f"with {Q.T} select {Q.SERVING} from t", doubles=Q.SERVING_DOUBLES, times="fetch_time")
def parquet_scan(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    SF.write_files(C.serving_view(O.transformed(spark, sf_dir)), path)
    return RF.read_observations(spark, path).drop("etl_timestamp", "etl_version")


@query(f"with {Q.OBS} select cast(event_id % 3 as int) as batch_id, count(*) as records, sum(temp) as total_temp from obs group by 1",
       doubles="total_temp")
def lake_batches(spark, sf_dir):
    """Three batches written to the lake, one of them twice: the repeat replaces itself."""
    root = scratch_path(spark, "lake")
    rows = X.obs(spark, sf_dir)
    for batch in (0, 1, 2, 1):
        SF.write_lake_batch(rows.filter(F.col("event_id") % 3 == batch), root, batch)
    lake = RF.read_lake(spark, root)
    return lake.groupBy("batch_id").agg(F.count("*").alias("records"), F.sum("temp").alias("total_temp"))


@query(f"""with {Q.OBS}, r as (select district, date, cast(hour(fetch_time) as int) as hour, temp, event_id,
    row_number() over (partition by district, date, hour(fetch_time)
      order by event_id % 2 desc, fetch_time desc) as rn from obs)
  select district, date, hour, temp, event_id from r where rn = 1""", doubles="temp")
def keyed_upsert(spark, sf_dir):
    """Two loads into a keyed table: rows of the second replace rows of the first with the same key."""
    rows = X.obs(spark, sf_dir).select(
        "district", "date", F.hour("fetch_time").alias("hour"), "fetch_time", "temp", "event_id"
    )
    table = KeyedTable(spark, scratch_path(spark, "keyed"), ["district", "date", "hour"], ["district"], ["date", "hour"])
    for load in (0, 1):
        table.upsert(rows.filter(F.col("event_id") % 2 == load), ["fetch_time"], f"load-{load}")
    return table.read().drop("fetch_time")


@query(f"with {D._HISTORY} select district, year, date, max_temp, precipitation from history", days="date",
       doubles="max_temp precipitation")
def history_table_scan(spark, sf_dir):
    """The (district, year) history table written and read back."""
    path = scratch_path(spark, "history")
    SF.write_history(history_good(spark, sf_dir), path)
    return SF.read_history(spark, path).select("district", "year", "date", "max_temp", "precipitation")


def history_good(spark, sf_dir):
    return SF.history_records(D.daily(spark, sf_dir))[0]


@query(f"""with {Q.DAILY} select "District", strftime("Date", '%Y-%m-%d') as "Date" from daily
  where "MaxTemp_2m" > 40""")
def history_rejects(spark, sf_dir):
    """Rows whose date or measure cannot be read are set apart, not loaded."""
    rows = D.daily(spark, sf_dir)
    day = F.col("Date").cast("string")
    broken = F.when(F.col("MaxTemp_2m") > 40, F.lit("n/a")).otherwise(F.col("Precip").cast("string"))
    text = rows.select("District", day.alias("Date"), "MaxTemp_2m", broken.alias("Precip"))
    return SF.history_records(text)[1].select("District", "Date")


@query(f"""with {Q.OBS} select district, date, {plain_round_sql('temp', 4)} as temp from obs where district = 'Parsa'
  order by fetch_time desc limit 1000""")
def export_csv(spark, sf_dir):
    """Newest 1000 observations of a district exported as one CSV file and read back."""
    path = scratch_path(spark, "export")
    newest = serving.observations(X.obs(spark, sf_dir), "Parsa", 1000)
    SF.export_csv(newest.select("district", "date", F.round("temp", 4).alias("temp")), path)
    return spark.read.option("header", True).schema("district string, date string, temp double").csv(path)


@query(f"with {Q.OBS} select count(*) as records, 'fallback' as written from obs")
def fallback_sink(spark, sf_dir):
    """The primary writer fails (its connector is absent); the rows land in the fallback folder."""
    path = scratch_path(spark, "fallback")

    def absent(df):
        df.write.format("no.such.connector").save()

    used = write_with_fallback(X.obs(spark, sf_dir), absent, path)
    return spark.read.parquet(path).agg(F.count("*").alias("records")).withColumn("written", F.lit(used))


def _lake(spark, sf_dir) -> dict[str, str]:
    root = scratch_path(spark, "areas")
    SF.write_files(X.obs(spark, sf_dir), f"{root}/raw")
    SF.write_files(views.daily_view(O.transformed(spark, sf_dir)), f"{root}/processed")
    return {"Raw Data (Data Lake)": f"{root}/raw", "Processed Data": f"{root}/processed"}


@query()
def lake_inventory(spark, sf_dir):
    return SF.lake_inventory(spark, _lake(spark, sf_dir))


@query()
def lake_listing(spark, sf_dir):
    return SF.lake_listing(spark, _lake(spark, sf_dir))


# --- whole plans -----------------------------------------------------------------------------

@query(f"""with {Q.T} select district, date, {O._climate_sql()}, {O.steady_sql('sum(total_precip)', 2)} as total_precip,
  {O.steady_sql('avg(wind_speed)', 2)} as avg_wind, cast(sum(is_rainy) as int) as rainy_hours,
  max(heatwave_indicator) as heatwave_risk_level, max(flood_indicator) as flood_risk_level,
  cast(count(*) as int) as observation_count from t group by district, date""")
def full_load(spark, sf_dir):
    """The whole batch load; the answer is the stored daily table."""
    root = scratch_path(spark, "load")
    tables = batch.serving_tables(spark, f"{root}/serving")
    batch.load(spark, X.obs(spark, sf_dir), f"{root}/out", tables, "first")
    return tables["weather_daily_summary"].read().drop("etl_timestamp")


@query(f"""{O._RECOMPUTE} select district, date, avg_temp, max_temp, min_temp, avg_humidity, total_precip, avg_wind,
  cast(rainy_hours as int) as rainy_hours, cast(trunc(max_heatwave_risk * 10) as int) as heatwave_risk_level,
  cast(trunc(max_flood_risk * 10) as int) as flood_risk_level, cast(observation_count as int) as observation_count from d""")
def rebuild_from_lake(spark, sf_dir):
    """Stream rows in a two-batch lake, the daily view rebuilt from it into the serving table."""
    root = scratch_path(spark, "rebuild")
    rows = O.stream_rows(spark, sf_dir)
    for part in (0, 1):
        SF.write_lake_batch(rows.filter(F.col("day") % 2 == part), f"{root}/lake", part)
    table = batch.serving_tables(spark, f"{root}/serving", "stream")["weather_daily_summary"]
    batch.rebuild_daily(spark, f"{root}/lake", f"{root}/daily", table)
    return table.read().drop("etl_timestamp")


@query(f"""with {Q.DAILY}, a as (select "District" as district, 'HEATWAVE' as alert_type, case when "MaxTemp_2m" > 45
    then 'HIGH' else 'MEDIUM' end as severity, "Date" as timestamp from daily where "MaxTemp_2m" > 40 union all
  select "District", 'FLOOD_RISK', case when "Precip" > 150 then 'HIGH' else 'MEDIUM' end, "Date" from daily where "Precip" > 100)
  select * from a order by timestamp desc, district desc, alert_type desc limit 20""", days="timestamp")
def recent_alerts(spark, sf_dir):
    rows = fan_out_alerts(D.daily(spark, sf_dir)).select("district", "alert_type", "severity", "timestamp")
    return serving.recent(rows, "timestamp", 20, tie=("district", "alert_type"))


@query(f"""with {Q.DAILY}, a as (select "District" as district, 'HEATWAVE' as alert_type, "Date" as timestamp from daily
    where "MaxTemp_2m" > 40 union all select "District", 'FLOOD_RISK', "Date" from daily where "Precip" > 100)
  select * from a where district = 'Parsa' order by timestamp desc, alert_type desc limit 20""", days="timestamp")
def recent_alerts_of_district(spark, sf_dir):
    rows = fan_out_alerts(D.daily(spark, sf_dir)).select("district", "alert_type", "timestamp")
    return serving.recent(rows, "timestamp", 20, "Parsa", ("alert_type",))
