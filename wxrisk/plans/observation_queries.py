"""Queries over observations: cleaning, profiles, aggregate views, alerts, serving."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk.functions.scalar import stable_id
from wxrisk.operators import alerts as A
from wxrisk.operators import cleaning as C
from wxrisk.operators import scoring, serving, views
from wxrisk.plans import sql_inputs as Q
from wxrisk.plans.registry import plain_round_sql, query, steady_sql
from wxrisk.session import TableStages
from wxrisk.sinks.files import as_json_rows
from wxrisk.sinks.tables import last_per_key
from wxrisk.sources import fixtures as X
from wxrisk.sources import messages as M


def transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.transform_batch(X.obs(spark, sf_dir))


def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.transform_stream(M.decode(X.message_values(X.obs(spark, sf_dir))))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.obs(spark, sf_dir).select(
        "event_id", "district", "date", "fetch_time", F.col("temp_max").alias("max_temp"),
        F.col("temp_min").alias("min_temp"),
        F.coalesce("rain_1h", F.lit(0.0)).alias("precipitation"),
        F.col("humidity").cast("double").alias("humidity"),
    )
    return scoring.add_rule_scores(rows, "steps")


# --- cleaning and profiles -------------------------------------------------------------------

@query(f"with {Q.CLEAN} select * from c", doubles="temp temp_min temp_max wind_speed rain_1h snow_1h",
       times="fetch_time")
def clean_observations(spark, sf_dir):
    return C.clean(X.obs(spark, sf_dir))


CYCLES = "doy_sin doy_cos hour_sin hour_cos"


@query(f"with {Q.T} select event_id, year, month, day, hour, day_of_year, doy_sin, doy_cos, hour_sin, hour_cos from t",
       doubles=CYCLES)
def temporal_features(spark, sf_dir):
    dated = C.add_calendar(X.obs(spark, sf_dir).select("event_id", "fetch_time"))
    return dated.drop("fetch_time")


@query(f"""with {Q.T} select event_id, temp_range, visibility_km, total_precip, is_rainy, is_cloudy, is_windy from t""",
       doubles="temp_range visibility_km total_precip")
def derived_metrics(spark, sf_dir):
    return C.add_derived(C.clean(X.obs(spark, sf_dir))).select(
        "event_id", "temp_range", "visibility_km", "total_precip", "is_rainy", "is_cloudy", "is_windy"
    )


@query(f"with {Q.T} select event_id, heat_index from t", doubles="heat_index")
def heat_index_batch(spark, sf_dir):
    return C.clean(X.obs(spark, sf_dir)).select("event_id", C.heat_index_batch().alias("heat_index"))


@query(f"with {Q.T} select event_id, heatwave_indicator, flood_indicator, humidity_risk from t")
def risk_batch(spark, sf_dir):
    return transformed(spark, sf_dir).select(
        "event_id", "heatwave_indicator", "flood_indicator", "humidity_risk"
    )


@query(f"with {Q.T} select {Q.SERVING}, '1.0' as etl_version from t", doubles=Q.SERVING_DOUBLES, times="fetch_time")
def serving_batch(spark, sf_dir):
    return C.serving_view(transformed(spark, sf_dir)).drop("etl_timestamp")


@query(f"with {Q.S} select {Q.SERVING}, 'kafka-spark-hdfs-1.0' as etl_version from s",
       doubles=Q.SERVING_DOUBLES + " heatwave_indicator flood_indicator", times="fetch_time")
def serving_stream(spark, sf_dir):
    return stream_rows(spark, sf_dir).drop("etl_timestamp")


@query(f"with {Q.S} select fetch_time, district, heat_index from s", doubles="heat_index", times="fetch_time")
def heat_index_stream(spark, sf_dir):
    return stream_rows(spark, sf_dir).select("fetch_time", "district", "heat_index")


@query(f"""with {Q.S} select fetch_time, district, heatwave_indicator, flood_indicator, humidity_risk from s""",
       doubles="heatwave_indicator flood_indicator", times="fetch_time")
def risk_stream(spark, sf_dir):
    return stream_rows(spark, sf_dir).select(
        "fetch_time", "district", "heatwave_indicator", "flood_indicator", "humidity_risk"
    )


# --- aggregate views -------------------------------------------------------------------------

def _climate_sql(high="temp_max", low="temp_min", humidity_digits=1) -> str:
    return (f"{steady_sql('avg(temp)', 2)} as avg_temp, {steady_sql(f'max({high})', 2)} as max_temp, "
            f"{steady_sql(f'min({low})', 2)} as min_temp, "
            f"{steady_sql('avg(humidity)', humidity_digits)} as avg_humidity")


@query(f"""with {Q.T} select district, date, hour, {_climate_sql()}, {steady_sql('sum(rain_1h)', 2)} as total_rain,
  {steady_sql('avg(wind_speed)', 2)} as avg_wind, max(heatwave_indicator) as max_heatwave_risk,
  max(flood_indicator) as max_flood_risk, count(*) as record_count from t group by district, date, hour""")
def hourly_summary(spark, sf_dir):
    return views.hourly_view(transformed(spark, sf_dir))


@query(f"""with {Q.T} select district, date, {_climate_sql()}, {steady_sql('sum(total_precip)', 2)} as total_precip,
  {steady_sql('avg(wind_speed)', 2)} as avg_wind, cast(sum(is_rainy) as bigint) as rainy_hours,
  max(heatwave_indicator) as heatwave_risk_level, max(flood_indicator) as flood_risk_level,
  count(*) as observation_count from t group by district, date""")
def daily_summary(spark, sf_dir):
    return views.daily_view(transformed(spark, sf_dir))


_RECOMPUTE = f"""with {Q.S}, d as (select district, date, {_climate_sql('temp', 'temp', 2)},
  {steady_sql('sum(rain_1h)', 2)} as total_precip, {steady_sql('avg(wind_speed)', 2)} as avg_wind,
  cast(sum(case when rain_1h > 0 then 1 else 0 end) as bigint) as rainy_hours,
  max(heatwave_indicator) as max_heatwave_risk, max(flood_indicator) as max_flood_risk,
  count(*) as observation_count from s group by district, date)"""


@query(f"{_RECOMPUTE} select * from d")
def daily_recompute(spark, sf_dir):
    return views.daily_recompute(stream_rows(spark, sf_dir))


@query(f"""{_RECOMPUTE} select district, date, avg_temp, max_temp, min_temp, avg_humidity, total_precip, avg_wind,
  cast(rainy_hours as int) as rainy_hours, cast(observation_count as int) as observation_count,
  cast(trunc(max_heatwave_risk * 10) as int) as heatwave_risk_level,
  cast(trunc(max_flood_risk * 10) as int) as flood_risk_level from d""")
def daily_serving(spark, sf_dir):
    return views.daily_serving(views.daily_recompute(stream_rows(spark, sf_dir)))


@query(f"""with {Q.T} select district, date, avg(temp) as avg_temp, max(temp_max) as max_temp,
  min(temp_min) as min_temp, sum(total_precip) as total_precip, avg(humidity) as avg_humidity,
  bool_or(heatwave_indicator >= 2) as heatwave_flag, bool_or(flood_indicator >= 2) as flood_risk_flag
  from t group by district, date""", doubles="avg_temp max_temp min_temp total_precip avg_humidity")
def daily_flags(spark, sf_dir):
    return views.day_flags(transformed(spark, sf_dir))


_ALERTS = """count_if(heatwave_risk = 'HIGH') as heatwave_alerts, count_if(flood_risk = 'HIGH') as flood_alerts"""


@query(f"""with {Q.SCORED} select district, date, count(*) as record_count, avg(max_temp) as avg_temp,
  max(max_temp) as max_temp, min(min_temp) as min_temp, sum(precipitation) as total_precip,
  avg(humidity) as avg_humidity, cast(sum(case when heatwave_risk = 'HIGH' then 1 else 0 end) as bigint) as heatwave_alerts,
  cast(sum(case when flood_risk = 'HIGH' then 1 else 0 end) as bigint) as flood_alerts
  from scored group by district, date""", doubles="avg_temp max_temp min_temp total_precip avg_humidity")
def daily_alert_summary(spark, sf_dir):
    return views.day_alerts(scored(spark, sf_dir))


_HOUR_STATS = f"""with {Q.SCORED} select district, date_trunc('hour', fetch_time) as hour_bucket,
  count(*) as record_count, avg(max_temp) as avg_temp, max(max_temp) as max_temp,
  sum(precipitation) as total_precip,
  cast(sum(case when heatwave_risk = 'HIGH' then 1 else 0 end) as bigint) as heatwave_alerts,
  cast(sum(case when flood_risk = 'HIGH' then 1 else 0 end) as bigint) as flood_alerts
  from scored group by 1, 2"""


@query(_HOUR_STATS, doubles="avg_temp max_temp total_precip", times="hour_bucket")
def hourly_stats(spark, sf_dir):
    return views.hour_stats(scored(spark, sf_dir), F.date_trunc("hour", "fetch_time"))


_COUNTER = f"""with {Q.OBS} select date as stat_date, district, cast(hour(fetch_time) as int) as hour,
  count(*) as record_count from obs group by 1, 2, 3"""


@query(_COUNTER)
def ingest_counter(spark, sf_dir):
    return views.ingest_counter(X.obs(spark, sf_dir))


@query(f"""with {Q.OBS} select sha256(date || chr(31) || district) as batch_id, max(fetch_time) as ingest_time,
  district as source_station, cast(count(*) as int) as records_count, 'ok' as status
  from obs group by date, district""", times="ingest_time")
def ingest_log(spark, sf_dir):
    return views.ingest_log(X.obs(spark, sf_dir), F.col("date"), F.col("fetch_time"))


_COUNTS = f"""with {Q.SCORED}, {Q.PLACES}, counts as (
  select district, coalesce(o, 0) as observations, coalesce(n, 0) as predictions from places
  left join (select district, count(*) as o from obs group by district) as a using (district)
  left join (select district, count(*) as n from scored where flood_risk = 'HIGH' group by district) as b
  using (district))"""


def _counts(spark, sf_dir):
    high = scored(spark, sf_dir).filter(F.col("flood_risk") == "HIGH")
    return views.district_counts(serving.dimension(spark), X.obs(spark, sf_dir), high)


@query(f"{_COUNTS} select * from counts")
def district_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(f"""{_COUNTS} select cast(sum(observations) as bigint) as total_observations,
  cast(sum(predictions) as bigint) as total_predictions,
  cast(sum(case when observations > 0 then 1 else 0 end) as bigint) as districts_monitored from counts""")
def overall_counts(spark, sf_dir):
    return views.overall_counts(_counts(spark, sf_dir))


@query(f"""with {Q.SCORED} select date, cast(sum(case when flood_probability > 0.5 then 1 else 0 end) as bigint)
  as high_risk from scored group by date""")
def high_risk_counts(spark, sf_dir):
    return views.high_risk_counts(scored(spark, sf_dir), ["date"], "flood_probability")


def attempts(spark, sf_dir):
    """Fetch attempts: an event of type "error" is a failed one."""
    return X.obs(spark, sf_dir).select(
        "district", F.col("fetch_time").alias("at"), (F.col("weather_main") != "error").alias("ok"),
        F.col("temp_max").alias("max_temp"),
    )


@query(f"""with {Q.OBS}, a as (select *, weather_main <> 'error' as ok from obs)
  select district, count(*) as fetches, cast(sum(case when ok then 1 else 0 end) as bigint) as success,
  cast(sum(case when ok then 0 else 1 end) as bigint) as errors,
  strftime(max(case when ok then fetch_time end), '%H:%M:%S') as last_fetch,
  arg_max(temp_max, fetch_time) filter (where ok) as last_temp from a group by district""", doubles="last_temp")
def station_status(spark, sf_dir):
    return views.fetch_status(attempts(spark, sf_dir))


@query(f"""with {Q.OBS} select count(*) as total,
  cast(sum(case when weather_main <> 'error' then 1 else 0 end) as bigint) as successful from obs""")
def fetch_success(spark, sf_dir):
    status = F.when(F.col("ok"), "success").otherwise("error").alias("status")
    return views.success_count(attempts(spark, sf_dir).select(status))


@query(f"""with {Q.OBS}, b as (select date, district, count(*) as n,
    (epoch_us(max(fetch_time)) - epoch_us(min(fetch_time))) / 1e6 as seconds from obs group by 1, 2)
  select district, date, case when seconds > 0 then n / seconds else 0e0 end as per_second,
  case when seconds > 0 then n / seconds * 60 else 0e0 end as per_minute from b""", doubles="per_second per_minute")
def record_rates(spark, sf_dir):
    micros = F.unix_micros(F.max("fetch_time")) - F.unix_micros(F.min("fetch_time"))
    spans = X.obs(spark, sf_dir).groupBy("district", "date").agg(
        F.count("*").alias("n"), (micros / F.lit(1e6)).alias("seconds")
    )
    rate = views.throughput(F.col("n"), F.col("seconds"))
    return spans.select("district", "date", rate.alias("per_second"), (rate * 60).alias("per_minute"))


# --- alerts ----------------------------------------------------------------------------------

@query(f"""with {Q.T} select district, fetch_time, date, temp_max, rain_1h, humidity, heatwave_indicator,
  flood_indicator, case when heatwave_indicator >= 2 then 'HEATWAVE' when flood_indicator >= 2 then 'FLOOD'
  else 'UNKNOWN' end as alert_type from t where heatwave_indicator >= 2 or flood_indicator >= 2""",
       doubles="temp_max rain_1h", times="fetch_time")
def alerts(spark, sf_dir):
    return A.risk_alerts(transformed(spark, sf_dir))


# --- serving ---------------------------------------------------------------------------------

_OBS_COLUMNS = "district, fetch_time, date, temp, temp_max, humidity, event_id"
_OBS_NAMES = [c.strip() for c in _OBS_COLUMNS.split(",")]


def _served(spark, sf_dir):
    return X.obs(spark, sf_dir).select(*_OBS_NAMES)


@query(f"""with {Q.OBS} select {_OBS_COLUMNS} from obs where district = 'Parsa'
  order by fetch_time desc, event_id desc limit 20""", doubles="temp temp_max", times="fetch_time")
def recent_observations(spark, sf_dir):
    return serving.observations(_served(spark, sf_dir), "Parsa", 20, tie=("event_id",))


@query(f"""with {Q.OBS} select {_OBS_COLUMNS} from obs where district = 'Bara'
  and fetch_time >= (select max(fetch_time) from obs) - interval 24 hour
  order by fetch_time desc, event_id desc limit 500""", doubles="temp temp_max", times="fetch_time")
def hours_back(spark, sf_dir):
    rows = _served(spark, sf_dir)
    as_of = rows.agg(F.max("fetch_time")).scalar()
    return serving.observations(rows, "Bara", 500, hours=24, as_of=as_of, tie=("event_id",))


@query(f"""with {Q.OBS} select {_OBS_COLUMNS} from obs where district = 'Siraha' and date >= '2024-01-24'""",
       doubles="temp temp_max", times="fetch_time")
def days_back(spark, sf_dir):
    rows = _served(spark, sf_dir).filter(F.col("district") == "Siraha")
    return serving.since_day(rows, 7, dt.date(2024, 1, 31))


@query(f"""with {Q.OBS} select {_OBS_COLUMNS} from obs order by fetch_time desc, event_id desc limit 20""",
       doubles="temp temp_max", times="fetch_time")
def recent_any(spark, sf_dir):
    return serving.recent(_served(spark, sf_dir), "fetch_time", 20, tie=("event_id",))


@query(f"""with {Q.OBS}, r as (select *, row_number() over (partition by district order by fetch_time desc, event_id desc)
  as rn from obs) select {_OBS_COLUMNS} from r where rn <= 50 // 5""", doubles="temp temp_max", times="fetch_time")
def recent_all_districts(spark, sf_dir):
    return serving.all_districts(_served(spark, sf_dir), "fetch_time", 50, "event_id")


@query(f"""with {Q.OBS}, r as (select *, row_number() over (partition by district order by fetch_time desc, event_id desc)
  as rn from obs) select {_OBS_COLUMNS} from r where rn = 1""", doubles="temp temp_max", times="fetch_time")
def latest_per_district(spark, sf_dir):
    return serving.latest(_served(spark, sf_dir), "fetch_time", "event_id")


def _predictions(spark, sf_dir):
    return scoring.prediction_rows(scored(spark, sf_dir), F.col("fetch_time"), "district", "event_id")


@query(f"""with {Q.SCORED} select sha256(district || chr(31) || cast(event_id as varchar)) as id, district,
  fetch_time as prediction_time, max_temp, precipitation, humidity, heatwave_probability, flood_probability,
  heatwave_risk, flood_risk from scored""",
       doubles="max_temp precipitation humidity heatwave_probability flood_probability", times="prediction_time")
def prediction_table(spark, sf_dir):
    return _predictions(spark, sf_dir)


_SHOWN = """district, strftime(fetch_time, '%Y-%m-%d %H:%M:%S') as prediction_time, max_temp, precipitation, humidity"""


@query(f"""with {Q.SCORED} select {_SHOWN}, {plain_round_sql('heatwave_probability * 100', 2)} as heatwave_prob,
  {plain_round_sql('flood_probability * 100', 2)} as flood_prob, heatwave_risk, flood_risk from scored where district = 'Sarlahi'
  order by fetch_time desc limit 50""", doubles="max_temp precipitation humidity heatwave_prob flood_prob")
def recent_predictions(spark, sf_dir):
    return serving.show_predictions(serving.predictions(_predictions(spark, sf_dir), "Sarlahi", 50))


@query(f"""with {Q.SCORED} select {_SHOWN}, {plain_round_sql('nullif(heatwave_probability, 0)', 4)} as heatwave_prob,
  {plain_round_sql('nullif(flood_probability, 0)', 4)} as flood_prob, heatwave_risk, flood_risk from scored where district = 'Bara'
  order by fetch_time desc limit 20""", doubles="max_temp precipitation humidity heatwave_prob flood_prob")
def recent_predictions_plain(spark, sf_dir):
    return serving.show_predictions(serving.predictions(_predictions(spark, sf_dir), "Bara", 20), percent=False)


@query(f"""with {Q.SCORED}, d as (select district, date, count(*) as record_count, avg(max_temp) as avg_temp,
    max(max_temp) as max_temp, min(min_temp) as min_temp, sum(precipitation) as total_precip,
    avg(humidity) as avg_humidity, cast(sum(case when heatwave_risk = 'HIGH' then 1 else 0 end) as bigint) as heatwave_alerts,
    cast(sum(case when flood_risk = 'HIGH' then 1 else 0 end) as bigint) as flood_alerts
    from scored group by district, date)
  select district, date, record_count, {steady_sql('nullif(avg_temp, 0)', 1)} as avg_temp,
  {steady_sql('nullif(max_temp, 0)', 1)} as max_temp, {steady_sql('nullif(min_temp, 0)', 1)} as min_temp,
  {steady_sql('nullif(total_precip, 0)', 2)} as total_precip, {steady_sql('nullif(avg_humidity, 0)', 1)} as avg_humidity,
  heatwave_alerts, flood_alerts from d where district = 'Dhanusa' and date >= '2024-01-24'""")
def daily_summary_shown(spark, sf_dir):
    days = views.day_alerts(scored(spark, sf_dir)).filter(F.col("district") == "Dhanusa")
    return serving.show_daily(serving.since_day(days, 7, dt.date(2024, 1, 31)))


@query(f"""with {Q.SCORED} select strftime(fetch_time, '%Y-%m-%d %H:%M:%S') as "Time", district as "District",
  {steady_sql('max_temp', 1)} as "Temp", {steady_sql('humidity', 0)} as "Humidity",
  {steady_sql('precipitation', 1)} as "Precip", {steady_sql('heatwave_probability * 100', 1)} as "Heatwave %",
  {steady_sql('flood_probability * 100', 1)} as "Flood %" from scored order by fetch_time desc limit 15""")
def history_table(spark, sf_dir):
    rows = scored(spark, sf_dir).select(
        F.date_format("fetch_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetched_at"),
        F.col("district").alias("District"), F.col("max_temp").alias("MaxTemp_2m"),
        F.col("humidity").alias("RH_2m"), F.col("precipitation").alias("Precip"),
        "heatwave_probability", "flood_probability",
    )
    return serving.history_table(rows, 15)


@query(f"""with {Q.OBS}, {Q.PLACES} select event_id, district, latitude, longitude from obs join places using (district)""",
       doubles="latitude longitude")
def district_dim_join(spark, sf_dir):
    rows = X.obs(spark, sf_dir).select("event_id", "district")
    return serving.with_coordinates(rows, serving.dimension(spark)).select(
        "event_id", "district", "latitude", "longitude"
    )


@query(f"with {Q.OBS} select event_id, district from obs where district in ('Bara', 'Parsa')")
def district_list_filter(spark, sf_dir):
    return C.limit_to(X.obs(spark, sf_dir).select("event_id", "district"), "Bara, Parsa,Nowhere", Q.DISTRICTS)


@query(f"""with {Q.S}, speed as (select * from s where heatwave_indicator >= 0.5), a as (
    select district, fetch_time, temp, 'speed' as layer,
      row_number() over (partition by district order by fetch_time desc) as rn from speed
      where district in ('Bara', 'Siraha')), b as (
    select district, fetch_time, temp, 'batch' as layer,
      row_number() over (partition by district order by fetch_time desc) as rn from s)
  select district, fetch_time, temp, layer from a where rn = 1 union all
  select district, fetch_time, temp, layer from b where rn = 1
    and district not in (select district from a)""", doubles="temp", times="fetch_time")
def speed_batch_merge(spark, sf_dir):
    rows = stream_rows(spark, sf_dir).select("district", "fetch_time", "temp", "heatwave_indicator")
    rows = TableStages(spark, "views")(rows, "serving")
    hot = rows.filter((F.col("heatwave_indicator") >= 0.5) & F.col("district").isin("Bara", "Siraha"))
    merged = serving.speed_over_batch(
        serving.latest(hot).drop("heatwave_indicator"), serving.latest(rows).drop("heatwave_indicator")
    )
    return merged


@query(f"""with {Q.OBS}, r as (select *, cast(hour(fetch_time) as int) as hour, row_number() over (
    partition by district, date, hour(fetch_time) order by fetch_time desc) as rn from obs)
  select district, date, hour, fetch_time, temp, event_id from r where rn = 1""", doubles="temp", times="fetch_time")
def upsert_latest(spark, sf_dir):
    rows = X.obs(spark, sf_dir).select(
        "district", "date", F.hour("fetch_time").alias("hour"), "fetch_time", "temp", "event_id"
    )
    return last_per_key(rows, ["district", "date", "hour"], ["fetch_time"])


# --- vocabularies ----------------------------------------------------------------------------

def producer_records(spark, sf_dir):
    """Producer input: some records lack the minimum or the range, or have them as zero."""
    e = F.col("event_id")
    return X.obs(spark, sf_dir).select(
        "event_id", "district", "date", F.col("temp_max").alias("max_temp"),
        F.when(e % 4 != 0, F.when(e % 6 == 0, F.lit(0.0)).otherwise(F.col("temp_min"))).alias("min_temp"),
        F.when(e % 3 != 0, F.when(e % 5 == 0, F.lit(0.0)).otherwise(F.lit(8.0))).alias("temp_range"),
        F.col("rain_1h").alias("precipitation"), F.col("humidity").cast("double").alias("humidity"),
        F.when(e % 5 != 0, F.col("wind_speed")).alias("wind_speed_10m"),
    )


_RECORDS = Q.OBS + """, r as (select event_id, district, date, temp_max as max_temp,
  case when event_id % 4 <> 0 then case when event_id % 6 = 0 then 0e0 else temp_min end end as min_temp,
  case when event_id % 3 <> 0 then case when event_id % 5 = 0 then 0e0 else 8e0 end end as temp_range,
  rain_1h as precipitation, cast(humidity as double) as humidity,
  case when event_id % 5 <> 0 then wind_speed end as wind_speed_10m from obs)"""
_STANDARD = """district as "District", date as "Date", 27e0 as "Latitude", 85e0 as "Longitude", max_temp as "MaxTemp_2m",
  coalesce(nullif(min_temp, 0), max_temp - 10) as "MinTemp_2m", coalesce(nullif(temp_range, 0), 10e0) as "TempRange_2m",
  precipitation as "Precip", humidity as "RH_2m", coalesce(wind_speed_10m, 0e0) as "WindSpeed_10m",
  0e0 as "WindSpeed_50m", 0e0 as "SolarRad", 'api' as source"""
_STANDARD_DOUBLES = ("Latitude Longitude MaxTemp_2m MinTemp_2m TempRange_2m Precip RH_2m WindSpeed_10m"
                     " WindSpeed_50m SolarRad")


@query(f"with {_RECORDS} select {_STANDARD} from r where precipitation is not null", doubles=_STANDARD_DOUBLES)
def producer_standardise(spark, sf_dir):
    complete, _ = C.split_required(producer_records(spark, sf_dir))
    return C.standardise_producer(complete)


@query(f"with {_RECORDS} select event_id, district, date from r where precipitation is null")
def producer_rejects(spark, sf_dir):
    _, rejected = C.split_required(producer_records(spark, sf_dir))
    return rejected.select("event_id", "district", "date")


@query(f"""with {Q.OBS} select event_id, wind_speed * 1.5e0 as wind_speed_50m from obs""", doubles="wind_speed_50m")
def wind_estimate(spark, sf_dir):
    return X.obs(spark, sf_dir).select("event_id", C.wind_at_50m(F.col("wind_speed")).alias("wind_speed_50m"))


@query(f"""with {Q.S} select district as "District", date as "Date", coalesce(nullif(temp_max, 0), temp) as "MaxTemp_2m",
  temp_min as "MinTemp_2m", coalesce(temp_max, 0) - coalesce(temp_min, 0) as "TempRange_2m",
  coalesce(rain_1h, 0e0) as "Precip", humidity as "RH_2m", wind_speed as "WindSpeed_10m", pressure as "Pressure",
  clouds as "Cloudiness", visibility_km as "Visibility", heat_index as "HeatIndex",
  heatwave_indicator as heatwave_probability, flood_indicator as flood_probability,
  {Q.label_above('heatwave_indicator')} as heatwave_risk, {Q.label_above('flood_indicator')} as flood_risk,
  'spark_etl' as source, 'From Spark ETL' as "WeatherDesc" from s""",
       doubles="MaxTemp_2m MinTemp_2m TempRange_2m Precip WindSpeed_10m Visibility HeatIndex"
               " heatwave_probability flood_probability")
def training_vocabulary(spark, sf_dir):
    return C.serving_to_training(stream_rows(spark, sf_dir))


def replay_safe_ids(df: DataFrame) -> DataFrame:
    return df.select(stable_id("district", F.col("event_id").cast("string")).alias("id"), "event_id")


@query(f"with {Q.OBS} select sha256(district || chr(31) || cast(event_id as varchar)) as id, event_id from obs")
def stable_ids(spark, sf_dir):
    return replay_safe_ids(X.obs(spark, sf_dir))


@query(f"""with {Q.OBS} select '{{"district":"' || district || '","event_id":' || event_id || ',"clouds":' || clouds || '}}'
  as json from obs""")
def json_rows(spark, sf_dir):
    return as_json_rows(X.obs(spark, sf_dir).select("district", "event_id", "clouds"))
