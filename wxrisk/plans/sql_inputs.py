"""The input adapters and shared steps as SQL text, for the checks."""

from __future__ import annotations

from wxrisk.constants import DISTRICTS

_NAMES = ", ".join(f"'{d}'" for d in DISTRICTS)


def _district(key: str) -> str:
    return f"([{_NAMES}])[cast({key} % 5 as int) + 1]"


PLACES = "places(district, latitude, longitude) as (values " + ", ".join(
    f"('{d}', {lat}e0, {lon}e0)" for d, (lat, lon) in DISTRICTS.items()
) + ")"

OBS = f"""obs as (
  select event_id, {_district('user_id')} as district, ts as fetch_time,
    strftime(ts, '%Y-%m-%d') as date,
    value / 4 as temp, value / 4 - 6 as temp_min, value / 4 + 2 as temp_max,
    cast(780 + event_id % 340 as int) as pressure, cast(event_id % 120 as int) as humidity,
    cast(event_id % 15 - 1 as double) as wind_speed, cast(event_id % 101 as int) as clouds,
    cast(case when event_id % 7 <> 0 then 1000 * (event_id % 11) end as int) as visibility,
    case when event_id % 10 <> 0 then (event_id * 7919 % 600) / cast(10 as double) end as rain_1h,
    case when event_id % 3 = 0 then 0.5e0 end as snow_1h, event_type as weather_main
  from events)"""

CLEAN = OBS + """, c as (
  select * replace (
    case when temp between -50 and 60 then temp end as temp,
    case when humidity between 0 and 100 then humidity end as humidity,
    case when pressure between 800 and 1100 then pressure end as pressure,
    case when wind_speed >= 0 then wind_speed else 0e0 end as wind_speed,
    coalesce(rain_1h, 0e0) as rain_1h, coalesce(snow_1h, 0e0) as snow_1h,
    coalesce(visibility, 10000) as visibility)
  from obs)"""

CALENDAR = """cast(year(fetch_time) as int) as year, cast(month(fetch_time) as int) as month,
    cast(day(fetch_time) as int) as day, cast(hour(fetch_time) as int) as hour,
    sin(2e0 * 3.14159e0 * dayofyear(fetch_time) / 365) as doy_sin,
    cos(2e0 * 3.14159e0 * dayofyear(fetch_time) / 365) as doy_cos"""

# Batch profile.
T = CLEAN + f""", t as (
  select *, {CALENDAR}, cast(dayofyear(fetch_time) as int) as day_of_year,
    sin(2e0 * 3.14159e0 * hour(fetch_time) / 24) as hour_sin,
    cos(2e0 * 3.14159e0 * hour(fetch_time) / 24) as hour_cos,
    temp_max - temp_min as temp_range, visibility / 1000e0 as visibility_km,
    rain_1h + snow_1h as total_precip,
    case when rain_1h > 0 then 1 else 0 end as is_rainy,
    case when clouds > 50 then 1 else 0 end as is_cloudy,
    case when wind_speed > 10 then 1 else 0 end as is_windy,
    case when temp >= 27 then -8.785e0 + 1.611e0 * temp + 2.339e0 * humidity - 0.146e0 * temp * humidity
      else temp end as heat_index,
    case when temp_max >= 40 then 3 when temp_max >= 35 then 2 when temp_max >= 32 then 1 else 0 end
      as heatwave_indicator,
    case when rain_1h >= 50 then 3 when rain_1h >= 20 then 2 when rain_1h >= 5 then 1 else 0 end
      as flood_indicator,
    case when humidity >= 90 then 2 when humidity >= 80 then 1 else 0 end as humidity_risk
  from c)"""

# Messages made from the observations, decoded to the training vocabulary.
M = OBS + """, m as (
  select event_id, district as "District", date as "Date", temp_max as "MaxTemp_2m", temp_min as "MinTemp_2m",
    temp_max - temp_min as "TempRange_2m", rain_1h as "Precip", cast(humidity as double) as "RH_2m",
    case when event_id % 5 <> 0 then wind_speed end as "WindSpeed_10m",
    case when event_id % 5 <> 0 then cast(pressure as double) end as "Pressure",
    case when event_id % 5 <> 0 then clouds end as "Cloudiness",
    case when event_id % 5 <> 0 then cast(visibility as double) end as "Visibility",
    weather_main as "WeatherDesc", fetch_time as kafka_timestamp,
    cast(event_id % 4 as int) as kafka_partition, cast(event_id // 4 as bigint) as kafka_offset
  from obs)"""

# Stream profile.
S = M + f""", s0 as (
  select event_id, "District" as district, "Date" as date, kafka_timestamp as fetch_time,
    "MaxTemp_2m" as temp, "MinTemp_2m" as temp_min, "MaxTemp_2m" as temp_max, "TempRange_2m" as temp_range,
    cast("RH_2m" as int) as humidity, cast("Pressure" as int) as pressure, "WindSpeed_10m" as wind_speed,
    "Cloudiness" as clouds, "Precip" as rain_1h, "Precip" as total_precip, "Visibility" / 1000 as visibility_km
  from m), s as (
  select *, {CALENDAR},
    case when temp > 27 then temp + 0.5e0 * (humidity - 10) else temp end as heat_index,
    case when temp > 40 then 0.9e0 when temp > 35 then 0.5e0 when temp > 30 then 0.2e0 else 0e0 end
      as heatwave_indicator,
    case when rain_1h > 50 then 0.8e0 when rain_1h > 20 then 0.5e0 when humidity > 90 then 0.3e0 else 0.1e0 end
      as flood_indicator,
    case when humidity > 90 then 'HIGH' when humidity > 70 then 'MEDIUM' else 'LOW' end as humidity_risk
  from s0)"""

SERVING = """district, fetch_time, date, temp, temp_min, temp_max, temp_range, humidity, pressure, wind_speed,
  clouds, rain_1h, total_precip, visibility_km, heat_index, heatwave_indicator, flood_indicator, humidity_risk,
  year, month, day, hour, doy_sin, doy_cos"""
SERVING_DOUBLES = ("temp temp_min temp_max temp_range wind_speed rain_1h total_precip visibility_km heat_index"
                   " doy_sin doy_cos")

DAILY = f"""daily as (
  select *, "MaxTemp_2m" - "TempRange_2m" as "MinTemp_2m", "WindSpeed_10m" * 1.5e0 as "WindSpeed_50m" from (
    select {_district('l_suppkey')} as "District", cast(l_shipdate as date) as "Date",
      round(30e0 - abs(dayofyear(cast(l_shipdate as date)) - 182) / cast(12 as double) + avg(l_quantity) / 2, 4)
        as "MaxTemp_2m",
      cast(5 + count(*) as double) as "TempRange_2m",
      sum(case when l_returnflag = 'R' then l_quantity end) as "Precip",
      round(100 - 70 / cast(case when count(*) > 1 then 1 + sum(l_linenumber) end as double), 4) as "RH_2m",
      round(max(l_discount) * 100, 2) as "WindSpeed_10m"
    from lineitem group by 1, 2) as base)"""


def heat_score_linear(t: str) -> str:
    return f"least(1e0, greatest(0e0, ({t} - 35) / 15))"


def flood_score_linear(p: str, h: str | None) -> str:
    extra = "" if h is None else f" + ({h} - 80) / 100e0"
    return f"least(1e0, greatest(0e0, ({p} - 50) / 100{extra}))"


def heat_score_steps(t: str) -> str:
    return (f"case when {t} > 40 then least(1e0, 0.7e0 + ({t} - 40) / 20)"
            f" when {t} > 35 then least(1e0, 0.3e0 + ({t} - 35) / 10) else greatest(0e0, ({t} - 30) / 20) end")


def flood_score_steps(p: str, h: str) -> str:
    return (f"least(1e0, case when {p} > 100 then 0.8e0 when {p} > 50 then 0.5e0 when {p} > 20 then 0.3e0 else 0e0 end"
            f" + case when {h} > 90 then 0.2e0 when {h} > 80 then 0.1e0 else 0e0 end)")


def label_above(p: str) -> str:
    return f"case when {p} > 0.5e0 then 'HIGH' when {p} > 0.3e0 then 'MEDIUM' else 'LOW' end"


def label_from(p: str) -> str:
    return f"case when {p} >= 0.7e0 then 'HIGH' when {p} >= 0.4e0 then 'MEDIUM' else 'LOW' end"


# Observations scored by the step rules.
SCORED = OBS + f""", p0 as (
  select event_id, district, date, fetch_time, temp_max as max_temp, temp_min as min_temp,
    coalesce(rain_1h, 0e0) as precipitation, cast(humidity as double) as humidity from obs), p1 as (
  select *, {heat_score_steps('max_temp')} as heatwave_probability,
    {flood_score_steps('precipitation', 'humidity')} as flood_probability from p0), scored as (
  select *, {label_above('heatwave_probability')} as heatwave_risk,
    {label_above('flood_probability')} as flood_risk from p1)"""

# Heat and flood labels on the daily history.
LABELS = DAILY + """, h0 as (
  select *, quantile_cont("MaxTemp_2m", 0.95) over (partition by "District") as heat_limit from daily), h1 as (
  select *, coalesce("MaxTemp_2m" > heat_limit, false) as heat_exceed,
    row_number() over (partition by "District" order by "Date") as rn from h0), h2 as (
  select *, rn - row_number() over (partition by "District", heat_exceed order by "Date") as island from h1), h3 as (
  select *, case when heat_exceed then row_number() over (partition by "District", heat_exceed, island order by "Date")
    else 0 end as heat_run from h2), h4 as (
  select *, heat_run >= 3 as heatwave, coalesce("Precip", 0e0) as precip_1d from h3), h5 as (
  select *, sum(precip_1d) over (partition by "District" order by "Date" rows 2 preceding) as precip_3d,
    sum(precip_1d) over (partition by "District" order by "Date" rows 6 preceding) as precip_7d,
    coalesce(last_value("RH_2m" ignore nulls) over (order by "District", "Date" rows unbounded preceding),
      first_value("RH_2m" ignore nulls) over (order by "District", "Date"
        rows between current row and unbounded following)) as "RH_2m_filled" from h4), h6 as (
  select *, quantile_cont(precip_1d, 0.99) over (partition by "District") as precip_p99,
    quantile_cont(precip_3d, 0.98) over (partition by "District") as precip3_p98,
    quantile_cont("RH_2m_filled", 0.9) over (partition by "District") as wet_limit from h5), h7 as (
  select *, coalesce("RH_2m_filled" > wet_limit, false) as wetness_flag from h6), labelled as (
  select *, (precip_1d > precip_p99 or precip_3d > precip3_p98) and wetness_flag as flood_proxy from h7)"""
