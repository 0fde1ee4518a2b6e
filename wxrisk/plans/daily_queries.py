"""Queries over the daily history: windows, labels, features, scores, replay, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.functions import risk
from wxrisk.functions.scalar import steady
from wxrisk.operators import alerts as A
from wxrisk.operators import cleaning as C
from wxrisk.operators import features as FE
from wxrisk.operators import labels as L
from wxrisk.operators import metrics as ME
from wxrisk.operators import models as MO
from wxrisk.operators import replay as R
from wxrisk.operators import scoring as SC
from wxrisk.operators import sequences as SE
from wxrisk.operators import serving, views
from wxrisk.operators.series import in_blocks
from wxrisk.plans import offline
from wxrisk.plans import sql_inputs as Q
from wxrisk.plans.registry import plain_round_sql, query, steady_sql
from wxrisk.session import TableStages
from wxrisk.sinks.files import history_records
from wxrisk.sources import fixtures as X

DD = '"District", "Date"'


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.daily(spark, sf_dir)


def staged_daily(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, TableStages]:
    """The history as a written table, for plans that read it several times."""
    stage = TableStages(spark, "daily")
    return stage(X.daily(spark, sf_dir), "history"), stage


# --- rolling windows -------------------------------------------------------------------------

_W = 'over (partition by "District" order by "Date" rows {} preceding)'


@query(f"""with {Q.DAILY} select {DD}, sum("Precip") {_W.format(2)} as precip_3d, sum("Precip") {_W.format(6)} as precip_7d
  from daily""", doubles="precip_3d precip_7d", days="Date")
def rolling_precip(spark, sf_dir):
    blocks = in_blocks(daily(spark, sf_dir).select("District", "Date", "Precip", "MaxTemp_2m", "TempRange_2m"),
                       "District", "Date", 6)
    return FE.rolling(blocks).plain().select("District", "Date", "precip_3d", "precip_7d")


@query(f"""with {Q.DAILY}, z as (select {DD}, coalesce("Precip", 0e0) as precip_1d from daily)
  select *, sum(precip_1d) {_W.format(2)} as precip_3d, sum(precip_1d) {_W.format(6)} as precip_7d from z""",
       doubles="precip_1d precip_3d precip_7d", days="Date")
def rolling_precip_filled(spark, sf_dir):
    blocks = in_blocks(daily(spark, sf_dir).select("District", "Date", "Precip"), "District", "Date", 6)
    return L.rain_windows(blocks).plain().drop("Precip")


@query(f"""with {Q.DAILY} select {DD}, avg("MaxTemp_2m") {_W.format(2)} as "maxT_3d_mean",
  max("TempRange_2m") {_W.format(2)} as temp_range_3d_max from daily""",
       doubles="maxT_3d_mean temp_range_3d_max", days="Date")
def rolling_temp(spark, sf_dir):
    blocks = in_blocks(daily(spark, sf_dir).select("District", "Date", "Precip", "MaxTemp_2m", "TempRange_2m"),
                       "District", "Date", 6)
    return FE.rolling(blocks).plain().select("District", "Date", "maxT_3d_mean", "temp_range_3d_max")


_LAGS = [f"{p}_lag_{k}" for k in K.LAG_DAYS for p in ("precip", "maxT")]


@query(f"""with {Q.DAILY} select {DD}, {', '.join(
    f'lag("{c}", {k}) over (partition by "District" order by "Date") as "{p}_lag_{k}"'
    for k in K.LAG_DAYS for p, c in (("precip", "Precip"), ("maxT", "MaxTemp_2m")))} from daily""",
       doubles=" ".join(_LAGS), days="Date")
def lags(spark, sf_dir):
    blocks = in_blocks(daily(spark, sf_dir).select("District", "Date", "Precip", "MaxTemp_2m"), "District", "Date", 14)
    return FE.lags(blocks).plain().select("District", "Date", *_LAGS)


@query(f"""with {Q.DAILY}, n as (select {DD}, coalesce("Precip", 0e0) as v,
    row_number() over (partition by "District" order by "Date") as rn from daily)
  select a."District", a."Date", sum(b.v * pow(0.8e0, a.rn - b.rn)) as "API"
  from n a join n b on a."District" = b."District" and b.rn between a.rn - 250 and a.rn group by 1, 2""",
       doubles="API", days="Date")
def api_index(spark, sf_dir):
    rows = daily(spark, sf_dir).select("District", "Date", "Precip")
    blocks = in_blocks(rows, "District", "Date", 0)
    return FE.wetness_index(blocks, stage=TableStages(spark, "wetness")).plain().drop("Precip")


@query(f"""with {Q.DAILY}, n as (select {DD}, coalesce("Precip", 0e0) as v,
    row_number() over (partition by "District" order by "Date") as rn from daily)
  select a."District", a."Date", sum(b.v * pow(0.99e0, a.rn - b.rn)) as "API"
  from n a join n b on a."District" = b."District" and b.rn <= a.rn group by 1, 2""",
       doubles="API", days="Date")
def api_index_long_memory(spark, sf_dir):
    """Slow decay over many short blocks, so nearly all of the index comes from earlier ones."""
    rows = daily(spark, sf_dir).select("District", "Date", "Precip")
    blocks = in_blocks(rows, "District", "Date", 0, block_rows=128)
    return FE.wetness_index(blocks, 128, decay=0.99, stage=TableStages(spark, "wetness")).plain().drop("Precip")


@query(f"""with {Q.DAILY} select {DD}, cast(dayofyear("Date") as int) as doy,
  sin(2 * pi() * dayofyear("Date") / 365.25e0) as doy_sin, cos(2 * pi() * dayofyear("Date") / 365.25e0) as doy_cos,
  cast(year("Date") as int) as year, cast(month("Date") as int) as month from daily""",
       doubles="doy_sin doy_cos", days="Date")
def season_features(spark, sf_dir):
    return FE.add_season(daily(spark, sf_dir).select("District", "Date"))


# --- limits and labels -----------------------------------------------------------------------

@query(f"""with {Q.DAILY} select "District", quantile_cont("MaxTemp_2m", 0.95) as heat_limit from daily group by 1""",
       doubles="heat_limit")
def heat_limits(spark, sf_dir):
    return L.heat_thresholds(daily(spark, sf_dir))


@query(f"""with {Q.LABELS} select distinct "District", precip_p99, precip3_p98, wet_limit from labelled""",
       doubles="precip_p99 precip3_p98 wet_limit")
def flood_limits(spark, sf_dir):
    rows, stage = staged_daily(spark, sf_dir)
    return L.flood_thresholds(L.flood_blocks(rows, stage=stage).df, stage=stage)


@query(f"""with {Q.LABELS} select {DD}, "MaxTemp_2m", heat_exceed, heat_run, heatwave from labelled""",
       doubles="MaxTemp_2m", days="Date")
def heat_run_labels(spark, sf_dir):
    rows, stage = staged_daily(spark, sf_dir)
    return L.label_heat(rows.select("District", "Date", "MaxTemp_2m"), stage=stage)


def staged_known(blocks, stage):
    known = L.known_humidity(blocks).own_rows()
    return known.over(stage(known.df, "humidity"))


@query(f"""with {Q.LABELS} select {DD}, "RH_2m", "RH_2m_filled" from labelled""",
       doubles="RH_2m RH_2m_filled", days="Date")
def rh_fill(spark, sf_dir):
    rows, stage = staged_daily(spark, sf_dir)
    blocks = in_blocks(rows.select("District", "Date", "RH_2m"), "District", "Date", 0)
    return L.fill_humidity(staged_known(blocks, stage)).plain()


@query(f"""with {Q.DAILY} select {DD}, coalesce(
    last_value("RH_2m" ignore nulls) over (partition by "District" order by "Date" rows unbounded preceding),
    first_value("RH_2m" ignore nulls) over (partition by "District" order by "Date"
      rows between current row and unbounded following)) as "RH_2m_filled" from daily""",
       doubles="RH_2m_filled", days="Date")
def rh_fill_in_district(spark, sf_dir):
    rows, stage = staged_daily(spark, sf_dir)
    blocks = in_blocks(rows.select("District", "Date", "RH_2m"), "District", "Date", 0)
    return L.fill_humidity(staged_known(blocks, stage), scope="district").plain().drop("RH_2m")


@query(f"""with {Q.LABELS} select {DD}, precip_1d, precip_3d, precip_7d, precip_p99, precip3_p98, "RH_2m_filled",
  wetness_flag, flood_proxy from labelled""",
       doubles="precip_1d precip_3d precip_7d precip_p99 precip3_p98 RH_2m_filled", days="Date")
def flood_labels(spark, sf_dir):
    rows, stage = staged_daily(spark, sf_dir)
    labelled = L.label_flood(rows.select("District", "Date", "Precip", "RH_2m"), stage=stage)
    return labelled.drop("Precip", "RH_2m")


@query(f"""with {Q.DAILY}, f as (select * from daily where "Date" < (select max("Date") from daily) - 365),
  q as (select "District", quantile_cont("MaxTemp_2m", 0.95) as heat_limit from f group by 1)
  select {DD}, coalesce("MaxTemp_2m" > heat_limit, false) as heat_exceed from daily left join q using ("District")""",
       days="Date")
def heat_labels_fit_on_train(spark, sf_dir):
    rows, stage = staged_daily(spark, sf_dir)
    rows = rows.select("District", "Date", "MaxTemp_2m")
    limits = L.heat_thresholds(offline.before_last_days(rows), stage=stage)
    return L.label_heat(rows, limits, stage=stage).select("District", "Date", "heat_exceed")


@query(f"""with {Q.LABELS} select {DD}, heat_run, heatwave, wetness_flag, flood_proxy from labelled""", days="Date")
def both_labels(spark, sf_dir):
    rows, stage = staged_daily(spark, sf_dir)
    return L.label_both(rows, stage=stage).select("District", "Date", "heat_run", "heatwave", "wetness_flag", "flood_proxy")


# --- climatology and features ----------------------------------------------------------------

_CLIM = Q.DAILY + """, clim as (select "District", cast(dayofyear("Date") as int) as doy,
  median("MaxTemp_2m") as "clim_maxT", median("Precip") as clim_precip from daily group by 1, 2)"""


@query(f"with {_CLIM} select * from clim", doubles="clim_maxT clim_precip")
def climatology(spark, sf_dir):
    return FE.climatology(daily(spark, sf_dir))


_ANOMALY = f"""with {_CLIM} select {DD}, doy, "clim_maxT", clim_precip, "MaxTemp_2m" - "clim_maxT" as "anom_maxT",
  "Precip" - clim_precip as anom_precip from (select *, cast(dayofyear("Date") as int) as doy from daily)
  left join clim using ("District", doy)"""
_ANOMALY_NAMES = ["clim_maxT", "clim_precip", "anom_maxT", "anom_precip"]


@query(_ANOMALY, doubles=" ".join(_ANOMALY_NAMES), days="Date")
def climatology_anomaly(spark, sf_dir):
    return FE.add_anomalies(daily(spark, sf_dir)).select("District", "Date", "doy", *_ANOMALY_NAMES)


@query(_ANOMALY, doubles=" ".join(_ANOMALY_NAMES), days="Date")
def climatology_join(spark, sf_dir):
    """The same from a climatology table: a left join on (district, day of year)."""
    rows = daily(spark, sf_dir)
    return FE.add_anomalies(rows, FE.climatology(rows)).select("District", "Date", "doy", *_ANOMALY_NAMES)


_FEATURES = Q.LABELS + f""", clim as (select "District", dayofyear("Date") as doy, median("MaxTemp_2m") as "clim_maxT"
  from daily group by 1, 2), n as (select {DD}, coalesce("Precip", 0e0) as v,
    row_number() over (partition by "District" order by "Date") as rn from daily), api as (
  select a."District", a."Date", sum(b.v * pow(0.8e0, a.rn - b.rn)) as "API"
  from n a join n b on a."District" = b."District" and b.rn between a.rn - 250 and a.rn group by 1, 2), features as (
  select {DD}, "Precip", sum("Precip") {_W.format(2)} as precip_3d, sum("Precip") {_W.format(6)} as precip_7d,
    {', '.join(f'lag("Precip", {k}) over w as precip_lag_{k}' for k in (1, 3, 7))},
    "MaxTemp_2m", avg("MaxTemp_2m") {_W.format(2)} as "maxT_3d_mean",
    {', '.join(f'lag("MaxTemp_2m", {k}) over w as "maxT_lag_{k}"' for k in (1, 3))},
    "MaxTemp_2m" - "clim_maxT" as "anom_maxT", "RH_2m", wetness_flag, "API", "TempRange_2m", "WindSpeed_10m",
    "WindSpeed_50m", sin(2 * pi() * l.doy / 365.25e0) as doy_sin, cos(2 * pi() * l.doy / 365.25e0) as doy_cos,
    cast(month("Date") as int) as month, cast(year("Date") as int) as year, heatwave, flood_proxy
  from (select *, dayofyear("Date") as doy from labelled) l left join clim using ("District", doy)
    join api using ("District", "Date") window w as (partition by "District" order by "Date"))"""
_FEATURE_DOUBLES = ("Precip precip_3d precip_7d precip_lag_1 precip_lag_3 precip_lag_7 MaxTemp_2m maxT_3d_mean"
                    " maxT_lag_1 maxT_lag_3 anom_maxT RH_2m API TempRange_2m WindSpeed_10m WindSpeed_50m"
                    " doy_sin doy_cos")


def feature_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, TableStages]:
    rows, stage = staged_daily(spark, sf_dir)
    return stage(offline.label_and_build(rows, stage=stage), "features"), stage


@query(f"with {_FEATURES} select * from features", doubles=_FEATURE_DOUBLES, days="Date")
def feature_table(spark, sf_dir):
    rows, stage = staged_daily(spark, sf_dir)
    return offline.label_and_build(rows, stage=stage)


_INPUTS = [c for c in K.FEATURE_COLUMNS if c not in K.NOT_INPUTS]


@query(f"""with {_FEATURES} select {DD}, {', '.join(f'coalesce(cast("{c}" as double), -999e0) as "{c}"' for c in _INPUTS)},
  cast(heatwave as int) as label from features""", doubles=" ".join(_INPUTS), days="Date")
def model_matrix(spark, sf_dir):
    table, _ = feature_rows(spark, sf_dir)
    return MO.model_matrix(table, "heatwave")[0]


@query(f"""with {_FEATURES} select {DD}, coalesce("Precip", 0e0) as "Precip", coalesce(precip_lag_7, 0e0) as precip_lag_7,
  coalesce("RH_2m", 0e0) as "RH_2m" from features""", doubles="Precip precip_lag_7 RH_2m", days="Date")
def zero_filled_inputs(spark, sf_dir):
    table, _ = feature_rows(spark, sf_dir)
    names = ["Precip", "precip_lag_7", "RH_2m"]
    return SE.finite_inputs(table.select("District", "Date", *names), names)


# --- single records and rule scores ----------------------------------------------------------

_BASIC = """coalesce("MaxTemp_2m", 30e0) as t, coalesce("Precip", 0e0) as p, coalesce("RH_2m", 50e0) as h"""
_ALONE = """p as "Precip", p * 3 as precip_3d, p * 7 as precip_7d, p as precip_lag_1, p as precip_lag_3, p as precip_lag_7,
  t as "MaxTemp_2m", t as "maxT_3d_mean", t as "maxT_lag_1", t as "maxT_lag_3", t - 30 as "anom_maxT", h as "RH_2m",
  case when h > 80 then 1 else 0 end as wetness_flag"""
_RECORD_DOUBLES = ("Precip precip_3d precip_7d precip_lag_1 precip_lag_3 precip_lag_7 MaxTemp_2m maxT_3d_mean"
                   " maxT_lag_1 maxT_lag_3 anom_maxT RH_2m API TempRange_2m WindSpeed_10m WindSpeed_50m doy_sin doy_cos")
_RECORD = """coalesce("TempRange_2m", 10e0) as "TempRange_2m", coalesce("WindSpeed_10m", 5e0) as "WindSpeed_10m",
  coalesce("WindSpeed_50m", 10e0) as "WindSpeed_50m", {} cast(month("Date") as int) as month, cast(year("Date") as int) as year"""


@query(f"""with {Q.DAILY}, b as (select daily.*, {_BASIC} from daily) select {DD}, {_ALONE}, p * 0.9e0 as "API",
  {_RECORD.format('0.5e0 as doy_sin, 0.5e0 as doy_cos,')} from b""",
       doubles=_RECORD_DOUBLES, days="Date")
def record_features(spark, sf_dir):
    return SC.record_features(daily(spark, sf_dir), F.col("Date"), keep=("District", "Date"))


@query(f"""with {Q.DAILY}, b as (select daily.*, {_BASIC} from daily) select {DD}, {_ALONE}, p * 0.9e0 as "API",
  {_RECORD.format('''sin(2 * pi() * dayofyear("Date") / 365) as doy_sin, cos(2 * pi() * dayofyear("Date") / 365) as doy_cos,''')}
  from b""", doubles=_RECORD_DOUBLES, days="Date")
def record_features_season(spark, sf_dir):
    return SC.record_features(daily(spark, sf_dir), F.col("Date"), season=True, keep=("District", "Date"))


_PAST = 'over (partition by "District" order by "Date" rows between 7 preceding and 1 preceding)'


@query(f"""with {Q.DAILY}, k as (select *, coalesce("Precip", 0e0) as p, "MaxTemp_2m" as t, coalesce("RH_2m", 50e0) as h
    from daily), b as (select *, count(*) {_PAST} as past, {', '.join(
    f'lag(p, {i}) over w as p{i}, lag(t, {i}) over w as t{i}' for i in range(1, 8))}
    from k window w as (partition by "District" order by "Date"))
  select {DD}, p as "Precip", case when past >= 7 then p1 + p2 + p3 else p * 3 end as precip_3d,
  case when past >= 7 then p1 + p2 + p3 + p4 + p5 + p6 + p7 else p * 7 end as precip_7d,
  {', '.join(f'case when past >= 7 then p{i} else p end as precip_lag_{i}' for i in (1, 3, 7))},
  t as "MaxTemp_2m", case when past >= 3 then (t1 + t2 + t3) / 3 else t end as "maxT_3d_mean",
  {', '.join(f'case when past >= 3 then t{i} else t end as "maxT_lag_{i}"' for i in (1, 3))},
  t - 30 as "anom_maxT", h as "RH_2m", case when h > 80 then 1 else 0 end as wetness_flag, p * 1.5e0 as "API",
  "TempRange_2m", "WindSpeed_10m", "WindSpeed_50m", sin(2 * pi() * dayofyear("Date") / 365.25e0) as doy_sin,
  cos(2 * pi() * dayofyear("Date") / 365.25e0) as doy_cos, cast(month("Date") as int) as month, 2025 as year from b""",
       doubles=_RECORD_DOUBLES, days="Date")
def form_features(spark, sf_dir):
    rows = daily(spark, sf_dir).withColumns({
        "Precip": F.coalesce("Precip", F.lit(0.0)), "RH_2m": F.coalesce("RH_2m", F.lit(50.0)),
    })
    blocks = in_blocks(rows, "District", "Date", 7)
    past = blocks.with_columns({
        "rain_past": F.collect_list("Precip").over(blocks.frame(-7, -1)),
        "temp_past": F.collect_list("MaxTemp_2m").over(blocks.frame(-7, -1)),
    }).plain()
    return SC.form_features(past, month=F.month("Date"), day_of_year=F.dayofyear("Date"),
                            rain_history="rain_past", temp_history="temp_past", keep=("District", "Date"))


def _rule_sql(heat: str, flood: str) -> str:
    return f"""with {Q.DAILY}, b as (select daily.*, {_BASIC} from daily), p as (select {DD},
      {heat} as heatwave_probability, {flood} as flood_probability from b)
      select *, {Q.label_above('heatwave_probability')} as heatwave_risk, {Q.label_above('flood_probability')} as flood_risk from p"""


def rule_scored(spark: SparkSession, sf_dir: str, rules: str) -> DataFrame:
    return SC.add_rule_scores(daily(spark, sf_dir), rules).select(
        "District", "Date", "heatwave_probability", "flood_probability", "heatwave_risk", "flood_risk"
    )


_PROBS = "heatwave_probability flood_probability"


@query(_rule_sql(Q.heat_score_linear("t"), Q.flood_score_linear("p", "h")), doubles=_PROBS, days="Date")
def rule_scores_linear(spark, sf_dir):
    return rule_scored(spark, sf_dir, "linear")


@query(_rule_sql(Q.heat_score_linear("t"), Q.flood_score_linear("p", None)), doubles=_PROBS, days="Date")
def rule_scores_linear_dry(spark, sf_dir):
    return rule_scored(spark, sf_dir, "linear_dry")


@query(_rule_sql(Q.heat_score_steps("t"), Q.flood_score_steps("p", "h")), doubles=_PROBS, days="Date")
def rule_scores_steps(spark, sf_dir):
    return rule_scored(spark, sf_dir, "steps")


_SCORE = f"""with {Q.DAILY}, b as (select {DD}, {Q.flood_score_linear('coalesce("Precip", 0e0)', 'coalesce("RH_2m", 50e0)')}
  as prob from daily)"""


def flood_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_scored(spark, sf_dir, "linear").select("District", "Date", F.col("flood_probability").alias("prob"))


@query(f"""{_SCORE} select *, {Q.label_above('prob')} as above, {Q.label_from('prob')} as reached from b""",
       doubles="prob", days="Date")
def risk_labels_3(spark, sf_dir):
    return flood_scored(spark, sf_dir).withColumns({
        "above": risk.label_above(F.col("prob")), "reached": risk.label_from(F.col("prob")),
    })


@query(f"""{_SCORE} select {DD}, case when prob >= 0.8e0 then 'EXTREME RISK' when prob >= 0.6e0 then 'HIGH RISK'
  when prob >= 0.4e0 then 'MODERATE RISK' when prob >= 0.2e0 then 'LOW RISK' else 'MINIMAL RISK' end as level,
  case when prob >= 0.8e0 then 'Immediate action required!' when prob >= 0.6e0 then 'High risk - Take precautions'
  when prob >= 0.4e0 then 'Moderate risk - Stay alert' when prob >= 0.2e0 then 'Low risk - Normal conditions'
  else 'Minimal risk - Safe conditions' end as advice from b""", days="Date")
def risk_labels_5(spark, sf_dir):
    return flood_scored(spark, sf_dir).select("District", "Date", risk.label_five(F.col("prob")).alias("r")).select(
        "District", "Date", "r.level", "r.advice"
    )


@query(f"{_SCORE} select {DD}, case when prob >= 0.5e0 then 1 else 0 end as prediction from b", days="Date")
def threshold_decision(spark, sf_dir):
    return MO.decided(flood_scored(spark, sf_dir), 0.5, "prob").select("District", "Date", "prediction")


@query(f"""{_SCORE} select {DD}, 1 / (1 + exp(-(prob * 4 - 2))) as squashed from b""", doubles="squashed", days="Date")
def sigmoid_scores(spark, sf_dir):
    return flood_scored(spark, sf_dir).select("District", "Date", risk.sigmoid(F.col("prob") * 4 - 2).alias("squashed"))


# --- alerts and display ----------------------------------------------------------------------

def _one_place(x: str) -> str:
    return f"cast(cast(round(cast({x} as decimal(28, 8)), 1) as decimal(28, 1)) as varchar)"


@query(f"""with {Q.DAILY}, a as (select {DD}, "MaxTemp_2m" as t, "Precip" as p, 'HEATWAVE' as alert_type,
    case when "MaxTemp_2m" > 45 then 'HIGH' else 'MEDIUM' end as severity,
    'Extreme temperature: ' || {_one_place('"MaxTemp_2m"')} || '°C' as message from daily where "MaxTemp_2m" > 40
  union all select {DD}, "MaxTemp_2m", "Precip", 'FLOOD_RISK', case when "Precip" > 150 then 'HIGH' else 'MEDIUM' end,
    'Heavy precipitation: ' || {_one_place('"Precip"')} || 'mm' from daily where "Precip" > 100)
  select sha256("District" || chr(31) || cast("Date" as varchar) || chr(31) || alert_type) as alert_id,
    "District" as district, alert_type, severity, "Date" as timestamp, t as temperature, p as precipitation, message,
    false as acknowledged from a""", doubles="temperature precipitation", days="timestamp")
def alert_fanout(spark, sf_dir):
    return A.fan_out_alerts(daily(spark, sf_dir))


@query(f"""with {Q.DAILY} select {DD}, case when "MaxTemp_2m" > 40 then 'HOT' when "Precip" > 100 then 'FLOOD' else 'OK' end
  as status, case when "MaxTemp_2m" > 40 then 'red' when "MaxTemp_2m" > 35 then 'yellow' else 'green' end as temp_band,
  case when "Precip" > 50 then 'blue' when "Precip" > 10 then 'cyan' else 'white' end as precip_band from daily""", days="Date")
def status_exclusive(spark, sf_dir):
    return C.display_bands(A.add_status(daily(spark, sf_dir))).select(
        "District", "Date", "status", "temp_band", "precip_band"
    )


def _totals_sql(exclusive: bool) -> str:
    hot, wet = 'coalesce("MaxTemp_2m" > 40, false)', 'coalesce("Precip" > 100, false)'
    flood = f"{wet} and not {hot}" if exclusive else wet
    return f"""with {Q.DAILY} select "District", count(*) as total_records,
      cast(sum(case when {hot} then 1 else 0 end) as bigint) as heatwave_alerts,
      cast(sum(case when {flood} then 1 else 0 end) as bigint) as flood_alerts from daily group by 1"""


@query(_totals_sql(False))
def alert_totals(spark, sf_dir):
    return A.alert_totals(daily(spark, sf_dir), ["District"])


@query(_totals_sql(True))
def alert_totals_exclusive(spark, sf_dir):
    return A.alert_totals(daily(spark, sf_dir), ["District"], exclusive=True)


# --- history table ---------------------------------------------------------------------------

_HISTORY = Q.DAILY + """, history as (select "District" as district, cast(year("Date") as int) as year, "Date" as date,
  0e0 as latitude, 0e0 as longitude, "MaxTemp_2m" as max_temp, "MinTemp_2m" as min_temp, "TempRange_2m" as temp_range,
  "Precip" as precipitation, "RH_2m" as humidity, "WindSpeed_10m" as wind_speed_10m, "WindSpeed_50m" as wind_speed_50m,
  0e0 as solar_radiation from daily)"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_records(daily(spark, sf_dir))[0].drop("timestamp")


@query(f"with {_HISTORY} select * from history", days="date",
       doubles="latitude longitude max_temp min_temp temp_range precipitation humidity wind_speed_10m wind_speed_50m"
               " solar_radiation")
def history_rows(spark, sf_dir):
    return history(spark, sf_dir)


@query(f"""with {_HISTORY} select district, year, avg(max_temp) as avg_temp, max(max_temp) as max_temp,
  sum(precipitation) as total_precip, count(*) as record_count from history group by 1, 2""",
       doubles="avg_temp max_temp total_precip")
def district_year_stats(spark, sf_dir):
    return views.district_year_stats(history(spark, sf_dir))


@query(f"""with {_HISTORY} select date, max_temp, precipitation, humidity from history where district = 'Dhanusa'
  and year = 1998 order by date desc limit 100""", doubles="max_temp precipitation humidity", days="date")
def district_year_scan(spark, sf_dir):
    return serving.district_year(history(spark, sf_dir), "Dhanusa", 1998, 100)


@query(f"""with {_HISTORY} select date, max_temp, district from history where district = 'Bara' and year = 1997
  and max_temp > 40""", doubles="max_temp", days="date")
def hot_days(spark, sf_dir):
    return serving.hot_days(history(spark, sf_dir), "Bara", 1997)


# --- replay ----------------------------------------------------------------------------------

_BLOCKS = Q.DAILY + """, batched as (select *, (row_number() over (partition by "District" order by "Date") - 1) // 10 + 1
  as batch from daily)"""


@query(f"with {_BLOCKS} select {DD}, cast(batch as bigint) as batch from batched", days="Date")
def replay_batches(spark, sf_dir):
    return R.block_batches(daily(spark, sf_dir)).select("District", "Date", "batch")


@query(f"""with {Q.DAILY} select {DD}, row_number() over (partition by "District" order by "Date") as batch from daily""",
       days="Date")
def replay_steps(spark, sf_dir):
    return R.step_batches(daily(spark, sf_dir)).select("District", "Date", "batch")


_ROBIN = Q.DAILY + """, r as (select *, row_number() over (partition by "District" order by "Date") as rn from daily),
  fed as (select *, row_number() over (order by rn, "District") - 1 as sequence from r)"""


@query(f"with {_ROBIN} select {DD}, cast(sequence as bigint) as sequence, cast(sequence // 10 + 1 as bigint) as batch from fed",
       days="Date")
def replay_round_robin(spark, sf_dir):
    return R.round_robin_batches(daily(spark, sf_dir)).select("District", "Date", "sequence", "batch")


@query(f"""with {_ROBIN} select cast(sequence // 10 + 1 as bigint) as batch, count(*) as records,
  avg("MaxTemp_2m") as avg_temp, sum("Precip") as total_precip, count(distinct "District") as districts
  from fed group by 1""", doubles="avg_temp total_precip")
def batch_summary(spark, sf_dir):
    return views.batch_summary(R.round_robin_batches(daily(spark, sf_dir)))


@query(f"""with {_BLOCKS} select batch, "District", count(*) as records, avg("MaxTemp_2m") as avg_temp,
  sum("Precip") as total_precip from batched group by 1, 2""", doubles="avg_temp total_precip")
def batch_summary_by_district(spark, sf_dir):
    return views.batch_by_district(R.block_batches(daily(spark, sf_dir)), ("batch", "District"))


@query(f"""with {_BLOCKS}, g as (select "District", cast(sum(case when batch <= 200 then 1 else 0 end) as bigint) as consumed,
    count(*) as total from batched group by 1)
  select *, consumed / total * 100 as percent, case when consumed / total * 100 > 80 then 'red'
    when consumed / total * 100 > 50 then 'yellow' else 'green' end as band from g""", doubles="percent")
def replay_progress(spark, sf_dir):
    return views.replay_progress(R.block_batches(daily(spark, sf_dir)), 200, K.PROGRESS_BANDS)


_NUMBERED = Q.DAILY + """, n as (select *, row_number() over (order by "District", "Date") as rn from daily)"""


@query(f"""with {_NUMBERED} select {DD}, "Precip" from n where rn > 3000 and rn <= 4000""", doubles="Precip", days="Date")
def replay_row_range(spark, sf_dir):
    return R.row_range(daily(spark, sf_dir), 3000, 4000, key="District", order="Date").select("District", "Date", "Precip")


@query(f"""with {_NUMBERED} select "TempRange_2m", "WindSpeed_10m" from n where rn <= 4000
  except select "TempRange_2m", "WindSpeed_10m" from n where rn <= 1000""", doubles="TempRange_2m WindSpeed_10m")
def replay_subtract(spark, sf_dir):
    rows = daily(spark, sf_dir).select("District", "Date", "TempRange_2m", "WindSpeed_10m")
    return R.prefix_difference(rows, 1000, 4000, "District", "Date", columns=["TempRange_2m", "WindSpeed_10m"])


@query(f"""with {Q.DAILY}, top as (select * from daily order by "Date" desc, "District" desc limit 100)
  select avg("MaxTemp_2m") as avg_temp, max("MaxTemp_2m") as max_temp, sum("Precip") as total_precip,
  count(*) as records, count(distinct "District") as districts from top""", doubles="avg_temp max_temp total_precip")
def recent_buffer_summary(spark, sf_dir):
    return views.buffer_summary(serving.newest(daily(spark, sf_dir), "Date", 100, "District"))


@query(f"""with {Q.DAILY} select strftime("Date", '%Y-%m-%d') as "Date", "District", {plain_round_sql('"MaxTemp_2m"', 1)} as "Temp (°C)",
  {plain_round_sql('"Precip"', 2)} as "Precip (mm)", {plain_round_sql('"RH_2m"', 1)} as "Humidity (%)" from daily
  order by daily."Date" desc, "District" desc limit 20""")
def recent_table(spark, sf_dir):
    return serving.recent_table(daily(spark, sf_dir), "Date", 20, "District")


@query(f"""with {Q.DAILY} select {DD}, "MaxTemp_2m" from daily order by "Date", "District" limit 10""",
       doubles="MaxTemp_2m", days="Date")
def sample_rows(spark, sf_dir):
    return serving.first_rows(daily(spark, sf_dir).select("District", "Date", "MaxTemp_2m"), 10, "Date", "District")


@query(f"""with {Q.DAILY}, {Q.PLACES} select daily."District", count(*) as records, any_value(latitude) as latitude,
  any_value(longitude) as longitude, 'WS-' || lpad(cast(row_number() over (order by daily."District") as varchar), 3, '0')
  as station_id from daily join places on daily."District" = places.district group by 1""", doubles="latitude longitude")
def station_cards(spark, sf_dir):
    places = serving.dimension(spark, name="District").withColumnsRenamed(
        {"latitude": "Latitude", "longitude": "Longitude"}
    )
    located = serving.with_coordinates(daily(spark, sf_dir), places, "District")
    cards = views.station_cards(located)
    # The dimension bounds the cards to a handful of rows.
    number = F.row_number().over(W.partitionBy().orderBy("District"))
    return cards.withColumn("station_id", F.format_string("WS-%03d", number))


# --- splits, sequences, metrics --------------------------------------------------------------

@query(f"""with {Q.DAILY}, x as (select max("Date") as last from daily), s as (
    select case when "Date" < last - 365 then 'train' else 'test' end as part, "Date" from daily, x)
  select part, count(*) as rows, min("Date") as first_day, max("Date") as last_day from s group by 1""",
       days="first_day last_day")
def time_split_counts(spark, sf_dir):
    train, test = MO.time_split(daily(spark, sf_dir).select("Date"))
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count("*").alias("rows"), F.min("Date").alias("first_day"), F.max("Date").alias("last_day")
    )


@query(f"""with {Q.DAILY} select {DD}, cast(('0x' || substr(md5("District" || '|' || cast("Date" as varchar)), 1, 8))::bigint
  % 100 as int) < 80 as train from daily""", days="Date")
def hash_split(spark, sf_dir):
    rows = daily(spark, sf_dir).select("District", "Date")
    return rows.withColumn("train", MO.hash_bucket("District", "Date") < 80)


_PAIR = 'list([t, p]) over (partition by "District" order by "Date" rows between {} and {}) as steps'


def _sequence_sql(start: str, end: str, least: int, extra: str) -> str:
    return f"""with {Q.LABELS}, z as (select {DD}, coalesce("MaxTemp_2m", 0e0) as t, coalesce("Precip", 0e0) as p,
      cast(heatwave as int) as label, row_number() over (partition by "District" order by "Date") as rn from labelled),
      q as (select *, first_value(t) over w as first_temp, last_value(t) over w as last_temp, sum(p) over w as rain_total,
      count(*) over w as steps from z window w as (partition by "District" order by "Date" rows between {start} and {end}))
      select {DD}, {extra} cast(steps as int) as steps, first_temp, last_temp, rain_total from q where rn > {least}"""


def _described(rows: DataFrame, *keep: str) -> DataFrame:
    first, last = F.element_at("sequence", 1), F.element_at("sequence", -1)
    rain = F.aggregate("sequence", F.lit(0.0), lambda s, x: s + x[1])
    return rows.select(
        "District", "Date", *keep, F.size("sequence").alias("steps"), first[0].alias("first_temp"),
        last[0].alias("last_temp"), rain.alias("rain_total"),
    )


@query(_sequence_sql("14 preceding", "1 preceding", 14, "label,"), doubles="first_temp last_temp rain_total", days="Date")
def sequences_train(spark, sf_dir):
    rows, stage = staged_daily(spark, sf_dir)
    labelled = L.label_heat(rows.select("District", "Date", "MaxTemp_2m", "Precip"), stage=stage)
    return _described(SE.training_sequences(labelled, inputs=["MaxTemp_2m", "Precip"]), "label")


@query(_sequence_sql("13 preceding", "current row", 13, ""), doubles="first_temp last_temp rain_total", days="Date")
def sequences_score(spark, sf_dir):
    return _described(SE.scoring_sequences(daily(spark, sf_dir), inputs=["MaxTemp_2m", "Precip"]))


@query(f"""with {Q.LABELS}, z as (select "District", "Date", coalesce("MaxTemp_2m", 0e0) as t, coalesce("Precip", 0e0) as p,
    row_number() over (partition by "District" order by "Date") as rn, count(*) over (partition by "District") as n
    from labelled), u as (select *, greatest(0, least(n, rn + 14) - greatest(rn, 14)) as uses from z)
  select 0 as input, sum(t * uses) / sum(uses) as mean,
    sqrt(sum(t * t * uses) / sum(uses) - pow(sum(t * uses) / sum(uses), 2)) as std from u
  union all select 1, sum(p * uses) / sum(uses),
    sqrt(sum(p * p * uses) / sum(uses) - pow(sum(p * uses) / sum(uses), 2)) from u""", doubles="mean std")
def sequence_scaling(spark, sf_dir):
    rows, stage = staged_daily(spark, sf_dir)
    labelled = L.label_heat(rows.select("District", "Date", "MaxTemp_2m", "Precip"), stage=stage)
    return MO.step_statistics(SE.training_sequences(labelled, inputs=["MaxTemp_2m", "Precip"]))


# All inputs: each sequence as two sums over its steps and inputs, weighted by the step and by the input.
_SEQUENCE_INPUTS = _INPUTS  # the tables have no coordinates
_Z = _FEATURES + f""", z as (select {DD}, cast(coalesce(heatwave, false) as int) as label, row_number() over (partition by "District" order by "Date") as rn,
  count(*) over (partition by "District") as n, {', '.join(f'coalesce(cast("{c}" as double), 0e0) as "{c}"' for c in _SEQUENCE_INPUTS)} from features)"""


def _digest_sql(start: str, end: str, least: int, extra: str) -> str:
    total = " + ".join(f'"{c}"' for c in _SEQUENCE_INPUTS)
    by_input = " + ".join(f'{i} * "{c}"' for i, c in enumerate(_SEQUENCE_INPUTS, 1))
    return f"""with {_Z}, a as (select *, {total} as a, {by_input} as b from z), q as (select {DD}, label, rn, count(*) over w as steps,
      sum(rn * a) over w - (min(rn) over w - 1) * sum(a) over w as by_step, sum(b) over w as by_input
      from a window w as (partition by "District" order by "Date" rows between {start} and {end}))
      select {DD}, {extra} cast(steps as int) as steps, {steady_sql('by_step', 2)} as by_step, {steady_sql('by_input', 2)} as by_input from q where rn > {least}"""


def _digested(rows: DataFrame, *keep: str) -> DataFrame:
    def total(weighted):
        return F.aggregate(F.flatten(F.transform("sequence", weighted)), F.lit(0.0), lambda s, x: s + x)

    by_step = total(lambda step, j: F.transform(step, lambda x: x * (j + 1)))
    by_input = total(lambda step: F.transform(step, lambda x, i: x * (i + 1)))
    return rows.select("District", "Date", *keep, F.size("sequence").alias("steps"), steady(by_step, 2).alias("by_step"), steady(by_input, 2).alias("by_input"))


@query(_digest_sql("14 preceding", "1 preceding", 14, "label,"), doubles="by_step by_input", days="Date")
def sequences_train_all(spark, sf_dir):
    """Training sequences over every input of the feature table."""
    table, _ = feature_rows(spark, sf_dir)
    return _digested(SE.training_sequences(table), "label")


@query(_digest_sql("13 preceding", "current row", 13, ""), doubles="by_step by_input", days="Date")
def sequences_score_all(spark, sf_dir):
    """Scoring sequences over every input of the feature table."""
    table, _ = feature_rows(spark, sf_dir)
    return _digested(SE.scoring_sequences(table))


@query(f"""with {_Z}, u as (select *, greatest(0, least(n, rn + 14) - greatest(rn, 14)) as uses from z) """ + " union all ".join(
    f"""select {i} as input, sum("{c}" * uses) / sum(uses) as mean, sqrt(greatest(0, sum("{c}" * "{c}" * uses) / sum(uses) - pow(sum("{c}" * uses) / sum(uses), 2))) as std from u"""
    for i, c in enumerate(_SEQUENCE_INPUTS)), doubles="mean std")
def sequence_scaling_all(spark, sf_dir):
    """Mean and deviation of every input over all steps of all training sequences."""
    table, _ = feature_rows(spark, sf_dir)
    return MO.step_statistics(SE.training_sequences(table))


_RANKED = Q.LABELS + f""", r as (select {DD}, {Q.flood_score_linear('coalesce("Precip", 0e0)', 'coalesce("RH_2m", 50e0)')}
  as prob, cast(flood_proxy as int) as label from labelled), g as (select prob, sum(label) as pos, count(*) - sum(label) as neg
  from r group by 1), a as (select *, sum(pos) over (order by prob desc) as tp, sum(neg) over (order by prob desc) as fp,
  sum(pos) over () as p, sum(neg) over () as n from g)"""


def scored_and_labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, TableStages]:
    rows, stage = staged_daily(spark, sf_dir)
    labelled = L.label_flood(rows.select("District", "Date", "MaxTemp_2m", "Precip", "RH_2m"), stage=stage)
    scored = SC.add_rule_scores(labelled, "linear").select(
        "District", "Date", F.col("flood_probability").alias("prob"), F.col("flood_proxy").cast("int").alias("label")
    )
    return scored, stage


@query(f"""with {_RANKED}, ap as (select sum(pos * tp / (tp + fp)) / max(p) as average_precision,
    1 - sum(pos * (fp - neg + neg / 2)) / (max(p) * max(n)) as roc_auc from a) select * from ap""",
       doubles="average_precision roc_auc")
def ranking_metrics(spark, sf_dir):
    scored, stage = scored_and_labelled(spark, sf_dir)
    return ME.ranking_metrics(ME.score_table(scored, "prob", "label", stage=stage))


@query(f"""with {_RANKED} select prob as threshold, tp / (tp + fp) as precision, tp / p as recall, fp / n as fpr,
  tp / p as tpr from a""", doubles="threshold precision recall fpr tpr")
def curve_points(spark, sf_dir):
    scored, stage = scored_and_labelled(spark, sf_dir)
    return ME.curve_points(ME.score_table(scored, "prob", "label", stage=stage))


@query(f"""with {_RANKED}, k as (select count(*) filter (where prob >= 0.2 and label = 1) as tp,
    count(*) filter (where prob >= 0.2 and label = 0) as fp, count(*) filter (where prob < 0.2 and label = 1) as fn from r)
  select tp / (tp + fp) as precision, tp / (tp + fn) as recall, 2 * tp / (2 * tp + fp + fn) as f1 from k""",
       doubles="precision recall f1")
def threshold_metrics(spark, sf_dir):
    scored, _ = scored_and_labelled(spark, sf_dir)
    return ME.threshold_metrics(scored, "prob", "label", 0.2)


@query(f"""with {_RANKED} select count(*) as total, count(*) filter (where prob >= 0.5) as positives,
  count(*) filter (where prob < 0.5) as negatives,
  avg(case when (prob >= 0.5) = (label = 1) then 1 else 0 end) as accuracy from r""", doubles="accuracy")
def scoring_summary(spark, sf_dir):
    scored, _ = scored_and_labelled(spark, sf_dir)
    return ME.scoring_summary(MO.decided(scored, 0.5, "prob"), actual="label")


@query(f"""with {Q.LABELS} select greatest(1e0, (count(*) - count(*) filter (where heatwave))
  / greatest(1, count(*) filter (where heatwave))) as pos_weight from labelled""", doubles="pos_weight")
def class_weight(spark, sf_dir):
    rows, stage = staged_daily(spark, sf_dir)
    return ME.class_weight(L.label_heat(rows.select("District", "Date", "MaxTemp_2m"), stage=stage), "heatwave")
