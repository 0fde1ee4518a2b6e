"""Alert rows, fan-out and status flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.functions.scalar import holds, stable_id
from wxrisk.schemas import ALERTS


def risk_alerts(df: DataFrame) -> DataFrame:
    """Rows with a heat or flood level of 2 or more; heat names the alert when both hold."""
    raised = F.coalesce(*[
        F.when(F.col(level) >= K.ALERT_LEVEL, kind)
        for level, kind in (("heatwave_indicator", "HEATWAVE"), ("flood_indicator", "FLOOD"))
    ])
    return df.withColumn("alert_type", raised).where("alert_type is not null").select(*ALERTS.names)


def _alert(condition: Column, kind: str, severe: Column, message: Column) -> Column:
    return F.when(condition, F.struct(
        F.lit(kind).alias("alert_type"),
        F.when(severe, "HIGH").otherwise("MEDIUM").alias("severity"),
        message.alias("message"),
    ))


def fan_out_alerts(df: DataFrame, district: str = "District", time: str = "Date",
                   temp: str = "MaxTemp_2m", precip: str = "Precip") -> DataFrame:
    """One row per alert: a hot and very wet day yields two. The id repeats when the day is replayed."""
    t, p = F.col(temp), F.col(precip)
    candidates = F.array(
        _alert(t > K.HOT_ABOVE, "HEATWAVE", t > K.HOT_SEVERE_ABOVE, F.format_string(K.HOT_MESSAGE, t)),
        _alert(p > K.WET_ABOVE, "FLOOD_RISK", p > K.WET_SEVERE_ABOVE, F.format_string(K.WET_MESSAGE, p)),
    )
    raised = df.select(
        F.col(district).alias("district"), F.col(time).alias("timestamp"),
        t.alias("temperature"), p.alias("precipitation"),
        F.explode(F.filter(candidates, lambda a: a.isNotNull())).alias("_a"),
    )
    return raised.select(
        stable_id("district", F.col("timestamp").cast("string"), "_a.alert_type").alias("alert_id"),
        "district", "_a.alert_type", "_a.severity", "timestamp", "temperature", "precipitation",
        "_a.message", F.lit(False).alias("acknowledged"),
    )


def add_status(df: DataFrame, temp: str = "MaxTemp_2m", precip: str = "Precip") -> DataFrame:
    """HOT wins over FLOOD; everything else is OK."""
    status = F.when(F.col(temp) > K.HOT_ABOVE, "HOT").when(F.col(precip) > K.WET_ABOVE, "FLOOD")
    return df.withColumn("status", status.otherwise("OK"))


def alert_totals(df: DataFrame, by=(), temp: str = "MaxTemp_2m", precip: str = "Precip",
                 exclusive: bool = False) -> DataFrame:
    """Records and alerts; with ``exclusive`` a hot day is not also counted as a flood day."""
    hot, wet = holds(F.col(temp) > K.HOT_ABOVE), holds(F.col(precip) > K.WET_ABOVE)
    return df.groupBy(*by).agg(
        F.count("*").alias("total_records"),
        F.count_if(hot).alias("heatwave_alerts"),
        F.count_if(wet & ~hot if exclusive else wet).alias("flood_alerts"),
    )
