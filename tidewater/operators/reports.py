"""Report queries over the metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.time import today_int


def _day_of_stt() -> F.Column:
    return F.regexp_replace(F.substring("stt", 1, 10), "-", "").cast("int")


def _one_day(metrics: DataFrame, day: int | None) -> DataFrame:
    """Rows of a day (yyyyMMdd; today by default, F19). A stored metric table is partitioned
    by ``dt``, so the filter on it reads that day's files alone."""
    if "dt" not in metrics.columns:
        return metrics.where(_day_of_stt() == (today_int() if day is None else F.lit(day)))
    if day is None:
        return metrics.where(F.col("dt") == F.date_format(F.current_date(), "yyyy-MM-dd"))
    d = str(day)
    return metrics.where(F.col("dt") == F.lit(f"{d[:4]}-{d[4:6]}-{d[6:]}"))


def gmv_report(province_metrics: DataFrame, day: int | None = None) -> DataFrame:
    """Total order amount of one day (yyyyMMdd) of the province metric table (A12); one
    row, null when the day has no rows. Summed in decimal so the total does not depend
    on the order of the windows."""
    rows = _one_day(province_metrics, day)
    return rows.agg(F.sum(F.col("order_amount").try_cast("decimal(18,2)")).cast("double")
                    .alias("gmv"))


def gmv_json(report: DataFrame) -> DataFrame:
    """Payload of the total (F23): ``{"status":0,"msg":"","data":number}``; 0 without rows."""
    body = F.struct(F.lit(0).alias("status"), F.lit("").alias("msg"),
                    F.coalesce("gmv", F.lit(0.0)).alias("data"))
    return report.select(F.to_json(body).alias("json"))


def uv_by_channel_report(channel_metrics: DataFrame, day: int | None = None) -> DataFrame:
    """Visitors and bounces per channel for one day of the channel metric table."""
    rows = _one_day(channel_metrics, day)
    return rows.groupBy("ch").agg(F.sum("uv_ct").alias("uv_ct"), F.sum("uj_ct").alias("uj_ct"))


def count_by_key(current: DataFrame, key: str) -> DataFrame:
    """``count(1)`` per key over a current (upsert) table."""
    return current.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def chart_json(report: DataFrame) -> DataFrame:
    """Chart payload of the channel report (F23): one row
    ``{"status":0,"msg":"","data":{"categories":[..],"series":[{"name","data"}..]}}``.
    The report has one row per channel, so the one-row collect is bounded by the
    number of channels."""
    rows = F.array_sort(F.collect_list(F.struct("ch", "uv_ct", "uj_ct")))
    agg = report.agg(rows.alias("r"))
    body = F.struct(
        F.lit(0).alias("status"), F.lit("").alias("msg"),
        F.struct(
            F.transform("r", lambda x: x["ch"]).alias("categories"),
            F.array(
                F.struct(F.lit("uv").alias("name"),
                         F.transform("r", lambda x: x["uv_ct"]).alias("data")),
                F.struct(F.lit("uj").alias("name"),
                         F.transform("r", lambda x: x["uj_ct"]).alias("data")),
            ).alias("series")).alias("data"))
    return agg.select(F.to_json(body).alias("json"))
