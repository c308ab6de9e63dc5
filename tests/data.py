"""Small observation tables made by rule; no file is shipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Boundary rows of the raw file, as CSV text.
BOUNDARY_CSV = """\
holiday,temp,rain_1h,snow_1h,clouds_all,weather_main,weather_description,date_time,traffic_volume
None,288.28,0.0,0.0,40,Clouds,scattered clouds,2012-10-02 09:00:00,5545
None,288.28,0.0,0.0,41,Clouds,broken clouds,2012-10-02 09:00:00,5545
None,0.0,0.0,0.0,75,Clear,sky is clear,2012-10-02 10:00:00,10
None,,0.0,0.0,75,Clear,sky is clear,2012-10-02 11:00:00,10
,290.0,bad,0.0,75,Mist,mist,2012-10-02 12:00:00,1500
None,290.0,0.0,0.0,75,Fog,fog,2012-10-06 13:00:00,1501
None,290.0,0.0,0.0,75,Haze,haze,2012-10-07 14:00:00,3499
None,270.0,0.0,1.2,90,Snow,light snow,2012-12-01 15:00:00,3500
Christmas Day,265.0,0.0,0.0,1,Clear,sky is clear,2012-12-25 00:00:00,
None,0.0,0.0,0.0,5,Rain,light rain,2013-03-01 08:00:00,900
None,290.0,0.0,0.0,5,Rain,light rain,2013-03-01 08:00:00,900
"""


def hourly_table(spark: SparkSession, hours: int) -> DataFrame:
    """One row per hour; the volume has rush hours on workdays and quiet nights."""
    time = F.timestamp_seconds(F.lit(1349168400) + F.col("id") * 3600)
    hour, day = F.hour("date_time"), F.dayofweek("date_time")
    noise = F.pmod(F.xxhash64("id"), F.lit(400)) - 200
    base = (
        F.when(day.isin(1, 7), F.when(hour.between(10, 20), 2200).otherwise(700))
        .when(hour.isin(7, 8, 16, 17), 4200)
        .when(hour.between(6, 20), 2500)
        .otherwise(800)
    )
    weather = F.array(*[F.lit(w) for w in
                        ("Clear", "Clouds", "Rain", "Snow", "Mist", "Fog", "Haze")])
    pick = F.pmod(F.xxhash64("id", F.lit("weather")), F.lit(7)).cast("int")
    return spark.range(hours).withColumn("date_time", time).select(
        F.when((F.dayofyear("date_time") == 1) & (hour == 0), "New Years Day")
        .otherwise("None").alias("holiday"),
        (F.lit(270.0) + F.pmod(F.xxhash64("id", F.lit("temp")), F.lit(300)) / 10).alias("temp"),
        (F.pmod(F.xxhash64("id", F.lit("rain")), F.lit(5)) / 2).alias("rain_1h"),
        F.lit(0.0).alias("snow_1h"),
        F.pmod("id", F.lit(101)).cast("int").alias("clouds_all"),
        F.get(weather, pick).alias("weather_main"),
        F.lower(F.get(weather, pick)).alias("weather_description"),
        "date_time",
        (base + noise).cast("int").alias("traffic_volume"),
    )
