"""Date keys and calendar attributes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season of each month.
SEASONS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8], "Autumn": [9, 10, 11]}


def date_id(day) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def season(month) -> Column:
    out = F.lit(None).cast("string")
    for name, months in SEASONS.items():
        out = F.when(month.isin(months), F.lit(name)).otherwise(out)
    return out


def calendar_columns(day: Column) -> list[Column]:
    return [
        date_id(day).alias("Date_ID"), day.alias("Full_Date"), F.year(day).alias("Year"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("Quarter"), F.month(day).alias("Month"),
        F.date_format(day, "MMMM").alias("Month_Name"), F.date_format(day, "yyyy-MM").alias("Month_Year"),
        season(F.month(day)).alias("Season"), F.date_format(day, "EEEE").alias("Day_Of_Week"),
        (F.weekday(day) >= 5).alias("Is_Weekend"),
    ]
