"""Daily weather: station selection, cleaning, staging joins and yearly answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.quality import quality_report
from millrace.operators.relational import (
    complete_rows,
    enrich,
    first_value,
    grid_key,
    matched_only,
    rename,
)
from millrace.operators.windows import daily_mean, yoy_days, yoy_lag, yoy_lag_faithful

# Column names of the daily weather files and of the fact table.
FACT_COLUMNS = {
    "Longitude (x)": "Longitude",
    "Latitude (y)": "Latitude",
    "Station Name": "StationName",
    "Climate ID": "ClimateID",
    "Date/Time": "DateTime",
    "Year": "Year",
    "Month": "Month",
    "Day": "Day",
    "Data Quality": "DataQuality",
    "Max Temp (°C)": "MaxTemp",
    "Max Temp Flag": "MaxTempFlag",
    "Min Temp (°C)": "MinTemp",
    "Min Temp Flag": "MinTempFlag",
    "Mean Temp (°C)": "MeanTemp",
    "Mean Temp Flag": "MeanTempFlag",
    "Heat Deg Days (°C)": "HeatDegDays",
    "Heat Deg Days Flag": "HeatDegDaysFlag",
    "Cool Deg Days (°C)": "CoolDegDays",
    "Cool Deg Days Flag": "CoolDegDaysFlag",
    "Total Rain (mm)": "TotalRainmm",
    "Total Rain Flag": "TotalRainFlag",
    "Total Snow (cm)": "TotalSnowcm",
    "Total Snow Flag": "TotalSnowFlag",
    "Total Precip (mm)": "TotalPrecipmm",
    "Total Precip Flag": "TotalPrecipFlag",
    "Snow on Grnd (cm)": "SnowonGrndcm",
    "Snow on Grnd Flag": "SnowonGrndFlag",
    "Dir of Max Gust (10s deg)": "DirofMaxGustsdeg",
    "Dir of Max Gust Flag": "DirofMaxGustFlag",
    "Spd of Max Gust (km/h)": "SpdofMaxGustkmh",
    "Spd of Max Gust Flag": "SpdofMaxGustFlag",
    "StationID": "StationID",
}

# Column names of the station list and of the station dimension.
STATION_COLUMNS = {
    "Name": "StationName",
    "Province": "Province",
    "Climate ID": "ClimateID",
    "Station ID": "StationID",
    "Latitude (Decimal Degrees)": "Latitude",
    "Longitude (Decimal Degrees)": "Longitude",
    "Elevation (m)": "Elevation",
    "First Year": "FirstYear",
    "Last Year": "LastYear",
}

# Column names of the place-name list and of the city dimension.
CITY_COLUMNS = {
    "name": "CityName",
    "category": "Category",
    "status.code": "StatusCode",
    "concise.code": "NameType",
    "province.code": "ProvinceCode",
    "latitude": "Latitude",
    "longitude": "Longitude",
    "decision": "StatusCodeDate",
}


def _pick(df: DataFrame, columns: dict[str, str]) -> list[Column]:
    return [F.col(f"`{source}`").alias(target) for source, target in columns.items()]


def stations(raw: DataFrame) -> DataFrame:
    """Station dimension with the grid key of its coordinates."""
    table = raw.select(*_pick(raw, STATION_COLUMNS))
    return table.withColumn("IRID", grid_key(F.col("Latitude"), F.col("Longitude")))


def cities(places: DataFrame) -> DataFrame:
    """Place names other than provinces, with their grid key."""
    table = places.select(*_pick(places, CITY_COLUMNS)).filter(F.col("NameType") != "PROV")
    return table.withColumn("IRID", grid_key(F.col("Latitude"), F.col("Longitude")))


def select_stations(places: DataFrame, station_table: DataFrame, province: str, city: str) -> DataFrame:
    """Stations in a grid cell of a place whose name holds ``city``, in the province
    whose name holds ``province`` (the first by name and code when several do)."""
    code = F.col("`province.code`")
    provinces = places.filter(
        (F.col("`concise.code`") == "PROV") & F.col("name").ilike(f"%{province}%")
    ).select("name", code.alias("code"))
    wanted = places.filter((code == first_value(provinces, "code", "name")) & F.col("name").ilike(f"%{city}%"))
    cells = wanted.select(grid_key(F.col("latitude"), F.col("longitude")).alias("IRID"))
    return matched_only(station_table, cells, ["IRID"])


def fact(raw: DataFrame) -> DataFrame:
    """Daily readings under their short names, those without a maximum left out."""
    return complete_rows(rename(raw, FACT_COLUMNS), ["MaxTemp"])


def clean(fact_table: DataFrame) -> DataFrame:
    """The columns the answers need; days lacking a temperature are left out."""
    table = fact_table.select(
        "StationID", "ClimateID", "Year", "Month", "Day", "DateTime", "MaxTemp", "MinTemp", "MeanTemp",
        F.col("TotalPrecipmm").alias("TotalPrecip"),
        F.col("SnowonGrndcm").alias("TotalSnow"),
    )
    return complete_rows(table, ["MaxTemp", "MinTemp", "MeanTemp"])


def station_cities(station_table: DataFrame, city_table: DataFrame, *, dedupe: bool = False) -> DataFrame:
    """One row for each station and each place name in its grid cell."""
    places = city_table.select("IRID", "CityName", "Latitude", "Longitude")
    located = station_table.select("IRID", "Province", "Elevation", "StationName", "StationID", "ClimateID")
    return enrich(located, places, ["IRID"], dedupe=dedupe)


def denormalize(weather: DataFrame, located: DataFrame) -> DataFrame:
    """Readings with their station and place: a day counts once for each place name."""
    return enrich(weather.drop("StationID"), located, ["ClimateID"])


def daily_by_city(table: DataFrame) -> DataFrame:
    day = F.make_date(F.col("Year").cast("int"), F.col("Month").cast("int"), F.col("Day").cast("int"))
    return daily_mean(table, ["CityName"], day, F.col("MeanTemp"))


def days_like_last_year(table: DataFrame, year: int, within: float | None, *, faithful: bool = False) -> DataFrame:
    """Days of ``year`` whose mean is within a tolerance of last year's (or equal to it)."""
    compare = yoy_lag_faithful if faithful else yoy_lag
    return yoy_days(compare(daily_by_city(table), ["CityName"]), year, within, "Count")


def year_mean(table: DataFrame, year: int, value: str = "MeanTemp", column: str = "Year") -> DataFrame:
    """Rounded mean of a year; no row if the year is absent."""
    return _one_year(table, year, F.round(F.avg(value), 1).alias(value), column)


def year_max(table: DataFrame, year: int, value: str = "MaxTemp", column: str = "Year") -> DataFrame:
    return _one_year(table, year, F.max(value).alias(value), column)


def year_min(table: DataFrame, year: int, value: str = "MinTemp", column: str = "Year") -> DataFrame:
    return _one_year(table, year, F.min(value).alias(value), column)


def _one_year(table: DataFrame, year: int, answer: Column, column: str) -> DataFrame:
    return table.filter(F.col(column) == year).groupBy(column).agg(answer).drop(column)


def monthly_mean(table: DataFrame, year: int, value: str = "MeanTemp") -> DataFrame:
    """Rounded mean of each month of a year."""
    return (
        table.filter(F.col("Year") == year)
        .groupBy("Month")
        .agg(F.round(F.avg(value), 1).alias(value))
        .orderBy("Month")
    )


def input_years(year: int, count: int = 3) -> Sequence[int]:
    """The year asked for and those before it."""
    return list(range(year, year - count, -1))


def check(weather: DataFrame, station_table: DataFrame, places: DataFrame) -> DataFrame:
    """Rows, duplicates and nulls of the three tables."""
    return quality_report({"weather": weather, "stations": station_table, "geonames": places})
