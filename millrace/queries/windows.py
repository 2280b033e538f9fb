"""Year over year on daily means: region stands in for the city, shipped quantity for the temperature."""

from pyspark.sql import functions as F

from millrace.operators import windows as ops
from millrace.operators.relational import in_year
from millrace.plans import weather
from millrace.registry import query
from millrace.sources import files, sinks
from millrace.workspace import fresh_path

_DAILY = """
daily AS (
  SELECT r_name AS city, CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS mean
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL),
parts AS (
  SELECT city, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(day(date) AS INTEGER) AS day, date, mean FROM daily)
"""
_YOY = _DAILY + """,
lagged AS (
  SELECT *, lag(mean) OVER w AS lag, lag(year) OVER w AS y0 FROM parts
  WINDOW w AS (PARTITION BY city, month, day ORDER BY year)),
yoy AS (
  SELECT city, year, month, day, date, mean, lag, abs(lag - mean) AS delta
  FROM lagged WHERE y0 = year - 1)
"""
_FAITHFUL = _DAILY + """,
yoy AS (
  SELECT *, abs(lag - mean) AS delta FROM (
    SELECT *, lag(mean, 1, 0.0) OVER (
      ORDER BY CAST(month AS VARCHAR) || CAST(day AS VARCHAR), year, city, month, day) AS lag FROM parts))
"""
_SHOWN = "city, year, month, day, date, round(mean, 6) AS mean, round(lag, 6) AS lag, round(delta, 6) AS delta"


def daily_quantity(t, year=None):
    """Mean shipped quantity by region and day. The fact brings three columns and meets the
    dimensions one by one, so the size of each base table decides how it is joined. With
    ``year`` the scan reads that year and the one before only."""
    lines = t.lineitem.select("l_suppkey", "l_shipdate", "l_quantity")
    if year is not None:
        lines = lines.filter(in_year("l_shipdate", year - 1, year))
    joined = (
        lines.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region.select("r_regionkey", F.col("r_name").alias("city")), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return ops.daily_mean(joined, ["city"], F.col("l_shipdate"), F.col("l_quantity"))


def _shown(df):
    return df.select("city", "year", "month", "day", "date", *[F.round(c, 6).alias(c) for c in ("mean", "lag", "delta")])


@query("yoy_lag", f"WITH {_YOY} SELECT {_SHOWN} FROM yoy")
def yoy_lag(t):
    return _shown(ops.yoy_lag(daily_quantity(t), ["city"]))


@query("yoy_lag_faithful", f"WITH {_FAITHFUL} SELECT {_SHOWN} FROM yoy")
def yoy_lag_faithful(t):
    return _shown(ops.yoy_lag_faithful(daily_quantity(t), ["city"]))


@query("yoy_days_within", f"WITH {_YOY} SELECT count(DISTINCT date) AS days FROM yoy WHERE year = 1998 AND delta < 1")
def yoy_days_within(t):
    return ops.yoy_days(ops.yoy_lag(daily_quantity(t, 1998), ["city"]), 1998, 1)


@query("yoy_days_equal", f"WITH {_YOY} SELECT count(DISTINCT date) AS days FROM yoy WHERE year = 1998 AND delta = 0")
def yoy_days_equal(t):
    return ops.yoy_days(ops.yoy_lag(daily_quantity(t, 1998), ["city"]), 1998)


@query(
    "yoy_days_within_faithful",
    f"WITH {_FAITHFUL} SELECT count(DISTINCT date) AS days FROM yoy WHERE year = 1998 AND delta < 1",
)
def yoy_days_within_faithful(t):
    return ops.yoy_days(ops.yoy_lag_faithful(daily_quantity(t), ["city"]), 1998, 1)


@query(
    "yoy_days_equal_faithful",
    f"WITH {_FAITHFUL} SELECT count(DISTINCT date) AS days FROM yoy WHERE year = 1998 AND delta = 0",
)
def yoy_days_equal_faithful(t):
    return ops.yoy_days(ops.yoy_lag_faithful(daily_quantity(t), ["city"]), 1998)


def _weather_files(t):
    """The inputs of the weather job as files: suppliers are stations in their nation, shipped quantities the readings."""
    spark = t.spark
    grid = {"latitude": F.col("n_nationkey") * 0.5 + 40, "longitude": F.col("n_nationkey") * 1.0 - 100}
    nations = t.nation.withColumns(grid)
    places = {"name": F.col("n_name"), "category": F.lit("city"), "status.code": F.lit(1), "concise.code": F.lit("CITY"),
              "province.code": F.col("n_regionkey"), "decision": F.lit("1990-01-01")}
    stations = {"Name": F.col("s_name"), "Province": F.col("n_regionkey"), "Climate ID": F.col("s_suppkey"),
                "Station ID": F.col("s_suppkey"), "Latitude (Decimal Degrees)": F.col("latitude"),
                "Longitude (Decimal Degrees)": F.col("longitude"), "Elevation (m)": F.lit(10.0), "First Year": F.lit(1990),
                "Last Year": F.lit(2010)}
    day = F.col("l_shipdate")
    readings = {"Climate ID": F.col("l_suppkey"), "StationID": F.col("l_suppkey"), "Date/Time": F.to_date(day),
                "Year": F.year(day), "Month": F.month(day), "Day": F.dayofmonth(day), "Max Temp (°C)": F.col("l_quantity") + 1,
                "Min Temp (°C)": F.col("l_quantity") - 1, "Mean Temp (°C)": F.col("l_quantity")}
    empty = [F.lit(None).cast("string").alias(c) for c in weather.FACT_COLUMNS if c not in readings]
    located = t.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    tables = {
        "places": nations.select("latitude", "longitude", *[v.alias(k) for k, v in places.items()]),
        "stations": located.select(*[v.alias(k) for k, v in stations.items()]),
        "readings": t.lineitem.select(*[v.alias(k) for k, v in readings.items()], *empty),
    }
    out = []
    for name, table in tables.items():
        path = fresh_path(spark, f"weather-{name}")
        sinks.sink_csv(table, path)
        out.append(files.scan_csv(spark, path))
    return out


_CITY_YOY = _YOY.replace("r_name AS city", "n_name AS city").replace("\n       JOIN region ON n_regionkey = r_regionkey", "")


@query("weather_days_like_last_year", f'WITH {_CITY_YOY} SELECT count(DISTINCT date) AS "Count" FROM yoy WHERE year = 1998 AND delta < 1')
def weather_days_like_last_year(t):
    """The whole weather job: files, cleaning, stations and places by grid cell, the joined table, the yearly answer."""
    places, station_list, raw = _weather_files(t)
    located = weather.station_cities(weather.stations(station_list), weather.cities(places))
    table = weather.denormalize(weather.clean(weather.fact(raw)), located)
    return weather.days_like_last_year(table, 1998, 1.0)
