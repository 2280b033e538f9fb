"""The weather job on a small made-up province, with answers worked out in plain Python."""

import random
from datetime import date, timedelta

import pytest
from conftest import rows

from millrace.plans import weather


@pytest.fixture(scope="module")
def places(spark):
    schema = (
        "name string, category string, `status.code` string, `concise.code` string, `province.code` int, "
        "latitude double, longitude double, decision string"
    )
    data = [
        ("Ontario", "p", "off", "PROV", 35, 50.0, -86.0, "d"),
        ("Quebec", "p", "off", "PROV", 24, 53.0, -70.0, "d"),
        ("Toronto", "c", "off", "CITY", 35, 43.70, -79.42, "d"),
        ("East Toronto", "c", "off", "UNP", 35, 43.68, -79.38, "d"),
        ("Toronto", "c", "off", "CITY", 24, 46.0, -71.0, "d"),
        ("Ottawa", "c", "off", "CITY", 35, 45.52, -75.69, "d"),
    ]
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def raw_stations(spark):
    schema = (
        "`Name` string, `Province` string, `Climate ID` string, `Station ID` int, `Latitude (Decimal Degrees)` double, "
        "`Longitude (Decimal Degrees)` double, `Elevation (m)` double, `First Year` int, `Last Year` int"
    )
    data = [
        ("TORONTO CITY", "ONTARIO", "615S001", 31688, 43.67, -79.40, 112.5, 2002, 2024),
        ("OTTAWA CDA", "ONTARIO", "6105976", 4333, 45.38, -75.72, 79.2, 1889, 2024),
        ("QUEBEC X", "QUEBEC", "7000001", 1, 46.01, -71.03, 10.0, 1900, 2024),
    ]
    return spark.createDataFrame(data, schema)


def readings(start, days, seed):
    rng = random.Random(seed)
    for i in range(days):
        day = start + timedelta(i)
        mean = float(rng.randint(-3, 3))
        yield day, mean


@pytest.fixture(scope="module")
def facts(spark):
    schema = (
        "StationID int, `Climate ID` string, `Date/Time` string, Year int, Month int, Day int, `Max Temp (°C)` double, "
        "`Min Temp (°C)` double, `Mean Temp (°C)` double, `Total Precip (mm)` double, `Snow on Grnd (cm)` double"
    )
    data = []
    for station, climate, seed in ((31688, "615S001", 1), (4333, "6105976", 2)):
        for day, mean in readings(date(2019, 12, 1), 800, seed):
            data.append((station, climate, day.isoformat(), day.year, day.month, day.day, mean + 5, mean - 5, mean, 0.0, None))
    data.append((31688, "615S001", "2022-03-01", 2022, 3, 1, None, 1.0, 1.0, None, None))
    data.append((31688, "615S001", "2022-03-02", 2022, 3, 2, 4.0, None, 1.0, None, None))
    return spark.createDataFrame(data, schema)


def test_select_stations(places, raw_stations):
    table = weather.stations(raw_stations)
    found = weather.select_stations(places, table, "ontario", "toronto")
    assert rows(found.select("StationID", "IRID")) == [(31688, "43Z7X79Z4")]
    assert weather.select_stations(places, table, "quebec", "toronto").first()["StationID"] == 1
    assert weather.select_stations(places, table, "atlantis", "toronto").count() == 0


@pytest.fixture(scope="module")
def table(places, raw_stations, facts):
    located = weather.station_cities(weather.stations(raw_stations), weather.cities(places))
    return weather.denormalize(weather.clean(weather.fact(facts)), located)


def test_staging_keeps_each_place_name(table, facts):
    assert weather.fact(facts).count() == 1601  # one day lacks a maximum
    names = {r["CityName"]: r["count"] for r in table.groupBy("CityName").count().collect()}
    assert names == {"Toronto": 800, "East Toronto": 800}  # no place lies in Ottawa's cell
    assert {"Province", "IRID", "StationName", "StationID", "TotalPrecip", "TotalSnow"} <= set(table.columns)


def expected_daily():
    return {(city, day): mean for city in ("Toronto", "East Toronto") for day, mean in readings(date(2019, 12, 1), 800, 1)}


def test_days_like_last_year(table):
    daily = expected_daily()
    delta = {}
    for (city, day), mean in daily.items():
        if day.month == 2 and day.day == 29:
            continue
        before = daily.get((city, day.replace(year=day.year - 1)))
        if before is not None:
            delta[city, day] = abs(before - mean)
    within = len({d for (_, d), x in delta.items() if d.year == 2021 and x < 2})
    equal = len({d for (_, d), x in delta.items() if d.year == 2021 and x == 0})
    assert within > equal > 0
    assert weather.days_like_last_year(table, 2021, 2).first()["Count"] == within
    assert weather.days_like_last_year(table, 2021, None).first()["Count"] == equal


def test_faithful_days(table):
    """LAG over one order of the text month||day, then year, city, month and day."""
    ordered = sorted(
        ((f"{d.month}{d.day}", d.year, city, d.month, d.day), d, mean) for (city, d), mean in expected_daily().items()
    )
    close = set()
    previous = 0.0
    for _, day, mean in ordered:
        if day.year == 2020 and abs(previous - mean) < 1:
            close.add(day)
        previous = mean
    assert weather.days_like_last_year(table, 2020, 1, faithful=True).first()["Count"] == len(close)


def test_year_answers(table):
    values = [m for (c, d), m in expected_daily().items() if d.year == 2020]
    assert weather.year_mean(table, 2020).first()[0] == round(sum(values) / len(values), 1)
    assert weather.year_max(table, 2020).first()[0] == 8.0
    assert weather.year_min(table, 2020).first()[0] == -8.0
    assert weather.year_mean(table, 1999).count() == 0
    months = weather.monthly_mean(table, 2020).collect()
    assert [r["Month"] for r in months] == list(range(1, 13))
    assert weather.input_years(2021) == [2021, 2020, 2019]


def test_check(table, places, raw_stations):
    report = weather.check(table, raw_stations, places)
    found = {(r["table"], r["check"], r["column"]): r["value"] for r in report.collect()}
    assert found["weather", "rows", ""] == 1600
    assert found["weather", "nulls", "TotalSnow"] == 1600
    assert found["geonames", "duplicates", ""] == 0
