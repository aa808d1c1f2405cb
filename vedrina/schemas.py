"""Column contracts of the messages and tables."""

from __future__ import annotations

# Messages that arrive flat, as (path in the message, column, type).
FLAT_MESSAGE = [
    ("grad", "grad", "string"),
    ("region", "region", "string"),
    ("drzava", "drzava", "string"),
    ("temperatura", "temperatura", "double"),
    ("osecaj", "osecaj", "double"),
    ("vlaznost", "vlaznost", "int"),
    ("stanje", "stanje", "string"),
    ("lokalno_vreme", "lokalno_vreme", "timestamp_ntz"),
    ("datum", "datum", "date"),
]

# Messages that arrive nested. The date is taken from the local time.
NESTED_MESSAGE = [
    ("location.name", "grad", "string"),
    ("location.region", "region", "string"),
    ("location.country", "drzava", "string"),
    ("current.temp_c", "temperatura", "double"),
    ("current.feelslike_c", "osecaj", "double"),
    ("current.humidity", "vlaznost", "int"),
    ("current.condition.text", "stanje", "string"),
    ("location.localtime", "lokalno_vreme", "timestamp_ntz"),
]

# The tables filled by the append stream and by the upsert stream.
OBSERVATIONS = (
    "grad string, region string, drzava string, temperatura double, osecaj double, "
    "vlaznost int, stanje string, lokalno_vreme timestamp_ntz, datum date"
)
OBSERVATION_KEYS = ["grad", "datum"]

# The report table: the hottest and the coldest city per date and country.
EXTREMES = (
    "datum date, drzava string, "
    "najtopliji_grad string, max_temperatura double, stanje_najtoplijeg string, "
    "najhladniji_grad string, min_temperatura double, stanje_najhladnijeg string"
)
EXTREMES_KEYS = ["datum", "drzava"]
# As stored, with the month that names the directory: a date has a few rows only.
REPORT_MONTH = "mesec"
REPORT_STORED = f"{EXTREMES}, {REPORT_MONTH} date"
REPORT_KEYS = [REPORT_MONTH, *EXTREMES_KEYS]

# The report as a table that goes on from what it has: per group the row at each extreme, ready to be compared with others.
_PICK = "by0: string, by1: timestamp_ntz, by2: string"
REPORT_STATE = (
    f"datum date, drzava string, top struct<not_nan: boolean, reversed: double, {_PICK}>, bottom struct<value: double, {_PICK}>, "
    f"n bigint, {REPORT_MONTH} date"
)

# The wide observation table. The id is a digest of the natural key (see sinks.ddl),
# so a retried job gives a row the same id again.
WIDE_TABLE = [
    ("id", "varchar(64)"),
    ("city", "varchar(100)"),
    ("region", "varchar(100)"),
    ("country", "varchar(100)"),
    ("lat", "decimal(10,4)"),
    ("lon", "decimal(10,4)"),
    ("tz_id", "varchar(100)"),
    ("local_time", "timestamp_ntz"),
    ("localtime_epoch", "bigint"),
    ("last_updated", "timestamp_ntz"),
    ("last_updated_epoch", "bigint"),
    ("temp_c", "decimal(5,2)"),
    ("temp_f", "decimal(5,2)"),
    ("is_day", "int"),
    ("condition_text", "varchar(100)"),
    ("condition_icon", "varchar(255)"),
    ("condition_code", "int"),
    ("wind_mph", "decimal(5,2)"),
    ("wind_kph", "decimal(5,2)"),
    ("wind_degree", "int"),
    ("wind_dir", "varchar(10)"),
    ("pressure_mb", "decimal(7,2)"),
    ("pressure_in", "decimal(7,2)"),
    ("precip_mm", "decimal(5,2)"),
    ("precip_in", "decimal(5,2)"),
    ("humidity", "int"),
    ("cloud", "int"),
    ("feelslike_c", "decimal(5,2)"),
    ("feelslike_f", "decimal(5,2)"),
    ("windchill_c", "decimal(5,2)"),
    ("windchill_f", "decimal(5,2)"),
    ("heatindex_c", "decimal(5,2)"),
    ("heatindex_f", "decimal(5,2)"),
    ("dewpoint_c", "decimal(5,2)"),
    ("dewpoint_f", "decimal(5,2)"),
    ("vis_km", "decimal(5,2)"),
    ("vis_miles", "decimal(5,2)"),
    ("uv", "decimal(5,2)"),
    ("gust_mph", "decimal(5,2)"),
    ("gust_kph", "decimal(5,2)"),
]
WIDE_NATURAL_KEY = ["city", "last_updated_epoch"]
# As stored, with the first day of the period that names the directory.
WIDE_PERIOD = "period"
WIDE_STORED = ", ".join(
    f"{name} {'string' if kind.startswith('varchar') else kind}" for name, kind in [*WIDE_TABLE, (WIDE_PERIOD, "date")]
)

# Countries the daily report covers.
REPORT_COUNTRIES = ["Srbija", "Hrvatska", "BiH", "Severna Makedonija"]

# Condition texts and their translation.
CONDITION_WORDS = {
    "Sunny": "Sunčano",
    "Clear": "Vedro",
    "Partly cloudy": "Delimično oblačno",
    "Cloudy": "Oblačno",
    "Overcast": "Tmurno",
    "Mist": "Izmaglica",
    "Patchy rain possible": "Moguća mestimična kiša",
    "Light rain": "Slaba kiša",
}

# Country names as the city lists write them, and as the report filter expects them.
COUNTRY_WORDS = {
    "Serbia": "Srbija",
    "Serbia RS": "Srbija",
    "Serbia East": "Srbija",
    "Croatia": "Hrvatska",
    "Bosnia and Herzegovina": "BiH",
    "North Macedonia": "Severna Makedonija",
}
