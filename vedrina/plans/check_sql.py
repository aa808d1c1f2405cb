"""The check queries in plain SQL over the same tables."""

from __future__ import annotations

from vedrina.functions.text import ACCENTED, PLAIN
from vedrina.plans.checks import ARRAYS_GO_ON, COUNTRIES, EVENT_CONDITIONS, REPORT_DATES, WIDE_SOURCES
from vedrina.schemas import CONDITION_WORDS, WIDE_TABLE


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _case(column: str, words: dict[str, str]) -> str:
    arms = " ".join(f"WHEN {column} = {_quoted(word)} THEN {_quoted(to)}" for word, to in words.items())
    return f"CASE {arms} ELSE {column} END"


IN_COUNTRIES = f"drzava IN ({', '.join(_quoted(country) for country in COUNTRIES)})"

CITIES = """cities AS (
  SELECT c_custkey, c_name AS grad, r_name AS region, n_name AS drzava, c_acctbal AS osecaj
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

OBS = f"""{CITIES}, obs AS (
  SELECT event_id, grad, region, drzava, value AS temperatura, osecaj,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS vlaznost,
         event_type AS stanje, ts AS lokalno_vreme, CAST(ts AS DATE) AS datum
  FROM events JOIN cities ON user_id = c_custkey
)"""

ITEMS = """obs AS (
  SELECT CAST(l_shipdate AS DATE) AS datum, l_returnflag AS drzava, CAST(l_suppkey AS VARCHAR) AS grad,
         l_extendedprice AS temperatura, l_linestatus AS stanje, l_shipdate AS lokalno_vreme
  FROM lineitem
)"""

OBS_COLUMNS = "grad, region, drzava, temperatura, osecaj, vlaznost, stanje, lokalno_vreme, datum"


def _picks(source: str, where: str = "true", prefix: str = "", measure: str = "temperatura") -> str:
    """The hottest and coldest row of every group, as the tables hot and cold."""
    return f"""{prefix}hot AS (
  SELECT datum, drzava, grad AS najtopliji_grad, value AS max_temperatura, stanje AS stanje_najtoplijeg
  FROM (SELECT *, {measure} AS value, row_number() OVER (PARTITION BY datum, drzava
          ORDER BY {measure} DESC, grad, lokalno_vreme, stanje) AS n FROM {source} WHERE {where})
  WHERE n = 1
), {prefix}cold AS (
  SELECT datum, drzava, grad AS najhladniji_grad, value AS min_temperatura, stanje AS stanje_najhladnijeg
  FROM (SELECT *, {measure} AS value, row_number() OVER (PARTITION BY datum, drzava
          ORDER BY {measure}, grad, lokalno_vreme, stanje) AS n FROM {source} WHERE {where})
  WHERE n = 1
)"""


EXTREMES = f"WITH {OBS}, {_picks('obs', IN_COUNTRIES)} SELECT * FROM hot JOIN cold USING (datum, drzava)"
ITEM_EXTREMES = f"WITH {ITEMS}, {_picks('obs')} SELECT * FROM hot JOIN cold USING (datum, drzava)"
PARSED = f"WITH {OBS} SELECT event_id, {OBS_COLUMNS} FROM obs"
APPENDED = f"WITH {OBS} SELECT {OBS_COLUMNS} FROM obs"
# Rows of one city and time are decided by their content.
LANDED = f"""WITH {OBS} SELECT {OBS_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY grad, datum ORDER BY lokalno_vreme DESC, region DESC, drzava DESC,
    temperatura DESC, osecaj DESC, vlaznost DESC, stanje DESC) AS n FROM obs)
WHERE n = 1"""
BY_TIME = f"""WITH {OBS}, late AS (
  SELECT event_id, grad, region, drzava, -temperatura AS temperatura, osecaj, vlaznost, stanje,
         lokalno_vreme - INTERVAL 1 HOUR AS lokalno_vreme,
         CAST(lokalno_vreme - INTERVAL 1 HOUR AS DATE) AS datum
  FROM obs)
SELECT {OBS_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY grad, datum ORDER BY lokalno_vreme DESC, batch DESC, event_id DESC) AS n
  FROM (SELECT event_id, {OBS_COLUMNS}, 0 AS batch FROM obs
        UNION ALL SELECT event_id, {OBS_COLUMNS}, 1 AS batch FROM late))
WHERE n = 1"""
LINES = """SELECT doc_id, CAST(n - 1 AS INTEGER) AS {number}, parts[n] AS line
FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS n
      FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"""

EPOCH_SECONDS = "epoch_us(l_shipdate) // 1000000"
WIDE_SQL = {
    **WIDE_SOURCES,
    "localtime_epoch": f"CASE WHEN l_linenumber = 3 THEN 65 WHEN l_linenumber NOT IN (2, 6) THEN {EPOCH_SECONDS} END",
    "last_updated_epoch": EPOCH_SECONDS,
    "cloud": "CASE WHEN l_linenumber IN (4, 7) THEN 65 WHEN l_linenumber NOT IN (5, 6) THEN l_linenumber END",
}
WIDE_MISFITS = """concat_ws(',',
  CASE WHEN l_linenumber IN (2, 6) THEN 'localtime_epoch' END,
  CASE WHEN length(r_name) > 10 THEN 'wind_dir' END,
  CASE WHEN TRY_CAST(l_extendedprice AS DECIMAL(7,2)) IS NULL THEN 'pressure_mb' END,
  CASE WHEN TRY_CAST(l_extendedprice AS DECIMAL(5,2)) IS NULL THEN 'precip_mm' END,
  CASE WHEN l_linenumber IN (5, 6) THEN 'cloud' END)"""
WIDE_FROM = """FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _wide_columns() -> str:
    columns = []
    for name, data_type in WIDE_TABLE:
        if name == "id":
            continue
        source = WIDE_SQL[name]
        sql_type = "TIMESTAMP" if data_type == "timestamp_ntz" else data_type
        if data_type.startswith("varchar"):
            size = data_type[len("varchar(") : -1]
            columns.append(f"CASE WHEN length({source}) <= {size} THEN {source} END AS {name}")
        else:
            columns.append(f"TRY_CAST({source} AS {sql_type}) AS {name}")
    return ", ".join(columns)


NO_ARRAY = f"(lang IN ('fr', 'es') OR source IN ({', '.join(map(_quoted, ARRAYS_GO_ON))}))"
URL = "'^(https?)://([^/]+)/([a-z]+)/([0-9]+)'"


def _group(number: int) -> str:
    return f"CASE WHEN regexp_matches(url, {URL}) THEN regexp_extract(url, {URL}, {number}) END"


def _groups(*names: str) -> str:
    return ", ".join(f"{_group(number)} AS {name}" for number, name in enumerate(names, 1))


ORACLE_SQL = {
    "extremes": EXTREMES,
    "extremes_joined": EXTREMES,
    "extremes_one_pass": ITEM_EXTREMES,
    "extremes_two_pass": ITEM_EXTREMES,
    "hottest": f"WITH {OBS}, {_picks('obs')} SELECT * FROM hot",
    "coldest": f"WITH {OBS}, {_picks('obs')} SELECT * FROM cold",
    "extreme_ties": """SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_quantity,
  high = 1 AS is_highest, low = 1 AS is_lowest
FROM (SELECT *, rank() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_quantity DESC) AS high,
             rank() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_quantity) AS low FROM lineitem)
WHERE high = 1 OR low = 1""",
    "agg_join_back": """SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_quantity, max_value, min_value
FROM lineitem JOIN (
  SELECT l_returnflag, l_linestatus, max(l_quantity) AS max_value, min(l_quantity) AS min_value
  FROM lineitem GROUP BY ALL) USING (l_returnflag, l_linestatus)""",
    "filter_isin": f"WITH {OBS} SELECT event_id, grad, drzava, temperatura FROM obs WHERE {IN_COUNTRIES}",
    "parse_flat": PARSED,
    "parse_nested": PARSED,
    "json_path": """SELECT event_id, json_extract_string(props, '$.k') AS k,
  json_extract_string(props, '$.a.b') AS missing FROM events""",
    "json_paths": f"""WITH {OBS}, whole AS (SELECT *, stanje NOT IN ('click', 'view') AS ok FROM obs)
SELECT event_id, {', '.join(f"CASE WHEN ok THEN {name} END AS {name}" for name in ('grad', 'region', 'drzava', 'lokalno_vreme', 'temperatura', 'osecaj', 'stanje'))},
  CASE WHEN ok AND stanje <> 'purchase' THEN vlaznost END AS vlaznost, CASE WHEN ok THEN CAST(vlaznost AS BIGINT) END AS k,
  CAST(NULL AS BIGINT) AS missing, ok AS readable,
  CASE WHEN NOT ok THEN 'message' WHEN stanje = 'purchase' THEN 'vlaznost' ELSE '' END AS problems,
  NOT ok OR stanje = 'purchase' AS raw FROM whole""",
    "json_elements": f"""SELECT doc_id, element_no, line, CAST(length(line) AS INTEGER) AS n FROM ({LINES.format(number="element_no")})""",
    "split_json": f"""WITH lines AS ({LINES.format(number="element_no")}), spoiled AS (
  SELECT doc_id, source = 'src3' AS no_number FROM documents WHERE NOT {NO_ARRAY}
), rows AS (
  SELECT doc_id, element_no, line, CASE WHEN NOT (no_number AND element_no = 0) THEN element_no END AS n
  FROM lines JOIN spoiled USING (doc_id))
SELECT *, '' AS problems, false AS aside FROM rows
UNION ALL SELECT *, 'n' AS problems, true AS aside FROM rows WHERE n IS NULL
UNION ALL SELECT doc_id, NULL, NULL, NULL, 'message', true FROM documents WHERE {NO_ARRAY}""",
    "file_lines": LINES.format(number="line_no"),
    "split_lines": LINES.format(number="line_no"),
    "temporal": """SELECT event_id, date_trunc('minute', ts) AS lokalno_vreme, CAST(ts AS DATE) AS datum,
  CAST(ts AS DATE) AS datum_vremena FROM events""",
    "epoch": """SELECT event_id, epoch_us(ts) // 1000000 AS epoch, date_trunc('second', ts) AS time
FROM events""",
    "auto_time": """SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('millisecond', ts)
  WHEN 'view' THEN ts - INTERVAL 2 HOUR WHEN 'purchase' THEN ts - INTERVAL 330 MINUTE
  WHEN 'error' THEN NULL ELSE ts END AS time FROM events""",
    "translate": f"""SELECT event_id, condition, {_case('condition', CONDITION_WORDS)} AS stanje
FROM (SELECT event_id, {_case('event_type', EVENT_CONDITIONS)} AS condition FROM events)""",
    "translate_join": """SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS grad
FROM orders LEFT JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 5000) ON o_custkey = c_custkey""",
    "extract_text": f"""SELECT page_id, {_groups('scheme', 'host', 'lang', 'item')}, 'pages' AS source,
  upper({_group(2)}) AS host_upper
FROM pages""",
    "enrich_cities": f"""WITH {OBS}, latest AS (
  SELECT grad, drzava, temperatura, stanje, lokalno_vreme, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY grad, drzava ORDER BY lokalno_vreme DESC, event_id DESC) AS n FROM obs)
  WHERE n = 1)
SELECT grad, drzava, latest.temperatura, latest.stanje, latest.lokalno_vreme
FROM cities LEFT JOIN latest USING (grad, drzava)""",
    "enrich_as_of": f"""WITH {OBS}, replies AS (
  SELECT drzava, lokalno_vreme, max(event_id) AS reply_id, arg_max(temperatura, event_id) AS reply
  FROM obs WHERE stanje = 'signup' GROUP BY drzava, lokalno_vreme)
SELECT event_id, obs.drzava, obs.lokalno_vreme, temperatura, reply_id, reply
FROM obs ASOF LEFT JOIN replies ON obs.drzava = replies.drzava AND obs.lokalno_vreme >= replies.lokalno_vreme""",
    "city_dedup": f"""SELECT city_key, country, city, CAST(sum(n) OVER w AS BIGINT) AS listed FROM (
  SELECT city, country, translate(city, '{ACCENTED}', '{PLAIN}') AS city_key, count(*) AS n FROM (
    SELECT city, CASE WHEN country = 'en' THEN 'English' ELSE country END AS country
    FROM (SELECT unnest(string_split(text, ' ')) AS city, lang AS country FROM documents
          UNION ALL SELECT unnest(string_split(text, ' ')) AS city, role AS country FROM conversations))
  GROUP BY city, country)
WINDOW w AS (PARTITION BY city_key, country)
QUALIFY row_number() OVER (PARTITION BY city_key, country ORDER BY n DESC, city) = 1""",
    "city_spellings": """WITH RECURSIVE names AS (
  SELECT n_name AS country, CASE WHEN o_orderpriority = '1-URGENT' THEN replace(c_name, 'Customer', 'Custmer') ELSE c_name END AS city, count(*) AS listed
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
), links AS (
  SELECT a.country, a.city AS a, b.city AS b FROM names a JOIN names b
  ON a.country = b.country AND a.city <> b.city AND abs(length(a.city) - length(b.city)) <= 1 AND levenshtein(a.city, b.city) = 1
), reached(country, city, root) AS (
  SELECT country, city, city FROM names
  UNION SELECT links.country, links.b, root FROM reached JOIN links ON reached.country = links.country AND reached.city = links.a
), grouped AS (SELECT country, city, min(root) AS root FROM reached GROUP BY country, city)
SELECT country, first(city ORDER BY listed DESC, city) AS city, CAST(sum(listed) AS BIGINT) AS listed, count(*) AS spellings
FROM grouped JOIN names USING (country, city) GROUP BY country, root""",
    "quarantine": f"""WITH {OBS} SELECT event_id,
  CASE WHEN stanje IN ('click', 'error') THEN 'message' WHEN stanje = 'purchase' THEN 'vlaznost'
       WHEN stanje = 'view' THEN 'temperatura,lokalno_vreme' ELSE '' END AS problems,
  stanje NOT IN ('click', 'error') AS readable,
  stanje <> 'signup' AS kept_raw,
  CASE WHEN stanje IN ('purchase', 'signup') THEN temperatura END AS temperatura,
  CASE WHEN stanje IN ('view', 'signup') THEN CAST(vlaznost AS VARCHAR) END AS vlaznost,
  CASE WHEN stanje IN ('purchase', 'signup') THEN lokalno_vreme END AS lokalno_vreme
FROM obs""",
    "stream_counts": f"""WITH {OBS}
SELECT 'append' AS name, count(*) AS messages, count(*) FILTER (stanje <> 'click') AS accepted,
  count(*) FILTER (stanje = 'purchase') AS misfits, count(*) FILTER (stanje = 'click') AS unreadable, CAST(0 AS BIGINT) AS keyless FROM obs
UNION ALL
SELECT 'upsert', count(*), count(*) FILTER (stanje NOT IN ('click', 'view')), count(*) FILTER (stanje = 'purchase'),
  count(*) FILTER (stanje = 'click'), count(*) FILTER (stanje = 'view') FROM obs""",
    "replayed": f"""WITH {OBS} SELECT CASE WHEN stanje <> 'view' THEN grad END AS grad, region, drzava, temperatura, osecaj,
  CASE WHEN stanje <> 'purchase' THEN vlaznost END AS vlaznost, stanje, lokalno_vreme, datum FROM obs""",
    "conform_wide": f"SELECT {_wide_columns()} {WIDE_FROM}",
    "conform_misfits": f"""SELECT * FROM (SELECT l_orderkey, l_linenumber, {WIDE_MISFITS} AS misfits
{WIDE_FROM}) WHERE misfits <> ''""",
    "wide_table": f"""WITH items AS (
  SELECT s_name, n_name, l_returnflag, {EPOCH_SECONDS} AS seconds, l_linenumber = 6 AND l_returnflag = 'R' AS cut,
         l_linenumber = 7 AS keyless, {WIDE_MISFITS} <> '' AS misfit
  {WIDE_FROM}), stored AS (SELECT DISTINCT s_name, n_name, seconds FROM items WHERE NOT cut AND NOT keyless)
SELECT n_name AS name, count(*) AS n_rows, count(*) AS n_ids FROM stored GROUP BY n_name
UNION ALL
SELECT run AS name, count(*) FILTER (run = '0' OR l_returnflag = 'A') AS n_rows, 0 AS n_ids
FROM items, (VALUES ('0'), ('1')) AS runs(run) WHERE cut OR keyless OR misfit GROUP BY run""",
    "report_job": f"""WITH {ITEMS}, again AS (
  SELECT * REPLACE (-temperatura AS temperatura) FROM obs WHERE datum BETWEEN '{REPORT_DATES[0]}' AND '{REPORT_DATES[1]}'
), {_picks('obs')}, {_picks('again', prefix='new_')}
SELECT * FROM new_hot JOIN new_cold USING (datum, drzava)
UNION ALL
SELECT * FROM hot JOIN cold USING (datum, drzava) WHERE datum NOT BETWEEN '{REPORT_DATES[0]}' AND '{REPORT_DATES[1]}'""",
    "report_running": f"""WITH {ITEMS}, {_picks('obs')}, counted AS (SELECT datum, drzava, count(*) AS n FROM obs GROUP BY ALL)
SELECT * FROM hot JOIN cold USING (datum, drzava) JOIN counted USING (datum, drzava)""",
    "upsert_batch": f"""WITH {OBS}, {_picks('obs')},
{_picks('obs', IN_COUNTRIES, 'new_', 'CAST(vlaznost AS DOUBLE)')}
SELECT * FROM new_hot JOIN new_cold USING (datum, drzava)
UNION ALL
SELECT * FROM hot JOIN cold USING (datum, drzava) WHERE NOT {IN_COUNTRIES}""",
    "upsert_by_time": BY_TIME,
    "upsert_by_file": BY_TIME,
    "append_stream": APPENDED,
    "append_compacted": APPENDED,
    "append_redelivered": APPENDED,
    "upsert_stream": f"""WITH {OBS} SELECT {OBS_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY grad, datum ORDER BY lokalno_vreme DESC, event_id DESC) AS n FROM obs)
WHERE n = 1""",
    "landing_roundtrip": APPENDED,
    "landing_quarantine": f"""WITH {OBS} SELECT
  {', '.join(f"CASE WHEN stanje <> 'click' THEN {name} END AS {name}" for name in ('grad', 'region', 'drzava', 'temperatura', 'osecaj'))},
  CASE WHEN stanje NOT IN ('click', 'error') THEN vlaznost END AS vlaznost, nullif(stanje, 'click') AS stanje,
  CASE WHEN stanje = 'view' THEN date_trunc('minute', lokalno_vreme) WHEN stanje <> 'click' THEN lokalno_vreme END AS lokalno_vreme,
  datum, stanje <> 'click' AS readable,
  CASE stanje WHEN 'click' THEN 'message' WHEN 'error' THEN 'vlaznost' ELSE '' END AS problems
FROM obs""",
    "landing_table": LANDED,
    "landing_new": LANDED,
    "spec_ingest": f"""WITH {OBS}, made AS (
  SELECT CASE stanje WHEN 'click' THEN date_trunc('millisecond', lokalno_vreme) WHEN 'purchase' THEN lokalno_vreme - INTERVAL 2 HOUR
         WHEN 'signup' THEN lokalno_vreme - INTERVAL 330 MINUTE ELSE lokalno_vreme END AS made_at, grad, temperatura, stanje
  FROM obs WHERE stanje <> 'error')
SELECT made_at, grad AS station, CAST(temperatura AS VARCHAR) AS degrees, stanje AS kind, CAST(made_at AS DATE) AS day
FROM made""",
}
