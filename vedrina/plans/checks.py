"""One query per operator over the check tables. ``check_sql`` holds the SQL for the same results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vedrina.functions.json_fields import json_path
from vedrina.functions.text import translate_words
from vedrina.functions.times import auto_time, calendar_date, date_of, from_epoch, to_epoch, wall_time
from vedrina.operators import extremes as ex
from vedrina.operators.cities import consolidate_cities, enrich_as_of, enrich_cities
from vedrina.operators.conform import MISFITS, conform
from vedrina.operators.dictionary import check_dictionary, translate_with
from vedrina.operators.documents import explode_array, select_paths
from vedrina.operators.parsing import PROBLEMS, accepted, parse_flat, parse_nested
from vedrina.operators.rows import (
    extract_columns,
    in_countries,
    set_columns,
    split_json,
    split_json_rejected,
    split_lines,
)
from vedrina.operators.spellings import consolidate_spellings
from vedrina.plans.jobs import (
    append_job,
    daily_extremes_job,
    landing_job,
    read_report,
    read_running_report,
    read_wide,
    report_increment,
    wide_job,
)
from vedrina.plans.observations import (
    cities,
    envelope,
    event_stream,
    flat_text,
    line_items,
    nested_text,
    observations,
    table,
)
from vedrina.plans.replay import replay_job
from vedrina.schemas import CONDITION_WORDS, EXTREMES, EXTREMES_KEYS, OBSERVATION_KEYS, OBSERVATIONS, WIDE_TABLE
from vedrina.shared import new_path
from vedrina.sinks.append import append_batch, read_appended
from vedrina.sinks.compaction import compact
from vedrina.sinks.ddl import insert_rows, replace_table, with_row_id
from vedrina.sinks.landing import write_landing
from vedrina.sinks.merge import upsert
from vedrina.sinks.versions import read_version, upsert_files
from vedrina.sources.files import read_landing, read_landing_lines, read_lines
from vedrina.sources.ingestion_spec import IngestionSpec
from vedrina.sources.message_log import ARRIVAL
from vedrina.streaming.streams import append_stream, ingest, read_counts, upsert_stream

# The four countries of the report checks.
COUNTRIES = ["NATION_3", "NATION_7", "NATION_11", "NATION_19"]

# The dates of which the report is made anew.
REPORT_DATES = ("1995-02-01", "1995-04-30")

# Event types read as condition texts; two stay outside the condition dictionary.
EVENT_CONDITIONS = {"click": "Sunny", "view": "Partly cloudy", "purchase": "Light rain", "error": "Fog"}

# What follows the arrays of three sources; each of it, read as part of an object, would pass.
ARRAYS_GO_ON = {"src4": ',"z":1', "src5": "} junk", "src6": ',"items":[{"line":"e"}]'}

# A specification for messages made from the events.
EVENT_SPEC = {
    "type": "kafka",
    "spec": {
        "dataSource": "event_data",
        "parser": {
            "type": "json",
            "parseSpec": {
                "timestampSpec": {"column": "made_at", "format": "auto"},
                "dimensionsSpec": {"dimensions": ["station", "degrees", "kind"]},
                "columns": ["made_at", "station", "degrees", "kind"],
            },
        },
        "ioConfig": {
            "type": "kafka",
            "topic": "events",
            "consumerProperties": {"bootstrap.servers": "log:9092", "group.id": "events"},
        },
        "tuningConfig": {"type": "index", "maxRowsPerSegment": 30000, "maxTotalRows": 700000},
    },
}


def extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.daily_extremes(observations(spark, sf_dir), COUNTRIES)


def extremes_two_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.daily_extremes(line_items(spark, sf_dir), None, values_path=new_path(spark, "values"))


def extremes_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.daily_extremes(line_items(spark, sf_dir), None)


def extremes_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = in_countries(observations(spark, sf_dir), COUNTRIES)
    return ex.join_sides(ex.hottest(rows), ex.coldest(rows))


def hottest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.hottest(observations(spark, sf_dir))


def coldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.coldest(observations(spark, sf_dir))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_quantity"
    )


def extreme_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus"]
    return ex.extreme_ties(_items(spark, sf_dir), keys, "l_quantity", new_path(spark, "values"))


def agg_join_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus"]
    return ex.agg_join_back(_items(spark, sf_dir), keys, "l_quantity", new_path(spark, "values"))


def filter_isin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir).select("event_id", "grad", "drzava", "temperatura")
    return in_countries(rows, COUNTRIES)


def parse_flat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = envelope(observations(spark, sf_dir), flat_text())
    return accepted(parse_flat(messages, keep=["offset"])).withColumnRenamed("offset", "event_id")


def parse_nested_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = envelope(observations(spark, sf_dir), nested_text())
    return accepted(parse_nested(messages, keep=["offset"])).withColumnRenamed("offset", "event_id")


def json_path_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        json_path(F.col("props"), "$.k").alias("k"),
        json_path(F.col("props"), "$.a.b").alias("missing"),
    )


# Paths of a nested message, with their types.
MESSAGE_PATHS = [
    ("$.location.name", "grad", "string"), ("$.location.region", "region", "string"), ("$.location.country", "drzava", "string"),
    ("$.location.localtime", "lokalno_vreme", "timestamp_ntz"), ("$.current.temp_c", "temperatura", "double"),
    ("$.current.feelslike_c", "osecaj", "double"), ("$.current.humidity", "vlaznost", "int"), ("$.current.condition.text", "stanje", "string"),
    ("$.props[0].k", "k", "bigint"), ("$.props[1].k", "missing", "bigint"),
]


def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten paths of nested messages with an array, parsed once; some are cut, some go on, and some have a value that does not fit."""
    text = F.expr("concat(left(message, length(message) - 1), ',\"props\":[', props, ']}')")
    spoiled = (
        F.when(F.col("stanje") == "click", F.expr("left(text, length(text) - 1)"))
        .when(F.col("stanje") == "view", F.concat("text", F.lit(",{}")))
        .when(F.col("stanje") == "purchase", F.regexp_replace("text", r'"humidity":\d+', '"humidity":"many"'))
        .otherwise(F.col("text"))
    )
    rows = observations(spark, sf_dir).withColumn("message", nested_text())
    props = table(spark, sf_dir, "events").select(F.col("event_id").alias("own_id"), "props")
    rows = rows.join(props, F.col("event_id") == F.col("own_id")).withColumn("text", text)
    found = select_paths(rows.select("event_id", spoiled.alias("text")), "text", MESSAGE_PATHS, ["event_id"])
    return found.withColumn("problems", F.array_join(PROBLEMS, ",")).withColumn("raw", F.col("raw").isNotNull())


def json_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the documents, as an array inside a JSON text, each with its length."""
    lines = F.transform(F.split("text", "\n", -1), lambda line: F.struct(line.alias("line"), F.length(line).alias("n")))
    texts = table(spark, sf_dir, "documents").select("doc_id", F.to_json(F.struct(lines.alias("lines"))).alias("body"))
    return explode_array(texts, "body", "$.lines", [("$.line", "line", "string"), ("$.n", "n", "int")], ["doc_id"])


def split_json_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The lines of the documents as arrays: those of one language are cut short, those of another are no arrays, those of three
    # sources go on behind the array, and in those of one source the first number is none.
    no_number = F.col("source") == "src3"
    lines = F.transform(
        F.split("text", "\n", -1),
        lambda part, n: F.struct(part.alias("line"), F.when(no_number & (n == 0), F.lit("many")).otherwise(n.cast("string")).alias("n")),
    )
    body = F.to_json(lines)
    spoiled = F.when(F.col("lang") == "fr", F.expr("left(body, length(body) - 1)")).when(F.col("lang") == "es", F.lit("junk"))
    for source, rest in ARRAYS_GO_ON.items():
        spoiled = spoiled.when(F.col("source") == source, F.concat("body", F.lit(rest)))
    arrays = table(spark, sf_dir, "documents").withColumn("body", body)
    arrays = arrays.select("doc_id", F.coalesce(spoiled, "body").alias("body"))
    fields = [("line", "line", "string"), ("n", "n", "int")]
    rows = split_json(arrays, "body", fields).withColumn("problems", F.lit(""))
    aside = split_json_rejected(arrays, "body", fields).withColumn("problems", F.array_join(PROBLEMS, ","))
    return rows.withColumn("aside", F.lit(False)).unionByName(aside.drop("readable", "raw").withColumn("aside", F.lit(True)))


def file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the documents, written as text files and read again."""
    path = new_path(spark, "lines")
    lines = split_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines.select(F.concat_ws("|", "doc_id", "line_no", "line").alias("value")).write.text(path)
    pattern = r"^([0-9]+)\|([0-9]+)\|(.*)$"
    found = extract_columns(read_lines(spark, path), "value", pattern, ["doc_id", "line_no", "line"])
    return found.select(F.col("doc_id").cast("bigint"), F.col("line_no").cast("int"), "line")


def split_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Text to the minute, as the messages carry it.
    texts = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("string").substr(1, 16).alias("lokalno_vreme"),
        F.col("ts").cast("string").substr(1, 10).alias("datum"),
    )
    return texts.withColumns(
        {
            "lokalno_vreme": wall_time(F.col("lokalno_vreme")),
            "datum": calendar_date(F.col("datum")),
            "datum_vremena": date_of(wall_time(F.col("lokalno_vreme"))),
        }
    )


def epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = to_epoch(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", seconds.alias("epoch"), from_epoch(seconds).alias("time")
    )


def auto_time_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = F.expr("cast(timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts) AS string)")
    local = F.col("ts").cast("string")
    text = (
        F.when(F.col("event_type") == "click", millis)
        .when(F.col("event_type") == "view", F.concat(local, F.lit("+02")))
        .when(F.col("event_type") == "purchase", F.concat(local, F.lit(" Asia/Kolkata")))
        .when(F.col("event_type") == "error", F.concat(local, F.lit(" Nowhere/Land")))
        .otherwise(local)
    )
    return table(spark, sf_dir, "events").select("event_id", auto_time(text).alias("time"))


def translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    english = translate_words(F.col("event_type"), EVENT_CONDITIONS)
    return table(spark, sf_dir, "events").select(
        "event_id", english.alias("condition"), translate_words(english, CONDITION_WORDS).alias("stanje")
    )


def translate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every city that ordered, named through the table of customers; half of them are in it.
    words = table(spark, sf_dir, "customer").filter("c_acctbal > 5000")
    words = words.select(F.col("c_custkey").cast("string").alias("word"), F.col("c_name").alias("meaning"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("grad"))
    check_dictionary(words)
    return translate_with(orders, "grad", words)


def extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    parts = extract_columns(pages, "url", r"^(https?)://([^/]+)/([a-z]+)/([0-9]+)", ["scheme", "host", "lang", "item"])
    return set_columns(parts, source="pages", host_upper=F.upper("host")).drop("url")


def enrich_cities_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = observations(spark, sf_dir).select(
        "grad", "drzava", "temperatura", "stanje", "lokalno_vreme", "event_id"
    )
    places = cities(spark, sf_dir).select("grad", "drzava")
    return enrich_cities(places, replies, ["grad", "drzava"], ["lokalno_vreme", "event_id"]).drop("event_id")


def enrich_as_of_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each observation with the last one that its country signed up at that time."""
    rows = observations(spark, sf_dir).select("event_id", "drzava", "lokalno_vreme", "temperatura")
    replies = observations(spark, sf_dir).filter("stanje = 'signup'").select(
        "drzava", "lokalno_vreme", F.col("event_id").alias("reply_id"), F.col("temperatura").alias("reply")
    )
    return enrich_as_of(rows, replies, ["drzava"], "lokalno_vreme", ["reply_id", "reply"], ["reply_id"])


def city_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every word of every text is a place name; documents and conversations are two lists.
    def words(name: str, country: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.explode(F.split("text", " ", -1)).alias("city"), F.col(country).alias("country")
        )

    return consolidate_cities([words("documents", "lang"), words("conversations", "role")], {"en": "English"})


def city_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' names on their orders, by nation, one letter missing on urgent ones."""
    orders = table(spark, sf_dir, "orders").join(cities(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    name = F.when(F.col("o_orderpriority") == "1-URGENT", F.replace("grad", F.lit("Customer"), F.lit("Custmer"))).otherwise(F.col("grad"))
    return consolidate_spellings([orders.select(name.alias("city"), F.col("drzava").alias("country"))], {})


def _spoiled(rows: DataFrame) -> DataFrame:
    """Messages of which those of one kind are cut short and those of another have a field that does not fit."""
    text = F.col("message")
    spoiled = (
        F.when(F.col("stanje") == "click", F.expr("left(message, length(message) - 1)"))
        .when(F.col("stanje") == "purchase", F.regexp_replace(text, r'"vlaznost":\d+', '"vlaznost":3000000000'))
        .when(F.col("stanje") == "view", F.regexp_replace(text, r'"grad":"[^"]*",', ""))
        .otherwise(text)
    )
    return envelope(rows.withColumn("message", flat_text()), spoiled)


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the append and the upsert stream count in a batch of which a part is spoiled or lacks its key."""
    rows = observations(spark, sf_dir, event_stream(spark, sf_dir))
    found = []
    for name, start in (("append", append_stream), ("upsert", upsert_stream)):
        target, checkpoint, aside, counts = (new_path(spark, f"counted-{part}") for part in ("rows", "checkpoint", "aside", "counts"))
        start(parse_flat(_spoiled(rows), keep=ARRIVAL), target, checkpoint, aside, counts=counts).awaitTermination()
        sums = read_counts(spark, counts).agg(*[F.sum(column).alias(column) for column in ("messages", "accepted", "misfits", "unreadable", "keyless")])
        found.append(sums.withColumn("name", F.lit(name)))
    return found[0].unionByName(found[1])


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut messages, set aside by the append stream, repaired and replayed twice."""
    rows = observations(spark, sf_dir, event_stream(spark, sf_dir))
    target, checkpoint, aside = (new_path(spark, f"replay-{part}") for part in ("rows", "checkpoint", "aside"))
    append_stream(parse_flat(_spoiled(rows)), target, checkpoint, aside).awaitTermination()
    for _ in range(2):
        replay_job(spark, aside, target, lambda text: F.concat(text, F.lit("}")))
    return read_appended(spark, target, OBSERVATIONS)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Messages spoiled by kind: cut short, a number out of range, two unreadable fields, and, by the order of arrival, an array,
    # a message of the other shape, one without any field.
    text = flat_text()
    spoiled = (
        F.when(F.col("stanje") == "click", F.expr("left(message, length(message) - 1)"))
        .when(F.col("stanje") == "purchase", F.regexp_replace("message", r'"vlaznost":\d+', '"vlaznost":3000000000'))
        .when(
            F.col("stanje") == "view",
            F.regexp_replace(
                F.regexp_replace("message", r'"temperatura":[0-9.]+', '"temperatura":"warm"'),
                r'"lokalno_vreme":"[^"]+"',
                '"lokalno_vreme":"junk"',
            ),
        )
        .when(
            F.col("stanje") == "error",
            F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("["), "message", F.lit("]")))
            .when(F.col("event_id") % 3 == 1, nested_text())
            .otherwise(F.lit("{}")),
        )
        .otherwise(F.col("message"))
    )
    rows = observations(spark, sf_dir).withColumn("message", text)
    parsed = parse_flat(envelope(rows, spoiled), keep=["offset"])
    return parsed.select(
        F.col("offset").alias("event_id"),
        F.array_join(PROBLEMS, ",").alias("problems"),
        "readable",
        F.col("raw").isNotNull().alias("kept_raw"),
        "temperatura",
        F.col("vlaznost").cast("string").alias("vlaznost"),
        "lokalno_vreme",
    )


# The wide table's columns and the check columns that fill them: line items, with their supplier, its
# nation and region. Some regions are too long for wind_dir, and most prices too large for precip_mm.
WIDE_SOURCES = {
    "city": "s_name",
    "region": "r_name",
    "country": "n_name",
    "lat": "s_acctbal",
    "lon": "l_tax",
    "tz_id": "l_linestatus",
    "local_time": "l_shipdate",
    "last_updated": "l_shipdate",
    "temp_c": "l_quantity",
    "temp_f": "l_discount",
    "is_day": "l_linenumber",
    "condition_text": "l_returnflag",
    "condition_icon": "s_name",
    "condition_code": "l_partkey",
    "wind_mph": "l_discount",
    "wind_kph": "l_tax",
    "wind_degree": "l_linenumber",
    "wind_dir": "r_name",
    "pressure_mb": "l_extendedprice",
    "pressure_in": "l_quantity",
    "precip_mm": "l_extendedprice",
    "precip_in": "l_discount",
    "humidity": "l_quantity",
    "cloud": "l_linenumber",
    "feelslike_c": "l_quantity",
    "feelslike_f": "l_tax",
    "windchill_c": "l_discount",
    "windchill_f": "l_tax",
    "heatindex_c": "l_quantity",
    "heatindex_f": "l_discount",
    "dewpoint_c": "l_tax",
    "dewpoint_f": "l_quantity",
    "vis_km": "l_discount",
    "vis_miles": "l_tax",
    "uv": "l_discount",
    "gust_mph": "l_quantity",
    "gust_kph": "l_tax",
}


def _wide_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = table(spark, sf_dir, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    # The check table is one file with one row group, which one task would parse; the shuffle of a hash join spreads it,
    # as the table's few columns, unsorted, and adaptive execution splits a supplier that has many.
    items = table(spark, sf_dir, "lineitem").join(suppliers.hint("shuffle_hash"), F.col("l_suppkey") == F.col("s_suppkey"))
    seconds = to_epoch(F.col("l_shipdate"))
    wide = items.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        *[F.col(source).alias(name) for name, source in WIDE_SOURCES.items()],
        seconds.cast("string").alias("localtime_epoch"),
        seconds.alias("last_updated_epoch"),
    )
    # Whole numbers as they are written elsewhere, a bigint and an int.
    number = F.col("l_linenumber")
    epoch_text = (
        F.when(number == 1, F.concat("localtime_epoch", F.lit(".0"))).when(number == 2, F.concat("localtime_epoch", F.lit("f")))
        .when(number == 3, F.lit("6.5e1")).when(number == 6, F.lit("0x1p3")).otherwise(F.col("localtime_epoch"))
    )
    cloud = (
        F.when(number == 4, F.lit("65.0")).when(number == 5, F.lit("1f")).when(number == 6, F.lit("0x1p3"))
        .when(number == 7, F.lit("6.5e1")).otherwise(number.cast("string"))
    )
    return wide.withColumns({"local_time": F.col("local_time").cast("string"), "localtime_epoch": epoch_text, "cloud": cloud})


def conform_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A name of its own: the catalog may be shared.
    name = f"vedrina_wide_{uuid.uuid4().hex}"
    replace_table(spark, name, WIDE_TABLE, new_path(spark, "wide"))
    columns = [column for column in WIDE_TABLE if column[0] != "id"]
    insert_rows(with_row_id(conform(_wide_input(spark, sf_dir), columns).drop(MISFITS)), name)
    # Line items share keys here; ``wide_table`` checks the ids.
    return spark.table(name).drop("id")


def wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as messages through the job, which is run, repeated, and run again with a part of them: the rows and
    distinct ids stored per country, and the messages set aside per run."""
    wide = _wide_input(spark, sf_dir).withColumn("last_updated", F.col("last_updated").cast("string"))
    city = F.when(F.col("l_linenumber") != 7, F.col("city"))
    fields = [name for name, _ in WIDE_TABLE if name not in ("id", "city")]
    message = F.to_json(F.struct(city.alias("city"), *fields))
    cut = (F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "R")
    messages = wide.select("l_returnflag", message.alias("value"), cut.alias("cut"))
    messages = messages.withColumn("value", F.when(F.col("cut"), F.expr("left(value, 40)")).otherwise(F.col("value")))
    target, aside, state = (new_path(spark, name) for name in ("wide-table", "wide-aside", "wide-state"))
    for run_id in (0, 0):
        wide_job(messages, target, aside, state, run_id, period="month")
    wide_job(messages.filter("l_returnflag = 'A'"), target, aside, state, 1, period="month")
    stored = read_wide(spark, target).groupBy(F.col("country").alias("name")).agg(
        F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_ids")
    )
    runs = spark.read.schema("readable boolean, run int").parquet(aside).groupBy(F.col("run").cast("string").alias("name"))
    runs = runs.agg(F.count("*").alias("n_rows"), F.lit(0).cast("bigint").alias("n_ids"))
    return stored.unionByName(runs)


def conform_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [column for column in WIDE_TABLE if column[0] != "id"]
    rows = conform(_wide_input(spark, sf_dir), columns, keep=["l_orderkey", "l_linenumber"])
    return rows.select("l_orderkey", "l_linenumber", F.array_join(MISFITS, ",").alias("misfits")).filter(
        "misfits <> ''"
    )


def upsert_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The report of all countries, then four of them anew with the humidity as the measure.
    rows = observations(spark, sf_dir)
    report, state = new_path(spark, "report"), new_path(spark, "report-state")
    by_humidity = rows.withColumn("temperatura", F.col("vlaznost").cast("double"))
    for result in (ex.daily_extremes(rows, None), ex.daily_extremes(by_humidity, COUNTRIES)):
        order = [name for name in result.columns if name not in EXTREMES_KEYS]
        upsert(result, report, EXTREMES, EXTREMES_KEYS, "datum", order, state)
    return read_landing(spark, report, EXTREMES, "parquet")


def upsert_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    # All observations, then all of them again as if made an hour earlier: late rows, which count only
    # for the dates on which nothing later is stored.
    rows = observations(spark, sf_dir)
    earlier = F.col("lokalno_vreme") - F.expr("INTERVAL 1 HOUR")
    late = rows.withColumns(
        {"lokalno_vreme": earlier, "datum": date_of(earlier), "temperatura": -F.col("temperatura")}
    )
    target, state = new_path(spark, "by-time"), new_path(spark, "by-time-state")
    for batch in (rows, late):
        upsert(
            batch, target, OBSERVATIONS, OBSERVATION_KEYS, "datum", ["lokalno_vreme", "event_id"], state,
            stored_order=["lokalno_vreme"],
        )
    return read_landing(spark, target, OBSERVATIONS, "parquet")


def upsert_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``upsert_by_time``, but only files that hold the keys of a batch are written anew; the late batch comes twice."""
    rows, target = observations(spark, sf_dir), new_path(spark, "by-file")
    earlier = F.col("lokalno_vreme") - F.expr("INTERVAL 1 HOUR")
    late = rows.withColumns(
        {"lokalno_vreme": earlier, "datum": date_of(earlier), "temperatura": -F.col("temperatura")}
    )
    for batch_id, batch in ((0, rows), (1, late), (1, late)):
        upsert_files(
            batch, target, OBSERVATIONS, OBSERVATION_KEYS, "datum", ["lokalno_vreme", "event_id"], batch_id, ["lokalno_vreme"], 2000
        )
    return read_version(spark, target, OBSERVATIONS)


def report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of all dates, then that of three months anew on top of it, with the prices turned round."""
    rows = line_items(spark, sf_dir)
    report, state = new_path(spark, "report"), new_path(spark, "report-state")
    daily_extremes_job(rows, report, state, None)
    turned = rows.withColumn("temperatura", -F.col("temperatura"))
    daily_extremes_job(turned, report, state, None, dates=REPORT_DATES)
    return read_report(spark, report)


def report_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report grown from three batches that share their dates: what came in on time, late rows, and one of the two again."""
    rows = line_items(spark, sf_dir)
    late = F.col("stanje") == "F"
    report, state = new_path(spark, "running"), new_path(spark, "running-state")
    for batch_id, batch in ((0, rows.filter(~late)), (1, rows.filter(late)), (1, rows.filter(late))):
        report_increment(batch, report, state, None, batch_id)
    return read_running_report(spark, report)


def append_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir, event_stream(spark, sf_dir))
    target, checkpoint = new_path(spark, "appended"), new_path(spark, "append-checkpoint")
    aside = new_path(spark, "quarantine")
    # Run twice on one checkpoint: the second run must add nothing.
    for _ in range(2):
        append_stream(parse_flat(envelope(rows, flat_text())), target, checkpoint, aside).awaitTermination()
    return read_appended(spark, target, OBSERVATIONS)


def append_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message delivered twice under other offsets, half of them in a later run."""
    rows, log = observations(spark, sf_dir), new_path(spark, "log")
    messages = envelope(rows, flat_text()).withColumn("timestamp", F.col("timestamp").cast("timestamp")).drop("stanje")
    target, checkpoint, aside = (new_path(spark, name) for name in ("once", "once-checkpoint", "once-aside"))
    again = messages.withColumn("offset", -F.col("offset"))
    for delivered in (messages.unionByName(again.filter("offset % 2 = 0")), again.filter("offset % 2 <> 0")):
        delivered.write.mode("append").parquet(log)
        stream = spark.readStream.schema(messages.schema).parquet(log)
        append_job(stream, target, checkpoint, aside, "10 days").awaitTermination()
    return read_appended(spark, target, OBSERVATIONS)


def append_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's quarters as batches, packed while they come in and at the end; a packed batch is delivered again."""
    rows, target = observations(spark, sf_dir).drop("event_id"), new_path(spark, "compacted")
    quarter = F.floor(F.hour("lokalno_vreme") / 6)
    for batch_id in (0, 1, 2, 3, 1):
        append_batch(rows.filter(quarter == batch_id), target, "events", batch_id)
        if batch_id >= 2:
            compact(spark, target, OBSERVATIONS, fanout=2)
    compact(spark, target, OBSERVATIONS, fanout=2, ended=True)
    return read_appended(spark, target, OBSERVATIONS)


def upsert_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir, event_stream(spark, sf_dir))
    target, checkpoint = new_path(spark, "upserted"), new_path(spark, "upsert-checkpoint")
    parsed = parse_nested(envelope(rows, nested_text()), keep=ARRIVAL)
    upsert_stream(parsed, target, checkpoint, new_path(spark, "quarantine")).awaitTermination()
    return read_landing(spark, target, OBSERVATIONS, "parquet")


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "landing")
    write_landing(observations(spark, sf_dir).drop("event_id"), path)
    return read_landing(spark, path, OBSERVATIONS)


def landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines spoiled by kind: no JSON, a time to the minute, a quoted number, a field that does not fit."""
    path = new_path(spark, "landing")
    spoiled = (
        F.when(F.col("stanje") == "click", F.lit("not json"))
        .when(F.col("stanje") == "view", F.regexp_replace("value", r'("lokalno_vreme":"[^"]{16})[^"]*"', '$1"'))
        .when(F.col("stanje") == "purchase", F.regexp_replace("value", r'"temperatura":([0-9.]+)', '"temperatura":"$1"'))
        .when(F.col("stanje") == "error", F.regexp_replace("value", r'"vlaznost":\d+', '"vlaznost":"many"'))
        .otherwise(F.col("value"))
    )
    rows = observations(spark, sf_dir).withColumn("value", flat_text()).select(spoiled.alias("value"), "datum")
    rows.write.partitionBy("datum").text(path)
    lines = read_landing_lines(spark, path, OBSERVATIONS)
    return lines.withColumn("problems", F.array_join(PROBLEMS, ",")).drop("raw")


def landing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed observations into the keyed table, by the job, and again as a repeated run."""
    landing, target = new_path(spark, "landing"), new_path(spark, "landed")
    state, aside = new_path(spark, "landed-state"), new_path(spark, "landed-aside")
    write_landing(observations(spark, sf_dir).drop("event_id"), landing)
    for _ in range(2):
        landing_job(spark, landing, target, aside, state, 0, words={})
    return read_landing(spark, target, OBSERVATIONS, "parquet")


def landing_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations that land a part of the day at a time, each part followed by a run that reads the new files only."""
    landing, target = new_path(spark, "landing"), new_path(spark, "landed")
    state, aside = new_path(spark, "landed-state"), new_path(spark, "landed-aside")
    rows = observations(spark, sf_dir).drop("event_id")
    for afternoon in (True, False):
        write_landing(rows.filter((F.hour("lokalno_vreme") >= 12) == afternoon), landing)
        for _ in range(2):
            landing_job(spark, landing, target, aside, state, words={}, only_new=True)
    return read_landing(spark, target, OBSERVATIONS, "parquet")


def spec_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir, event_stream(spark, sf_dir))
    millis = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', lokalno_vreme)")
    values = [
        F.col("grad").alias("station"),
        F.col("temperatura").alias("degrees"),
        F.col("stanje").alias("kind"),
    ]
    # Some messages carry the time as a number, the others as text, with and without a zone; one zone is none.
    zone = F.create_map(
        *[F.lit(word) for word in ("purchase", "+02", "signup", " Asia/Kolkata", "error", " Nowhere/Land", "view", "")]
    )
    local = F.concat(F.col("lokalno_vreme").cast("string"), zone[F.col("stanje")])
    text = F.when(F.col("stanje") == "click", F.to_json(F.struct(millis.alias("made_at"), *values))).otherwise(
        F.to_json(F.struct(local.alias("made_at"), *values))
    )
    spec = IngestionSpec.read(EVENT_SPEC)
    target, checkpoint = new_path(spark, spec.table), new_path(spark, "ingest-checkpoint")
    ingest(envelope(rows, text), spec, target, checkpoint, new_path(spark, "quarantine")).awaitTermination()
    return read_appended(spark, target, spec.schema())


QUERIES = {
    "extremes": extremes,
    "extremes_one_pass": extremes_one_pass,
    "extremes_two_pass": extremes_two_pass,
    "extremes_joined": extremes_joined,
    "hottest": hottest,
    "coldest": coldest,
    "extreme_ties": extreme_ties,
    "agg_join_back": agg_join_back,
    "filter_isin": filter_isin,
    "parse_flat": parse_flat_query,
    "parse_nested": parse_nested_query,
    "json_path": json_path_query,
    "json_paths": json_paths,
    "json_elements": json_elements,
    "split_json": split_json_query,
    "split_lines": split_lines_query,
    "file_lines": file_lines,
    "temporal": temporal,
    "epoch": epoch,
    "auto_time": auto_time_query,
    "translate": translate,
    "translate_join": translate_join,
    "extract_text": extract_text,
    "enrich_cities": enrich_cities_query,
    "enrich_as_of": enrich_as_of_query,
    "city_dedup": city_dedup,
    "city_spellings": city_spellings,
    "quarantine": quarantine,
    "stream_counts": stream_counts,
    "replayed": replayed,
    "conform_wide": conform_wide,
    "conform_misfits": conform_misfits,
    "wide_table": wide_table,
    "report_job": report_job,
    "report_running": report_running,
    "upsert_batch": upsert_batch,
    "upsert_by_time": upsert_by_time,
    "upsert_by_file": upsert_by_file,
    "append_stream": append_stream_query,
    "append_compacted": append_compacted,
    "append_redelivered": append_redelivered,
    "upsert_stream": upsert_stream_query,
    "landing_roundtrip": landing_roundtrip,
    "landing_quarantine": landing_quarantine,
    "landing_table": landing_table,
    "landing_new": landing_new,
    "spec_ingest": spec_ingest,
}
