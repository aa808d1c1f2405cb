import json

import pytest

from vedrina.operators.cities import city_lines, other_lines
from vedrina.plans.checks import EVENT_SPEC
from vedrina.shared import shared_folder
from vedrina.sources import jdbc, message_log
from vedrina.sources.files import read_lines
from vedrina.sources.ingestion_spec import IngestionSpec, parse_specified


class Recorder:
    """Stands in for a session or a reader and keeps what it is asked for."""

    def __init__(self):
        self.calls = {}

    @property
    def read(self):
        return self

    @property
    def readStream(self):
        return self

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def load(self):
        return self

    def jdbc(self, url, table, predicates, properties):
        self.calls.update(url=url, table=table, predicates=predicates, properties=properties)
        return self


def test_log_from_the_earliest_offset():
    spark = Recorder()
    message_log.read_log(spark, "log:9092", "daily", starting="earliest", max_per_batch=1000, min_partitions=64)
    assert spark.calls == {
        "format": "kafka",
        "options": {
            "kafka.bootstrap.servers": "log:9092", "subscribe": "daily", "startingOffsets": "earliest",
            "maxOffsetsPerTrigger": "1000", "minPartitions": "64",
        },
    }


def test_log_with_the_default_start():
    spark = Recorder()
    message_log.read_log(spark, "log:9092", "daily")
    assert spark.calls["options"] == {"kafka.bootstrap.servers": "log:9092", "subscribe": "daily"}


def test_database_read_in_ranges():
    spark = Recorder()
    split = jdbc.range_options("datum", "2025-01-01", "2025-12-31", 16)
    jdbc.read_table(spark, "jdbc:x", "daily_weather", {"user": "u"}, split)
    assert spark.calls == {
        "format": "jdbc",
        "options": {
            "url": "jdbc:x", "dbtable": "daily_weather", "fetchsize": "10000", "user": "u", "partitionColumn": "datum",
            "lowerBound": "2025-01-01", "upperBound": "2025-12-31", "numPartitions": "16",
        },
    }


def test_database_read_in_buckets_covers_every_row_once():
    duckdb = pytest.importorskip("duckdb")
    predicates = jdbc.bucket_predicates("n", 4)
    spark = Recorder()
    jdbc.read_table(spark, "jdbc:x", "t", predicates=predicates)
    assert spark.calls["predicates"] == predicates and len(predicates) == 4
    rows = "(SELECT * FROM (VALUES (NULL), (-7), (-1), (0), (1), (2), (3), (4), (9)) AS t(n))"
    counts = [duckdb.sql(f"SELECT count(*) FROM {rows} WHERE {predicate}").fetchall()[0][0] for predicate in predicates]
    assert sum(counts) == 9 and all(counts)


def test_lines_of_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Niš,Serbia\nBor,Serbia East\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("Zagreb,Croatia\nno country\n", encoding="utf-8")
    lines = read_lines(spark, str(tmp_path))
    assert sorted((row.file_name, row.value) for row in lines.collect()) == [
        ("a.txt", "Bor,Serbia East"), ("a.txt", "Niš,Serbia"), ("b.txt", "Zagreb,Croatia"), ("b.txt", "no country"),
    ]
    assert sorted(map(tuple, city_lines(lines).collect())) == [
        ("Bor", "Serbia East"), ("Niš", "Serbia"), ("Zagreb", "Croatia"),
    ]
    assert [tuple(row) for row in other_lines(lines).collect()] == [("no country", "b.txt")]


def test_lines_end_at_line_feeds_only(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("a\rb\n\nc".encode())
    assert [row.value for row in read_lines(spark, str(tmp_path)).collect()] == ["a\rb", "", "c"]


def test_specification():
    spec = IngestionSpec.read(EVENT_SPEC)
    assert spec == IngestionSpec.read(json.dumps(EVENT_SPEC))
    assert (spec.table, spec.time_column, spec.dimensions) == ("event_data", "made_at", ["station", "degrees", "kind"])
    assert spec.max_rows_per_file == 30000
    assert spec.log_options() == {
        "kafka.bootstrap.servers": "log:9092", "subscribe": "events", "kafka.group.id": "events",
        "maxOffsetsPerTrigger": "700000",
    }


def test_dimension_called_like_the_message_column(spark):
    body = json.loads(json.dumps(EVENT_SPEC))
    body["spec"]["parser"]["parseSpec"] = {
        "timestampSpec": {"column": "timestamp", "format": "auto"}, "dimensionsSpec": {"dimensions": ["value"]},
    }
    messages = spark.createDataFrame([('{"timestamp": 0, "value": 7}',), ("junk",)], "value string")
    first, second = parse_specified(messages, IngestionSpec.read(body)).collect()
    assert (first.value, str(first.timestamp), first.raw) == ("7", "1970-01-01 00:00:00", None)
    assert (second.value, second.problems, second.raw) == (None, ["message"], "junk")


def test_specification_with_unknown_time_format_or_column():
    body = json.loads(json.dumps(EVENT_SPEC))
    body["spec"]["parser"]["parseSpec"]["timestampSpec"]["format"] = "ruby"
    with pytest.raises(ValueError, match="ruby"):
        IngestionSpec.read(body)
    body = json.loads(json.dumps(EVENT_SPEC))
    body["spec"]["parser"]["parseSpec"]["columns"].remove("station")
    with pytest.raises(ValueError, match="station"):
        IngestionSpec.read(body)


class Session:
    """Stands in for a session with a master and, perhaps, a folder."""

    def __init__(self, master, folder=None, checkpoint=None):
        self.settings = {} if folder is None else {"spark.checkpoint.dir": folder}
        names = {"master": master, "applicationId": f"app-{id(self)}", "getCheckpointDir": lambda: checkpoint}
        self.sparkContext = type("Context", (), {name: staticmethod(value) if callable(value) else value for name, value in names.items()})
        self.conf = self

    def get(self, name, default):
        return self.settings.get(name, default)


def test_shared_folder():
    assert shared_folder(Session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert shared_folder(Session("yarn", None, "hdfs://x/z")) == "hdfs://x/z"
    local = Session("local[2]")
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("yarn"))
