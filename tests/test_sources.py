import json

import pytest

from logquarry.operators.cleaning import blank_to_null
from logquarry.plans.jobs import publish_layers
from logquarry.plans.layers import aggregate_layers, curate, to_cleansed, to_raw
from logquarry.plans.profiles import PROFILES
from logquarry.schema import CLEANSED_SCHEMA
from logquarry.session import object_store_conf, scratch_folder
from logquarry.sources import catalog, readers, writers
from logquarry.streaming.messages import to_message_payload, write_messages
from tests.lines import ALL, frame
from tests.test_aggregate import MIXED

CONTROL = [chr(c) for c in range(0x21)]
CODED = ["a\x00b", "two\nlines", "cr\r"]
MARKS = ["\\N", "\\E", "\\EQQ==", "\\\\N", "\\\\\\N", "\\", "N", "\\Nx", '"', '""', '","', "#x", "'"]
ODD = ['q"uo"te', "back\\slash", '\\"both\\"', "com,ma", "é ü", "  padded  ", "-", "NA", ""]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_object_store_conf():
    assert object_store_conf() == {}
    assert object_store_conf(endpoint="s3.example.com", provider="a.B,c.D") == {
        "spark.hadoop.fs.s3a.endpoint": "s3.example.com",
        "spark.hadoop.fs.s3a.aws.credentials.provider": "a.B,c.D",
    }
    assert object_store_conf(access_key="a", secret_key="b", session_token="c") == {
        "spark.hadoop.fs.s3a.access.key": "a",
        "spark.hadoop.fs.s3a.secret.key": "b",
        "spark.hadoop.fs.s3a.session.token": "c",
    }


@pytest.mark.parametrize("given", [{"access_key": "a"}, {"secret_key": "b"}, {"session_token": "c"}])
def test_object_store_conf_refuses_half_a_key(given):
    with pytest.raises(ValueError, match="key"):
        object_store_conf(**given)


def test_scratch_folder_follows_the_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first.startswith(base + "/x-") and first != second


def test_scratch_folder_refuses_a_cluster_without_it():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session(), "x")


def test_numbered_lines_over_many_splits(spark, tmp_path):
    files = {"b.log": 3000, "a.log": 5000, "c.log": 1}
    want = []
    for name, n in sorted(files.items()):
        lines = [f"{name} {i} " + "x" * (i % 50) for i in range(n)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        want += lines
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
        numbered = readers.read_numbered_lines(spark, str(tmp_path))
        assert readers.read_log_lines(spark, str(tmp_path)).selectExpr(
            "spark_partition_id() p"
        ).distinct().count() > 10
        got = {r.line_no: r.value for r in numbered.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == dict(enumerate(want))


def test_append_log_text(spark, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):
        writers.append_log_text(frame(spark, ALL), path)
    assert rows(readers.read_log_lines(spark, path)) == sorted([(x,) for x in ALL * 2], key=str)


@pytest.mark.parametrize("columns", [["id", "value"], ["value"], ["value", "id"]])
def test_csv_gives_back_what_was_written(spark, tmp_path, columns):
    df = frame(spark, ODD + CONTROL + CODED + MARKS + [None]).select(columns)
    writers.write_layer_csv(df, str(tmp_path / "c"))
    assert rows(readers.read_layer_csv(spark, str(tmp_path / "c"), df.schema)) == rows(df)


def test_blank_to_null_trims_blanks_and_controls(spark):
    df = frame(spark, [f"{c}x{c}" for c in CONTROL] + CONTROL + ["", " \x00\x1f ", "é\xa0"])
    got = [r.value for r in blank_to_null(df).orderBy("id").collect()]
    assert got == ["x"] * len(CONTROL) + [None] * (len(CONTROL) + 2) + ["é\xa0"]


def test_csv_without_schema_is_all_strings(spark, tmp_path):
    writers.write_layer_csv(spark.range(3), str(tmp_path / "c"), files=1)
    assert readers.read_layer_csv(spark, str(tmp_path / "c")).dtypes == [("id", "string")]
    assert len(list((tmp_path / "c").glob("part-*"))) == 1


def test_csv_without_header_is_noticed(spark, tmp_path):
    cleansed = to_cleansed(to_raw(frame(spark, ALL)))
    writers.write_layer_csv(cleansed, str(tmp_path / "c"), header=False)
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_layer_csv(spark, str(tmp_path / "c"), CLEANSED_SCHEMA).collect()


def test_parquet_partitioned(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS half")
    writers.write_layer_parquet(df, str(tmp_path / "p"), partition_by=["half"])
    assert (tmp_path / "p" / "half=1").is_dir()
    assert rows(readers.read_layer_parquet(spark, str(tmp_path / "p")).select("id", "half")) == rows(df)


def test_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS logs")
    df = frame(spark, ODD)
    writers.save_table(df, "logs.default_format")
    with pytest.raises(Exception, match="(?i)exists"):
        writers.save_table(df, "logs.default_format")
    writers.save_table(df, "logs.orc_format", mode="overwrite", fmt="orc")
    writers.save_table(df, "logs.orc_format", mode="overwrite", fmt="orc")
    assert rows(spark.table("logs.default_format")) == rows(spark.table("logs.orc_format")) == rows(df)
    provider = spark.sql("DESCRIBE EXTENDED logs.orc_format").where("col_name = 'Provider'").first()
    assert provider.data_type.lower() == "orc"
    assert {r.tableName for r in catalog.list_tables(spark, "logs").collect()} == {"default_format", "orc_format"}
    assert "logs" in {r.namespace for r in catalog.list_databases(spark).collect()}
    assert catalog.list_tables(spark).columns == ["namespace", "tableName", "isTemporary"]


def test_connector_passes_format_options_and_mode(spark, tmp_path):
    path = str(tmp_path / "w")
    for _ in range(2):
        writers.write_connector(frame(spark, ODD), "json", {"path": path}, "curated")
    assert spark.read.json(path).count() == len(ODD)


def test_message_payload_is_the_line_as_json(spark, tmp_path):
    got = [r.value for r in to_message_payload(frame(spark, ALL + ODD)).collect()]
    assert [json.loads(x) for x in got] == [x + "\n" for x in ALL + ODD]
    bare = [r.value for r in to_message_payload(frame(spark, ODD), line_end="").collect()]
    assert [json.loads(x) for x in bare] == ODD
    path = str(tmp_path / "topic")
    write_messages(frame(spark, ODD), "log", {"path": path}, fmt="text")
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(got[len(ALL):])


@pytest.mark.parametrize("profile", [p for p in PROFILES])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_published_layers_equal_the_lazy_ones(spark, tmp_path, profile, fmt):
    choice = PROFILES[profile]
    lines = frame(spark, ALL[:-1] + MIXED, partitions=3)
    stored = publish_layers(lines, str(tmp_path), choice, fmt)
    lazy = aggregate_layers(curate(lines, choice))
    for name, df in lazy.items():
        assert rows(stored[name]) == rows(df), name
        assert stored[name].dtypes == df.dtypes
    raw = to_raw(lines, choice)
    assert rows(stored["raw"]) == rows(raw)
    assert rows(stored["cleansed"]) == rows(to_cleansed(raw, choice))
    assert rows(stored["curated"]) == rows(curate(lines, choice))
    assert stored["curated"].schema.names == curate(lines, choice).schema.names


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_layers_to_keep_and_days(spark, tmp_path, fmt):
    lines = frame(spark, ALL[:-1] + MIXED, partitions=3)
    stored = publish_layers(lines, str(tmp_path), fmt=fmt, keep=["curated"], by_day=True)
    assert not (tmp_path / "raw").exists() and not (tmp_path / "cleansed").exists()
    assert (tmp_path / "curated" / "day=2019-01-22").is_dir()
    assert rows(stored["curated"].drop("day")) == rows(curate(lines))
    for name, df in aggregate_layers(curate(lines)).items():
        assert rows(stored[name]) == rows(df), name
    with pytest.raises(ValueError, match="silver"):
        publish_layers(lines, str(tmp_path), keep=["silver"])


def test_numbered_lines_refuse_too_many_splits(spark, tmp_path, monkeypatch):
    for name in "abc":
        (tmp_path / name).write_text("x\n")
    monkeypatch.setattr(readers, "MAX_SPLITS", 2)
    with pytest.raises(Exception, match="more than 2 splits"):
        readers.read_numbered_lines(spark, str(tmp_path)).collect()


def test_publish_rejects_other_formats(spark, tmp_path):
    with pytest.raises(ValueError, match="xml"):
        publish_layers(frame(spark, ALL), str(tmp_path), fmt="xml")


def test_layers_run_on_a_stream(spark, tmp_path):
    """The layers hold no state, so a stream of lines with ids can be cleaned as it comes."""
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    lines = frame(spark, ALL[:-1])
    lines.write.parquet(source)
    stream = spark.readStream.schema(lines.schema).parquet(source)
    query = (
        curate(stream)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert rows(spark.read.parquet(sink)) == rows(curate(lines))
