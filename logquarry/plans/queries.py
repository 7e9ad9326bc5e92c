"""One query per operator, over log lines made from the ``events`` table.

Each takes the session and the folder of the tables and returns a frame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.functions import clean, extract
from logquarry.functions.patterns import TIME_FORMAT_12H
from logquarry.operators import aggregate, augment, cleaning
from logquarry.operators.dedup import dedup_requests
from logquarry.operators.extraction import extract_columns, line_id
from logquarry.plans.jobs import publish_layers
from logquarry.plans.layers import aggregate_layers, curate, to_cleansed, to_raw
from logquarry.plans.profiles import DISTINCT, LOOSE, STRICT, TYPED, LogProfile
from logquarry.schema import DEDUP_KEYS
from logquarry.session import scratch_folder
from logquarry.sources import catalog, readers, writers
from logquarry.sources.event_lines import event_lines
from logquarry.streaming.messages import to_message_payload, write_messages


def _hourly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_lines(spark, sf_dir, on_the_hour=True)


def _numbered(lines: DataFrame) -> DataFrame:
    return lines.select(F.col("id").alias("line_no"), "value")


def _requests(lines: DataFrame, profile: LogProfile) -> DataFrame:
    """A curated layer of what counting needs."""
    return curate(lines, profile, DEDUP_KEYS)


# --- sources ---------------------------------------------------------------------------


def _written_lines(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = scratch_folder(spark, label)
    writers.append_log_text(event_lines(spark, sf_dir), path)
    return path


def read_lines(spark, sf_dir):
    return readers.read_log_lines(spark, _written_lines(spark, sf_dir, "read-lines"))


def numbered_lines(spark, sf_dir):
    """The lines of a log written in the order of their ids, numbered when read."""
    return readers.read_numbered_lines(spark, _ordered_log(spark, sf_dir, "numbered-lines"))


def _ordered_log(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = scratch_folder(spark, label)
    writers.append_log_text(event_lines(spark, sf_dir).orderBy("id"), path)
    return path


def row_count(spark, sf_dir):
    """Rows of the log, and of what one removal of duplicates leads to."""
    lines = _hourly_lines(spark, sf_dir)
    per_client = aggregate.hourly_per_client_agg(_requests(lines, DISTINCT))
    hours = per_client.groupBy("day_hour").agg(
        F.sum("count_row").alias("requests"), F.count(F.lit(1)).alias("clients")
    )
    sizes = hours.agg(
        F.sum("requests").alias("raw"), F.sum("clients").alias("per_client"), F.count(F.lit(1)).alias("across")
    ).unpivot([], ["raw", "per_client", "across"], "layer", "n_rows")
    return aggregate.row_count(lines).select(F.lit("lines").alias("layer"), "n_rows").union(sizes)


# --- extraction ------------------------------------------------------------------------


def extract_loose(spark, sf_dir):
    return extract_columns(event_lines(spark, sf_dir), "loose")


def extract_strict(spark, sf_dir):
    return extract_columns(event_lines(spark, sf_dir), "strict")


def device(spark, sf_dir):
    agent = extract.extract_field("value", "user_agent", "strict")
    return (
        event_lines(spark, sf_dir)
        .select("id", agent.alias("user_agent"))
        .withColumn("device", extract.extract_device("user_agent"))
    )


def line_id_unique(spark, sf_dir):
    lines = line_id(event_lines(spark, sf_dir).select("value"))
    return lines.agg(F.count("id").alias("n_ids"), F.count_distinct("id").alias("n_distinct"))


# --- cleaning --------------------------------------------------------------------------


def _fields(spark, sf_dir, *names, family="loose"):
    return extract_columns(event_lines(spark, sf_dir), family).select("id", *names)


def strip_chars(spark, sf_dir):
    return _fields(spark, sf_dir, "request").select(
        "id", clean.strip_request_chars("request").alias("request")
    )


def strip_tokens(spark, sf_dir):
    return _fields(spark, sf_dir, "request").select(
        "id", clean.strip_request_tokens("request").alias("request")
    )


def size_kb0(spark, sf_dir):
    return _fields(spark, sf_dir, "size").select("id", clean.size_to_kb("size").alias("size"))


def size_kb2(spark, sf_dir):
    return _fields(spark, sf_dir, "size").select("id", clean.size_to_kb("size", 2).alias("size"))


def dash_null(spark, sf_dir):
    return cleaning.dash_to_null(extract_loose(spark, sf_dir))


def empty_na(spark, sf_dir):
    return cleaning.empty_to_na(extract_loose(spark, sf_dir))


def fill_na(spark, sf_dir):
    return cleaning.fill_na(cleaning.dash_to_null(extract_loose(spark, sf_dir)))


def blank_null(spark, sf_dir):
    return cleaning.blank_to_null(extract_loose(spark, sf_dir))


def null_profile(spark, sf_dir):
    return cleaning.null_profile(cleaning.blank_to_null(to_raw(event_lines(spark, sf_dir), LOOSE)))


def parse_time(spark, sf_dir):
    return _fields(spark, sf_dir, "datetime_confirmed").select(
        "id", clean.parse_timestamp("datetime_confirmed").alias("datetime_confirmed")
    )


def parse_time_12h(spark, sf_dir):
    time = clean.parse_timestamp("datetime_confirmed", TIME_FORMAT_12H)
    return _fields(spark, sf_dir, "datetime_confirmed").select("id", time.alias("datetime_confirmed"))


def first_token(spark, sf_dir):
    return event_lines(spark, sf_dir).select("id", clean.first_token("value").alias("token"))


def typed(spark, sf_dir):
    return cleaning.type_columns(
        _fields(spark, sf_dir, "status_code", "size", family="strict")
    )


def referer_flag(spark, sf_dir):
    return cleaning.referer_flag(_fields(spark, sf_dir, "referer"))


def markers_hours(spark, sf_dir):
    requests = curate(event_lines(spark, sf_dir), LOOSE, DEDUP_KEYS).drop("clientip")
    times = cleaning.request_times(cleaning.method_markers(requests))
    return times.withColumn("day", F.col("day").cast("string"))


def curated_columns(spark, sf_dir):
    frame = cleaning.method_markers(curate(event_lines(spark, sf_dir), LOOSE))
    return cleaning.curated_columns(frame, ["id", "clientIp", "No_get", "No_post", "No_Head"])


def warehouse_cols(spark, sf_dir):
    return cleaning.warehouse_projection(curate(event_lines(spark, sf_dir), LOOSE))


# --- layers ----------------------------------------------------------------------------


def raw_loose(spark, sf_dir):
    return to_raw(event_lines(spark, sf_dir), LOOSE)


def raw_strict(spark, sf_dir):
    return to_raw(event_lines(spark, sf_dir), STRICT)


def raw_typed(spark, sf_dir):
    return to_raw(event_lines(spark, sf_dir), TYPED)


def raw_distinct(spark, sf_dir):
    return to_raw(_hourly_lines(spark, sf_dir), DISTINCT)


def _cleansed(lines, profile):
    return to_cleansed(to_raw(lines, profile), profile)


def cleansed(spark, sf_dir):
    return _cleansed(event_lines(spark, sf_dir), LOOSE)


def cleansed_strict(spark, sf_dir):
    return _cleansed(event_lines(spark, sf_dir), STRICT)


def cleansed_typed(spark, sf_dir):
    return _cleansed(event_lines(spark, sf_dir), TYPED)


def cleansed_distinct(spark, sf_dir):
    return _cleansed(_hourly_lines(spark, sf_dir), DISTINCT)


def curated(spark, sf_dir):
    return curate(event_lines(spark, sf_dir), LOOSE)


def layers_published(spark, sf_dir):
    folder = scratch_folder(spark, "layers")
    return publish_layers(_hourly_lines(spark, sf_dir), folder, DISTINCT)["hourly_across"]


def _published(name: str):
    """The query for one of the tables that a published log has."""

    def query(spark, sf_dir):
        folder = scratch_folder(spark, "layers")
        return publish_layers(_hourly_lines(spark, sf_dir), folder, DISTINCT)[name]

    return query


PUBLISHED = (
    "raw",
    "cleansed",
    "curated",
    "hourly_per_client",
    "hourly_distinct",
    "per_device",
    "per_client",
    "across_totals",
    "across_first_hour",
)


def layers_csv_typed(spark, sf_dir):
    """Devices by way of CSV files, which have to keep ``''`` apart from NULL."""
    folder = scratch_folder(spark, "layers-csv")
    return publish_layers(event_lines(spark, sf_dir), folder, TYPED, "csv")["per_device"]


def layers_by_day(spark, sf_dir):
    folder = scratch_folder(spark, "layers-day")
    tables = publish_layers(event_lines(spark, sf_dir), folder, STRICT, keep=["curated"], by_day=True)
    return tables["curated"].withColumn("day", F.col("day").cast("string"))


def aggregates_cached(spark, sf_dir):
    """How many rows each aggregate has, all of them cached."""
    frames = aggregate_layers(curate(event_lines(spark, sf_dir), TYPED), cache=True)
    counts = [
        aggregate.row_count(df).select(F.lit(name).alias("table_name"), "n_rows") for name, df in frames.items()
    ]
    return reduce(DataFrame.union, counts)


# --- distinct and aggregates -----------------------------------------------------------


def dedup(spark, sf_dir):
    return dedup_requests(extract_columns(_hourly_lines(spark, sf_dir)))


def per_device(spark, sf_dir):
    return aggregate.per_device_agg(curate(event_lines(spark, sf_dir), TYPED))


def per_client(spark, sf_dir):
    return aggregate.per_client_agg(curate(event_lines(spark, sf_dir), STRICT))


def hourly_per_client(spark, sf_dir):
    return aggregate.hourly_per_client_agg(_requests(_hourly_lines(spark, sf_dir), DISTINCT))


def across_totals(spark, sf_dir):
    return aggregate.across_device_totals(curate(event_lines(spark, sf_dir), TYPED))


def across_first_hour(spark, sf_dir):
    return aggregate.across_clients_first_hour(curate(event_lines(spark, sf_dir), STRICT))


def hourly_across(spark, sf_dir):
    """Flagship: lines without duplicates, cleaned, counted per hour."""
    return aggregate.hourly_across_agg(_requests(_hourly_lines(spark, sf_dir), DISTINCT))


def hourly_across_all(spark, sf_dir):
    return aggregate.hourly_across_agg(curate(event_lines(spark, sf_dir), LOOSE))


def hourly_rollup(spark, sf_dir):
    return aggregate.roll_up_clients(hourly_per_client(spark, sf_dir))


def hourly_distinct(spark, sf_dir):
    return aggregate.hourly_distinct_clients(curate(event_lines(spark, sf_dir), LOOSE))


# --- augmentation ----------------------------------------------------------------------


def replicate(spark, sf_dir):
    return augment.replicate_log(_numbered(event_lines(spark, sf_dir)), 3)


def replicate_spread(spark, sf_dir):
    return augment.replicate_log(_numbered(event_lines(spark, sf_dir)), 5, partitions=8)


def perturb_nth(spark, sf_dir):
    return augment.perturb_every_nth(_numbered(event_lines(spark, sf_dir)))


def ramp_seed(spark, sf_dir):
    return augment.ramp_seed_lines(_numbered(event_lines(spark, sf_dir)), 5)


def ramp_hourly(spark, sf_dir):
    grown = augment.ramp_seed_lines(_numbered(event_lines(spark, sf_dir)), 5)
    return aggregate.hourly_distinct_clients(curate(grown.select("value"), LOOSE))


def passes(spark, sf_dir):
    return augment.measure_passes(event_lines(spark, sf_dir), 3)


def fixed_passes(spark, sf_dir):
    """What the fixed-rate generator makes of a log for one lakh."""
    grown = augment.replicate_log(_numbered(event_lines(spark, sf_dir)), augment.passes_per_lakh(1))
    return grown.groupBy("line_no").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("pass_no").alias("first_pass"), F.max("pass_no").alias("last_pass")
    )


def seed_to_log(spark, sf_dir):
    """A seed file is numbered, varied and added to itself."""
    path = _ordered_log(spark, sf_dir, "seed")
    varied = augment.perturb_every_nth(readers.read_numbered_lines(spark, path), step=3)
    grown = scratch_folder(spark, "grown")
    writers.append_log_text(readers.read_log_lines(spark, path), grown)
    writers.append_log_text(varied, grown)
    return readers.read_log_lines(spark, grown)


# --- sinks -----------------------------------------------------------------------------


def layer_csv(spark, sf_dir):
    frame = cleansed(spark, sf_dir)
    path = scratch_folder(spark, "layer-csv")
    writers.write_layer_csv(frame, path)
    return readers.read_layer_csv(spark, path, frame.schema)


def layer_parquet(spark, sf_dir):
    path = scratch_folder(spark, "layer-parquet")
    writers.write_layer_parquet(cleansed(spark, sf_dir), path)
    return readers.read_layer_parquet(spark, path)


def _new_database(spark) -> str:
    location = scratch_folder(spark, "tables")
    name = "logquarry_" + location.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    return name


def table_default(spark, sf_dir):
    name = f"{_new_database(spark)}.curated_log"
    writers.save_table(curated(spark, sf_dir), name)
    return spark.table(name)


def _save_orc_aggregates(spark, sf_dir) -> str:
    database = _new_database(spark)
    for name, query in {
        "log_agg_per_device": per_device,
        "log_agg_across_device": across_totals,
    }.items():
        writers.save_table(query(spark, sf_dir), f"{database}.{name}", "overwrite", "orc")
    return database


def table_orc(spark, sf_dir):
    return spark.table(f"{_save_orc_aggregates(spark, sf_dir)}.log_agg_per_device")


def table_orc_totals(spark, sf_dir):
    return spark.table(f"{_save_orc_aggregates(spark, sf_dir)}.log_agg_across_device")


def catalog_databases(spark, sf_dir):
    """The database made for the ORC aggregates, as listed, and how many tables it has."""
    database = _save_orc_aggregates(spark, sf_dir)
    tables = catalog.list_tables(spark, database).groupBy("namespace").agg(F.count(F.lit(1)).alias("n_tables"))
    listed = catalog.list_databases(spark).join(tables, "namespace")
    return listed.select(F.split("namespace", "_")[0].alias("database"), "n_tables")


def few_files(spark, sf_dir):
    """An aggregate written as one file, with the number of files that it is read from."""
    path = scratch_folder(spark, "few-files")
    writers.write_layer_parquet(per_device(spark, sf_dir), path, files=1)
    found = readers.read_layer_parquet(spark, path)
    return found.withColumn("n_files", F.lit(len(found.inputFiles())))


def catalog_tables(spark, sf_dir):
    """The tables of a database with the rows of each, after saving the ORC aggregates."""
    database = _save_orc_aggregates(spark, sf_dir)
    listed = catalog.list_tables(spark, database)
    sizes = [
        aggregate.row_count(spark.table(f"{database}.{name}")).select(
            F.lit(name).alias("tableName"), "n_rows"
        )
        for name in ("log_agg_per_device", "log_agg_across_device")
    ]
    return listed.join(reduce(DataFrame.union, sizes), "tableName").select("tableName", "n_rows")


def connector(spark, sf_dir):
    path = scratch_folder(spark, "connector")
    frame = cleaning.warehouse_projection(curated(spark, sf_dir))
    writers.write_connector(frame, "parquet", {"path": path}, "curated")
    return readers.read_layer_parquet(spark, path)


def append_text(spark, sf_dir):
    path = scratch_folder(spark, "append-text")
    lines = _numbered(event_lines(spark, sf_dir))
    writers.append_log_text(lines, path)
    writers.append_log_text(augment.perturb_every_nth(lines), path)
    return readers.read_log_lines(spark, path)


def payload(spark, sf_dir):
    return to_message_payload(event_lines(spark, sf_dir))


def messages(spark, sf_dir):
    path = scratch_folder(spark, "messages")
    grown = augment.ramp_seed_lines(_numbered(event_lines(spark, sf_dir)), 2)
    write_messages(grown, "access-log", {"path": path}, fmt="text")
    return readers.read_log_lines(spark, path)


QUERIES = {
    query.__name__: query
    for query in (
        hourly_across,
        read_lines,
        numbered_lines,
        row_count,
        extract_loose,
        extract_strict,
        device,
        line_id_unique,
        strip_chars,
        strip_tokens,
        size_kb0,
        size_kb2,
        dash_null,
        empty_na,
        fill_na,
        blank_null,
        null_profile,
        parse_time,
        parse_time_12h,
        first_token,
        typed,
        referer_flag,
        markers_hours,
        curated_columns,
        warehouse_cols,
        raw_loose,
        raw_strict,
        raw_typed,
        raw_distinct,
        cleansed,
        cleansed_strict,
        cleansed_typed,
        cleansed_distinct,
        curated,
        layers_published,
        layers_csv_typed,
        layers_by_day,
        aggregates_cached,
        dedup,
        per_device,
        per_client,
        hourly_per_client,
        across_totals,
        across_first_hour,
        hourly_across_all,
        hourly_rollup,
        hourly_distinct,
        replicate,
        replicate_spread,
        perturb_nth,
        ramp_seed,
        ramp_hourly,
        passes,
        fixed_passes,
        seed_to_log,
        layer_csv,
        layer_parquet,
        table_default,
        table_orc,
        table_orc_totals,
        catalog_databases,
        few_files,
        catalog_tables,
        connector,
        append_text,
        payload,
        messages,
    )
} | {f"layers_{name}": _published(name) for name in PUBLISHED}
