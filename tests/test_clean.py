import datetime as dt

import pytest

from logquarry.functions import clean as C
from logquarry.functions.patterns import TIME_FORMAT_12H
from logquarry.operators import cleaning
from logquarry.plans.layers import curate, to_cleansed, to_raw
from logquarry.plans.profiles import LOOSE, STRICT, TYPED
from logquarry.schema import CLEANSED_SCHEMA, CURATED_SCHEMA, RAW_SCHEMA, WAREHOUSE_COLUMNS
from tests.lines import AHREFS, ALL, ANDROID, GARBAGE, frame


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "c string").select(column).first()[0]


def test_strip_request(spark):
    row = frame(spark, [AHREFS])
    raw = {p.name: to_raw(row, p).first().request for p in (LOOSE, STRICT)}
    assert raw["loose"] == " /filter/271320abx12y35 HTTP/11"
    assert raw["strict"] == ' /filter/27|1320ab?x=1,2&y=3.5 HTTP/1.1"'
    assert one(spark, "a\"b#c$d%e&f,g-h.i=j?k|l/m:n", C.strip_request_chars("c")) == "abcdefghijkl/m:n"
    assert one(spark, "a%b-c?=d?e=f", C.strip_request_tokens("c")) == "abcd?e=f"


@pytest.mark.parametrize(
    "size,digits,kb", [("512", 0, 1.0), ("30577", 0, 30.0), ("30577", 2, 29.86), ("", 0, None), ("x", 2, None)]
)
def test_size_to_kb(spark, size, digits, kb):
    assert one(spark, size, C.size_to_kb("c", digits)) == kb


@pytest.mark.parametrize(
    "text,hour",
    [
        ("22/Jan/2019:03:56:14", 3),
        ("22/Jan/2019:13:56:14", 13),
        ("31/Feb/2019:13:56:14", None),
        ("22/Jan/2019:24:00:00", None),
        ("1/Jan/2019:1:1:1", None),
        ("22/Jan/2019:010:00:00", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, text, hour):
    got = one(spark, text, C.parse_timestamp("c"))
    assert (got and got.hour) == hour


def test_parse_timestamp_12h(spark):
    assert one(spark, "22/Jan/2019:13:56:14", C.parse_timestamp("c", TIME_FORMAT_12H)) is None
    assert one(spark, "22/Jan/2019:03:56:14", C.parse_timestamp("c", TIME_FORMAT_12H)).hour == 3


def test_wall_clock_survives_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("America/New_York", "Asia/Tehran", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            # In New York this half hour did not exist.
            got = one(spark, "10/Mar/2024:02:30:00", C.parse_timestamp("c").cast("string"))
            assert got == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_null_conventions(spark):
    df = spark.createDataFrame(
        [("-", 1.0, ""), (" x ", float("nan"), None), ("\t", None, "NA")], "a string, b double, c string"
    )
    rows = lambda frame: [tuple(r) for r in frame.select("a", "c").collect()]
    assert rows(cleaning.dash_to_null(df)) == [(None, ""), (" x ", None), ("\t", "NA")]
    assert rows(cleaning.empty_to_na(df)) == [("-", "NA"), (" x ", None), ("\t", "NA")]
    assert rows(cleaning.blank_to_null(df)) == [("-", None), ("x", None), (None, "NA")]
    assert rows(cleaning.fill_na(df)) == [("-", ""), (" x ", "NA"), ("\t", "NA")]
    assert tuple(cleaning.null_profile(df).first()) == (0, 2, 1)


def test_referer_flag(spark):
    df = spark.createDataFrame([(None,), ("",), ("NA",), ("https://x",)], "referer string")
    assert [r[1] for r in cleaning.referer_flag(df).collect()] == ["N", "N", "N", "Y"]


def test_times_and_markers(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2019, 1, 28, 3, 5), "GET"), (None, "PUT")], "datetime_confirmed timestamp_ntz, method_GET string"
    )
    good, bad = cleaning.request_times(cleaning.method_markers(df)).collect()
    assert (good.day, good.hour, good.day_hour) == (dt.date(2019, 1, 28), 3, "2019-01-28 3")
    assert (good.no_get, good.no_post, good.no_head) == ("GET", None, None)
    assert list(bad)[2:] == [None] * 6


def test_layer_schemas(spark):
    lines = frame(spark, ALL)
    raw = to_raw(lines, LOOSE)
    as_pairs = lambda schema: [(f.name, f.dataType) for f in schema.fields]
    assert as_pairs(raw.schema) == as_pairs(RAW_SCHEMA)
    assert as_pairs(to_cleansed(raw, LOOSE).schema) == as_pairs(CLEANSED_SCHEMA)
    curated = curate(lines, LOOSE)
    assert as_pairs(curated.schema) == as_pairs(CURATED_SCHEMA)
    assert cleaning.warehouse_projection(curated).columns == WAREHOUSE_COLUMNS


def test_cleansed_rows(spark):
    lines = frame(spark, [AHREFS, ANDROID, GARBAGE])
    first, second, third = curate(lines, LOOSE).orderBy("id").collect()
    assert tuple(first) == (
        0, "54.36.149.41", dt.datetime(2019, 1, 22, 3, 56, 14), "GET",
        "/filter/271320abx12y35 HTTP/11", 200, 30.0, '"Mozilla/5.0 (compatible; AhrefsBot/6.1;', "N",
    )
    assert (second.status_code, second.size, second["referer_present(Y/N)"]) == (404, 1.0, "Y")
    assert tuple(third) == (2, "garbage", None, "NA", "NA", None, None, "NA", "N")


def test_typed_profile_keeps_bytes_and_blanks(spark):
    row = curate(frame(spark, [AHREFS, GARBAGE]), TYPED).orderBy("id").collect()
    assert (row[0].status_code, row[0].size) == (200, 30577)
    assert (row[1].clientip, row[1].size, row[1].method_GET) == ("", None, "")


def test_curated_columns_ignores_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "clientip int, No_get int, other int")
    assert cleaning.curated_columns(df, ["no_get", "clientIp"]).columns == ["No_get", "clientip"]


def test_type_columns(spark):
    df = spark.createDataFrame([("200", "5000000000"), ("", "-")], "status_code string, size string")
    assert [tuple(r) for r in cleaning.type_columns(df).collect()] == [(200, 5_000_000_000), (None, None)]
    assert dict(cleaning.type_columns(df).dtypes) == {"status_code": "int", "size": "bigint"}
