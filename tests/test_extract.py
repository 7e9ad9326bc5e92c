import pytest

from logquarry.functions import extract as E
from logquarry.operators.extraction import extract_columns, line_id
from tests.lines import AHREFS, ALL, ANDROID, BLANK_REFERER, EMPTY, GARBAGE, HTTP2, LONG_AGENT, PUT, by_id, frame


@pytest.fixture(scope="module")
def loose(spark):
    return {ALL[i]: r for i, r in by_id(extract_columns(frame(spark, ALL), "loose")).items()}


@pytest.fixture(scope="module")
def strict(spark):
    return {ALL[i]: r for i, r in by_id(extract_columns(frame(spark, ALL), "strict")).items()}


def test_client(loose, strict):
    assert loose[AHREFS].clientip == strict[AHREFS].clientip == "54.36.149.41"
    assert loose[GARBAGE].clientip == "garbage"
    assert strict[GARBAGE].clientip == ""
    assert loose[EMPTY].clientip == strict[EMPTY].clientip == ""


def test_time(loose, strict):
    for rows in (loose, strict):
        assert rows[AHREFS].datetime_confirmed == "22/Jan/2019:03:56:14"
        assert rows[GARBAGE].datetime_confirmed == ""


def test_method(loose):
    methods = [loose[x].method_GET for x in (AHREFS, ANDROID, HTTP2, PUT, GARBAGE)]
    assert methods == ["GET", "POST", "HEAD", "", ""]


def test_method_is_the_first_anywhere(spark):
    lines = frame(spark, ['1.2.3.4 "PUT /x HTTP/1.1" "HEAD then GET"'])
    assert lines.select(E.extract_field("value", "method_GET")).first()[0] == "HEAD"


def test_request(loose):
    assert loose[ANDROID].request == ' /image/1 HTTP/1.1"'
    assert loose[HTTP2].request == ""


def test_status(loose, strict):
    assert (loose[ANDROID].status_code, strict[ANDROID].status_code) == (" 404 ", "404")


def test_size(loose, strict):
    assert loose[AHREFS].size == strict[AHREFS].size == "30577"
    assert loose[PUT].size == strict[PUT].size == ""


def test_referer(loose, strict):
    assert loose[ANDROID].referer == '"https://www.z.ir/m/1"'
    assert strict[ANDROID].referer == "://www.z.ir/m/1"
    for line in (AHREFS, HTTP2, BLANK_REFERER):
        assert loose[line].referer == strict[line].referer == ""


def test_user_agent(loose, strict):
    assert loose[ANDROID].user_agent == '"Mozilla/5.0 (Linux; Android 6.0'
    assert loose[HTTP2].user_agent == ""
    assert strict[BLANK_REFERER].user_agent == 'Mozilla/5.0 (Windows NT 6.2; Win64) Gecko" '
    assert strict[LONG_AGENT].user_agent == LONG_AGENT
    assert len(LONG_AGENT) == 40_012


@pytest.mark.parametrize(
    "agent,device",
    [
        ("Mozilla/5.0 (Linux; Android 6.0; ALE) Gecko", "Linux; Android 6.0"),
        ("Mozilla/5.0 (Windows NT 6.2; Win64) Gecko", "Windows NT 6.2"),
        ("Mozilla/5.0 (compatible; bingbot/2.0; +x)", "compatible; bingbot/2.0;"),
        ("curl/7.0", ""),
    ],
)
def test_device(spark, agent, device):
    df = spark.createDataFrame([(agent,)], "user_agent string")
    assert df.select(E.extract_device("user_agent")).first()[0] == device


def test_line_id_is_unique_and_kept(spark):
    lines = spark.range(1000).selectExpr("cast(id as string) value").repartition(7)
    numbered = line_id(lines)
    assert numbered.columns == ["id", "value"]
    assert numbered.select("id").distinct().count() == 1000
    assert line_id(numbered) is numbered
