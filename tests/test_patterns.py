"""The tuned patterns find what their plain shapes find, and survive hostile lines."""

import random
import time

import pytest
from pyspark.sql import functions as F

from logquarry.functions.extract import extract_device, extract_field
from logquarry.functions.patterns import FAMILIES
from logquarry.operators.augment import perturb_every_nth

SHAPES = {
    ("strict", "clientip"): (r"(^\S+\.[\S+\.]+\S+)\s", 1),
    ("strict", "user_agent"): (r"(Mozilla|Dalvik|Goog|torob|Bar)(\S+\s+)*", 0),
    ("strict", "method_GET"): (r"GET|POST|HEAD", 0),
    ("loose", "datetime_confirmed"): (r"(\d+/\w+/\d+[:\d]+)", 1),
    ("loose", "method_GET"): (r"GET|POST|HEAD", 0),
    ("loose", "user_agent"): (
        r'"(Mozilla|Dalvik|Goog|torob|Bar).\d\S+\s\((\S\w+;?\s\S+(\s\d\.(\d\.)?\d)?)',
        0,
    ),
    ("agent", "device"): (
        r"(Mozilla|Dalvik|Goog|torob|Bar).\d\S+\s\((\S\w+;?\s\S+(\s\d\.(\d\.)?\d)?)",
        2,
    ),
}
PIECES = [
    "Mozilla", "Dalvik", "Goog", "torob", "Bar", "GET", "POST", "HEAD", "POS", "G", "M", "B", "t",
    "1", "22", "Jan", "/", ":", ".", "..", "a", "é", " ", "  ", "\t", "-", '"', "(", ";", "+", "2019",
    "22/Jan/2019:03:56:14", "1.2.3.4", "5.0 ", "1/2/3", " ",
]
AGENT_PIECES = [
    '"Mozilla', '"Bar', "Mozilla", "torob", "/5.0", " 5", "5", "\t1", "\u20281", "\x0b7", "x", " (", " (", "(",
    "Linux; ", "ab; U", "a b", ";", " ", " 6.0", " 1.2.3", "é", "\n", "\x85", '"Goog/2.1 (Linux; U', " (ab c",
]


def _random_lines(n, seed=7, pieces=PIECES):
    rng = random.Random(seed)
    return ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(n)]


def _found(family, field):
    return extract_device("value") if family == "agent" else extract_field("value", field, family)


@pytest.mark.parametrize("family,field", SHAPES)
def test_same_as_shape(spark, family, field):
    pattern, group = SHAPES[family, field]
    pieces = AGENT_PIECES if "(Mozilla" in pattern else PIECES
    lines = _random_lines(20_000) + _random_lines(20_000, pieces=pieces)
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    got = _found(family, field)
    want = F.regexp_extract("value", pattern, group)
    rows = df.select("value", got.alias("got"), want.alias("want"))
    assert rows.where("want != ''").count() > 500
    assert rows.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == []


HOSTILE = {
    "dotted token": "a." * 50_000,
    "digits": "1" * 30_000,
    "many tokens": "Mozilla/5.0 " + "a " * 200_000,
    "slashes": "1/a" * 40_000,
    "quotes": '"' * 50_000,
    "blanks": " " * 50_000,
    "keywords in one run": '"Mozilla/5' * 100_000,
    "keywords, then a bracket": '"Mozilla/5' * 100_000 + " (",
    "keywords, then a device": '"Mozilla/5' * 100_000 + " (Linux; U",
    "keywords and blanks": '"Mozilla 5' * 100_000,
    "brackets": '"Mozilla/5 (' * 80_000,
    "open brackets": '"Mozilla/5. (' + "a" * 1_000_000,
    "requests": " /a" * 300_000,
    "referers": '"https' * 150_000,
    "numbers": " 1" * 400_000,
}


@pytest.mark.parametrize("family", FAMILIES)
def test_hostile_lines_finish(spark, family):
    df = spark.createDataFrame([(line,) for line in HOSTILE.values()], "value string")
    begin = time.time()
    fields = [F.length(extract_field("value", name, family)) for name in FAMILIES[family]]
    fields.append(F.length(extract_device("value")))
    assert df.select(fields).count() == len(HOSTILE)
    df.select(fields).collect()
    assert time.time() - begin < 60


def test_hostile_lines_can_be_varied(spark):
    lines = [*HOSTILE.values(), "1." * 400_000, " " * 400_000 + "1", "1" * 900_000 + " a b ["]
    df = spark.createDataFrame([(9, line) for line in lines], "line_no bigint, value string")
    begin = time.time()
    assert perturb_every_nth(df).where("length(value) > 0").count() == len(lines)
    assert time.time() - begin < 60
