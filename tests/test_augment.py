import re

import pytest

from logquarry.operators import augment as G
from logquarry.operators.aggregate import hourly_distinct_clients
from logquarry.plans.layers import curate
from logquarry.plans.profiles import LOOSE
from tests.test_aggregate import line


def numbered(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "line_no bigint, value string")


def text(df):
    return [r.value for r in df.orderBy("pass_no", "line_no").collect()] if "pass_no" in df.columns else [
        r.value for r in df.orderBy("line_no").collect()
    ]


SHAPE = re.compile(r"( *(?:[^ ]*\.)?)(\d+)( [^ ]* [^ ]* \[)(\d\d)(/[^ :]*:)(\d\d)(.*)", re.S)
LINES = [
    line(f"10.0.{i}.{i * 9}", f"{1 + i:02}/Jan/2019:{i % 24:02}:0{i % 10}:00") for i in range(28)
] + ["garbage", "", "GET GET", "localhost - - [22/Jan/2019:03:00:00 +0000] \"GET /", " 9.9.9.9 a b [05/Jan/2019:09:09:09 x] GET"]


def varied(value, octet=0, day=0, hour=0, top_hour=23):
    found = SHAPE.fullmatch(value)
    if not found:
        return value
    head, last, middle, dd, month, hh, rest = found.groups()
    new_day = f"{min(31, int(dd) + day):02}" if int(dd) >= 10 else dd
    new_hour = f"{min(top_hour, int(hh) + hour):02}"
    return f"{head}{int(last) + octet}{middle}{new_day}{month}{new_hour}{rest}"


@pytest.mark.parametrize("passes", [0, 1, 2, 3, 5, 10, 17])
@pytest.mark.parametrize("partitions", [None, 3])
def test_replicate(spark, passes, partitions):
    got = G.replicate_log(numbered(spark, ["a", "b", "b"]), passes, partitions)
    assert got.columns == ["pass_no", "line_no", "value"]
    want = [(k, n, v) for k in range(passes) for n, v in enumerate(["a", "b", "b"])]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_replicate_spreads_a_one_task_seed(spark):
    seed = numbered(spark, ["x"] * 10).coalesce(1)
    grown = G.replicate_log(seed, 10_000, partitions=8)
    sizes = [r["count"] for r in grown.selectExpr("spark_partition_id() p").groupBy("p").count().collect()]
    assert sum(sizes) == 100_000
    assert len(sizes) == 8 and max(sizes) < 1.5 * min(sizes)


def test_perturb_every_nth(spark):
    lines = LINES * 4
    want = []
    for n, value in enumerate(lines, 1):
        if n % 10 == 0:
            found = SHAPE.fullmatch(value)
            move = 1 if found and int(found[6]) < 10 else 0
            value = varied(value, octet=1, hour=move)
        if n % 9 == 0:
            value = value.replace("GET", "POST", 1)
        want.append(value)
    assert text(G.perturb_every_nth(numbered(spark, lines))) == want


@pytest.mark.parametrize("step", [0, 3, 14])
def test_steps_keep_lines_legal(spark, step):
    lines = [""] * 9 + [line("1.1.1.9", "22/Jan/2019:09:09:09")]
    got = text(G.perturb_every_nth(numbered(spark, lines), step))[-1]
    assert got == line(f"1.1.1.{9 + step}", f"22/Jan/2019:{9 + step:02}:09:09")


@pytest.mark.parametrize("step", [-5, 15, 20, 95])
def test_other_steps_are_refused(spark, step):
    with pytest.raises(ValueError, match="step"):
        G.perturb_every_nth(numbered(spark, LINES), step)


def test_octets_of_any_length(spark):
    octets = [
        "0", "7", "007", "9" * 16, "9" * 17, "9" * 18, "9" * 19, "9" * 40, "1" + "0" * 30, "12" + "9" * 25,
        "0" * 20, "0" * 20 + "5", "3" * 500, "5" + "9" * 17, "10" + "9" * 17,
    ]
    rows = [(9, line(f"1.2.3.{o}", "22/Jan/2019:15:09:09")) for o in octets]
    df = spark.createDataFrame(rows, "line_no bigint, value string")
    for step in (0, 1, 14):
        got = [r.value.split(" ")[0].split(".")[-1] for r in G.perturb_every_nth(df, step).collect()]
        assert got == [str(int(o) + step) for o in octets]


def test_nine_becomes_ten(spark):
    lines = [""] * 9 + [line("1.1.1.1", "22/Jan/2019:09:09:09")]
    got = text(G.perturb_every_nth(numbered(spark, lines)))[-1]
    assert got == line("1.1.1.2", "22/Jan/2019:10:09:09")


@pytest.mark.parametrize("partitions", [None, 4])
def test_ramp(spark, partitions):
    lines = LINES[24:] + LINES[:20]
    want = []
    for k in range(30):
        for n, value in enumerate(lines):
            if n < 10:
                value = varied(value, octet=k, day=k, hour=k)
                if k >= 1:
                    value = value.replace("GET", "POST", 1)
            want.append(value)
    assert text(G.ramp_seed_lines(numbered(spark, lines), 30, partitions)) == want


def test_ramp_rebuilds_the_known_hours(spark):
    """940 passes over 319 lines whose first ten hold five clients."""
    seed = [line(f"5.5.5{n % 5}.{n % 5}", "22/Jan/2019:03:56:14") for n in range(10)]
    seed += [line("5.5.50.0", "22/Jan/2019:03:56:14")] * 309
    grown = G.ramp_seed_lines(numbered(spark, seed), G.passes_for(3, len(seed)), partitions=8)
    hours = {r.day_hour: r for r in hourly_distinct_clients(curate(grown.select("value"), LOOSE)).collect()}
    assert len(hours) == 21
    assert tuple(hours["2019-01-31 23"])[1:] == (4600,) * 5
    assert tuple(hours["2019-01-25 6"])[1:] == (5,) * 5


def test_passes(spark):
    assert G.passes_for(3, 319) == 940
    assert G.passes_per_lakh(3) == 3000
    seed = spark.range(319)
    assert tuple(G.measure_passes(seed, 3).first()) == (319, 940)
    assert tuple(G.measure_passes(seed.limit(0), 3).first()) == (0, None)


def test_first_get_only(spark):
    df = spark.createDataFrame([("é GET GET",), ("none",), ("GETGET",)], "value string")
    got = [r[0] for r in df.select(G.first_get_to_post("value")).collect()]
    assert got == ["é POST GET", "none", "POSTGET"]
