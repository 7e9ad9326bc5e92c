"""The registered queries again, as SQL for the checking engine.

Written from the definitions, not generated from the Spark code: patterns stand in their
plain shapes here, and duplicates, first hours and distinct clients are found by other means.
"""

from __future__ import annotations

from logquarry.sources.event_lines import LINE_SQL

_LINE_COLUMNS = [
    "clientip", "datetime_confirmed", "method_GET", "request",
    "status_code", "size", "referer", "user_agent",
]
_STRINGS_RAW = [c for c in _LINE_COLUMNS if c != "size"]
_STRINGS_CLEANSED = [c for c in _STRINGS_RAW if c not in ("datetime_confirmed", "status_code")]

# The two pattern families.
_DEVICE = r"(Mozilla|Dalvik|Goog|torob|Bar).\d\S+\s\((\S\w+;?\s\S+(\s\d\.(\d\.)?\d)?)"
_PATTERNS = {
    "strict": [
        (r"(^\S+\.[\S+\.]+\S+)\s", 1), (r"(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2})", 1),
        (r"GET|POST|HEAD", 0), (r'\s\S+\sHTTP/1.1"', 0), (r"\s(\d{3})\s", 1),
        (r'\s(\d+)\s"', 1), (r'("https(\S+)")', 2), (r"(Mozilla|Dalvik|Goog|torob|Bar)(\S+\s+)*", 0),
    ],
    "loose": [
        (r"([\S+\.]+)", 1), (r"(\d+/\w+/\d+[:\d]+)", 1),
        (r"GET|POST|HEAD", 0), (r'\s\S+\sHTTP/1.1"', 0), (r"\s\d{3}\s", 0),
        (r'\s(\d+)\s"', 1), (r'("https(\S+)")', 1), (r'"(Mozilla|Dalvik|Goog|torob|Bar).\d\S+\s\((\S\w+;?\s\S+(\s\d\.(\d\.)?\d)?)', 0),
    ],
}


def _steps(**ctes: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in ctes.items())


def _lines(on_the_hour: bool = False) -> str:
    clock = "%H:00:00" if on_the_hour else "%H:%M:%S"
    line = LINE_SQL.format(time=f"strftime(ts, '%d/%b/%Y:{clock}')", str="VARCHAR")
    return (
        f"SELECT event_id AS id, {line} AS value FROM (SELECT *, "
        "CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k FROM events) e"
    )


def _extract(family: str) -> str:
    fields = ", ".join(
        f"regexp_extract(value, '{pattern}', {group}) AS {name}"
        for name, (pattern, group) in zip(_LINE_COLUMNS, _PATTERNS[family])
    )
    return f"SELECT id, {fields} FROM lines"


def _change(source: str, **changes: str) -> str:
    listed = ", ".join(f"{sql} AS {name}" for name, sql in changes.items())
    return f"SELECT * REPLACE ({listed}) FROM {source}"


def _each(names: list[str], template: str) -> dict[str, str]:
    return {name: template.format(name) for name in names}


_DASH = "NULLIF({0}, '-')"
_EMPTY_NA = "CASE WHEN {0} = '' THEN 'NA' ELSE {0} END"
_FILL = "COALESCE({0}, 'NA')"
_BLANK = "NULLIF(trim({0}), '')"
_CHARS = """regexp_replace(request, '[%,|"-&.=?-]', '', 'g')"""
_TOKENS = r"regexp_replace(request, '%|-|\?=', '', 'g')"
_KB = "round(TRY_CAST(size AS DOUBLE) / 1024, {0})"
_TIME = "CAST(try_strptime(split_part(datetime_confirmed, ' ', 1), '%d/%b/%Y:%H:%M:%S') AS TIMESTAMP)"
_FLAG = """CASE WHEN referer IS NULL OR referer IN ('', 'NA') THEN 'N' ELSE 'Y' END"""
_FIRST_ROW = "QUALIFY row_number() OVER (PARTITION BY clientip, datetime_confirmed, method_GET ORDER BY id) = 1"


def _layers(profile: str, on_the_hour: bool = False) -> dict[str, str]:
    family = "loose" if profile in ("loose", "distinct") else "strict"
    ctes = {"lines": _lines(on_the_hour), "extracted": _extract(family)}
    if profile == "typed":
        ctes["raw"] = "SELECT * FROM extracted"
        ctes["typed"] = _change(
            "raw",
            datetime_confirmed=_TIME,
            status_code="TRY_CAST(status_code AS INTEGER)",
            size="TRY_CAST(size AS BIGINT)",
        )
    else:
        ctes["kept"] = "SELECT * FROM extracted " + (_FIRST_ROW if profile == "distinct" else "")
        ctes["stripped"] = _change(
            "kept",
            request=_TOKENS if profile == "strict" else _CHARS,
            size=_KB.format(2 if profile == "strict" else 0),
        )
        ctes["raw"] = _change(
            "stripped", **_each(_STRINGS_RAW, _EMPTY_NA if profile == "distinct" else _DASH)
        )
        ctes["unblanked"] = _change("raw", **_each(_STRINGS_RAW, _BLANK))
        ctes["parsed"] = _change(
            "unblanked", datetime_confirmed=_TIME, status_code="TRY_CAST(status_code AS INTEGER)"
        )
        filled = {} if profile == "strict" else _each(_STRINGS_CLEANSED, _FILL)
        ctes["typed"] = _change("parsed", **filled) if filled else "SELECT * FROM parsed"
    ctes["cleansed"] = f'SELECT *, {_FLAG} AS "referer_present(Y/N)" FROM typed'
    ctes["curated"] = "SELECT * EXCLUDE (referer) FROM cleansed"
    return ctes


def _layer_query(profile: str, select: str, on_the_hour: bool = False, **more: str) -> str:
    return _steps(**_layers(profile, on_the_hour), **more) + " " + select


def _field_query(select: str, family: str = "loose") -> str:
    return _steps(lines=_lines(), extracted=_extract(family)) + " " + select


def _counts(prefix: str = "") -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE method_GET = '{m}') AS {prefix}{m.lower()}"
        for m in ("GET", "POST", "HEAD")
    )


_DAY_HOUR = (
    "strftime(datetime_confirmed, '%Y-%m-%d') || ' ' || CAST(hour(datetime_confirmed) AS VARCHAR)"
)
_SUM_HOURS = "CAST(sum(hour(datetime_confirmed)) AS BIGINT)"

_PER_CLIENT_HOUR = (
    f"SELECT {_DAY_HOUR} AS day_hour, clientip, count(*) AS count_row, {_counts()} "
    "FROM curated GROUP BY 1, 2"
)
_HOURLY_ACROSS = (
    f"SELECT {_DAY_HOUR} AS day_hour, count(clientip) AS no_of_clients, count(*) AS count_row, "
    f"{_counts()} FROM curated GROUP BY 1"
)
_HOURLY_DISTINCT = (
    "SELECT day_hour, CAST(max(n) AS BIGINT) AS no_of_clients, max(n) AS id, max(n) AS no_get, "
    "max(n) AS no_post, max(n) AS no_head FROM (SELECT day_hour, "
    "count(DISTINCT clientip) AS n FROM (SELECT "
    f"{_DAY_HOUR} AS day_hour, clientip FROM curated) GROUP BY 1) GROUP BY 1"
)
_PER_DEVICE = (
    f"SELECT regexp_extract(user_agent, '{_DEVICE}', 2) AS device, {_counts()}, "
    f"{_SUM_HOURS} AS hour, count(clientip) AS no_of_client FROM curated GROUP BY 1"
)
_TOTALS = (
    f"SELECT {_counts('no_')}, {_SUM_HOURS} AS day_hour, count(clientip) AS no_of_clients, "
    "CAST(0 AS BIGINT) AS row_id FROM curated"
)
_FIRST_HOUR = (
    "SELECT count(DISTINCT coalesce(clientip, '')) AS no_get, "
    "count(DISTINCT coalesce(clientip, '')) AS no_post, "
    "count(DISTINCT coalesce(clientip, '')) AS no_head, "
    "CAST(arg_min_null(hour(datetime_confirmed), id) AS INTEGER) AS day_hour, "
    "count(DISTINCT clientip) AS no_of_clients, CAST(0 AS BIGINT) AS row_id FROM curated"
)

_PER_CLIENT = (
    f"SELECT clientip, {_counts()}, CAST(arg_min_null(hour(datetime_confirmed), id) AS INTEGER) AS hour, "
    "count(clientip) AS no_of_client FROM curated GROUP BY 1"
)
_AGGREGATE_SIZES = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM ({sql})"
    for name, sql in {
        "per_device": _PER_DEVICE,
        "per_client": _PER_CLIENT,
        "hourly_per_client": _PER_CLIENT_HOUR,
        "across_totals": _TOTALS,
        "across_first_hour": _FIRST_HOUR,
        "hourly_across": _HOURLY_ACROSS,
        "hourly_distinct": _HOURLY_DISTINCT,
    }.items()
)

# --- augmentation ----------------------------------------------------------------------

_SHAPE = r"^( *(?:[^ ]*\.)?)(\d+)( [^ ]* [^ ]* \[)(\d{2})(/[^ :]*:)(\d{2})(.*)$"
_PIECES = (
    "SELECT *, regexp_matches(value, '{0}') AS fits, "
    + ", ".join(f"regexp_extract(value, '{{0}}', {i}) AS p{i}" for i in range(1, 8))
    + " FROM {1}"
)
_GET_TO_POST = "regexp_replace(value, 'GET', 'POST')"


def _numbered() -> dict[str, str]:
    return {"lines": _lines(), "seed": "SELECT id AS line_no, value FROM lines"}


def _copies(passes: int) -> str:
    return f"SELECT CAST(n AS BIGINT) AS pass_no, line_no, value FROM seed CROSS JOIN range({passes}) r(n)"


def _perturbed(step: int) -> dict[str, str]:
    return {
        "pieces": _PIECES.format(_SHAPE, "seed"),
        "shifted": (
            "SELECT line_no, CASE WHEN (line_no + 1) % 10 = 0 AND fits THEN p1 "
            f"|| CAST(CAST(p2 AS BIGINT) + {step} AS VARCHAR) || p3 || p4 || p5 || CASE WHEN p6 < '10' "
            f"THEN lpad(CAST(CAST(p6 AS INTEGER) + {step} AS VARCHAR), 2, '0') ELSE p6 END || p7 "
            "ELSE value END AS value FROM pieces"
        ),
        "perturbed": (
            f"SELECT line_no, CASE WHEN (line_no + 1) % 9 = 0 THEN {_GET_TO_POST} ELSE value END "
            "AS value FROM shifted"
        ),
    }


def _ramped(passes: int) -> dict[str, str]:
    return {
        "copies": _copies(passes),
        "pieces": _PIECES.format(_SHAPE, "copies"),
        "moved": (
            "SELECT pass_no, line_no, CASE WHEN line_no < 10 AND fits THEN p1 "
            "|| CAST(CAST(p2 AS BIGINT) + pass_no AS VARCHAR) || p3 || CASE WHEN p4 >= '10' "
            "THEN CAST(least(31, CAST(p4 AS INTEGER) + pass_no) AS VARCHAR) ELSE p4 END || p5 "
            "|| lpad(CAST(least(23, CAST(p6 AS INTEGER) + pass_no) AS VARCHAR), 2, '0') || p7 "
            "ELSE value END AS value FROM pieces"
        ),
        "ramped": (
            f"SELECT pass_no, line_no, CASE WHEN line_no < 10 AND pass_no >= 1 THEN {_GET_TO_POST} "
            "ELSE value END AS value FROM moved"
        ),
    }


def _ramp_hourly() -> str:
    steps = _layers("loose")
    lines = {"events_lines": steps.pop("lines"), "seed": "SELECT id AS line_no, value FROM events_lines"}
    grown = {**_ramped(5), "lines": "SELECT 0 AS id, value FROM ramped"}
    return _steps(**lines, **grown, **steps) + " " + _HOURLY_DISTINCT


_JSON_LINE = "CAST(to_json(value || chr(10)) AS VARCHAR) AS value"
_MARKERS = ", ".join(
    f"CASE WHEN method_GET = '{m}' THEN '{m}' END AS no_{m.lower()}" for m in ("GET", "POST", "HEAD")
)
_WAREHOUSE = (
    "SELECT id, clientip, datetime_confirmed, method_GET, status_code, size, user_agent, "
    '"referer_present(Y/N)" AS referer_present FROM curated'
)
_NULL_COUNTS = ", ".join(f"count(*) - count({c}) AS {c}" for c in ["id", *_LINE_COLUMNS])
_HOURLY_DEDUPED = _layer_query("distinct", _HOURLY_ACROSS, on_the_hour=True)
_CLEANSED = _layer_query("loose", "SELECT * FROM cleansed")
_CURATED = _layer_query("loose", "SELECT * FROM curated")

ORACLES = {
    "hourly_across": _HOURLY_DEDUPED,
    "read_lines": _steps(lines=_lines()) + " SELECT value FROM lines",
    "numbered_lines": _steps(lines=_lines())
    + " SELECT row_number() OVER (ORDER BY id) - 1 AS line_no, value FROM lines",
    "row_count": _layer_query(
        "distinct",
        "SELECT 'lines' AS layer, count(*) AS n_rows FROM lines UNION ALL "
        "SELECT 'raw', count(*) FROM raw UNION ALL "
        f"SELECT 'per_client', count(*) FROM ({_PER_CLIENT_HOUR}) UNION ALL "
        f"SELECT 'across', count(*) FROM ({_HOURLY_ACROSS})",
        on_the_hour=True,
    ),
    "extract_loose": _field_query("SELECT * FROM extracted"),
    "extract_strict": _field_query("SELECT * FROM extracted", "strict"),
    "device": _field_query(
        f"SELECT id, user_agent, regexp_extract(user_agent, '{_DEVICE}', 2) AS device FROM extracted",
        "strict",
    ),
    "line_id_unique": "SELECT count(*) AS n_ids, count(*) AS n_distinct FROM events",
    "strip_chars": _field_query(f"SELECT id, {_CHARS} AS request FROM extracted"),
    "strip_tokens": _field_query(f"SELECT id, {_TOKENS} AS request FROM extracted"),
    "size_kb0": _field_query(f"SELECT id, {_KB.format(0)} AS size FROM extracted"),
    "size_kb2": _field_query(f"SELECT id, {_KB.format(2)} AS size FROM extracted"),
    "dash_null": _field_query(_change("extracted", **_each(_LINE_COLUMNS, _DASH))),
    "empty_na": _field_query(_change("extracted", **_each(_LINE_COLUMNS, _EMPTY_NA))),
    "fill_na": _field_query(
        _change("extracted", **_each(_LINE_COLUMNS, _FILL.format(_DASH)))
    ),
    "blank_null": _field_query(_change("extracted", **_each(_LINE_COLUMNS, _BLANK))),
    "null_profile": _layer_query("loose", f"SELECT {_NULL_COUNTS} FROM unblanked"),
    "parse_time": _field_query(f"SELECT id, {_TIME} AS datetime_confirmed FROM extracted"),
    "parse_time_12h": _field_query(
        # Hour 12 without a half of the day is midnight.
        "SELECT id, CASE WHEN hour(t) = 12 THEN t - INTERVAL 12 HOUR ELSE t END AS datetime_confirmed "
        "FROM (SELECT id, CAST(try_strptime(datetime_confirmed, '%d/%b/%Y:%I:%M:%S') AS TIMESTAMP) AS t "
        "FROM extracted)"
    ),
    "first_token": _steps(lines=_lines()) + " SELECT id, split_part(value, ' ', 1) AS token FROM lines",
    "typed": _field_query(
        "SELECT id, TRY_CAST(status_code AS INTEGER) AS status_code, "
        "TRY_CAST(size AS BIGINT) AS size FROM extracted",
        "strict",
    ),
    "referer_flag": _field_query(f'SELECT id, referer, {_FLAG} AS "referer_present(Y/N)" FROM extracted'),
    "markers_hours": _layer_query(
        "loose",
        f"SELECT id, datetime_confirmed, method_GET, {_MARKERS}, "
        "strftime(datetime_confirmed, '%Y-%m-%d') AS day, CAST(hour(datetime_confirmed) AS INTEGER) AS hour, "
        f"{_DAY_HOUR} AS day_hour FROM curated",
    ),
    "curated_columns": _layer_query("loose", f"SELECT id, clientip, {_MARKERS} FROM curated"),
    "warehouse_cols": _layer_query("loose", _WAREHOUSE),
    "raw_loose": _layer_query("loose", "SELECT * FROM raw"),
    "raw_strict": _layer_query("strict", "SELECT * FROM raw"),
    "raw_typed": _layer_query("typed", "SELECT * FROM raw"),
    "raw_distinct": _layer_query("distinct", "SELECT * FROM raw", on_the_hour=True),
    "cleansed": _CLEANSED,
    "cleansed_strict": _layer_query("strict", "SELECT * FROM cleansed"),
    "cleansed_typed": _layer_query("typed", "SELECT * FROM cleansed"),
    "cleansed_distinct": _layer_query("distinct", "SELECT * FROM cleansed", on_the_hour=True),
    "curated": _CURATED,
    "layers_published": _HOURLY_DEDUPED,
    "layers_raw": _layer_query("distinct", "SELECT * FROM raw", on_the_hour=True),
    "layers_cleansed": _layer_query("distinct", "SELECT * FROM cleansed", on_the_hour=True),
    "layers_curated": _layer_query("distinct", "SELECT * FROM curated", on_the_hour=True),
    "layers_hourly_per_client": _layer_query("distinct", _PER_CLIENT_HOUR, on_the_hour=True),
    "layers_hourly_distinct": _layer_query("distinct", _HOURLY_DISTINCT, on_the_hour=True),
    "layers_per_device": _layer_query("distinct", _PER_DEVICE, on_the_hour=True),
    "layers_per_client": _layer_query("distinct", _PER_CLIENT, on_the_hour=True),
    "layers_across_totals": _layer_query("distinct", _TOTALS, on_the_hour=True),
    "layers_across_first_hour": _layer_query("distinct", _FIRST_HOUR, on_the_hour=True),
    "layers_csv_typed": _layer_query("typed", _PER_DEVICE),
    "layers_by_day": _layer_query(
        "strict", "SELECT *, strftime(datetime_confirmed, '%Y-%m-%d') AS day FROM curated"
    ),
    "aggregates_cached": _layer_query("typed", _AGGREGATE_SIZES),
    "dedup": _steps(lines=_lines(on_the_hour=True), extracted=_extract("loose"))
    + f" SELECT * FROM extracted {_FIRST_ROW}",
    "per_device": _layer_query("typed", _PER_DEVICE),
    "per_client": _layer_query("strict", _PER_CLIENT),
    "hourly_per_client": _layer_query("distinct", _PER_CLIENT_HOUR, on_the_hour=True),
    "across_totals": _layer_query("typed", _TOTALS),
    "across_first_hour": _layer_query("strict", _FIRST_HOUR),
    "hourly_across_all": _layer_query("loose", _HOURLY_ACROSS),
    "hourly_rollup": _HOURLY_DEDUPED,
    "hourly_distinct": _layer_query("loose", _HOURLY_DISTINCT),
    "replicate": _steps(**_numbered()) + " " + _copies(3),
    "replicate_spread": _steps(**_numbered()) + " " + _copies(5),
    "perturb_nth": _steps(**_numbered(), **_perturbed(1)) + " SELECT * FROM perturbed",
    "ramp_seed": _steps(**_numbered(), **_ramped(5)) + " SELECT * FROM ramped",
    "ramp_hourly": _ramp_hourly(),
    "passes": (
        "SELECT count(*) AS seed_rows, CAST(floor(300000 / count(*)) AS BIGINT) AS passes FROM events"
    ),
    "fixed_passes": (
        "SELECT event_id AS line_no, CAST(1000 AS BIGINT) AS n_lines, CAST(0 AS BIGINT) AS first_pass, "
        "CAST(999 AS BIGINT) AS last_pass FROM events"
    ),
    "seed_to_log": _steps(
        lines=_lines(), seed="SELECT row_number() OVER (ORDER BY id) - 1 AS line_no, value FROM lines", **_perturbed(3)
    )
    + " SELECT value FROM seed UNION ALL SELECT value FROM perturbed",
    "layer_csv": _CLEANSED,
    "layer_parquet": _CLEANSED,
    "table_default": _CURATED,
    "table_orc": _layer_query("typed", _PER_DEVICE),
    "table_orc_totals": _layer_query("typed", _TOTALS),
    "catalog_databases": (
        "SELECT 'logquarry' AS database, count(*) AS n_tables FROM (VALUES ('per device'), ('across'))"
    ),
    "few_files": _layer_query("typed", f"SELECT *, 1 AS n_files FROM ({_PER_DEVICE})"),
    "catalog_tables": _layer_query(
        "typed",
        f"SELECT 'log_agg_per_device' AS tableName, count(*) AS n_rows FROM ({_PER_DEVICE}) "
        f"UNION ALL SELECT 'log_agg_across_device', count(*) FROM ({_TOTALS})",
    ),
    "connector": _layer_query("loose", _WAREHOUSE),
    "append_text": _steps(**_numbered(), **_perturbed(1))
    + " SELECT value FROM seed UNION ALL SELECT value FROM perturbed",
    "payload": _steps(lines=_lines()) + f" SELECT {_JSON_LINE} FROM lines",
    "messages": _steps(**_numbered(), **_ramped(2)) + f" SELECT {_JSON_LINE} FROM ramped",
}
