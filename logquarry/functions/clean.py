"""Column functions that clean one extracted field.

Bad input gives NULL rather than an error, with ANSI mode on or off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logquarry.functions.patterns import MISSING, REQUEST_CHARS, REQUEST_TOKENS, TIME_FORMAT

#: Blanks and control characters, what plain CSV readers trim.
_WHITESPACE = "".join(map(chr, range(0x21)))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_request_chars(request: Column | str) -> Column:
    """Drop the characters ``" # $ % & , - . = ? |``."""
    return F.regexp_replace(request, REQUEST_CHARS, "")


def strip_request_tokens(request: Column | str) -> Column:
    """Drop ``%``, ``-`` and the pair ``?=``."""
    return F.regexp_replace(request, REQUEST_TOKENS, "")


def size_to_kb(size: Column | str, digits: int = 0) -> Column:
    """Bytes to kilobytes, rounded half up; NULL if ``size`` is not a number."""
    return F.round(_col(size).try_cast("double") / 1024, digits)


def first_token(text: Column | str) -> Column:
    """The part before the first blank: cuts the zone off a time."""
    return F.split(text, " ")[0]


def parse_timestamp(text: Column | str, fmt: str = TIME_FORMAT) -> Column:
    """Wall-clock time as ``timestamp_ntz``; NULL if the text does not fit ``fmt``.

    The text is read as UTC and rebuilt from its epoch seconds. A plain cast to
    ``timestamp_ntz`` would move times inside the session zone's daylight-saving gap.
    """
    instant = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{fmt} xx"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(instant), epoch)


def request_day(time: Column | str) -> Column:
    return F.to_date(time)


def request_hour(time: Column | str) -> Column:
    return F.hour(time)


def day_hour(day: Column | str, hour: Column | str) -> Column:
    """``2019-01-28 3``: the hour is not padded; NULL if the time is."""
    return F.concat(_col(day).cast("string"), F.lit(" "), _col(hour).cast("string"))


def dash_null(text: Column | str) -> Column:
    """``-`` means nothing was logged."""
    return F.nullif(_col(text), F.lit("-"))


def empty_na(text: Column | str) -> Column:
    return F.when(_col(text) == "", F.lit(MISSING)).otherwise(_col(text))


def blank_null(text: Column | str) -> Column:
    """Trim blanks and control characters, then NULL if nothing is left."""
    return F.nullif(F.trim(_col(text), F.lit(_WHITESPACE)), F.lit(""))


def referer_present(referer: Column | str) -> Column:
    """``Y`` if a referer was logged; NULL, ``''`` and ``NA`` all mean it was not."""
    r = _col(referer)
    return F.when(r.isNull() | r.isin("", MISSING), "N").otherwise("Y")


def method_marker(method: Column | str, name: str) -> Column:
    """The method where it equals ``name``, else NULL: made to be counted."""
    return F.when(_col(method) == name, F.lit(name))
