"""Column functions that pull one field out of a log line.

All of them are JVM-side ``regexp_extract`` calls, so a query that needs two fields
pays for two patterns: the others are pruned with their columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logquarry.functions.patterns import DEVICE, FAMILIES


def extract_field(line: Column | str, field: str, family: str = "loose") -> Column:
    """The raw-layer column ``field`` of a line, ``''`` where nothing matches.

    ==================  =====================================================================
    clientip            strict: a dotted first token before a blank; loose: any first token
    datetime_confirmed  the time without its zone, so it stays local wall clock
    method_GET          the first GET, POST or HEAD anywhere in the line
    request             the path with its leading blank and trailing ``HTTP/1.1"``
    status_code         three digits between blanks; loose keeps the blanks
    size                the response size in bytes
    referer             an https referer: loose the quoted URL, strict what follows ``https``
    user_agent          strict: from the keyword to the last blank; loose: up to the platform
    ==================  =====================================================================
    """
    pattern, group = FAMILIES[family][field]
    return F.regexp_extract(line, pattern, group)


def extract_device(user_agent: Column | str) -> Column:
    """The platform inside a user agent's parentheses, e.g. ``Linux; Android 6.0``."""
    pattern, group = DEVICE
    return F.regexp_extract(user_agent, pattern, group)
