"""Strings in CSV files, so that what is read is what was written.

NULL is written as a mark, quotes are doubled and blanks are kept; all values are quoted, as
readers skip lines that look blank. The few strings that no reader would give back are coded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CSV_OPTIONS = {
    "nullValue": r"\N",
    "quote": '"',
    "escape": '"',
    "quoteAll": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


#: Strings that readers would take for something else: NULL's mark, that of coded ones, and
#: all with a line end or the character 0.
_ODD = r"^\\[NE]|[\n\r\x00]"


def marked(text: Column) -> Column:
    return F.when(F.rlike(text, F.lit(_ODD)), F.concat(F.lit(r"\E"), F.base64(text.cast("binary")))).otherwise(text)


def unmarked(text: Column) -> Column:
    coded = F.startswith(text, F.lit(r"\E"))
    return F.when(coded, F.unbase64(F.substr(text, F.lit(3))).cast("string")).otherwise(text)
