"""Log lines as messages for a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_message_payload(lines: DataFrame, line_end: str = "\n") -> DataFrame:
    """One column ``value``: the line, with its line end, as a JSON string."""
    listed = F.to_json(F.array(F.concat("value", F.lit(line_end))))
    # Without the brackets of the one-element array.
    return lines.select(F.substr(listed, F.lit(2), F.length(listed) - 2).alias("value"))


def write_messages(
    lines: DataFrame,
    topic: str,
    options: dict[str, str],
    fmt: str = "kafka",
) -> None:
    """Send every line to ``topic``; servers and security settings go into ``options``.

    Tasks send their own lines, so throughput grows with the partitions.
    """
    payload = to_message_payload(lines)
    payload.write.format(fmt).options(**options).option("topic", topic).mode("append").save()
