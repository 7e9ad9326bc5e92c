"""Combined-format log lines made from the ``events`` test table.

One expression, read by Spark and by the checking engine alike. The number in ``props``
picks odd lines: garbage, blank, other methods and protocols, missing sizes, and so on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.sources.readers import spread_rows

# {k}: the number in props. {time}: the log time. {str}: the engine's string type.
LINE_SQL = """
CASE k WHEN 0 THEN 'garbage' WHEN 1 THEN '' ELSE
  CASE k WHEN 2 THEN 'localhost' WHEN 3 THEN '-'
         ELSE '10.0.' || CAST(user_id % 3 AS {str}) || '.' || CAST(user_id % 20 AS {str}) END
  || ' - - [' || CASE k WHEN 4 THEN '31/Feb/2024:10:00:00' ELSE {time} END || ' +0000] "'
  || CASE WHEN k = 5 THEN 'PUT' WHEN event_type = 'purchase' THEN 'POST'
          WHEN event_type = 'signup' THEN 'HEAD' ELSE 'GET' END
  || ' /' || event_type || '/' || CAST(event_id AS {str})
  || CASE WHEN k % 2 = 0 THEN '?v=%2C1-2&w=3.5' ELSE '?=a|b,c#d$e' END
  || CASE k WHEN 6 THEN ' HTTP/2.0" ' ELSE ' HTTP/1.1" ' END
  || CASE event_type WHEN 'error' THEN '404' ELSE '200' END || ' '
  || CASE k WHEN 7 THEN '-' ELSE CAST(event_id * 37 AS {str}) END || ' "'
  || CASE WHEN k = 8 THEN 'http://www.example.com' WHEN k = 9 THEN 'https://www.example.com/a b'
          WHEN user_id % 3 = 0 THEN 'https://www.example.com/' || event_type ELSE '-' END || '" "'
  || CASE WHEN k = 10 THEN 'Dalvik/2.1.0 (Linux; U; Android 7.1.1; SM-J510)'
          WHEN k = 11 THEN 'torob/1.0 (GET; x 1.0)' WHEN k = 12 THEN 'Googlebot/2.1 (+x)'
          WHEN user_id % 3 = 0 THEN 'Mozilla/5.0 (Linux; Android 6.0; ALE) Gecko'
          WHEN user_id % 3 = 2 THEN 'curl/7.0'
          WHEN k % 2 = 0 THEN 'Mozilla/5.0 (compatible; bingbot/2.0; +x)'
          ELSE 'Mozilla/5.0 (Windows NT 6.2; Win64) Gecko' END || '" "-"' END
"""


def event_lines(spark: SparkSession, sf_dir: str, on_the_hour: bool = False) -> DataFrame:
    """``id`` and ``value`` for every event; ``on_the_hour`` makes repeated requests common.

    The table can be one row group, so its narrow rows are dealt out over the cores first.
    """
    clock = "HH:00:00" if on_the_hour else "HH:mm:ss"
    line = LINE_SQL.format(time=f"date_format(ts, 'dd/MMM/yyyy:{clock}')", str="STRING")
    events = spread_rows(
        spark.read.parquet(f"{sf_dir}/events.parquet").select(
            "event_id", "ts", "user_id", "event_type", "props"
        ),
        spark.sparkContext.defaultParallelism,
    )
    return events.withColumn("k", F.regexp_extract("props", "[0-9]+", 0).cast("int")).select(
        F.col("event_id").alias("id"), F.expr(line).alias("value")
    )
