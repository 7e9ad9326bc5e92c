"""Hand-written log lines."""

AHREFS = (
    '54.36.149.41 - - [22/Jan/2019:03:56:14 +0330] "GET /filter/27|13%20a-b?x=1,2&y=3.5 HTTP/1.1" '
    '200 30577 "-" "Mozilla/5.0 (compatible; AhrefsBot/6.1; +http://ahrefs.com/robot/)" "-"'
)
ANDROID = (
    '31.56.96.51 - - [22/Jan/2019:13:56:16 +0330] "POST /image/1 HTTP/1.1" 404 512 '
    '"https://www.z.ir/m/1" "Mozilla/5.0 (Linux; Android 6.0; ALE-L21 Build/X) AppleWebKit/537.36" "-"'
)
HTTP2 = (
    '31.56.96.51 - - [22/Jan/2019:03:56:16 +0330] "HEAD / HTTP/2.0" 304 0 "http://www.z.ir" "curl/7.0" "-"'
)
PUT = (
    '2.177.12.140 - - [22/Jan/2019:00:01:02 +0330] "PUT /x HTTP/1.1" 200 - "-" '
    '"Dalvik/2.1.0 (Linux; U; Android 7.1.1; SM-J510)" "-"'
)
BLANK_REFERER = (
    '1.2.3.4 - - [22/Jan/2019:03:01:02 +0330] "GET /y HTTP/1.1" 200 99 "https://a.b/c d" '
    '"Mozilla/5.0 (Windows NT 6.2; Win64) Gecko" "-"'
)
GARBAGE = "garbage"
EMPTY = ""
LONG_AGENT = "Mozilla/5.0 " + 20_000 * "a "

ALL = [AHREFS, ANDROID, HTTP2, PUT, BLANK_REFERER, GARBAGE, EMPTY, LONG_AGENT]


def frame(spark, lines, partitions=None):
    """``id`` and ``value`` with the id being the place in the list."""
    df = spark.createDataFrame(list(enumerate(lines)), "id bigint, value string")
    return df.repartition(partitions) if partitions else df


def by_id(df):
    return {r["id"]: r for r in df.collect()}
