"""Pattern tables for combined-format access-log lines.

Two families exist. ``strict`` anchors the client and fixes digit counts; ``loose``
takes the first token and any digit run. Each table maps a raw-layer column to
``(pattern, group)``; a line that does not match gives ``''``.

Where a shape is quoted beside an entry, the entry finds the same strings. ``safe`` ones
replace a shape that backtracks so much that one client-controlled line of many kilobytes
could stall or crash a task; they gain nothing on ordinary lines. ``faster`` ones look for
the first letter of a word before they try it. ``tests/test_patterns.py`` compares them with
their shapes on random lines and times them on hostile ones.
"""

# Patterns and groups that decide the results.
STRICT_FIELDS = {
    # safe; shape: (^\S+\.[\S+\.]+\S+)\s
    "clientip": (r"^(\S[^\s.]*\.\S{2,})\s", 1),
    "datetime_confirmed": (r"(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2})", 1),
    # faster; shape: GET|POST|HEAD
    "method_GET": (r"(?=[GPH])(?:GET|POST|HEAD)", 0),
    "request": (r'\s\S+\sHTTP/1.1"', 0),
    "status_code": (r"\s(\d{3})\s", 1),
    "size": (r'\s(\d+)\s"', 1),
    "referer": (r'("https(\S+)")', 2),
    # safe and faster; shape: (Mozilla|Dalvik|Goog|torob|Bar)(\S+\s+)*
    "user_agent": (r"(?=[MDGtB])(?:Mozilla|Dalvik|Goog|torob|Bar)(?:\S(?s:.*)\s)?", 0),
}

LOOSE_FIELDS = {
    "clientip": (r"([\S+\.]+)", 1),
    # safe; shape: (\d+/\w+/\d+[:\d]+)
    "datetime_confirmed": (r"(?<!\d)(\d++/\w++/\d+[:\d]+)", 1),
    # faster; shape: GET|POST|HEAD
    "method_GET": (r"(?=[GPH])(?:GET|POST|HEAD)", 0),
    "request": (r'\s\S+\sHTTP/1.1"', 0),
    "status_code": (r"\s\d{3}\s", 0),
    "size": (r'\s(\d+)\s"', 1),
    "referer": (r'("https(\S+)")', 1),
    # safe; shape: "(Mozilla|Dalvik|Goog|torob|Bar).\d\S+\s\((\S\w+;?\s\S+(\s\d\.(\d\.)?\d)?)
    # A run of non-blanks is looked at once: is it followed by a bracket and what must come
    # in it? Only then is a keyword looked for. The one character after a keyword can also be
    # a blank, and then the next run is the one that counts.
    "user_agent": (
        r'(?:(?<!\S)(?=\S++\s\(\S\w++;?+\s\S)\S*?(?="(?:Mozilla|Dalvik|Goog|torob|Bar)[^\s\x85\u2028\u2029]\d\S)'
        r'|(?="(?:Mozilla|Dalvik|Goog|torob|Bar)[ \t\x0B\f]\d))'
        r'("(?:Mozilla|Dalvik|Goog|torob|Bar).\d\S++\s\(\S\w++;?+\s\S+(?:\s\d\.(?:\d\.)?\d)?)',
        1,
    ),
}

# Applied to an extracted user agent, not to the line. safe, as above;
# shape: (Mozilla|Dalvik|Goog|torob|Bar).\d\S+\s\((\S\w+;?\s\S+(\s\d\.(\d\.)?\d)?), group 2
DEVICE = (
    r"(?:(?<!\S)(?=\S++\s\(\S\w++;?+\s\S)\S*?(?=(?:Mozilla|Dalvik|Goog|torob|Bar)[^\s\x85\u2028\u2029]\d\S)"
    r"|(?=(?:Mozilla|Dalvik|Goog|torob|Bar)[ \t\x0B\f]\d))"
    r"(?:Mozilla|Dalvik|Goog|torob|Bar).\d\S++\s\((\S\w++;?+\s\S+(?:\s\d\.(?:\d\.)?\d)?)",
    1,
)

# Removed from the request. In the first, "-& is a range: " # $ % &.
REQUEST_CHARS = r'[%,|"-&.=?-]'
REQUEST_TOKENS = r"%|-|\?="

TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"
TIME_FORMAT_12H = "dd/MMM/yyyy:hh:mm:ss"
METHODS = ("GET", "POST", "HEAD")
MISSING = "NA"

FAMILIES = {"strict": STRICT_FIELDS, "loose": LOOSE_FIELDS}
