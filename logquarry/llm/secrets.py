"""Secrets in texts: three fixed shapes, and strings that a battery of tests finds random.

A string of 16 or more letters, digits, ``+/_-`` is a candidate. Its encoding is inferred
(hexadecimal, base 32, upper case and digits, base 64) and three tests ask whether it is
uniform noise in that alphabet: chi-squared over the symbols, runs above and below the
middle, and serial correlation of neighbours. Being short also lets ordinary words pass, so
each candidate gets a p-value against ordinary strings of the corpus: how often kinds of
characters change in it, and how seldom its symbols repeat. These are weighted by length,
and a false-discovery rate over all candidates of the corpus decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import attach, stored, table

#: The shapes that always count, with the group and length that they need.
KINDS = {
    "assign": (
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
RANDOM = r"[A-Za-z0-9+/_-]{16,}={0,2}"
#: Share of false discoveries among the candidates called random.
FALSE_SHARE = 0.001
#: Standard deviations that a test allows uniform noise.
NOISE_LIMIT = 4.0
#: Ordinary strings are taken to change the kind of character at least and at most so often.
CHANGES = (0.002, 0.05)
_BINS = 6_000
_ALPHABETS = {"hex": 16, "base32": 32, "upper": 36, "base64": 64}


def _matches(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Per match: what lies before it since the last one, its length, that of its group."""
    regex = F.lit(pattern)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    part = F.regexp_extract_all(text, regex, F.lit(group)) if group else whole
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), part.alias("part")
    )
    found = F.transform(
        zipped,
        lambda x: F.struct(
            F.lit(kind).alias("kind"),
            F.char_length(x["gap"]).alias("gap"),
            F.char_length(x["whole"]).alias("length"),
            F.char_length(x["part"]).alias("needed"),
            # Only candidates are needed as strings.
            F.when(F.lit(kind == "random"), x["whole"]).alias("token"),
        ),
    )
    return F.when(F.rlike(text, regex), found).otherwise(F.slice(found, 1, 0))


def find_matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(row, doc_id, kind, begin, end, needed, token)``, code points; one null for rows without any."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = [_matches(F.col("text"), k, p, g) for k, (p, g, _) in KINDS.items()]
    read = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), text.alias("text")
    )
    found = read.select(
        "row", "doc_id", F.posexplode_outer(F.concat(*kinds, _matches(F.col("text"), "random", RANDOM, 0)))
    ).select("row", "doc_id", "pos", "col.*")
    # Kinds follow each other in the array, so matches of a kind are in order of place.
    until = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.coalesce("length", F.lit(0))).over(until)
    return stored(
        found.select(
            "row", "doc_id", "kind", (end - F.col("length")).alias("begin"), end.alias("end"), "needed", "token"
        ),
        "matches",
    )


def _digest(token: str) -> Column:
    return F.sha2(token, 256)


def _battery(tokens: DataFrame) -> DataFrame:
    """Per candidate's ``id`` its length, alphabet and test statistics, without trailing ``=``.

    Characters travel with the id: candidates can be as long as a text.
    """
    body = F.rtrim(F.col("token"), F.lit("="))
    encoding = (
        F.when(body.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(body.rlike("^([A-Z2-7]+|[a-z2-7]*[2-7][a-z2-7]*)$"), "base32")
        .when(body.rlike("^[A-Z0-9]+$"), "upper")
        .otherwise("base64")
    )
    size = F.create_map(*[F.lit(x) for pair in _ALPHABETS.items() for x in pair])[F.col("encoding")]
    code = lambda c: F.ascii(F.col(c))
    # Symbols as numbers from 0, in the order digits, letters, others.
    number = lambda c: (
        F.when(code(c).between(48, 57), code(c) - 48)
        .when(code(c).between(97, 122), code(c) - 87)
        .when(code(c).between(65, 90) & F.col("encoding").isin("hex", "base32", "upper"), code(c) - 55)
        .when(code(c).between(65, 90), code(c) - 29)
        .otherwise(62 + code(c) % 2)
    )
    kind = lambda c: (
        F.when(code(c).between(48, 57), 0).when(code(c).between(97, 122), 1).when(code(c).between(65, 90), 2).otherwise(3)
    )
    letters = F.split(body, "")
    chars = (
        tokens.withColumn("encoding", encoding)
        .withColumn("k", size)
        .select(
            "id",
            "encoding",
            "k",
            F.explode(F.arrays_zip(letters.alias("c"), F.slice(letters, 2, F.char_length("token")).alias("d"))).alias("x"),
        )
        .select("id", "encoding", "k", "x.c", "x.d")
        .filter("c <> ''")
    )
    has = F.col("d").isNotNull() & (F.col("d") != "")
    x, y = number("c"), number("d")
    middle = F.when(F.col("encoding") == "base32", F.lit(18)).otherwise(F.expr("k div 2"))
    by_char = chars.groupBy("id", "encoding", "k", "c").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(has & (kind("c") != kind("d")), 1).otherwise(0)).alias("changes"),
        F.sum(F.when(has & ((x < middle) != (y < middle)), 1).otherwise(0)).alias("turns"),
        F.sum(F.when(has, x * y).otherwise(0)).alias("xy"),
        F.sum(F.when(has, y).otherwise(0)).alias("y"),
        F.sum(F.when(has, x).otherwise(0)).alias("first"),
        F.sum(x).alias("x"),
        F.sum(x * x).alias("xx"),
        F.sum(F.when(x < middle, 1).otherwise(0)).alias("low"),
    )
    sums = {c: F.sum(c).alias(c) for c in ("n", "changes", "turns", "xy", "y", "first", "x", "xx", "low")}
    return by_char.groupBy("id", "encoding", "k").agg(
        *sums.values(), F.sum(F.col("n") * F.col("n")).alias("squares")
    )


def _noise(stats: DataFrame) -> DataFrame:
    """Adds ``noise``: no test of uniform noise in the inferred alphabet fails."""
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    chi = (k / n * F.col("squares") - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    p = F.col("low") / n
    runs = (F.col("turns") - 2 * (n - 1) * p * (1 - p)) / F.sqrt((n - 1) * F.greatest(p * (1 - p), F.lit(0.01)))
    mean, spread = F.col("x") / n, F.col("xx") / n - (F.col("x") / n) * (F.col("x") / n)
    lagged = F.col("xy") - mean * (F.col("y") + F.col("first")) + (n - 1) * mean * mean
    serial = F.when(spread > 0, lagged / (n * spread) * F.sqrt(n)).otherwise(F.lit(99.0))
    fine = [F.abs(z) <= NOISE_LIMIT for z in (chi, runs, serial)]
    return stats.withColumn("noise", fine[0] & fine[1] & fine[2])


def _ordinary(stats: DataFrame) -> DataFrame:
    """Adds ``p``, a bound of the chance that an ordinary string looks like this."""
    usual = stats.agg(
        (F.sum("changes") / F.greatest(F.sum(F.col("n") - 1), F.lit(1))).alias("changes"),
        (F.sum(F.col("squares") - F.col("n")) / F.greatest(F.sum(F.col("n") * (F.col("n") - 1)), F.lit(1))).alias("repeats"),
    ).first()
    q = min(max(usual["changes"] or 0.0, CHANGES[0]), CHANGES[1])
    s = min(max(usual["repeats"] or 0.0, 0.03), 0.12)
    n = F.col("n").cast("double")
    r = F.least(F.greatest(F.col("changes") / (n - 1), F.lit(q)), F.lit(1 - 1e-9))
    # Chernoff's bound for so many changes of the kind of character.
    change = (n - 1) * (r * F.log(r / q) + (1 - r) * F.log((1 - r) / (1 - q)))
    pairs = n * (n - 1) / 2
    few = ((F.col("squares") - n) / 2 - pairs * s) / F.sqrt(pairs * s * (1 - s) * 2)
    rare = F.when(few < 0, few * few / 2).otherwise(F.lit(0.0))
    # Fisher's sum of two logarithms, exact for independent tests.
    total = change + rare
    return stats.withColumn("log_p", -total + F.log1p(total))


def random_strings(matches: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """``(id, n)``: digests of the candidates called random, and in how many places they are."""
    tokens = matches.filter("kind = 'random' and token is not null").groupBy("token").agg(
        F.count(F.lit(1)).alias("places")
    )
    tokens = stored(tokens.withColumn("id", _digest("token")), "tokens")
    stats = stored(_battery(tokens), "stats")
    judged = _ordinary(_noise(stats))
    total = stats.agg(F.count(F.lit(1)).alias("m"), F.avg("n").alias("length")).first()
    if not total["m"]:
        return tokens.select("id", F.col("places").alias("n")).limit(0)
    # Long candidates carry more evidence and get more of the error: weights with mean 1.
    weighted = judged.withColumn("log_q", F.col("log_p") - F.log(F.col("n") / F.lit(total["length"])))
    # Benjamini and Hochberg over bins of log p, each taken at its larger end.
    bin_ = F.least(F.floor(-F.col("log_q") * 100), F.lit(_BINS)).cast("int")
    weighted = weighted.withColumn("bin", F.greatest(bin_, F.lit(0)))
    bins = weighted.filter("noise").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    passing = (
        # One row per bin, _BINS at most.
        bins.withColumn("k", F.sum("n").over(above))
        .filter(-F.col("bin") / 100 <= F.log(F.col("k") * false_share / total["m"]))
        .agg(F.min("bin").alias("bin"))
        .first()
    )
    least = passing["bin"] if passing["bin"] is not None else _BINS + 1
    called = weighted.filter((F.col("bin") >= least) & F.col("noise")).select("id")
    return stored(called.join(tokens, "id").select("id", F.col("places").alias("n")), "random")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)`` per row: ``kind, begin, end`` by begin, then assign, access, hex, random.

    Ends are exclusive, places count code points. The first three kinds are the fixed shapes,
    each found from the left without overlap; a match that is too short is dropped and hides
    what it covers. A null or empty text has no spans. Rows that repeat an id stay apart.
    """
    matches = find_matches(docs, id_col, text_col)
    random = random_strings(matches)
    needed = F.create_map(*[F.lit(x) for k, (_, _, n) in KINDS.items() for x in (k, n)])
    fixed = matches.filter(F.col("kind").isNull() | (F.col("kind") != "random")).withColumn(
        "good", F.coalesce(F.col("needed") >= needed[F.col("kind")], F.lit(False))
    )
    others = matches.filter("kind = 'random'").withColumn("id", _digest("token")).drop("token")
    total = max(1, others.count())
    added = attach(others, random.withColumn("good", F.lit(True)), ["id"], total, how="left")
    order = F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "random")]), F.col("kind"))
    span = F.struct("begin", order.alias("order"), "end", "kind")
    columns = ["row", "doc_id", F.when(F.col("good"), span).alias("span")]
    spans = fixed.select(*columns).unionByName(added.select(*columns))
    return (
        spans.groupBy("row", "doc_id")
        .agg(F.sort_array(F.collect_list("span")).alias("spans"))
        .select("doc_id", "spans")
    )


def op7_randomness_battery(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    line = lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [number(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
    )
