"""Growing a seed log.

Generated lines change one field and keep the rest of the text. Expansion is an
``explode``: rows multiply where they are, without a join.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The pieces of a line that can be varied: client up to its last octet, that octet, the
# two fields after it, day, month and year, hour, and the rest.
_PARTS = r"^( *(?:[^ ]*\.)?)(\d+)( [^ ]* [^ ]* \[)(\d{2})(/[^ :]*:)(\d{2})([\s\S]*)$"
_PART_NAMES = ["head", "octet", "middle", "day", "month", "hour", "rest"]


def replicate_log(lines: DataFrame, passes: int, partitions: int | None = None) -> DataFrame:
    """Every line ``passes`` times, with its 0-based ``pass_no`` in front.

    A line becomes about sqrt(passes) blocks and each block as many copies, so no array
    of all passes is ever held. By default a task expands its own lines, which suits a
    log that is already spread out. A small seed sits in one task: ``partitions`` deals
    out its blocks before they are expanded.
    """
    if passes < 1:
        return lines.select(F.lit(0).cast("bigint").alias("pass_no"), *lines.columns).where(F.lit(False))
    stride = isqrt(passes - 1) + 1
    blocks = -(-passes // stride)
    dealt = lines.select(_sequence(F.lit(0), F.lit(blocks)).alias("block_no"), *lines.columns)
    if partitions is not None:
        dealt = dealt.repartition(partitions)
    start = F.col("block_no") * stride
    end = F.least(start + stride, F.lit(passes).cast("bigint"))
    return dealt.select(_sequence(start, end).alias("pass_no"), *lines.columns)


def _sequence(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start.cast("bigint"), end.cast("bigint") - 1))


def perturb_every_nth(
    lines: DataFrame,
    step: int = 1,
    shift_every: int = 10,
    post_every: int = 9,
) -> DataFrame:
    """Vary lines by their place in the seed (``line_no``, 0-based).

    Every tenth line: last client octet and hour go up by ``step``. Every ninth: its
    first ``GET`` becomes ``POST``. Only hours 00 to 09 move, so with a step from 0 to 14
    none passes midnight; other steps are refused.
    """
    if not 0 <= step <= 14:
        raise ValueError(f"step is {step}, not from 0 to 14")
    nth = F.col("line_no") + 1
    hour = F.col("hour").cast("int")
    return _vary(
        lines,
        touched=nth % shift_every == 0,
        octet=_add(F.col("octet"), F.lit(step)),
        day=F.col("day"),
        hour=F.when(hour < 10, _two_digits(hour + step)).otherwise(F.col("hour")),
        to_post=nth % post_every == 0,
    )


def ramp_seed_lines(lines: DataFrame, passes: int, partitions: int | None = None) -> DataFrame:
    """``passes`` copies of the seed whose first ten lines drift with ``pass_no``.

    In pass k their last client octet goes up by k, their hour by k up to 23 and their
    day by k up to 31 (two-digit days only, from the 10th on); from pass 1 on their first
    ``GET`` becomes ``POST``.
    """
    k = F.col("pass_no")
    day = F.col("day").cast("int")
    first_ten = F.col("line_no") < 10
    return _vary(
        replicate_log(lines, passes, partitions),
        touched=first_ten,
        octet=_add(F.col("octet"), k),
        day=F.when(day >= 10, _two_digits(F.least(day + k, F.lit(31)))).otherwise(F.col("day")),
        hour=_two_digits(F.least(F.col("hour").cast("int") + k, F.lit(23))),
        to_post=first_ten & (k >= 1),
    )


def _vary(
    lines: DataFrame, touched: Column, octet: Column, day: Column, hour: Column, to_post: Column
) -> DataFrame:
    # Only touched lines are taken apart. On the others, and on those of another shape,
    # the pieces are NULL, so is their concat, and coalesce keeps the text.
    fits = touched & F.col("value").rlike(_PARTS)
    pieces = {
        name: F.when(fits, F.regexp_extract("value", _PARTS, i))
        for i, name in enumerate(_PART_NAMES, 1)
    }
    varied = F.concat("head", octet, "middle", day, "month", hour, "rest")
    return (
        lines.withColumns(pieces)
        .withColumn("value", F.coalesce(varied, "value"))
        .withColumn("value", F.when(to_post, first_get_to_post("value")).otherwise(F.col("value")))
        .select(lines.columns)
    )


def _two_digits(number: Column) -> Column:
    """Numbers below 10 get a zero; nothing is ever cut."""
    text = number.cast("string")
    return F.when(number.between(0, 9), F.concat(F.lit("0"), text)).otherwise(text)


_TAIL = 17  # Digits that are added as a number.


def _add(digits: Column, number: Column) -> Column:
    """``digits`` plus ``number`` (below 10 ** _TAIL, not negative) as text, however long it is."""
    long = F.char_length(digits) > _TAIL
    tail = F.when(long, F.right(digits, F.lit(_TAIL))).otherwise(digits).cast("bigint") + number
    head = F.left(digits, F.char_length(digits) - _TAIL)
    carried = tail >= 10**_TAIL
    # One more at the end of the head: its last nines become noughts.
    nines = F.char_length(F.regexp_extract(head, "9*$", 0))
    kept = F.left(head, F.char_length(head) - nines - 1)
    turned = F.coalesce(F.substr(head, F.char_length(head) - nines, F.lit(1)).try_cast("int"), F.lit(0)) + 1
    all_nines = nines == F.char_length(head)
    raised = F.concat(
        F.when(all_nines, F.lit("1")).otherwise(F.concat(kept, turned.cast("string"))), F.repeat(F.lit("0"), nines)
    )
    low = F.lpad((tail % 10**_TAIL).cast("string"), _TAIL, "0")
    joined = F.concat(F.when(carried, raised).otherwise(head), low)
    return F.when(long, F.regexp_replace(joined, "^0+(?=.)", "")).otherwise(tail.cast("string"))


def first_get_to_post(line: Column | str) -> Column:
    """The line with its first ``GET``, wherever it stands, turned into ``POST``."""
    text = F.col(line) if isinstance(line, str) else line
    at = F.instr(text, "GET")
    return F.when(at > 0, F.overlay(text, F.lit("POST"), at, F.lit(3))).otherwise(text)


def passes_for(lakhs: int, seed_rows: int) -> int:
    """Passes over a seed that give ``lakhs`` × 100,000 lines, rounded down."""
    return lakhs * 100_000 // seed_rows


def passes_per_lakh(lakhs: int) -> int:
    """Passes of the fixed-rate generator: 1,000 per lakh, whatever the seed's size."""
    return lakhs * 1_000


def measure_passes(seed: DataFrame, lakhs: int) -> DataFrame:
    """One row, ``seed_rows`` and ``passes``: :func:`passes_for` over a seed's own size."""
    return seed.agg(F.count(F.lit(1)).alias("seed_rows")).select(
        "seed_rows",
        F.expr(f"{lakhs * 100_000}L div nullif(seed_rows, 0L)").alias("passes"),
    )
