"""Mixing sources to target weights by a low-discrepancy schedule.

The documents of a source are shuffled by hash and laid end to end; blocks of equal length
cut this stream. Golden-ratio points, mapped through the cumulative weights, say which
source each slot of the mix takes from. A slot's rank within its source says which block,
so every stretch of the mix is close to the weights and a source is used evenly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import stored, table

#: Weights of the sources by code point, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated so many times at most.
MAX_PASSES = 3
BLOCK_WORDS = 256
#: Tables with a row per source are broadcast up to so many sources; beyond, they are joined by shuffles.
BROADCAST_SOURCES = 20_000
#: Rows that are ranked together; longer lists are ranked piece by piece.
PIECE_ROWS = 1_000
PIECE_SLOTS = 65_536
#: Golden ratio in 32 bits; odd, so the points run through all 2 ** 32 values.
_GOLDEN = 2_654_435_769
#: The points' range is cut into cells, four times as many as sources and no fewer than this.
_CELLS = 1_024
_WORD = r"[^\x20\x09-\x0D]+"


def sized_rows(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(_WORD)).cast("long")
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size")
    )


def _unit(sources: DataFrame, passes: int) -> float:
    """Words per weight at which the targets use up all words.

    Sources that this would give more than ``passes`` times their words are full, and what
    they leave raises it for the others, until no more of them are full.
    """
    cap = F.col("words") * passes
    unit, before = 0.0, -1
    while True:
        full = cap < F.col("weight") * F.lit(unit)
        found = sources.filter("words > 0").agg(
            F.sum("words").alias("words"),
            F.sum(F.when(full, cap).otherwise(0)).alias("used"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open"),
            F.sum(F.when(full, 1).otherwise(0)).alias("full"),
        ).first()
        if not found.open or found.full == before:
            return unit
        unit, before = (found.words - found.used) / found.open, found.full


def source_table(rows: DataFrame, weights=WEIGHTS, passes: int = MAX_PASSES, block: int = BLOCK_WORDS) -> DataFrame:
    """``(k, source, words, target, quota, blocks, slots, until)``, a row per source, stored.

    ``k`` numbers the sources by code point, null last, and they get ``weights`` in turn. The
    targets share all words by weight, none above ``passes`` times the source's. ``slots`` of
    the schedule are for the source, ``until`` are for it and those before.
    """
    last = F.col("source").isNull()
    words = rows.groupBy("source").agg(F.sum("size").alias("words"))
    ranged = words.repartitionByRange(last, "source").sortWithinPartitions(last, "source")
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "sources")
    # One row for each part.
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")))
    place = F.row_number().over(Window.partitionBy("part").orderBy(last, "source")) - 1
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int"))
    known = ranged.withColumn("place", place).join(offsets, "part").withColumn("k", F.col("offset") + F.col("place"))
    known = stored(known.select("k", "part", "source", "words", turn.alias("weight")), "sources")
    cap, due = F.col("words") * passes, F.col("weight") * F.lit(_unit(known, passes))
    target = F.when(F.col("words") == 0, 0.0).otherwise(F.least(cap.cast("double"), due))
    planned = (
        known.withColumn("target", target)
        .withColumn("quota", F.least(F.floor(F.col("target") + 0.5), cap))
        .withColumn("blocks", F.expr(f"(words + {block - 1}) div {block}"))
        .withColumn(
            "slots",
            F.expr(f"if(words > 0, quota div words * blocks + (quota % words + {block - 1}) div {block}, 0L)"),
        )
    )
    sums = planned.groupBy("part").agg(F.sum("slots").alias("n"))
    offsets = F.broadcast(sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")))
    inside = Window.partitionBy("part").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = planned.withColumn("inside", F.sum("slots").over(inside)).join(offsets, "part")
    whole = whole.withColumn("until", F.col("offset") + F.col("inside"))
    return stored(whole.select("k", "source", "words", "target", "quota", "blocks", "slots", "until"), "sources")


def _light(sources: DataFrame, count: int) -> DataFrame:
    """``sources`` to be broadcast if they are few, else as they are."""
    return F.broadcast(sources) if count <= BROADCAST_SOURCES else sources


def _schedule(sources: DataFrame) -> DataFrame:
    """``(slot, k, rank)``: the source of each slot, and the how-manieth of its source it is.

    ``sources`` (k, slots, until) have their sums of slots up to and with each of them.
    """
    spark = sources.sparkSession
    sums = sources.agg(F.count(F.lit(1)).alias("n"), F.sum("slots").alias("slots")).first()
    count, total = sums.n, sums.slots or 0
    bits = min(32, max(_CELLS - 1, 4 * count).bit_length())
    point_of = lambda n: F.expr(f"cast(cast({n} as decimal(19, 0)) * 4294967296 div {max(1, total)} as bigint)")
    width = 1 << (32 - bits)
    bounds = sources.filter("slots > 0").select("k", point_of("until - slots").alias("low"), point_of("until").alias("high"))
    numbers = F.expr(f"sequence(low div {width}, (high - 1) div {width})")
    # A row per source and per cell at most.
    cells = bounds.filter("high > low").select("k", "low", "high", F.explode(numbers).alias("cell"))
    cells = _light(cells, count)
    n = F.col("slot") % (1 << 32)
    # n * golden modulo 2 ** 32, in two halves that do not overflow.
    head = (F.shiftright(n, 16) * _GOLDEN) % (1 << 16) * (1 << 16)
    point = ((n % (1 << 16)) * _GOLDEN + head) % (1 << 32)
    drawn = (
        spark.range(total)
        .withColumnRenamed("id", "slot")
        .withColumn("point", point)
        .withColumn("cell", F.shiftright("point", 32 - bits))
        .join(cells, "cell")
        .filter("low <= point and point < high")
        .select("slot", "k", F.shiftright("slot", 16).alias("piece"))
    )
    pieces = drawn.groupBy("k", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("k").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("k", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("k", "piece").orderBy("slot")) - 1
    ranked = drawn.withColumn("place", place).join(offsets, ["k", "piece"])
    ranked = ranked.select("slot", "k", (F.col("offset") + F.col("place")).alias("rank"))
    # Points miss a source's due number by a few. Ranks beyond it go, missing ones come last.
    due = _light(sources.select("k", "slots"), count)
    late = (
        due.join(drawn.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .filter("slots > n")
        .select("k", F.explode(F.sequence("n", F.col("slots") - 1)).alias("rank"))
        .select((F.col("rank") + total).alias("slot"), "k", "rank")
    )
    return ranked.join(due, "k").filter("rank < slots").select("slot", "k", "rank").unionByName(late)


def mix(
    rows: DataFrame, weights=WEIGHTS, passes: int = MAX_PASSES, block: int = BLOCK_WORDS
) -> tuple[DataFrame, DataFrame]:
    """What a mix of ``rows`` (doc_id, source, size) takes, and the mix itself.

    The first frame has a row for each different row: its ``copies`` in the table, their
    ``source_size`` and ``target``, and ``taken``, the words taken of all copies together.
    The second has the pieces: slot, doc_id, source, size, first word within the document (of
    the copies laid end to end) and number of words. Sources by code point, null last, get
    ``weights`` in turn. Rows without words are not taken; an empty table gives none.
    """
    rows = stored(rows, "sized")
    sources = source_table(rows, weights, passes, block)
    about = _light(sources.drop("slots", "until"), sources.count())
    same = rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    keyed = same.join(about.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    pieces = -(-rows.count() // PIECE_ROWS) or 1
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "size", F.lit("mix")), 33)
    placed = stored(
        keyed.withColumn("length", F.col("size") * F.col("copies"))
        .withColumn("draw", draw)
        .withColumn("piece", F.shiftright(F.col("draw") * pieces, 31)),
        "placed",
    )
    sums = placed.groupBy("k", "piece").agg(F.sum("length").alias("n"))
    before = Window.partitionBy("k").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("k", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = (
        Window.partitionBy("k", "piece")
        .orderBy("draw", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    begin = F.col("offset") + F.sum("length").over(inside) - F.col("length")
    laid = placed.join(offsets, ["k", "piece"]).withColumn("begin", begin)
    first, last = F.col("begin"), F.col("begin") + F.col("length") - 1
    numbers = F.when(F.col("length") > 0, F.sequence(F.expr(f"begin div {block}"), F.expr(f"(begin + length - 1) div {block}")))
    cut = laid.withColumn("block", F.explode_outer(numbers))
    slots = (
        _schedule(sources)
        .join(about.select("k", "words", "quota", "blocks"), "k")
        .withColumn("block", F.col("rank") % F.col("blocks"))
        .withColumn("done", F.expr(f"(rank div blocks) * words + block * {block}"))
        .withColumn("until", F.least(F.expr(f"block * {block}") + F.least(F.lit(block), F.col("quota") - F.col("done")), "words"))
        .select("slot", "k", "block", "until")
    )
    start = F.greatest(first, F.col("block") * block)
    end = F.least(last + 1, F.col("until"), (F.col("block") + 1) * block)
    joined = cut.join(slots, ["k", "block"], "left").withColumn(
        "n", F.when(F.col("until").isNotNull(), F.greatest(end - start, F.lit(0))).otherwise(0)
    )
    taken = joined.groupBy("doc_id", "source", "size", "copies").agg(
        F.first("words").alias("source_size"),
        F.first("target").alias("target"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("taken"),
    )
    mixed = joined.filter("n > 0").select(
        "slot", "doc_id", "source", "size", (start - first).alias("first_word"), F.col("n").alias("words")
    )
    return taken, mixed


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, to the nearest whole document."""
    taken, _ = mix(sized_rows(docs, id_col, source_col, text_col))
    each = F.expr("taken div copies")
    times = F.expr("cast(t div size + if(2 * (t % size) >= size, 1, 0) as int)")
    plan = (
        taken.filter("size > 0")
        .withColumn("t", each)
        .select("doc_id", "source", "size", times.alias("times"))
        .filter("times > 0")
    )
    plan = plan.select(F.struct("doc_id", "source", "size").alias("key_"), "times")
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    fields = [F.col("row").getField(c) for c in (id_col, source_col, text_col)]
    size = F.regexp_count(F.coalesce(fields[2], F.lit("")), F.lit(_WORD)).cast("long")
    # Structs compare null to null as equal when each field is made not null.
    key = F.to_json(F.struct(fields[0].alias("doc_id"), fields[1].cast("string").alias("source"), size.alias("size")))
    plan = plan.select(F.to_json("key_").alias("key_"), "times")
    return (
        packed.withColumn("key_", key)
        .join(plan, "key_")
        .select("row", F.explode(F.sequence(F.lit(1), "times")))
        .select("row.*")
    )


def op3_golden_mix(spark, sf_dir: str) -> DataFrame:
    taken, _ = mix(sized_rows(table(spark, sf_dir, "documents"), "doc_id", "source", "text"))
    # Copies of a row share what is taken of them evenly.
    share = F.expr("taken div copies + if(copy <= taken % copies, 1, 0)")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id", "size", "source_size", "target", share.alias("taken"), "source"
    )
