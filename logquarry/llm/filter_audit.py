"""How filters interact: what each removes in every order they can be applied in.

Each document has a mask of the filters that it fails. Per part of the corpus the masks are
counted into a decision diagram: a level for each filter, a low edge to those that pass it and
a high edge to those that fail, equal sub-diagrams shared, each node with the counts of what
reaches the leaves below it. On the path of all passes, a node's low and high edge say what
the filter keeps and removes at that step. Swapping adjacent levels turns one order into the
next; by such swaps the diagram goes through all orders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import attach, stored, table

FILTERS = "ABCDE"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = b"#$%&*|"
_FOLLOWING = bytes(range(0x80, 0xC0))

Counts = tuple[int, ...]


def few_words(data: bytes, words: list[bytes]) -> bool:
    return len(words) < 100


def repeated_words(data: bytes, words: list[bytes]) -> bool:
    return 100 * len(set(words)) < 80 * len(words)


def capitals(data: bytes, words: list[bytes]) -> bool:
    points = len(data.translate(None, _FOLLOWING))
    return 100 * (len(data) - len(data.translate(None, _UPPER))) > 10 * points


def marks(data: bytes, words: list[bytes]) -> bool:
    return len(data.translate(None, _MARKS)) < len(data)


#: What a text alone decides, in the order of FILTERS; the last one is the copies.
CONDITIONS: tuple[Callable[[bytes, list[bytes]], bool], ...] = (few_words, repeated_words, capitals, marks)


class Diagram:
    """A count-weighted decision diagram over the bits of masks; ``order`` has the top level first.

    Nothing reaches the node EMPTY, which may stand at any level.
    """

    EMPTY = 0

    def __init__(self, counts: dict[int, Counts], levels: int):
        self.order = list(range(levels))
        width = len(next(iter(counts.values())))
        self.weight: list[Counts] = [(0,) * width]
        self.edges: list[tuple[int, int]] = [(self.EMPTY, self.EMPTY)]
        self.unique: list[dict[tuple[int, int], int]] = [{} for _ in self.order]
        leaves: dict[Counts, int] = {}
        at = {}
        for mask, found in counts.items():
            if any(found):
                if found not in leaves:
                    leaves[found] = self._add((self.EMPTY, self.EMPTY), found)
                at[mask] = leaves[found]
        for level in reversed(self.order):
            bit = 1 << level
            at = {
                rest: self._node(self.unique[level], at.get(rest, self.EMPTY), at.get(rest | bit, self.EMPTY))
                for rest in {mask & ~bit for mask in at}
            }
        self.root = at.get(0, self.EMPTY)

    def _add(self, edges: tuple[int, int], weight: Counts) -> int:
        self.edges.append(edges)
        self.weight.append(weight)
        return len(self.edges) - 1

    def _node(self, unique: dict[tuple[int, int], int], low: int, high: int) -> int:
        if low == high == self.EMPTY:
            return self.EMPTY
        if (low, high) not in unique:
            both = zip(self.weight[low], self.weight[high], strict=True)
            unique[low, high] = self._add((low, high), tuple(a + b for a, b in both))
        return unique[low, high]

    def swap(self, level: int) -> None:
        """Exchanges ``level`` and the one below. Nodes of ``level`` keep their place and weight."""
        upper, lower = {}, {}
        for (low, high), node in self.unique[level].items():
            (a, b), (c, d) = self.edges[low], self.edges[high]
            self.edges[node] = self._node(lower, a, c), self._node(lower, b, d)
            upper[self.edges[node]] = node
        self.unique[level : level + 2] = [upper, lower]
        self.order[level : level + 2] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, Counts, Counts]]:
        """Along the path of all passes: filter, counts kept, counts removed."""
        node = self.root
        for bit in self.order:
            low, high = self.edges[node]
            yield bit, self.weight[low], self.weight[high]
            node = low

    def reaching(self, mask: int) -> Counts:
        """The counts of one mask."""
        node = self.root
        for bit in self.order:
            node = self.edges[node][mask >> bit & 1]
        return self.weight[node]


def plain_changes(n: int) -> Iterator[int]:
    """Levels to swap, one after the other, to go through all orders of ``n``."""
    order, left = list(range(n)), [True] * n
    while True:
        for value in reversed(range(n)):
            at = order.index(value)
            to = at - 1 if left[value] else at + 1
            if 0 <= to < n and order[to] < value:
                break
        else:
            return
        order[at], order[to] = order[to], order[at]
        for larger in range(value + 1, n):
            left[larger] = not left[larger]
        yield min(at, to)


_AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long,"
    " unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def audit_part(part: str, counts: dict[int, Counts], filters: Sequence[str]) -> pd.DataFrame:
    """A row for each order and step from the counts (documents, good, toxic) by mask."""
    diagram = Diagram(counts, len(filters))
    rows: list[list] = []

    def read() -> None:
        name = "".join(filters[bit] for bit in diagram.order)
        for step, (bit, kept, removed) in enumerate(diagram.steps(), 1):
            rows.append([part, name, step, bit, kept[0], *removed])

    read()
    for level in plain_changes(len(filters)):
        diagram.swap(level)
        read()
    out = pd.DataFrame(
        rows, columns=["part", "filter_order", "step", "bit", "kept", "removed", "good_lost", "toxic_lost"]
    )
    fails = out[out["step"] == 1].groupby("bit")["removed"].first()
    out["redundant"] = out["bit"].map(fails) - out["removed"]
    out["unique_fails"] = out["bit"].map({bit: diagram.reaching(1 << bit)[0] for bit in range(len(filters))})
    out["shapley"] = out.groupby("bit")["removed"].transform("sum")
    return out[[c.split()[0] for c in _AUDIT.split(",")]]


def audit(failed: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """All orders and steps per part from ``failed`` (part, mask, good, toxic), a row per document.

    Bit k of ``mask`` says that filter k fails; ``good`` and ``toxic`` are booleans. A null
    part is the empty string. Rows are counted by part and mask before they move, so a part's
    task has 2 ** len(filters) rows at most. No rows give no parts.
    """
    number = lambda c: F.sum(F.coalesce(F.col(c).cast("long"), F.lit(0))).alias(c)
    part = F.coalesce("part", F.lit("")).alias("part")
    counted = failed.groupBy(part, "mask").agg(F.count(F.lit(1)).alias("n"), number("good"), number("toxic"))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        found = group[["mask", "n", "good", "toxic"]].astype(int).to_numpy().tolist()
        return audit_part(key[0], {mask: tuple(counts) for mask, *counts in found}, filters)

    return counted.groupBy("part").applyInPandas(run, _AUDIT)


def failure_masks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    conditions: Sequence[Callable[[bytes, list[bytes]], bool]] = CONDITIONS,
) -> DataFrame:
    """``(doc_id, part, mask)`` for every row; the bit beyond the ``conditions`` is for copies.

    A row is a copy if a smaller id in the whole table has an identical text. Rows that repeat
    the smallest id are no copies of each other; a null id is neither smaller nor larger. A null
    text is an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column(2).cast(pa.binary()):
                data = value.as_py() or b""
                words = data.split()
                masks.append(sum(1 << k for k, fails in enumerate(conditions) if fails(data, words)))
                digests.append(hashlib.sha256(data).digest())
            columns = [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "digest"])

    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(part_col).cast("string").alias("part"),
        F.col(text_col).alias("text"),
    )
    rows = stored(read.mapInArrow(run, "doc_id long, part string, mask int, digest binary"), "masks")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = stored(firsts.filter("n > 1"), "firsts")
    judged = attach(rows, firsts, ["digest"], max(1, rows.count()), how="left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * (1 << len(conditions))
    return judged.select("doc_id", "part", (F.col("mask") + copy).alias("mask"))


def labelled(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``failed`` with ``good`` and ``toxic``; of labels that repeat an id, one says so or none does."""
    said = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    said = said.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return failed.join(said, "doc_id", "left")


def op13_filter_diagrams(spark, sf_dir: str) -> DataFrame:
    failed = failure_masks(table(spark, sf_dir, "documents"))
    return audit(labelled(failed, table(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
  FROM t),
l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, failed),
c(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT a.x || b.x || g.x || d.x || e.x AS filter_order
  FROM c AS a, c AS b, c AS g, c AS d, c AS e WHERE len(list_distinct([a.x, b.x, g.x, d.x, e.x])) = 5),
s AS (
  SELECT filter_order, CAST(i AS INTEGER) AS step, substr(filter_order, i, 1) AS x,
    '[' || substr(filter_order, 1, i - 1) || '-]' AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6)) AS i FROM o)),
r AS (
  SELECT part, filter_order, step, x, n, good, toxic, failed,
    regexp_matches(failed, earlier) AS gone, contains(failed, x) AS fails
  FROM s, m),
a AS (
  SELECT part, filter_order, step, x,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (gone AND fails), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (failed = x), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS BIGINT) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM a
"""
