"""Benchmark decontamination with Wu and Manber's search for many patterns.

Words take the place of characters. The patterns are the 10-word windows of the items, and
whole items that are shorter. Patterns of one length share a search: a shift table over
blocks of words says how far the window may move on, a suffix bucket picks the patterns
that can end here, and a direct comparison confirms them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import stored, table

WINDOW = 10
#: Bytes of item text per search. More text takes more searches, each with its own table.
SEARCH_BYTES = 2_000_000
#: Searches in one scan; what a scan has found is written before the next one begins.
SCAN_SEARCHES = 8
#: Bytes that are no letters or digits become blanks, A-Z become a-z, all others stay.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class Search:
    """Tables for patterns of one length: words, with the items that hold them."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list[str]]):
        self.length, self.patterns = length, patterns
        self.block = min(2, length)
        #: What moves on when a block is in no pattern.
        self.far = length - self.block + 1
        self.shift: dict = {}
        self.ends = defaultdict(list)
        for pattern in patterns:
            for end in range(self.block, length + 1):
                block = self._key(pattern, end)
                self.shift[block] = min(self.shift.get(block, self.far), length - end)
            self.ends[self._key(pattern, length)].append(pattern)

    def _key(self, words, end: int):
        return words[end - 1] if self.block == 1 else (words[end - 2], words[end - 1])

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """Begin and pattern of every occurrence, overlapping ones too."""
        shift, far, length, key = self.shift, self.far, self.length, self._key
        end, last = length, len(words)
        while end <= last:
            block = key(words, end)
            move = shift.get(block, far)
            if not move:
                begin = end - length
                here = words[begin:end]
                for pattern in self.ends[block]:
                    if all(map(bytes.__eq__, pattern, here)):
                        yield begin, pattern
                move = 1
            end += move


def searches(items: list[tuple[str, bytes]], window: int = WINDOW) -> list[Search]:
    """One search for each length of pattern."""
    by_length: dict = defaultdict(lambda: defaultdict(list))
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for pattern in {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else ():
            by_length[size][pattern].append(item)
    return [Search(size, dict(patterns)) for size, patterns in sorted(by_length.items())]


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def hits(words: list[bytes], tables: list[Search]) -> tuple[list[tuple[int, int]], set[str]]:
    """Disjoint word spans that are hit, and the items found."""
    spans, items = set(), set()
    for search in tables:
        for begin, pattern in search.occurrences(words):
            spans.add((begin, begin + search.length))
            items.update(search.patterns[pattern])
    return _union(list(spans)), items


def _portions(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, bytes]]]:
    """The items, one partition at a time, in portions of about SEARCH_BYTES."""
    rows = (
        benchmark.filter(F.col(text_col).isNotNull() & F.col(item_col).isNotNull())
        .select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
        .distinct()
    )
    portion, size = [], 0
    for row in rows.toLocalIterator():
        text = row.text.encode()
        portion.append((row.item, text))
        size += len(text)
        if size >= SEARCH_BYTES:
            yield portion
            portion, size = [], 0
    yield portion


_built: dict[str, list[Search]] = {}


def _tables(name: str, portion, window: int) -> list[Search]:
    """The searches for a broadcast portion, built once in each Python worker."""
    if name not in _built:
        _built.clear()
        _built[name] = searches(portion.value, window)
    return _built[name]


def _finder(portion, window: int):
    """Adds what a portion finds to the last two of the columns: spans and items."""
    name = uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = _tables(name, portion, window)
            all_spans, all_items, counts = [], [], []
            old = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
            texts = batch.column("text").cast(pa.binary())
            for text, (spans, items) in zip(texts, old, strict=True):
                words = words_of(text.as_py())
                more, found = hits(words, tables)
                all_spans.append(_union([(s["begin"], s["end"]) for s in spans] + more))
                all_items.append(sorted(found.union(items)))
                counts.append(len(words))
            spans = [[{"begin": b, "end": e} for b, e in s] for s in all_spans]
            columns = {
                "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array(spans, batch.schema.field("spans").type),
                "items": pa.array(all_items, batch.schema.field("items").type),
            }
            yield pa.RecordBatch.from_arrays(
                [columns.get(n, batch.column(i)) for i, n in enumerate(batch.schema.names)],
                names=batch.schema.names,
            )

    return run


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Per row ``(doc_id, text, n_words, spans, items)``.

    ``spans`` are the disjoint word ranges inside occurrences of a window, ``items`` the ids
    of items with a window that occurs, sorted as strings. A null text has no words; items
    without words, with a null id or text are never found; items may share windows and ids.
    Rows stay rows, whatever their ids: nothing is joined or grouped, and no row moves. Items
    come by in portions of SEARCH_BYTES; tasks and driver hold SCAN_SEARCHES of them at most.
    """
    spark = docs.sparkSession
    none = F.lit(None)
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        none.cast("bigint").alias("n_words"),
        F.array().cast("array<struct<begin: bigint, end: bigint>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    held = []
    for portion in _portions(benchmark, item_col, item_text_col):
        if len(held) == SCAN_SEARCHES:
            found = stored(found, "found")
            for shared in held:
                shared.unpersist()
            held = []
        held.append(spark.sparkContext.broadcast(portion))
        found = found.mapInArrow(_finder(held[-1], window), found.schema)
    return found


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, **columns: str
) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns."""
    # A struct keeps the columns of a row together, whatever their names.
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    packed = packed.withColumn("text", F.col("row").getField(text_col))
    clean = find_passages(packed, benchmark, id_col="row", window=window, **columns)
    return clean.filter(F.size("spans") == 0).select("doc_id.*")


def op8_wu_manber(spark, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


#: Whole tables in SQL: windows by list slices, occurrences by an equi-join.
OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
s AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM p) WHERE len(w) >= k)),
o AS (SELECT s.doc_id, s.i, s.k, p.item_id FROM s JOIN p ON s.k = p.k AND s.t = p.t),
h AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM o) GROUP BY doc_id),
m AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN m USING (doc_id)
"""
