"""Line deduplication: fuzzy lines by SimHash, pigeonhole blocks and edit similarity.

A line is normalised to its letters and digits in lower case and single blanks; one without
either is compared as it is. Each line has a SimHash of its pairs of words (single words would
make all lines of common words alike), 128 bits. Candidates are distinct lines that agree on one
of the print's four blocks; and, as edits that are few for a line may still be many for a print,
lines that agree on the least hash of their runs of four words under one of six seeds, or that
are equal but for a word (short lines) or a character (very short ones). Candidates of similar
length and print whose edit similarity is 0.8 or more are linked. Of each linked group the first
occurrence stays.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import attach, components, stored, table
from logquarry.llm.edit_limits import Texts, within

SIMILARITY = 0.8
#: Bits of a print, cut into blocks of BLOCK_BITS: prints within BLOCKS - 1 bits agree on one.
BITS = 128
BLOCKS = 4
BLOCK_BITS = BITS // BLOCKS
#: Prints of lines that are similar enough differ in fewer bits; unrelated ones mostly do not.
MOST_BITS = 49
#: Words of a run, and seeds of the least hashes of a line's runs.
RUN_WORDS = 4
SEEDS = 6
#: Lines of so many words are looked up without each of them, lines of so many characters
#: without each of these.
FEW_WORDS = 10
FEW_CHARS = 14
#: Bits of the map of keys that several lines have, and of that of places where lines are looked up
#: again; places of a text are told apart by multiples of a number.
MAP_BITS = 27
PICK_BITS = 25
PLACE_ODD = 0x9E3779B1
#: Bytes of lines that are hashed together.
PART_BYTES = 1 << 19
#: Bytes of pairs that are compared together; those that differ in more characters are compared
#: alone, which is faster for them and gives the same.
PORTION_BYTES = 1 << 23
LONG_CHARS = 1 << 13
#: Lines of a key that are compared by one task, with as many others; rows of a task, and rows,
#: bytes and pairs that it works on at once.
BLOCK_LINES = 1 << 10
TASK_ROWS = 1 << 14
GATHERED_ROWS = 1 << 15
GATHERED_BYTES = 1 << 25
GATHERED_PAIRS = 1 << 20
#: Columns of a table of edits that are worked on over the same rows.
STRIP = 2048

#: The first 256 characters, with blanks for all but letters, digits and line ends.
_LATIN = bytes(c if chr(c).isalnum() or c == 10 else 32 for c in range(256))
_random = np.random.default_rng(42)
_ODD = _random.integers(0, 1 << 64, 32, np.uint64) | np.uint64(1)
_SEED = _random.integers(0, 1 << 64, SEEDS, np.uint64)
_LANES = np.uint64(0x0101010101010101)
_powers: dict[int, np.ndarray] = {}


class _Wide(dict):
    """The same for all characters, found out as they come."""

    def __missing__(self, code: int) -> str:
        self[code] = chr(code) if chr(code).isalnum() or code == 10 else " "
        return self[code]


_WIDE = _Wide()


def normalised(text: str) -> list[str]:
    """The lines of a text, each its letters and digits, or itself without spare blanks if it has none."""
    low = text.lower()
    try:
        worded = low.encode("latin-1").translate(_LATIN).decode("latin-1")
    except UnicodeEncodeError:
        worded = low.translate(_WIDE)
    lines = [" ".join(line.split()) for line in worded.split("\n")]
    if "" in lines:
        lines = [line or " ".join(own.split()) for line, own in zip(lines, low.split("\n"), strict=True)]
    return lines


def line_hash(norm: str) -> int:
    return xxhash.xxh64_intdigest(norm.encode(), seed=42) - (1 << 63)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    for sign in (1, -1):
        if len(_powers.get(sign, ())) < n:
            base = np.full(max(n, PART_BYTES), np.uint64(pow(int(_ODD[2]), sign, 1 << 64)))
            base[0] = 1
            _powers[sign] = np.multiply.accumulate(base)
    return _powers[1][:n], _powers[-1][:n]


def _word_hashes(norms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and the place of each line's first one; no line is empty."""
    buffer = np.frombuffer(("\n".join(norms) + "\n").encode(), np.uint8)
    ends = np.flatnonzero((buffer == 32) | (buffer == 10))
    starts = np.concatenate(([0], ends[:-1] + 1))
    power, inverse = _power(len(buffer))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((buffer + np.uint64(1)) * power, dtype=np.uint64)))
    words = _mixed((sums[ends] - sums[starts]) * inverse[starts])
    last = np.flatnonzero(buffer[ends] == 10)
    return words, np.concatenate(([0], last[:-1] + 1))


def _ones(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set, per line."""
    out = np.empty((len(first), 8, 8), np.int64)
    for g in range(8):
        # Eight counters in a number: right for up to 255 words.
        counts = np.add.reduceat((values >> np.uint64(g)) & _LANES, first)
        out[:, :, g] = counts.view(np.uint8).reshape(-1, 8)
    for k in np.flatnonzero(sizes > 255):
        own = values[first[k] : first[k] + sizes[k]]
        out[k] = sum(
            np.unpackbits(own[i : i + 65_536].view(np.uint8).reshape(-1, 8, 1), axis=2, bitorder="little").sum(axis=0, dtype=np.int64)
            for i in range(0, len(own), 65_536)
        )
    return out.reshape(-1, 64)


def sketches(norms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per line its print, as two numbers, and the least hashes of its runs of words."""
    words, first = _word_hashes(norms)
    sizes = np.diff(np.append(first, len(words)))
    line = np.repeat(np.arange(len(first)), sizes)
    left = np.repeat(first + sizes, sizes) - np.arange(len(words))
    # Pairs of words; a line of one word has that.
    pairs = words * _ODD[5]
    pairs[:-1] += np.where(left[:-1] > 1, words[1:] * _ODD[6], np.uint64(0))
    none = (left == 1) & (sizes[line] > 1)
    prints = np.empty((len(norms), BITS // 64), np.uint64)
    for half in range(BITS // 64):
        ones = _ones(np.where(none, np.uint64(0), _mixed(pairs * _ODD[3 + half])), first, sizes)
        most = np.maximum(sizes - 1, 1)[:, None]
        prints[:, half] = np.packbits(2 * ones > most, axis=1, bitorder="little").view(np.uint64).ravel()
    runs = np.zeros(len(words), np.uint64)
    for k in range(RUN_WORDS):
        there = left > k
        runs[there] += words[np.flatnonzero(there) + k] * _ODD[8 + k]
    runs = _mixed(runs)
    # A run is whole, or all of a line that is shorter.
    whole = (left >= RUN_WORDS) | (np.arange(len(words)) == first[line])
    least = np.empty((len(norms), SEEDS), np.uint64)
    for k in range(SEEDS):
        drawn = np.where(whole, (runs ^ _SEED[k]) * _ODD[16 + k], np.iinfo(np.uint64).max)
        least[:, k] = np.minimum.reduceat(drawn, first)
    return prints, least


def _without_one(norm: str, words: list[str]) -> set[int]:
    """Keys of a short line without one of its words, or of its characters; and its own.

    A word is left out if it may be replaced at all, by one as long, in a line this short.
    """
    out = set()
    if 2 <= len(words) <= FEW_WORDS:
        out = {
            xxhash.xxh64_intdigest(" ".join(words[:i] + words[i + 1 :]).encode(), seed=1)
            for i, word in enumerate(words)
            if len(word) <= len(norm) * 0.25 + 1
        }
        out.add(xxhash.xxh64_intdigest(norm.encode(), seed=1))
    if len(norm) <= FEW_CHARS:
        out |= {xxhash.xxh64_intdigest((norm[:i] + norm[i + 1 :]).encode(), seed=2) for i in range(len(norm))}
        out.add(xxhash.xxh64_intdigest(norm.encode(), seed=2))
    return out


def line_keys(norms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line, none of them empty, its print; all keys that it may meet others by, and how many."""
    prints, least = sketches(norms)
    blocks = np.stack(
        [prints[:, i * BLOCK_BITS // 64] >> np.uint64(i * BLOCK_BITS % 64) & np.uint64((1 << BLOCK_BITS) - 1) for i in range(BLOCKS)], axis=1
    )
    places = np.arange(1, BLOCKS + SEEDS + 1, dtype=np.uint64)
    keys = _mixed(_mixed(np.hstack((blocks, least))) + places * _ODD[24])
    owner, more = [], []
    for k, norm in enumerate(norms):
        if len(norm) <= FEW_CHARS or norm.count(" ") < FEW_WORDS:
            own = _without_one(norm, norm.split(" "))
            owner += [k] * len(own)
            more += sorted(own)
    owner = np.concatenate((np.repeat(np.arange(len(norms)), keys.shape[1]), np.array(owner, np.int64)))
    flat = np.concatenate((keys.ravel(), np.array(more, np.uint64)))[np.argsort(owner, kind="stable")]
    return prints, flat.view(np.int64), np.bincount(owner, minlength=len(norms))


_LINES = (
    "row long, doc_id {}, text_hash long, pos int, h long, length int, high long, low long, keys array<long>"
)


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, text_hash, pos, h, length, high, low, keys)`` for every line; blank ones have length 0 and no keys."""
    read = _numbered(docs, id_col, text_col)
    schema = _LINES.format(read.schema["doc_id"].dataType.simpleString())
    names = [x.split()[0] for x in schema.split(", ")]

    def made(batch: pa.RecordBatch, rows: list[int], counts: list[int], norms: list[str]) -> pa.RecordBatch:
        at = np.array([k for k, n in enumerate(norms) if n], np.int64)
        prints, flat, sizes = np.zeros((len(norms), 2), np.uint64), np.zeros(0, np.int64), np.zeros(len(norms), np.int64)
        if len(at):
            prints[at], flat, sizes[at] = line_keys([n for n in norms if n])
        ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        taken = pa.array(np.repeat(rows, counts))
        columns = [
            *[batch.column(c).take(taken) for c in range(3)],
            pa.array(np.concatenate([np.arange(n) for n in counts]), pa.int32()),
            pa.array([line_hash(n) for n in norms], pa.int64()),
            pa.array([len(n) for n in norms], pa.int32()),
            *[pa.array(prints[:, k].copy().view(np.int64)) for k in (0, 1)],
            pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, counts, norms, size = [], [], [], 0
            for k, text in enumerate(batch.column(3)):
                lines = normalised(text.as_py())
                rows.append(k)
                counts.append(len(lines))
                norms += lines
                size += sum(map(len, lines))
                if size >= PART_BYTES:
                    yield made(batch, rows, counts, norms)
                    rows, counts, norms, size = [], [], [], 0
            if rows:
                yield made(batch, rows, counts, norms)

    return read.mapInArrow(run, schema)


def _bitmap(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """The lowest ``bits`` bits of a column's numbers, as a map with a bit for each; its size does not grow."""
    word = F.shiftright(column, 6).bitwiseAND(F.lit((1 << (bits - 6)) - 1)).cast("int").alias("word")
    bit = F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit")
    found = keys.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def _marked(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the numbers are in the map."""
    place = values.view(np.uint64)
    word = place >> np.uint64(6) & np.uint64(len(bitmap) - 1)
    return (bitmap[word] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _meetings(lines: DataFrame) -> DataFrame:
    """``(key, h, lo, hi)``: the lines of each key that several have, with the least and the largest."""
    keyed = lines.select(F.explode("keys").alias("key"), "h")
    shared = keyed.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.count(F.lit(1)).alias("n"))
    shared = stored(shared.filter("lo <> hi"), "shared")
    bitmap = lines.sparkSession.sparkContext.broadcast(_bitmap(shared, "key", MAP_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            values = keys.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(batch.column(1).to_numpy(), np.diff(keys.offsets.to_numpy()))
            kept = _marked(bitmap.value, values)
            yield pa.RecordBatch.from_arrays([pa.array(values[kept]), pa.array(owner[kept])], ["key", "h"])

    # Most keys are of one line alone; the map spares them the way.
    rows = stored(lines.select("keys", "h").mapInArrow(run, "key long, h long").distinct(), "meeting")
    total = shared.agg(F.sum("n").alias("n")).first().n or 1
    return stored(attach(rows, shared, ["key"], total), "met")


def _near(a: str, b: str, similarity: float) -> Column:
    """Whether lengths and prints allow the similarity."""
    bits = F.bit_count(F.col(f"{a}.high").bitwiseXOR(F.col(f"{b}.high"))) + F.bit_count(
        F.col(f"{a}.low").bitwiseXOR(F.col(f"{b}.low"))
    )
    short, long = F.least(f"{a}.length", f"{b}.length"), F.greatest(f"{a}.length", f"{b}.length")
    return (short >= F.lit(similarity) * long - 1e-9) & ((bits < MOST_BITS) | (long <= 4 * FEW_CHARS))


def _texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(h, norm)`` of the ``wanted`` lines (h, text_hash and, if it is known, pos), each from the text where it is first.

    A map of bits picks their places, so most lines are not even normalised.
    """
    # Without places, all lines of a text are looked at.
    odd = PLACE_ODD if "pos" in wanted.columns else 0
    place = F.col("text_hash").bitwiseXOR(F.col("pos").cast("long") * odd if odd else F.lit(0)).alias("place")
    places = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted.select(place), "place", PICK_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.add(pc.count_substring(texts, "\n"), 1).to_numpy().astype(np.int64)
            ends = np.cumsum(sizes)
            pos = np.arange(sizes.sum()) - np.repeat(ends - sizes, sizes)
            picked = np.flatnonzero(_marked(places.value, np.repeat(batch.column(0).to_numpy(), sizes) ^ pos * odd))
            owner, pos = np.searchsorted(ends, picked, side="right"), pos[picked]
            norms = []
            for k, own in zip(np.unique(owner).tolist(), np.split(pos, np.flatnonzero(np.diff(owner)) + 1), strict=False):
                lines = texts[k].as_py().split("\n")
                norms += [n for n in normalised("\n".join([lines[p] for p in own.tolist()])) if n]
            hashes = [line_hash(n) for n in norms]
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(norms, pa.string())], ["h", "norm"])

    read = _numbered(docs, id_col, text_col).select("text_hash", "text")
    lines = read.mapInArrow(run, "h long, norm string").join(wanted.select("h"), "h", "left_semi")
    return lines.dropDuplicates(["h"])


def _common(x: str, y: str) -> int:
    """How many characters both begin with."""
    low, high = 0, min(len(x), len(y))
    while low < high:
        middle = (low + high + 1) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _edits(x: str, y: str, most: int) -> int:
    """The edits between two texts, or more than ``most``; a column of the table is a few numbers.

    Bit k of ``up`` and ``down`` says that the column rises or falls by one from row k to the next.
    A strip of columns has only the rows that so few edits reach; what is above them is taken to
    rise from column to column and what is below from row to row, which is never too little.
    """
    x, y = sorted((x, y), key=len)
    extra = len(y) - len(x)
    if extra > most or not x:
        return extra
    below, above = (most - extra) // 2, (most + extra + 1) // 2
    codes = np.frombuffer(x.encode("utf-32-le"), np.uint32)
    up, down, edits, first, after = 0, 0, 0, 0, 0
    for begin in range(0, len(y), STRIP):
        strip = y[begin : begin + STRIP]
        top, bottom = max(0, begin - above), min(len(x), begin + STRIP + below)
        up, down = up >> (top - first) | ((1 << (bottom - after)) - 1) << (after - top), down >> (top - first)
        edits += bottom - after
        first, after = top, bottom
        own = codes[first:after]
        at = {c: int.from_bytes(np.packbits(own == ord(c), bitorder="little").tobytes(), "little") for c in set(strip)}
        every, last = (1 << len(own)) - 1, 1 << (len(own) - 1)
        for c in strip:
            same = at[c]
            stay = (((same & up) + up) ^ up) | same
            right, back = down | (every & ~(stay | up)), up & stay
            edits += bool(right & last) - bool(back & last)
            right, back, kept = right << 1 | 1, back << 1, same | down
            up, down = (back | ~(kept | right)) & every, right & kept & every
        if edits - up.bit_count() > most:
            return most + 1
    return edits


def _aligned(x: str, y: str) -> int:
    """An upper bound of the edits: runs of words that both have once, in one order, stay."""
    words = [text.split(" ") for text in (x, y)]
    width, places = 2 if len(words[0]) < 1_000 else 4, []
    for own in words:
        at: dict = {}
        for k in range(len(own)):
            run = tuple(own[k : k + width])
            at[run] = None if run in at else k
        places.append(at)
    both = sorted((i, places[1][run]) for run, i in places[0].items() if i is not None and places[1].get(run) is not None)
    # The longest rising sequence of places, by patience.
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(both):
        k = bisect_left(tops, j)
        back.append(ends[k - 1] if k else -1)
        if k == len(tops):
            tops.append(j)
            ends.append(n)
        else:
            tops[k], ends[k] = j, n
    chain, n = [], ends[-1] if ends else -1
    while n >= 0:
        chain.append(both[n])
        n = back[n]
    sizes = [np.concatenate(([0], np.cumsum([len(w) + 1 for w in own]))) for own in words]
    total, at = 0, (0, 0)
    for i, j in [*chain[::-1], (len(words[0]), len(words[1]))]:
        total += int(max(sizes[0][i] - sizes[0][at[0]], sizes[1][j] - sizes[1][at[1]]))
        at = (i + 1, j + 1)
    return total


def _alone(x: str, y: str, most: int) -> bool:
    """Whether two texts are so few edits apart; many similar lines differ in a few words."""
    return _aligned(x, y) <= most or _edits(x, y, most) <= most


def verdicts(xs: list[str], ys: list[str], similarity: float) -> np.ndarray:
    """Per pair, whether the edits are few enough; common ends do not count."""
    most = np.array([int((1 - similarity) * max(len(x), len(y)) + 1e-9) for x, y in zip(xs, ys, strict=True)], np.int64)
    rest = []
    for x, y in zip(xs, ys, strict=True):
        head = _common(x, y)
        x, y = x[head:], y[head:]
        tail = _common(x[::-1], y[::-1])
        rest.append((x[: len(x) - tail], y[: len(y) - tail]))
    long = np.array([max(len(x), len(y)) > LONG_CHARS for x, y in rest], bool)
    found, short = np.zeros(len(rest), bool), np.flatnonzero(~long)
    found[short] = within([rest[k][0] for k in short], [rest[k][1] for k in short], most[short], _alone)
    for k in np.flatnonzero(long):
        x, y = rest[k]
        if abs(len(x) - len(y)) <= most[k]:
            found[k] = max(len(x), len(y)) <= most[k] or _alone(x, y, int(most[k]))
    return found


def are_similar(x: str, y: str, similarity: float) -> bool:
    return bool(verdicts([x], [y], similarity)[0])


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose edit similarity is high enough."""
    first = texts.select(F.col("h").alias("a"), F.col("norm").alias("x"))
    second = texts.select(F.col("h").alias("b"), F.col("norm").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Portions of some characters; at least one pair.
            sizes = pc.add(pc.binary_length(batch.column(2)), pc.binary_length(batch.column(3)))
            portions = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // PORTION_BYTES
            edges = [*np.unique(portions, return_index=True)[1].tolist(), len(portions)]
            for begin, end in zip(edges, edges[1:], strict=False):
                part = batch.slice(begin, end - begin)
                found = verdicts(part.column(2).to_pylist(), part.column(3).to_pylist(), similarity)
                yield pa.RecordBatch.from_arrays(part.columns[:2], names=["a", "b"]).filter(pa.array(found, pa.bool_()))

    both = pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y")
    return stored(both.mapInArrow(run, "a long, b long"), "similar")


def similar_lines(docs: DataFrame, lines: DataFrame, distinct: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    """``(h, root)`` for all linked lines but the roots: the least of those linked to it.

    First every line is compared with the least and the largest of each of its keys, which
    joins large groups as stars. Only lines of a key that this leaves apart are then compared
    with each other.
    """
    met = _meetings(lines)
    place = [c for c in ("text_hash", "pos") if c in distinct.schema["first"].dataType.names]
    facts = distinct.select("h", "length", "high", "low", *[f"first.{c}" for c in place])
    facts = stored(facts.join(met.select("h").distinct(), "h", "left_semi"), "facts")
    texts = stored(_texts(docs, facts.select("h", *place), id_col, text_col), "texts")
    print_ = F.struct("length", "high", "low")

    ends = met.select("h", F.explode(F.array("lo", "hi")).alias("end")).filter("h <> end")
    stars = ends.select(F.least("h", "end").alias("a"), F.greatest("h", "end").alias("b")).distinct()
    # A line may be the end of many: its facts are found by way of how often.
    often = stored(stars, "stars")
    near = _both(often, facts.select(F.col("h"), print_.alias("f"))).filter(_near("f", "g", similarity)).select("a", "b")
    roots = stored(components(_verified(near, texts, similarity)), "roots")

    # What differs from all its ends has been compared with them: the others remain.
    known = met.select("key", "h").join(roots.withColumnRenamed("a", "h"), "h", "left")
    known = stored(known.withColumn("root", F.coalesce("root", "h")), "rooted")
    homes = known.groupBy("key").agg(
        F.min("h").alias("lo"), F.max("h").alias("hi"), F.count(F.lit(1)).alias("n"), F.min("root").alias("home"), F.max("root").alias("last")
    )
    homes = homes.filter("home <> last and n > 3").select("key", "lo", "hi", F.ceil((F.col("n") - 2) / BLOCK_LINES).cast("int").alias("blocks"))
    apart = known.join(homes, "key").filter("h <> lo and h <> hi")
    meets = apart.groupBy("h").agg(F.min("root").alias("root"), F.sort_array(F.collect_list(F.struct("key", "blocks"))).alias("meets"))
    apart = stored(meets.join(facts.drop(*place), "h").join(texts, "h"), "apart")
    links = components(_compared(apart, similarity)).withColumnRenamed("root", "top")

    # Roots that are linked now take along what is linked to them.
    often = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    tops = often.join(links.withColumnRenamed("a", "root"), "root", "left").withColumn("top", F.coalesce("top", "root"))
    moved = attach(roots, tops, ["root"], max(1, roots.count()))
    return moved.select(F.col("a").alias("h"), F.col("top").alias("root")).unionByName(links.toDF("h", "root"))


def _candidates(group: np.ndarray, side: np.ndarray, root: np.ndarray, length: np.ndarray, prints: np.ndarray, similarity: float) -> Iterator:
    """Pairs of rows of a group, in portions: of two sides, if it has two, and of different roots, with near prints.

    The rows are in order of group and length.
    """
    place = group * (int(length.max()) * 2 + 4)
    most = np.minimum(np.floor((length + 1e-9) / similarity) + 1, length.max() + 1).astype(np.int64)
    others = np.searchsorted(place + length, place + most, side="right") - np.arange(1, len(group) + 1)
    ends = np.cumsum(others)
    begin = 0
    while begin < len(group):
        after = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + GATHERED_PAIRS, side="right")))
        sizes = others[begin:after]
        a = np.repeat(np.arange(begin, after), sizes)
        b = np.arange(len(a)) + np.repeat(np.arange(begin, after) + 1 - np.cumsum(sizes) + sizes, sizes)
        bits = np.bitwise_count(prints[a, 0] ^ prints[b, 0]) + np.bitwise_count(prints[a, 1] ^ prints[b, 1])
        kept = np.flatnonzero((bits < MOST_BITS) | (length[b] <= 4 * FEW_CHARS))
        a, b = a[kept], b[kept]
        kept = (root[a] != root[b]) & ((side[a] < 0) | (side[a] != side[b])) & (length[a] >= similarity * length[b] - 1e-9)
        yield a[kept], b[kept]
        begin = after


def _met_before(keys: np.ndarray, offsets: np.ndarray, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows of a pair share a key that is less than that by which they meet here; a row's keys ascend."""
    found = np.zeros(len(a), bool)
    for i in range(int(np.diff(offsets).max(initial=0))):
        own = np.flatnonzero(~found & (offsets[a] + i < offsets[a + 1]))
        own = own[keys[offsets[a[own]] + i] < key[a[own]]]
        if not len(own):
            break
        value = keys[offsets[a[own]] + i]
        for j in range(int(np.diff(offsets).max())):
            there = offsets[b[own]] + j
            live = there < offsets[b[own] + 1]
            own, value, there = own[live], value[live], there[live]
            live = keys[there] <= value
            own, value, there = own[live], value[live], there[live]
            if not len(own):
                break
            found[own[keys[there] == value]] = True
    return found


def _links(table: pa.Table, similarity: float) -> pa.RecordBatch:
    """The roots of similar lines in the same group; see ``_compared`` for the rows."""
    key, i, j, own, h, root, length, high, low = (table.column(c).to_numpy() for c in range(9))
    length = length.astype(np.int64)
    group = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
    order = np.lexsort((length, group))
    lists = table.column(9).combine_chunks().take(pa.array(order))
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    key, h, root, length, group = key[order], h[order], root[order], length[order], group[order]
    prints = np.stack((high[order], low[order]), axis=1).view(np.uint64)
    side = np.where(i == j, -1, own)[order]
    keys, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    found = []
    for a, b in _candidates(group, side, root, length, prints, similarity):
        new = ~_met_before(keys, offsets, key, a, b)
        found.append((a[new], b[new]))
    a, b = (np.concatenate([pair[k] for pair in found]) for k in (0, 1))
    # The same line may be in many rows.
    lines, first, which = np.unique(h, return_index=True, return_inverse=True)
    a, b = which[a], which[b]
    used, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    norms = table.column(10).take(pa.array(order[first[used]])).to_pylist()
    a, b, root = at[: len(a)], at[len(a) :], root[first[used]]
    sizes = length[first[used]]
    most = ((1 - similarity) * np.maximum(sizes[a], sizes[b]) + 1e-9).astype(np.int64)
    left = Texts(norms).left(a, b, most) if len(a) else np.zeros(0, np.int64)
    a, b = a[left], b[left]
    pairs = [np.zeros(0, np.int64)]
    weight = np.cumsum(sizes[a] + sizes[b]) // PORTION_BYTES
    for own in np.split(np.arange(len(a)), np.flatnonzero(np.diff(weight)) + 1):
        pairs.append(own[verdicts([norms[k] for k in a[own]], [norms[k] for k in b[own]], similarity)])
    similar = np.concatenate(pairs)
    return pa.RecordBatch.from_arrays([pa.array(root[a[similar]]), pa.array(root[b[similar]])], names=["a", "b"])


def _compared(apart: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: roots of similar lines among those that meet, by the rows ``(h, root, meets, length, high, low, norm)``.

    The lines of a key are dealt into blocks and every two blocks are a group: a line is sent
    once for each block, never once for each other line, and pairs are made where they are
    compared, by the least key that both lines have. Only those whose prints are near and
    whose characters allow it are compared in full.
    """
    met = apart.select(
        "*", F.explode("meets").alias("met"), F.transform("meets", lambda m: m["key"]).alias("keys")
    ).drop("meets")
    own = F.pmod(F.xxhash64("h"), F.col("met.blocks")).cast("int")
    dealt = met.select("*", own.alias("own"), F.explode(F.expr("sequence(0, met.blocks - 1)")).alias("other"))
    group = [F.col("met.key").alias("key"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]
    dealt = dealt.select(*group, "own", "h", "root", "length", "high", "low", "keys", "norm")
    rows = apart.agg(F.sum(F.aggregate("meets", F.lit(0).cast("long"), lambda total, m: total + m["blocks"]))).first()[0] or 0
    parts = max(2 * apart.sparkSession.sparkContext.defaultParallelism, rows // TASK_ROWS + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(x.num_rows for x in waiting) >= GATHERED_ROWS or sum(x.nbytes for x in waiting) >= GATHERED_BYTES:
                table = pa.Table.from_batches(waiting)
                # The last group may go on.
                names = [table.column(c).to_numpy() for c in range(3)]
                whole = int(np.flatnonzero(np.any([n != n[-1] for n in names], axis=0)).max(initial=-1)) + 1
                if whole:
                    yield _links(table.slice(0, whole), similarity)
                    waiting = table.slice(whole).to_batches()
        if waiting and sum(x.num_rows for x in waiting):
            yield _links(pa.Table.from_batches(waiting), similarity)

    dealt = dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(run, "a long, b long")


def _both(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the facts ``f`` of a and ``g`` of b."""
    total = max(1, pairs.count())
    for end, name in (("a", "f"), ("b", "g")):
        often = pairs.groupBy(end).agg(F.count(F.lit(1)).alias("n"))
        own = often.join(facts.select(F.col("h").alias(end), F.col("f").alias(name)), end)
        pairs = attach(pairs, own, [end], total)
    return pairs


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """``(doc_id, text_hash, n_lines, dropped)`` per row: which of its lines go, from 0.

    Of a group of equal or linked lines the first stays, by id, row and place; a null id
    comes first. Blank lines always stay; a null or empty text has one such line.
    """
    lines = stored(line_table(docs, id_col, text_col), "lines")
    written = lines.filter("length > 0")
    place = F.struct("doc_id", "row", "pos", "text_hash")
    distinct = written.groupBy("h").agg(
        F.max("length").alias("length"),
        F.max("high").alias("high"),
        F.max("low").alias("low"),
        F.count(F.lit(1)).alias("n"),
        F.min(place).alias("first"),
    )
    distinct = stored(distinct, "distinct")
    roots = similar_lines(docs, written, distinct, id_col, text_col, similarity)
    # Groups of several lines, and lines of several rows.
    rooted = distinct.select("h", "n", "first").join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    rooted = stored(rooted, "members")
    groups = rooted.groupBy("root").agg(
        F.min("first").alias("keeper"), F.sum("n").alias("rows"), F.count(F.lit(1)).alias("size")
    )
    linked = attach(
        rooted.select("h", "root", "n"), groups.filter("rows > 1"), ["root"], max(1, rooted.count()), n="size"
    )
    facts = stored(linked.select("h", "keeper", "n"), "keepers")
    total = max(1, written.count())
    marks = attach(written.select("row", "doc_id", "text_hash", "pos", "h"), facts, ["h"], total, how="left")
    keep = F.col("keeper").isNull() | F.col("keeper").eqNullSafe(place)
    marks = marks.select("row", "doc_id", "text_hash", F.when(~keep, F.col("pos")).alias("dropped"))
    blank = lines.filter("length = 0").select("row", "doc_id", "text_hash", F.lit(None).cast("int").alias("dropped"))
    return (
        marks.unionByName(blank)
        .groupBy("row", "doc_id", "text_hash")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sort_array(F.collect_list("dropped")).alias("dropped"))
        .drop("row")
    )


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` with the repeated lines left out; a text may end up empty."""
    found = repeated_lines(docs, id_col, text_col).withColumn("key_", F.coalesce("doc_id", F.lit(-1)))
    texts = docs.select(
        F.coalesce(F.col(id_col), F.lit(-1)).alias("key_"),
        F.xxhash64(text_col).alias("text_hash"),
        F.split(F.col(text_col), "\n").alias("lines"),
    ).dropDuplicates(["key_", "text_hash"])
    kept = F.filter("lines", lambda line, i: ~F.array_contains("dropped", i))
    return found.join(texts, ["key_", "text_hash"]).select("doc_id", F.array_join(kept, "\n").alias("text"))


def op4_fuzzy_lines(spark, sf_dir: str) -> DataFrame:
    found = repeated_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join("dropped", ",").alias("dropped"),
    )
