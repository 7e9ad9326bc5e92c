"""Whether the edits between texts stay within limits, for many pairs of texts at once.

A column of a pair's table is kept as bits (Myers 1999), 64 rows to a word: ``up`` and ``down``
say where it rises or falls by one from row to row. All pairs of a block take a step together,
in which word w works on column ``step - w``, as it needs what the word above passed on. Only
words in the band that so few edits can reach are worked on (Ukkonen 1985); what lies outside
it is taken for more than it may be, so nothing is found that is not there. A pair leaves the
block when no way on is left within its limit. Pairs whose characters alone need more edits, in
whatever order they stand, never enter one.

Pairs of texts that meet many others (``Texts``) are first ruled out by lower bounds: by their
characters, then window by window. A window is 64 characters of the shorter text; the least edits
between it and any part of the other that is in its reach add up, as windows do not overlap.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Words that are worked on in a step, and words of a block's table of characters.
STEP_WORDS = 1 << 13
TABLE_WORDS = 1 << 22
#: Fewer pairs than this are compared one by one where a block would take as many steps for them.
FEW_PAIRS = 32
#: Steps between two looks for pairs that are settled.
LOOK = 32
#: Kinds that characters are counted by; texts that are counted together.
KINDS = 64
COUNTED = 1 << 7
#: Rows of a window, the longest texts that are cut into some, pairs whose windows are compared
#: together, and how few are left to the table of edits. Pairs whose counts are compared together.
ROWS = 64
WINDOWED = 1 << 11
LANES = 1 << 13
FEW_LANES = 1 << 7
WEIGHED = 1 << 10

_ALL = np.uint64((1 << 64) - 1)
_ONE, _TOP = np.uint64(1), np.uint64(63)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters of all texts, whose they are and at which place."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    return flat, owner, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _block(xs: list[str], ys: list[str], most: np.ndarray) -> np.ndarray:
    """``within`` for texts of similar length; no x is longer than its y, and none is empty."""
    pairs = len(xs)
    m, n = np.array([len(t) for t in xs]), np.array([len(t) for t in ys])
    words, columns = (int(m.max()) + 63) // 64, int(n.max())
    (x, x_of, x_at), (y, y_of, y_at) = _codes(xs), _codes(ys)
    kinds = np.zeros(0x110000, np.int32)
    kinds[x] = 1
    characters = np.flatnonzero(kinds)
    kinds[characters] = np.arange(1, len(characters) + 1)
    wide = len(characters) + 1

    # Where each character stands in x; no two of the same bit and word meet in a place.
    table = np.zeros(words * pairs * wide, np.uint64)
    place = ((x_at >> 6) * pairs + x_of) * wide + kinds[x]
    bits = (x_at & 63).astype(np.uint8)
    by_bit = np.split(place[np.argsort(bits, kind="stable")], np.cumsum(np.bincount(bits, minlength=64))[:-1])
    for bit, own in enumerate(by_bit):
        table[own] |= np.uint64(1 << bit)
    # The columns, last ones first; characters that x has not are 0.
    turned = np.zeros((words + columns, pairs), np.int32)
    turned[words + columns - 1 - y_at, y_of] = kinds[y]
    base = np.arange(words * pairs, dtype=np.int64).reshape(words, pairs) * wide

    up, down = np.full((words, pairs), _ALL), np.zeros((words, pairs), np.uint64)
    # What a word passes on: whether its last row rises or falls in this column.
    rise, fall = np.zeros((words + 1, pairs), np.uint64), np.zeros((words + 1, pairs), np.uint64)
    last = np.zeros((words, pairs), np.int64)
    # Ways within the limit stay between these diagonals, counted as column less row; one more
    # on either side, so that the word above is at work when a word begins.
    below, above = 1 + int(((most - (n - m)) // 2).max()), 1 + int(((most + n - m + 1) // 2).max())
    number, ends = np.arange(pairs), n - 1 + (m - 1) // 64
    found = np.zeros(pairs, bool)
    final = set(ends.tolist())
    reached = 0
    for step in range(int(ends.max()) + 1):
        first = max(0, -(-(step - 63 - above) // 65))
        after = min(words, step + 1, (step + below) // 65 + 1)
        after = max(after, reached)
        rise[first], fall[first] = 1, 0
        for w in range(reached, after):
            # A word begins with what is above it and a rise in each of its rows.
            last[w] = 64 + (last[w - 1] - rise[w].view(np.int64) + fall[w].view(np.int64) if w else 0)
        reached = after
        rows = slice(first, after)
        at = words + columns - 1 - step
        same = table.take(base[rows] + turned[at + first : at + after])
        own_up, own_down = up[rows], down[rows]
        stay = same | own_down
        same |= fall[rows]
        right = same & own_up
        right += own_up
        right ^= own_up
        right |= same
        rises = right | own_up
        np.invert(rises, out=rises)
        rises |= own_down
        falls = own_up & right
        out_rise, out_fall = rises >> _TOP, falls >> _TOP
        rises <<= _ONE
        rises |= rise[rows]
        falls <<= _ONE
        falls |= fall[rows]
        np.bitwise_and(rises, stay, out=own_down)
        stay |= rises
        np.invert(stay, out=stay)
        np.bitwise_or(falls, stay, out=own_up)
        last[rows] += out_rise.view(np.int64)
        last[rows] -= out_fall.view(np.int64)
        rise[first + 1 : after + 1], fall[first + 1 : after + 1] = out_rise, out_fall

        if step in final:
            done = np.flatnonzero(ends == step)
            word, rest = (m[done] - 1) // 64, np.uint64(1) + ((m[done] - 1) % 64).astype(np.uint64)
            # Rows beyond the end of x; a shift by 64 is none.
            beyond = np.where(rest < 64, _ALL << (rest % np.uint64(64)), np.uint64(0))
            edits = last[word, done] - np.bitwise_count(up[word, done] & beyond).astype(np.int64)
            edits += np.bitwise_count(down[word, done] & beyond)
            found[number[done]] = edits <= most[done]
        if step % LOOK == LOOK - 1:
            # A way passes the words' columns, or between two of them, which is worth one edit.
            least = (last[rows] - np.bitwise_count(up[rows])).min(axis=0) - 1
            open_ = (ends > step) & (least <= most)
            if open_.sum() < 0.75 * len(open_):
                if not open_.any():
                    break
                up, down, rise, fall, last, base, turned = (a[:, open_] for a in (up, down, rise, fall, last, base, turned))
                m, n, most, number, ends = (a[open_] for a in (m, n, most, number, ends))
    return found


def _counts(texts: list[str]) -> np.ndarray:
    """Per text, how many of its characters are of each kind."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    place = np.repeat(np.arange(0, len(texts) * KINDS, KINDS), [len(t) for t in texts])
    place += flat & np.uint32(KINDS - 1)
    return np.bincount(place, minlength=len(texts) * KINDS).reshape(-1, KINDS)


def _least(xs: list[str], ys: list[str]) -> np.ndarray:
    """Per pair, a lower bound of the edits: one takes a character of one kind away, adds one, or both."""
    out = np.zeros(len(xs), np.int64)
    for begin in range(0, len(xs), COUNTED):
        part = slice(begin, begin + COUNTED)
        more = _counts(xs[part]) - _counts(ys[part])
        out[part] = np.maximum(np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1))
    return out


def within(xs: list[str], ys: list[str], most: np.ndarray, alone: Callable[[str, str, int], bool] | None = None) -> np.ndarray:
    """Per pair, whether its texts are ``most`` edits apart or fewer, exactly; ``alone`` tells it for those few in a block."""
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(xs, ys, strict=True)]
    most = np.asarray(most, np.int64)
    sizes = np.array([(len(x), len(y)) for x, y in pairs], np.int64).reshape(-1, 2)
    found = sizes[:, 1] <= most
    near = ~found & (sizes[:, 1] - sizes[:, 0] <= most) & (sizes[:, 0] > 0)
    order = np.flatnonzero(near)
    order = order[_least([pairs[k][0] for k in order], [pairs[k][1] for k in order]) <= most[order]]
    order = order[np.argsort(sizes[order, 1], kind="stable")]
    kinds = len(set().union(*(pairs[k][0] for k in order))) + 1
    begin = 0
    while begin < len(order):
        # Of like length if a block is a quarter full by that, or up to twice as long.
        like, longer = (int(np.searchsorted(sizes[order, 1], k * sizes[order[begin], 1] + 32, side="right")) for k in (1.2, 2))
        own = int(sizes[order[begin], 1]) // 64 + 1
        band = int(most[order[begin:like]].max()) // 64 + 2
        size = max(1, min(STEP_WORDS // min(own, band), TABLE_WORDS // (own * kinds)))
        chosen = order[begin : min(begin + size, max(like, min(longer, begin + size // 4)))]
        if alone and len(chosen) < FEW_PAIRS:
            found[chosen] = [alone(*pairs[k], int(most[k])) for k in chosen]
        else:
            found[chosen] = _block([pairs[k][0] for k in chosen], [pairs[k][1] for k in chosen], most[chosen])
        begin += len(chosen)
    return found


class Texts:
    """Texts of which many pairs are to be ruled out: characters by kinds, the commonest apart, and their counts."""

    def __init__(self, texts: list[str]) -> None:
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        often = np.bincount(codes, minlength=KINDS)
        kinds = np.full(len(often), KINDS - 1, np.uint8)
        kinds[np.argsort(-often, kind="stable")[: KINDS - 1]] = np.arange(KINDS - 1)
        self.flat = kinds[codes]
        self.counts = np.empty((len(texts), KINDS), np.int32)
        for begin in range(0, len(texts), COUNTED):
            own = self.sizes[begin : begin + COUNTED]
            place = np.repeat(np.arange(0, len(own) * KINDS, KINDS), own)
            place += self.flat[self.begins[begin] : self.begins[begin] + own.sum()]
            self.counts[begin : begin + COUNTED] = np.bincount(place, minlength=len(own) * KINDS).reshape(-1, KINDS)

    def _by_counts(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which pairs the counts of characters leave; see ``_least``."""
        left = np.zeros(len(a), bool)
        for begin in range(0, len(a), WEIGHED):
            part = slice(begin, begin + WEIGHED)
            more = self.counts[a[part]] - self.counts[b[part]]
            net = self.sizes[a[part]] - self.sizes[b[part]]
            # What one has more and what the other has more differ by the lengths.
            left[part] = (np.abs(more, out=more).sum(axis=1) + np.abs(net)) // 2 <= most[part]
        return left

    def _windows(self, x_at: np.ndarray, y_at: np.ndarray, columns: int) -> np.ndarray:
        """Per pair, the least edits between the window at ``x_at`` and any part of so many columns from ``y_at``, or fewer.

        Columns that are beyond a pair's reach, even in other texts, can only find fewer edits.
        """
        own, which = np.unique(x_at, return_inverse=True)
        table, place = np.zeros(len(own) * KINDS, np.uint64), np.arange(0, len(own) * KINDS, KINDS)
        for row in range(ROWS):
            table[place + self.flat.take(own + row)] |= np.uint64(1 << row)
        base, place = which * KINDS, y_at.copy()
        up, down = np.full(len(base), _ALL), np.zeros(len(base), np.uint64)
        now, least = np.full(len(base), ROWS, np.int64), np.full(len(base), ROWS, np.int64)
        kind, rises, stay = np.empty(len(base), np.int64), np.empty_like(up), np.empty_like(up)
        for _ in range(columns):
            np.add(base, self.flat.take(place, mode="clip"), out=kind)
            same = table.take(kind)
            place += 1
            np.bitwise_or(same, down, out=stay)
            right = same & up
            right += up
            right ^= up
            right |= same
            np.bitwise_or(right, up, out=rises)
            np.invert(rises, out=rises)
            rises |= down
            falls = np.bitwise_and(up, right, out=right)
            now += (rises >> _TOP).view(np.int64)
            now -= (falls >> _TOP).view(np.int64)
            np.minimum(least, now, out=least)
            rises <<= _ONE
            falls <<= _ONE
            np.bitwise_and(rises, stay, out=down)
            rises |= stay
            np.invert(rises, out=rises)
            np.bitwise_or(falls, rises, out=up)
        return least

    def left(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which of the pairs may be ``most`` edits apart or fewer: all that are, and few others."""
        kept = np.flatnonzero(self._by_counts(a, b, most))
        a, b, most = a[kept], b[kept], most[kept]
        x, y = np.where(self.sizes[a] <= self.sizes[b], a, b), np.where(self.sizes[a] <= self.sizes[b], b, a)
        m, n = self.sizes[x], self.sizes[y]
        below, above = (most - (n - m)) // 2, (most + n - m + 1) // 2
        total, on, k = np.zeros(len(x), np.int64), np.flatnonzero((m >= ROWS) & (n <= WINDOWED)), 0
        while len(on) > FEW_LANES:
            # From both ends inwards.
            at = np.full(len(on), k // 2 * ROWS) if k % 2 == 0 else m[on] - (k // 2 + 1) * ROWS
            begins, ends = np.maximum(at - below[on], 0), np.minimum(at + ROWS + above[on], n[on])
            order = np.argsort(ends - begins, kind="stable")
            columns, after = (ends - begins)[order], 0
            while after < len(order):
                begin, like = after, int(np.searchsorted(columns, 1.2 * columns[after] + 16, side="right"))
                after = min(begin + LANES, max(like, begin + LANES // 8))
                lanes = order[begin:after]
                own = on[lanes]
                total[own] += self._windows(self.begins[x[own]] + at[lanes], self.begins[y[own]] + begins[lanes], int(columns[min(after, len(order)) - 1]))
            k += 1
            on = on[(m[on] // ROWS > k) & (total[on] <= most[on])]
        return kept[total <= most]
