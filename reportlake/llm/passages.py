"""Repeated passages by compact windows over token min-hashes.

A token is a 5-word shingle at its place. For each of ``HASHES`` hash functions a document's
Cartesian tree (split at the least hash, then left and right) yields its compact windows (l, c, r):
every stretch of tokens that has c inside and lies within l..r has its min-hash at c. Only windows of
at least the least passage length are kept, about 2n / length for n tokens, so a repeated passage
meets itself in a window of each document at the token of least hash, whatever surrounds it.

Windows are grouped by that min-hash together with two tokens of context, 8 and 16 places to the
right or to the left; a passage of the least length reaches that far on one side at least. A group
is joined as a star to its first window, in one pass over sorted rows: first within each slice of
the input, so that a passage in a third of all documents sends one row a slice, then over the
shuffle. Members of a group are never paired with each other. Where a member's stretches of the least
length around the min-hash of the first function aren't all in its first window too (the two share
only a frequent line, say), those stretches form groups of their own by all their tokens, joined as
stars once more. Members of such a group are equal there, so no exact passage is left out. So that
near passages around such a line meet too, the token at which a member parts from the first window
on either side forms one more group with the min-hash's. Windows of any hash function that verification
leaves outside every passage form more such groups, by that token and by two behind it. Members of these
are joined as a star once and not grouped again, so a near passage can still be left out.

All joined windows of two documents are verified together on the words. Tokens of one side take
their place on the other, nearest to the shift of a window's meeting; their runs are chained over
neighbouring shifts, so that inserted, deleted and replaced words only cost what they are. A chain's
longest parts with ``least_words`` words on both sides whose equal tokens outweigh the skipped ones,
and whose shingle sets have a similarity of 0.75 or more, are passages; so are all runs of
``least_words`` equal words. Passages of one pair may overlap.

Defined cases: null, empty and short texts have no windows; rows with equal id and text are one
document; repeats inside one document are not reported; of several occurrences each is reported
against the group's first window, and repeats of a passage in the first window's own document against
one document that shares it; the first window is that of the least (hash of id and text, place); an
empty table gives an empty result.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlake.llm import words as W
from reportlake.llm.shared import written

SHINGLE = 5
LEAST_WORDS = 50
HASHES = 4
NEAR, FAR = 8, 16
PER_CENT = 75
#: Ids of documents that may be broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
GAIN, LOSS = 1, 3
#: Segments before one up to which they are looked at one by one.
FEW = 32

_rng = np.random.default_rng(77)
_FACTORS = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def compact_windows(h: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(l, c, r) of every compact window of at least ``least`` tokens, r included."""
    _, *found = _all_windows(h, np.array([0]), np.array([len(h)]), least)
    return list(zip(*(v.tolist() for v in found)))


def _all_windows(h: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(stretch, l, c, r) of the compact windows of many stretches of ``h``.

    A window of ``least`` tokens reaches half of that to one side of c, so only tokens that are least
    so far are looked at. Where such a token's window ends further off, it ends at another of them."""
    half, n = least // 2, len(h)
    levels = _minima(h, half)
    c = np.arange(n)
    if half:
        over = half - (1 << len(levels) - 1)
        lowest = np.minimum(levels[-1][: max(n - half + 1, 0)], levels[-1][over:])
        keep = np.zeros(n, bool)
        keep[half:] = lowest[: max(n - half, 0)] > h[half:]
        keep[: max(n - half, 0)] |= lowest[1:] >= h[: max(n - half, 0)]
        c = np.flatnonzero(keep)
    values = h[c]
    wide, ends = _minima(values, len(c)), []
    for side in (-1, 1):
        reach = _reach(levels, c, values, side)
        far = np.flatnonzero(reach == (1 << len(levels)) - 1)
        stop = far + side * (1 + _reach(wide, far, values[far], side))
        ends.append(c + side * reach)
        ends[-1][far] = np.concatenate([[-1], c, [n]])[stop + 1] - side
    stretch = np.searchsorted(begin, c, side="right") - 1
    inside = (stretch >= 0) & (c < end[stretch])
    left, right = np.maximum(ends[0], begin[stretch]), np.minimum(ends[1], end[stretch] - 1)
    found = np.flatnonzero(inside & (right - left + 1 >= least))
    return stretch[found], left[found], c[found], right[found]


def _minima(values: np.ndarray, most: int) -> list[np.ndarray]:
    """The least of 1, 2, 4, ... values from each place on, up to ``most`` of them."""
    out = [values]
    while 1 << len(out) <= most:
        step = 1 << len(out) - 1
        out.append(np.minimum(out[-1][:-step], out[-1][step:]))
    return out


def _reach(levels: list[np.ndarray], at: np.ndarray, values: np.ndarray, side: int) -> np.ndarray:
    """How many places before each one have greater values, or after it none that are less; as far as
    the levels go."""
    reach = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        if len(levels[k]):
            start = at + 1 + reach if side > 0 else at - reach - (1 << k)
            least = levels[k][np.clip(start, 0, len(levels[k]) - 1)]
            ok = (start < len(levels[k])) & (least >= values) if side > 0 else (start >= 0) & (least > values)
            reach += ok.astype(np.int64) << k
    return reach


def _signed_mix(*parts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        total = W.mix(total * np.uint64(0x9E3779B97F4A7C15) + p)
    return W.signed(total)


def _star(key, doc, c, span) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each key's group, number of its group's first row for every other row)."""
    order = np.lexsort((c, doc, key))
    k = key[order]
    first = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    lead = order[np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))] if len(k) else order
    return order[first], np.stack([lead[~first], order[~first]])


#: ``at``: a window's place c << 32 and its reach to the left and right, whether others of its slice follow it and,
#: for the first hash function, its side, else that only near passages are looked for; ``link``: null, or what ``_LINK`` has from doc2 on.
_ROW = "key long, doc long, at long, span long, link binary"
#: ``at2``: the first window's place and, once a group, the same of the first window.
_LINK = "doc long, at long, doc2 long, at2 long, from2 long, to2 long"
_NAMES, _LINK_NAMES = (fields.replace(" long", "").replace(" binary", "").split(", ") for fields in (_ROW, _LINK))
_LOW = (1 << 32) - 1
_BITS = 13  # of a reach: least_words is below 8192
_RIGHT, _LEFT, _FOLLOWED, _NEAR_ONLY = 1 << 26, 1 << 27, 1 << 28, 1 << 29
#: Tokens behind the one where windows part of which the least stands for them, for copies with an edit there.
_BEHIND = ((SHINGLE, SHINGLE + 8), (SHINGLE + 8, SHINGLE + 16))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _dealt(key, doc, c, span, mine):
    """Batches of a slice's rows: the first row of each group, to be sent on, and the links of the
    others to it, dealt out evenly. Rows of one document are linked only to find what they don't share."""
    alone, (z, x) = _star(key, doc, c, span)
    other = (doc[z] != doc[x]) | (mine[x] != 0)
    z, x = z[other], x[other]
    at = (c << 32) | mine
    lead = np.unique(z)
    at[lead] = np.where(mine[lead] != 0, at[lead] | _FOLLOWED, at[lead])
    yield pa.RecordBatch.from_arrays([pa.array(v[alone]) for v in (key, doc, at, span)] + [pa.nulls(len(alone), pa.binary())], names=_NAMES)
    spread = _signed_mix(doc[x].view(np.uint64), c[x].astype(np.uint64))
    links = np.stack([doc[z], c[z] << 32, c[z] - (span[z] >> 32), c[z] + (span[z] & _LOW)], axis=1)
    packed = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(0, links.nbytes + 1, 32, dtype=np.int32)), pa.py_buffer(links)])
    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (spread, doc[x], (c[x] << 32) | mine[x], np.zeros(len(x), np.int64))] + [packed], names=_NAMES)


def _windows(rows: DataFrame, least: int) -> DataFrame:
    """Window rows (doc2 null) and links found within a slice, dealt out by their own key."""
    reach = least - 1

    def run(batches):
        for batch in W.slices(batches):
            data, offsets = W.text_buffers(batch.column("text"))
            starts, ends, owner = W.word_spans(data, offsets, W.SPACED)
            tokens, belongs = W.shingles(W.word_hashes(data, starts, ends), owner, SHINGLE)
            docs = batch.column("doc").to_numpy()
            limits = np.searchsorted(belongs, np.arange(batch.num_rows + 1))
            rows_with = np.flatnonzero(np.diff(limits) >= least)
            if not len(rows_with):
                continue
            found = []
            for k, factor in enumerate(_FACTORS):
                row, left, c, right = _all_windows(W.mix(tokens * factor), limits[rows_with], limits[rows_with + 1], least)
                found.append((np.full(len(row), k), rows_with[row], left, c, right))
            k, row, left, c, right = (np.concatenate(v) for v in zip(*found))
            base = limits[row]
            left, c, right = left - base, c - base, right - base
            span = ((c - left) << 32) | (right - c)
            sizes = np.minimum(c - left, reach) | (np.minimum(right - c, reach) << _BITS) | np.where(k == 0, 0, _NEAR_ONLY)
            at, token = base + c, tokens
            parts = []
            for side, keep in ((1, right - c >= FAR), (-1, c - left >= FAR)):
                i = np.flatnonzero(keep)
                key = _signed_mix(k[i].astype(np.uint64), token[at[i]], token[at[i] + side * NEAR], token[at[i] + side * FAR], np.full(len(i), side + 1, np.uint64))
                parts.append((key, docs[row[i]], c[i], span[i], sizes[i] | np.where(k[i] == 0, _RIGHT if side > 0 else _LEFT, 0)))
            yield from _dealt(*(np.concatenate(x) for x in zip(*parts)))

    return rows.mapInArrow(run, _ROW)


def _regrouped(rest: DataFrame) -> DataFrame:
    """The same rows of (key, doc, c, span) groups whose members are equal."""

    def run(batches):
        for batch in batches:
            key, doc, c, span = (batch.column(n).to_numpy() for n in ("key", "doc", "c", "span"))
            if len(key):
                yield from _dealt(key, doc, c, span, np.zeros(len(key), np.int64))

    return rest.select("key", "doc", "c", "span").mapInArrow(run, _ROW)


def _links(windows: DataFrame) -> DataFrame:
    """Every window with the first window of its group. What ``at2`` tells of that is given with the
    second link of a group, or with the first if a slice's rows follow either of its windows: from
    there on a member can have what the first window lacks. Those that follow a member were only seen
    against that, so with each such member the first window tells where it parts from it.

    Rows are sorted by the key alone, and windows that are alone stay out of Python. A group has at
    most one row a slice of the input, so its rows are put in order here; those of a batch's last
    group wait for the next batch."""

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            linked = batch.column("link").is_valid().to_numpy(zero_copy_only=False)
            if linked.any():
                known = batch.filter(pa.array(linked))
                links = np.frombuffer(b"".join(known.column("link").to_pylist()), np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([known.column("doc"), known.column("at"), *[pa.array(v) for v in links.T.copy()]], names=_LINK_NAMES)
            rest = np.flatnonzero(~linked)
            if not len(rest):
                continue
            rows = tuple(batch.column(n).to_numpy()[rest] for n in ("key", "doc", "at", "span"))
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            if last or (held and held[0][0][0] != rows[0][0]):
                yield _first_links(*(np.concatenate(v) for v in zip(*held, tuple(v[:last] for v in rows))))
                held = []
            held.append(tuple(v[last:] for v in rows))
        if held:
            yield _first_links(*(np.concatenate(v) for v in zip(*held)))

    grouped = windows.repartition("key").withColumn("size", F.count("*").over(Window.partitionBy("key")))
    grouped = grouped.where("size > 1 OR link IS NOT NULL").drop("size").sortWithinPartitions("key")
    return grouped.mapInArrow(run, _LINK)


def _first_links(key, doc, at, span) -> pa.RecordBatch:
    """The links of whole groups, sorted by key, to the first window of each."""
    same = np.concatenate([[False], key[1:] == key[:-1], [False]])
    many = np.flatnonzero(same[1:] | same[:-1])
    key, doc, at, span = (v[many] for v in (key, doc, at, span))
    order = np.lexsort((at >> 32, doc, key))
    key, doc, at, span = (v[order] for v in (key, doc, at, span))
    first = ~same[many]
    lead = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
    mine, leads, c2 = at & _LOW, at[lead] & _LOW, at[lead] >> 32
    other = ~first & (doc[lead] != doc)
    seen = np.cumsum(other)
    seen -= seen[lead]
    followed = ((leads | mine) & _FOLLOWED) != 0
    whole = other & ((seen == 2) | ((seen == 1) & followed)) & ((leads & _NEAR_ONLY) == 0)
    tell = np.where(whole, leads, np.where(other & ((mine & _FOLLOWED) != 0), leads | _NEAR_ONLY, 0))
    ok = other | (~first & (mine != 0))
    rows = (doc, at, doc[lead], (c2 << 32) | tell, c2 - (span[lead] >> 32), c2 + (span[lead] & _LOW))
    return pa.RecordBatch.from_arrays([pa.array(v[ok]) for v in rows], names=_LINK_NAMES)


def _stretch_keys(tokens: np.ndarray, least: int) -> np.ndarray:
    """One key for each stretch of ``least`` tokens, by its start."""
    n = len(tokens) - least + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens * _powers(_BASE, len(tokens)), dtype=np.uint64)])
    return W.signed(W.mix((sums[least:] - sums[:-least]) * _powers(_INVERSE, n)))


def _has_repeats(words: np.ndarray, least: int) -> int:
    keys = _stretch_keys(words, least)
    return int(len(np.unique(keys)) < len(keys))


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        out = np.full(max(n, 1 << 14), base, np.uint64)
        out[:1] = 1
        _POWERS[base] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[base][:n]


def _shared_reach(x: np.ndarray, c: np.ndarray, z: np.ndarray, c2: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal tokens before each c and after it, seen from c2 on the other side; -1 where c's differs."""
    edge = lambda v, kind: np.concatenate([edges := np.full(reach, kind, np.uint64), v, edges])
    wide = np.lib.stride_tricks.sliding_window_view
    same = wide(edge(x, 0), 2 * reach + 1)[c] == wide(edge(z, 1), 2 * reach + 1)[c2]
    sides = same[:, reach::-1], same[:, reach:]
    before, after = (np.where(v.all(axis=1), reach, v.argmin(axis=1) - 1) for v in sides)
    return before, after


def _stretches_around(mine: np.ndarray, least: int, shared: tuple = (-1, -1)) -> tuple[np.ndarray, np.ndarray]:
    """(window, tokens before c) of the stretches of ``least`` tokens around each c in its window that
    the window's side is to settle, without those that lie within the shared reach."""
    reach, (before, after) = least - 1, (np.broadcast_to(s, mine.shape)[:, None] for s in shared)
    left, right, is_right = ((v)[:, None] for v in (mine & (1 << _BITS) - 1, (mine >> _BITS) & (1 << _BITS) - 1, (mine & _RIGHT) != 0))
    a = np.arange(least)
    inside = (a <= left) & (reach - a <= right) & ((a <= reach // 2) == is_right)
    return np.nonzero(inside & ((a > before) | (reach - a > after)))


def _first_unshared(tokens: np.ndarray, c: np.ndarray, mine: np.ndarray, shared: tuple, rows: np.ndarray, base: int = 0, kind: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, c, span) of the first token on either side that a window doesn't share with the first
    window of its group, with the token at c: near copies that part from it at one place meet there."""
    left, right = mine & (1 << _BITS) - 1, (mine >> _BITS) & (1 << _BITS) - 1
    step = np.concatenate([-1 - shared[0][rows], 1 + shared[1][rows]])  # 0 if even the tokens at c differ
    i, size = np.concatenate([rows, rows]), np.concatenate([left[rows], right[rows]])
    at = c[i] + step
    ok = (step != 0) & (np.abs(step) <= size) & (at >= 0) & (at < len(tokens))
    i, at, step = i[ok], at[ok], step[ok]
    key = _signed_mix(tokens[c[i]], tokens[at], (step > 0).astype(np.uint64) + np.uint64(kind))
    return key, c[i] + base, (left[i] << 32) | right[i]


def _unshared(tokens: np.ndarray, c: np.ndarray, mine: np.ndarray, shared: tuple, base: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of windows that no passage holds, and of tokens behind the first one: near copies may have
    an edit just where both part from the first window. Their groups are others, so the first of those isn't changed."""
    found = [_first_unshared(tokens, c, mine, shared, np.arange(len(c)), base, 11)]
    left, right = mine & (1 << _BITS) - 1, (mine >> _BITS) & (1 << _BITS) - 1
    for side, reach, size in ((-1, shared[0], left), (1, shared[1], right)):
        for low, high in _BEHIND:
            step = 1 + reach[:, None] + np.arange(low, high)
            at = c[:, None] + side * step
            ok = (reach[:, None] >= 0) & (step <= size[:, None]) & (at >= 0) & (at < len(tokens))
            at = np.clip(at, 0, len(tokens) - 1)
            best = np.where(ok, W.mix(tokens[at]) >> np.uint64(1), np.uint64(1 << 63)).argmin(axis=1)
            i = np.flatnonzero(ok.any(axis=1))
            key = _signed_mix(tokens[c[i]], tokens[at[i, best[i]]], np.full(len(i), (side > 0) + 11, np.uint64))
            found.append((key, c[i] + base, (left[i] << 32) | right[i]))
    return tuple(np.concatenate(v) for v in zip(*found))


class _Side:
    """The tokens of a document's stretch, ordered by token and place, to look up the place of a
    token that is nearest to a wanted one."""

    def __init__(self, tokens: np.ndarray):
        order = np.argsort(tokens, kind="stable")
        ordered = tokens[order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(tokens)]
        self.values = ordered[first]
        self.width = max(1, len(tokens))
        self.places = (np.cumsum(first) - 1) * self.width + order
        self.counts = np.diff(np.append(np.flatnonzero(first), len(tokens)))

    def common(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``tokens``, number of the token here) of all tokens that are here too."""
        if not len(self.values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.values, tokens), len(self.values) - 1)
        here = np.flatnonzero(self.values[at] == tokens)
        return here, at[here]

    def nearest(self, number: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        goal = number * self.width + np.clip(wanted, 0, self.width - 1)
        above = np.searchsorted(self.places, goal)
        low, high = self.places[np.maximum(above - 1, 0)], self.places[np.minimum(above, len(self.places) - 1)]
        low_ok, high_ok = low // self.width == number, high // self.width == number
        use_low = low_ok & (~high_ok | (goal - low <= high - goal))
        return np.where(use_low, low, high) % self.width


def _segments(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """(place, other place, length) of the runs in which both places go up by one."""
    cut = np.flatnonzero((np.diff(i) != 1) | (np.diff(j) != 1)) + 1
    starts = np.concatenate([[0], cut])
    return np.stack([i[starts], j[starts], np.diff(np.concatenate([starts, [len(i)]]))], axis=1)


def _chains(segments: np.ndarray, least: int):
    """Lists of segments that go up on both sides. Each segment follows the one before it that
    leaves most, an equal token counting ``GAIN`` and a skipped one of either side ``-LOSS``. What
    branches off a better chain comes with as much of it as can pay for the branch's gaps."""
    n = len(segments)
    if n == 1:
        if 7 * int(segments[0, 2]) >= 6 * (least - SHINGLE + 1):
            yield segments
        return
    i, j, size = segments.T
    best, before, cut = size.copy(), np.full(n, -1), np.zeros(n, np.int64)
    most = np.maximum.accumulate(size[::-1])[::-1].tolist()  # of a segment still to come
    starts, others, sizes = i.tolist(), j.tolist(), size.tolist()
    totals, open_ = list(sizes), []  # open: total less what a skipped token costs from 0 on, on one side and on both; other end and start, number
    for t in range(1, n):
        start, other, length = starts[t], others[t], sizes[t]
        other_end, paid = others[t - 1] + sizes[t - 1], GAIN * totals[t - 1] + LOSS * (starts[t - 1] + sizes[t - 1])
        open_.append((paid, paid + LOSS * other_end, other_end, others[t - 1], t - 1))
        # neither this nor a later segment can pay for the gaps to the rest
        least_paid = LOSS * start - GAIN * most[t]
        open_ = [u for u in open_ if u[0] >= least_paid]
        if len(open_) > FEW:
            at = np.array([u[4] for u in open_])
            over = np.maximum(0, j[at] + size[at] - j[t])  # the place where both sides are past the other
            left = size[t] - over
            skipped = (i[t] - i[at] - size[at] + over) + np.maximum(0, j[t] - j[at] - size[at])
            total = np.where((left > 0) & (j[at] < j[t]), GAIN * (best[at] + left) - LOSS * skipped, -1)
            u = int(total.argmax())
            top = (int(total[u]), int(at[u]), int(over[u]))
        else:
            total_of, top_of, past_of = -1, -1, 0
            gain, gain_both = GAIN * length - LOSS * start, GAIN * length - LOSS * (start + other)
            for paid, paid_both, other_end, before_it, u in open_:
                if other >= other_end:
                    total, past = paid_both + gain_both, 0
                elif other_end - other < length and before_it < other:
                    past = other_end - other
                    total = paid + gain - (GAIN + LOSS) * past
                else:
                    continue
                if total > total_of:
                    total_of, top_of, past_of = total, u, past
            top = (total_of, top_of, past_of)
        if top[0] >= 0:  # else what lies before can't pay for the gap
            before[t], cut[t] = top[1:]
            best[t] = totals[t] = max(GAIN * sizes[t], top[0])
    last = np.ones(n + 1, bool)
    last[before] = False  # -1 is the one too many
    leaves = np.flatnonzero(last[:-1])
    used = np.zeros(n, bool)
    for t in leaves[np.argsort(-best[leaves], kind="stable")].tolist():
        chain, need, paid, common = [], 0, 0, 0
        while t >= 0:
            here = int(i[t] + cut[t]), int(j[t] + cut[t]), int(size[t] - cut[t])
            skipped = chain[-1][0] + chain[-1][1] - here[0] - here[1] - 2 * here[2] if chain else 0
            if not used[t]:
                need += LOSS * skipped
                used[t] = True
            elif not paid:
                need, paid = need + LOSS * skipped, GAIN * here[2]
            else:
                paid += GAIN * here[2] - LOSS * skipped
            chain.append(here)
            common += here[2]
            if paid > need and common >= least:
                break
            t = int(before[t])
        if 7 * common >= 6 * (least - SHINGLE + 1):
            yield np.array(chain[::-1])


def _stretches(chain: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) segment of every longest part of a chain whose equal tokens outweigh the skipped
    ones: 7 x common >= 3 x (tokens + other tokens) is a similarity of 3/4."""
    i, j, size = chain.T
    gain = 7 * np.cumsum(size)
    least = gain - 7 * size - 3 * (i + j)
    most = np.maximum.accumulate((gain - 3 * (i + j) - 6 * size)[::-1])  # of a segment or one after it
    last = len(chain) - 1 - np.searchsorted(most, least)
    reach = np.maximum.accumulate(np.concatenate([[-1], last[:-1]]))
    a = np.flatnonzero(last > reach)
    return list(zip(a.tolist(), last[a].tolist()))


def _alignments(x: np.ndarray, z: np.ndarray, tokens: np.ndarray, others: np.ndarray, c: np.ndarray, c2: np.ndarray, least: int, once: bool = False) -> list[tuple[int, int, int, int, float]]:
    """(start, end, other start, other end, similarity) of the passages of two stretches of words (and their tokens), in
    words. For each shift with a meeting (c, c2) no passage has yet, every token of x takes the nearest place
    it has in z, seen from that shift; the runs of these are chained over neighbouring shifts.

    At a similarity of 3/4 a passage has 3/7 of both sides' tokens in common, so fewer common tokens
    than 6/7 of the least length end the search, and sides differ by a third at most. With ``once`` every
    place of the other side is settled by its first passage."""
    rest = SHINGLE - 1
    side, enough = _Side(others), lambda places: 7 * places >= 6 * (least - rest)
    i, number = side.common(tokens)
    met = np.zeros(len(side.values), bool)
    met[number] = True
    if not enough(len(i)) or not enough(int(side.counts[met].sum())):
        return []
    order = np.argsort(c - c2, kind="stable")
    shifts = (c - c2)[order]
    first = np.flatnonzero(np.concatenate([[True], shifts[1:] != shifts[:-1]]))
    shifts, counts = shifts[first], np.diff(np.append(first, len(c)))
    settled, mine, theirs = np.zeros(len(c), bool), np.zeros(len(x), bool), np.zeros(len(z), bool)
    found: dict[tuple, float] = {}

    def add(a, b, a2, b2, like):
        found[a, b, a2, b2] = like
        mine[a:b] = theirs[a2:b2] = True
        within = (a2 <= c2) & (c2 < b2)
        np.logical_or(settled, within if once else within & (a <= c) & (c < b), out=settled)

    for k in np.lexsort((shifts, -counts)).tolist():
        shift = int(shifts[k])
        if settled[order[first[k] : first[k] + counts[k]]].all():
            # of words that come back, another shift may reach further
            for a, b, a2, b2 in _equal_runs(x, z, shift, least):
                if not ((once or mine[a:b].all()) and theirs[a2:b2].all()):
                    add(a, b, a2, b2, 1.0)
            continue
        drift = len(z) // 3 + least
        low, high = np.searchsorted(i, (shift - drift, shift + len(z) + drift))
        j = side.nearest(number[low:high], i[low:high] - shift)
        if not enough(int(np.count_nonzero(np.bincount(j)))):
            continue
        for chain in _chains(_segments(i[low:high], j), least):
            rows = chain.tolist()
            parts = [(rows[a], rows[b]) for a, b in _stretches(chain)]
            parts += [(p, p) for p in rows if p[2] + rest >= least]
            for (a, a2, _), (b, b2, size) in parts:
                b, b2 = b + size + rest, b2 + size + rest
                if min(b - a, b2 - a2) < least or any(p[0] <= a and b <= p[1] and p[2] <= a2 and b2 <= p[3] for p in found):
                    continue
                if once and theirs[a2:b2].all():
                    continue
                like = _similarity(tokens[a : b - rest], others[a2 : b2 - rest])
                if 100 * like >= PER_CENT:
                    add(a, b, a2, b2, like)
    return [(*ends, like) for ends, like in sorted(found.items())]


def _equal_runs(x: np.ndarray, z: np.ndarray, shift: int, least: int) -> list[tuple[int, int, int, int]]:
    """(start, end, other start, other end) of the runs of ``least`` equal words at a shift."""
    low, high = max(0, shift), max(0, shift, min(len(x), len(z) + shift))
    cuts = np.concatenate([[low - 1], np.flatnonzero(x[low:high] != z[low - shift : high - shift]) + low, [high]])
    at = np.flatnonzero(np.diff(cuts) > least)
    return [(a + 1, b, a + 1 - shift, b - shift) for a, b in zip(cuts[at].tolist(), cuts[at + 1].tolist())]


def _similarity(x: np.ndarray, z: np.ndarray) -> float:
    """Of the token sets of two stretches."""
    if len(x) == len(z) and (x == z).all():
        return 1.0
    both = np.sort(np.concatenate([_distinct(x), _distinct(z)]))
    common = int((both[1:] == both[:-1]).sum())
    return common / max(1, len(both) - common)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def _text_words(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = W.word_spans(data, np.array([0, len(data)]), W.SPACED)
    return W.word_hashes(data, starts, ends)


_FOUND = "start long, end long, other_start long, other_end long, similarity double"


def repeated_passages(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """One row for each passage of a document and the document it is joined to: ``doc_id``, start
    and end (word numbers, end exclusive), the same of the other document, the number of places
    in it at which windows met, and the similarity."""
    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    rows = rows.withColumn("doc", F.xxhash64("id", "text"))
    least = least_words - SHINGLE + 1
    pairs = _pairs(_links(_windows(rows.select("doc", "text"), least)))

    texts = written(_texts_of(pairs, rows).dropDuplicates(["doc"]), "passage-texts")

    kind = rows.schema["id"].dataType.simpleString()
    compared = written(_compared(pairs, texts, kind, least_words), "passage-found")
    found, rest = compared.where("key IS NULL"), compared.where("key IS NOT NULL")
    pairs = _pairs(_links(_regrouped(rest)))
    if not pairs.isEmpty():
        found = found.unionByName(written(_compared(pairs, _texts_of(pairs, texts), kind, least_words).where("key IS NULL"), "passage-found"))
    pairs = _pairs(_repeats(found, texts, least_words))
    if not pairs.isEmpty():
        found = found.unionByName(_compared(pairs, _texts_of(pairs, texts), kind, least_words, once=True))
    names = ["id", "other_id", "start", "end", "other_start", "other_end", "similarity"]
    found = found.groupBy(*names).agg(F.max("met").alias("met"))
    return found.select(F.col("id").alias(doc_id), "start", "end", F.col("other_id").alias(f"other_{doc_id}"), "other_start", "other_end", "met", "similarity")


def _texts_of(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of documents that some pair has."""
    need = written(pairs.select("doc").unionByName(pairs.select(F.col("doc2").alias("doc"))).distinct(), "passage-need")
    return rows.join(F.broadcast(need) if need.count() <= BROADCAST_IDS else need, "doc", "left_semi")


def _repeats(found: DataFrame, texts: DataFrame, least_words: int) -> DataFrame:
    """Links from one document of each passage to the places where the other, the first of its group
    or of its slice's part of it, has ``least_words`` of the passage's words once more."""
    names, one, two = ("doc2", "begin", "stop", "doc", "start", "end"), ("doc2", "other_start", "other_end", "doc", "start", "end"), ("doc", "start", "end", "doc2", "other_start", "other_end")
    sides = [found.where(F.col("again").bitwiseAND(F.lit(bit)) != 0).select(*[F.col(c).alias(n) for c, n in zip(side, names)]) for bit, side in ((1, one), (2, two))]
    places = sides[0].unionByName(sides[1]).groupBy("doc2", "begin", "stop").agg(F.min(F.struct("doc", "start", "end")).alias("one"))
    places = places.groupBy("doc2").agg(F.array_sort(F.collect_list(F.struct("begin", "stop", "one.doc", "one.start", "one.end"))).alias("places"))
    given = places.join(texts.select(F.col("doc").alias("doc2"), "text"), "doc2")

    def run(batches):
        for batch in W.slices(batches):
            bounds = batch.column("places").offsets.to_numpy()
            known = [v.to_numpy() for v in batch.column("places").flatten().flatten()]
            for i, doc2 in enumerate(batch.column("doc2").to_pylist()):
                begin, end, doc, start, last = (v[bounds[i] - bounds[0] : bounds[i + 1] - bounds[0]] for v in known)
                keys = _stretch_keys(_text_words(batch.column("text")[i].as_buffer().to_pybytes()), least_words)
                distinct, number = np.unique(keys, return_inverse=True)
                covered, seen = np.full(len(keys), -1), np.full(len(distinct), -1)
                for k in range(len(begin) - 1, -1, -1):
                    covered[begin[k] : end[k] - least_words + 1] = k
                inside = np.flatnonzero(covered >= 0)
                seen[number[inside]] = inside
                more = np.flatnonzero((covered < 0) & (seen[number] >= 0))
                if not len(more):
                    continue
                shift, of = more - seen[number[more]], covered[seen[number[more]]]
                cut = np.concatenate([[True], (np.diff(more) != 1) | (np.diff(shift) != 0) | (np.diff(of) != 0)])
                c2, shift, of = more[cut], shift[cut], of[cut]
                c = np.minimum(start[of] + c2 - shift - begin[of], last[of] - SHINGLE)
                low, high = np.maximum(begin[of] + shift - least_words, 0), np.minimum(end[of] + shift + least_words, len(keys) + least_words - 1)
                rows = (doc[of], c << 32, np.full(len(c2), doc2), c2 << 32, low, high)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in rows], names=_LINK_NAMES)

    return given.mapInArrow(run, _LINK)


def _pairs(links: DataFrame) -> DataFrame:
    """One row for each pair of documents with all windows it meets in."""
    anchors = F.sort_array(F.collect_set(F.struct("at", "at2")))
    return written(links.groupBy("doc", "doc2").agg(anchors.alias("anchors"), F.min("from2").alias("from2"), F.max("to2").alias("to2")), "passage-pairs")


def _compared(pairs: DataFrame, texts: DataFrame, kind: str, least_words: int, once: bool = False) -> DataFrame:
    """The passages of each pair (key null), and (key, doc, c, span) of the stretches to group again."""
    least = least_words - SHINGLE + 1

    def cut(batches):
        """The other document's words within its windows, as 8-byte hashes, and whether it has ``least_words`` words twice."""
        for batch in W.slices(batches):
            parts, again, memory = [], [], (None, None, None)
            for i, (doc, a, b) in enumerate(zip(batch.column("doc2").to_pylist(), batch.column("from2").to_pylist(), batch.column("to2").to_pylist())):
                if memory[0] != doc:
                    words = _text_words(batch.column("text")[i].as_buffer().to_pybytes())
                    memory = (doc, words, _has_repeats(words, least_words))
                again.append(memory[2])
                parts.append(memory[1][a : b + SHINGLE].tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in ("doc", "doc2", "other_id", "anchors", "from2")], pa.array(again, pa.int32()), pa.array(parts, pa.binary())], names=["doc", "doc2", "other_id", "anchors", "from2", "again", "part"])

    side = texts.select(F.col("doc").alias("doc2"), F.col("id").alias("other_id"), "text")
    given = pairs.join(side, "doc2").select("doc", "doc2", "other_id", "anchors", "from2", "to2", "text")
    given = given.mapInArrow(cut, f"doc long, doc2 long, other_id {kind}, anchors array<struct<at:long,at2:long>>, from2 long, again int, part binary")

    def apart(doc, doc2, tokens, keys, others, from2, c, c2, mine, lead, ends):
        """(key, doc, c, span) of what the first window lacks, and of the first window's own stretches;
        ``ends`` takes the rows of the tokens where they part."""
        exact = (mine != 0) & ((mine & _NEAR_ONLY) == 0)
        for a in range(0, len(c), 4096):
            at = a + np.flatnonzero(exact[a : a + 4096])
            if len(at):
                shared = _shared_reach(tokens, c[at], others, c2[at] - from2, least - 1)
                row, before = _stretches_around(mine[at], least, shared)
                yield doc, keys, 0, c[at], (row, before)
                if len(row):
                    ends.append((doc, *_first_unshared(tokens, c[at], mine[at], shared, np.unique(row))))
        at = np.flatnonzero((lead != 0) & ((lead & _NEAR_ONLY) == 0))
        if len(at):
            yield doc2, _stretch_keys(others, least), from2, c2[at], _stretches_around(lead[at], least)
            for a in range(0, len(at), 4096):
                of = at[a : a + 4096]
                shared = _shared_reach(others, c2[of] - from2, tokens, c[of], least - 1)
                ends.append((doc2, *_first_unshared(others, c2[of] - from2, lead[of], shared, np.arange(len(of)), from2)))

    def left_open(doc, doc2, tokens, others, from2, c, c2, mine, lead):
        """(key, doc, c, span) of the places where windows that no passage holds part."""
        for owner, side, place, other, there, reach, base in ((doc, tokens, c, others, c2 - from2, mine, 0), (doc2, others, c2 - from2, tokens, c, lead, from2)):
            at = np.flatnonzero(reach)
            for a in range(0, len(at), 4096):
                of = at[a : a + 4096]
                shared = _shared_reach(side, place[of], other, there[of], least - 1)
                key, where, span = _unshared(side, place[of], reach[of], shared, base)
                if len(key):
                    key, first = np.unique(key, return_index=True)
                    yield key, np.full(len(key), owner), where[first], span[first]

    def verify(batches):
        for batch in W.slices(batches):
            out, rest, memory = [], [], (None,) * 4
            bounds = batch.column("anchors").offsets.to_numpy()
            again = batch.column("again").to_pylist()
            met = [v.to_numpy() for v in batch.column("anchors").flatten().flatten()]
            for i, (doc, doc2, from2) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("doc", "doc2", "from2")))):
                if memory[0] != doc:
                    words = _text_words(batch.column("text")[i].as_buffer().to_pybytes())
                    tokens = _tokens(words)
                    memory = (doc, words, tokens, _stretch_keys(tokens, least))
                    mine_again = 2 * _has_repeats(words, least_words)
                z = np.frombuffer(batch.column("part")[i].as_buffer(), np.uint64)
                others = _tokens(z)
                at, at2 = (v[bounds[i] - bounds[0] : bounds[i + 1] - bounds[0]] for v in met)
                c, mine, c2, lead = at >> 32, at & _LOW, at2 >> 32, at2 & _LOW
                ends = []
                for owner, keys, shift, places, (row, before) in apart(doc, doc2, *memory[2:], others, from2, c, c2, mine, lead, ends):
                    if len(row):
                        start = places[row] - before
                        rest.append((keys[start - shift], np.full(len(row), owner), places[row], (before << 32) | (least - 1 - before)))
                rest += [(key, np.full(len(key), owner), at, span) for owner, key, at, span in ends if len(key)]
                if doc == doc2:
                    rest += left_open(doc, doc2, memory[2], others, from2, c, c2, mine, lead)
                    continue
                windows, is_open = (c, c2, mine, lead), (mine | lead) != 0
                meetings = np.unique((c << 32) | c2)
                c, c2 = meetings >> 32, meetings & _LOW
                for a, b, a2, b2, like in _alignments(memory[1], z, memory[2], others, c, c2 - from2, least_words, once):
                    a2, b2 = a2 + from2, b2 + from2
                    inside = (c >= a) & (c < b) & (c2 >= a2) & (c2 < b2)
                    out.append((i, int(inside.sum()), a, b, a2, b2, like, mine_again + again[i]))
                    is_open &= ~((windows[0] >= a) & (windows[0] < b) & (windows[1] >= a2) & (windows[1] < b2))
                if is_open.any():
                    rest += left_open(doc, doc2, memory[2], others, from2, *(v[is_open] for v in windows))
            cols = list(zip(*out)) if out else [[]] * 8
            at = pa.array(cols[0], pa.int64())
            ids = [batch.column(n).take(at) for n in ("id", "other_id")]
            yield pa.RecordBatch.from_arrays([*ids, *[pa.array(v, pa.int64()) for v in cols[1:6]], pa.array(cols[6], pa.float64()), *[batch.column(n).take(at) for n in ("doc", "doc2")], pa.array(cols[7], pa.int32())] + [pa.nulls(len(at), pa.int64())] * 3, names=names)
            if rest:
                more = [pa.array(np.concatenate(v)) for v in zip(*rest)]
                n = len(more[0])
                yield pa.RecordBatch.from_arrays([pa.nulls(n, v.type) for v in ids] + [pa.nulls(n, pa.int64())] * 5 + [pa.nulls(n, pa.float64()), more[1], pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), more[0], *more[2:]], names=names)

    names = ["id", "other_id", "met", "start", "end", "other_start", "other_end", "similarity", "doc", "doc2", "again", "key", "c", "span"]
    both = given.join(texts.select("doc", "id", "text"), "doc").select("doc", "doc2", "id", "other_id", "anchors", "from2", "again", "part", "text")
    return both.mapInArrow(verify, f"id {kind}, other_id {kind}, met long, {_FOUND}, doc long, doc2 long, again int, key long, c long, span long")


def _tokens(words: np.ndarray) -> np.ndarray:
    return W.shingles(words, np.zeros(len(words), np.int64), SHINGLE)[0]


def by_document(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row for each document that shares a passage: the number of documents it is linked with,
    its own places in passages, and the list of the passages with the documents that came before it.
    A document's lists are bounded by its own length: of a document that came first only the links
    are counted, the passages are in the lists of the others."""
    found, other = written(found, "passage-links"), f"other_{doc_id}"
    names = ("id", "other", "start", "end")
    one, two = (doc_id, other, "start", "end"), (other, doc_id, "other_start", "other_end")
    sides = [found.select(*[F.col(c).alias(n) for c, n in zip(side, names)]) for side in (one, two)]
    sides = sides[0].unionByName(sides[1])
    links = sides.select("id", "other").distinct().groupBy("id").agg(F.count("*").alias("n_links"))
    places = sides.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("places"))
    passage = F.struct("start", "end", other, "other_start", "other_end", "met", "similarity")
    rows = found.groupBy(F.col(doc_id).alias("id")).agg(F.array_sort(F.collect_list(passage)).alias("passages"))
    rows = links.join(places, "id").join(rows, "id", "left").withColumn("passages", F.coalesce("passages", F.array().cast(rows.schema["passages"].dataType)))
    others = F.array_sort(F.array_distinct(F.transform("passages", lambda p: p[other])))
    return rows.select(F.col("id").alias(doc_id), others.alias(f"{other}s"), "passages", "n_links", "places")
