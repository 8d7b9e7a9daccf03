"""External induced sorting of the suffixes of a text, with the lengths of their common prefixes.

The suffixes that begin a rising run (LMS suffixes) are put in order first; all
others are induced from them, one character at a time: whoever is popped pushes
the suffix one place to the left into the queue of that suffix's first
character. A queue of a character is popped when its turn comes, in the order
in which it was filled, so the queues together are a priority queue by
(character, rank of the suffix to the right). Entries are (place, common prefix
with the entry before), kept in numpy blocks that go to a scratch file once
they exceed the memory given, and are read back block by block.

The order of the LMS suffixes is found the same way: one induction from
unordered ones sorts the substrings between them, equal substrings get equal
names, and the text of names, about a third as long, is ordered in turn (by
doubling the number of names compared, as buckets of names hold few suffixes
each). Only ``depth`` characters matter: longer common prefixes count as that
long, and their order is left open.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

_BLOCK = 1 << 18


class Queues:
    """First-in-first-out queues of (place, common prefix), one per character, in memory up to ``memory`` bytes."""

    def __init__(self, characters: int, memory: int) -> None:
        self.chunks: list[list] = [[] for _ in range(characters)]
        self.memory, self.held, self.file = memory, 0, None

    def push(self, character: int, places: np.ndarray, common: np.ndarray) -> None:
        size = places.nbytes + common.nbytes
        if self.held + size <= self.memory:
            self.held += size
            # Slices of a batch would keep the whole batch in memory.
            self.chunks[character].append((places.copy(), common.copy()))
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # scratch of this task, gone with it
        at = self.file.seek(0, 2)
        self.file.write(places.tobytes())
        self.file.write(common.tobytes())
        self.chunks[character].append((at, len(places)))

    def pop(self, character: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Large blocks in order; what is pushed to the same queue meanwhile comes last."""
        while self.chunks[character]:
            queue, self.chunks[character] = self.chunks[character], []
            block, size = [], 0
            for i, chunk in enumerate(queue):
                block.append(self._read(*chunk))
                size += len(block[-1][0])
                if size >= _BLOCK or i == len(queue) - 1:
                    yield tuple(map(np.concatenate, zip(*block, strict=True)))
                    block, size = [], 0

    def _read(self, first: np.ndarray | int, second: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(second, int):
            self.file.seek(first)
            places = np.frombuffer(self.file.read(4 * second), np.int32)
            return places, np.frombuffer(self.file.read(second), np.uint8)
        self.held -= first.nbytes + second.nbytes
        return first, second

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class _Least:
    """Minima of runs of one array: a table with one row per power of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [values]
        while 2 << (len(self.rows) - 1) <= len(values):
            row, half = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(row[:-half], row[half:]))
        self.flat = np.concatenate(self.rows)
        self.starts = np.cumsum([0, *map(len, self.rows)])[:-1]

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least of values[begin:end], for runs that are not empty."""
        level = np.frexp((end - begin).astype(np.float64))[1] - 1
        base = self.starts[level]
        return np.minimum(self.flat[base + begin], self.flat[base + end - (1 << level)])


class _Induction:
    """One direction: pops suffixes in order and pushes their left neighbours of the wanted type."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, characters: int, depth: int, memory: int) -> None:
        """Without ``depth`` no common prefixes are worked out."""
        self.text, self.wanted, self.depth = text, wanted, depth
        self.queues = Queues(characters, memory)
        # The least common prefix met since a queue was last pushed to; an empty queue's first entry shares nothing.
        self.since = np.full(characters, -1, np.int64)

    def step(self, places: np.ndarray, common: np.ndarray) -> None:
        """Induces from suffixes in order; ``common`` is shared with the one popped before."""
        for i in range(0, len(places), _BLOCK):
            self._block(places[i : i + _BLOCK], common[i : i + _BLOCK])

    def _block(self, places: np.ndarray, common: np.ndarray) -> None:
        left = places - 1
        ok = (left >= 0) & self.wanted[left]
        index = np.flatnonzero(ok)
        floor = int(common.min(initial=255)) if self.depth else 0
        if not len(index):
            np.minimum(self.since, floor, out=self.since)
            return
        left = left[index]
        target = self.text[left]
        order = np.argsort(target, kind="stable")
        left, target, index = left[order], target[order], index[order]
        head = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
        heads, last = target[head], np.append(head[1:], len(index)) - 1
        value = self._common(common, index, head, heads, last, floor) if self.depth else np.zeros(len(index), np.uint8)
        for character, a, b in zip(heads.tolist(), head.tolist(), (last + 1).tolist(), strict=True):
            self.queues.push(character, left[a:b], value[a:b])

    def _common(
        self, common: np.ndarray, index: np.ndarray, head: np.ndarray, heads: np.ndarray, last: np.ndarray, floor: int
    ) -> np.ndarray:
        """What each new entry shares with the one before it in its queue: one more than the inducers in between all share."""
        begin = np.empty_like(index)
        begin[1:] = index[:-1] + 1
        begin[head] = 0
        least = _Least(common)
        shared = least.of(begin, index + 1).astype(np.int64)
        shared[head] = np.minimum(shared[head], self.since[heads])
        np.minimum(self.since, floor, out=self.since)
        after = index[last] + 1
        rest = np.full(len(last), 255, np.int64)
        more = np.flatnonzero(after < len(common))
        if len(more):
            rest[more] = least.of(after[more], np.full(len(more), len(common)))
        self.since[heads] = rest
        return np.minimum(shared + 1, self.depth).astype(np.uint8)


def _shared(text: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes, of which ``known`` characters are equal already."""
    out = np.minimum(known, depth)
    active = np.flatnonzero(out < depth)
    end = len(text)
    while len(active):
        x, y = a[active] + out[active], b[active] + out[active]
        inside = np.maximum(x, y) < end
        active, x, y = active[inside], x[inside], y[inside]
        active = active[text[x] == text[y]]
        out[active] += 1
        active = active[out[active] < depth]
    return out


def _induce(
    text: np.ndarray, falling: np.ndarray, starts: np.ndarray, common: np.ndarray, characters: int, depth: int, memory: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in descending order, in blocks, each with the prefix it shares with the next larger one.

    ``starts`` are the LMS suffixes, in order by at least their first character,
    with the prefixes they share with the one before.
    """
    bounds = np.searchsorted(text[starts], np.arange(characters + 1))
    run = _Induction(text, falling, characters, depth, memory)
    kept = Queues(characters, memory)
    for c in range(characters):
        np.minimum(run.since, 0, out=run.since)
        last = -1
        for places, shared in run.queues.pop(c):
            last = int(places[-1])
            kept.push(c, places, shared)
            run.step(places, shared)
        a, b = bounds[c], bounds[c + 1]
        if a < b:
            places, shared = starts[a:b], common[a:b].copy()
            shared[0] = 0 if last < 0 or not depth else _shared(text, starts[a : a + 1], np.array([last]), np.zeros(1, np.int64), depth)[0]
            run.step(places, shared)
    run.queues.close()
    run = _Induction(text, ~falling, characters, depth, memory)
    for c in reversed(range(characters)):
        np.minimum(run.since, 0, out=run.since)
        last = -1
        for places, shared in run.queues.pop(c):
            last = int(places[-1])
            yield places, shared
            run.step(places, shared)
        blocks = list(kept.pop(c))
        for i, (places, shared) in enumerate(reversed(blocks)):
            # Downwards an entry shares with the one popped before what that one shared with it upwards.
            places = places[::-1]
            down = np.empty(len(places), np.uint8)
            down[1:] = shared[:0:-1]
            if i:
                down[0] = above
            elif last >= 0 and depth:
                down[0] = _shared(text, places[:1], np.array([last]), np.zeros(1, np.int64), depth)[0]
            else:
                down[0] = 0
            above = shared[0]
            yield places, down
            run.step(places, down)
    run.queues.close()
    kept.close()
    # Nothing stands to the right of the last suffix, so it is not induced; it is the smallest.
    yield np.array([len(text) - 1], np.int32), np.zeros(1, np.uint8)


def _order_names(
    names: np.ndarray, by: np.ndarray, places: np.ndarray, depth: int
) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Order of the suffixes of a text of names, and their ranks by the first 1, 2, 4 ... names.

    ``by`` orders them by their first name. A rank is the first place of its group in the order.
    """
    n = len(names)
    order = by.copy()
    rank = np.empty(n, np.int32)
    first = np.flatnonzero(np.append(True, names[by[1:]] != names[by[:-1]]))
    sizes = np.diff(np.append(first, n))
    rank[order] = np.repeat(first, sizes)
    levels, h = [(1, rank)], 1
    far = np.append(places, places[-1] + 2 * depth)
    open_ = order[np.repeat(sizes > 1, sizes)]
    while len(open_):
        # Groups that agree in all that matters stay tied.
        open_ = open_[far[np.minimum(open_ + h, n)] - places[open_] < depth]
        ahead = open_ + h
        key = rank[open_].astype(np.int64) * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        sort = np.argsort(key)
        open_, key = open_[sort], key[sort]
        group = rank[open_]
        index = np.arange(len(open_))
        fresh = np.append(True, key[1:] != key[:-1])[: len(key)]
        group_first = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1])[: len(key)], index, 0))
        key_first = np.maximum.accumulate(np.where(fresh, index, 0))
        order[group + index - group_first] = open_
        rank = rank.copy()
        rank[open_] = group + key_first - group_first
        h *= 2
        levels.append((h, rank))
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(open_)))
        open_ = open_[np.repeat(sizes > 1, sizes)]
    return order, levels


def sorted_suffixes(text: np.ndarray, characters: int, depth: int = 200, memory: int = 64 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all suffixes in descending order, in blocks, each with the length of the prefix shared with the next larger.

    ``text`` holds unsigned characters below ``characters`` and ends with a 0 that
    stands nowhere else; ``depth`` is at most 254. The queues keep at most
    ``memory`` bytes in memory. A text of the 0 alone has one suffix.
    """
    n = len(text)
    # A suffix falls if it is greater than the one to its right; within a run of one character all do what the last does.
    change = np.flatnonzero(text[1:] != text[:-1])
    falls = text[change] > text[change + 1]
    falling = np.zeros(n, bool)
    if len(change):
        falling[: change[-1] + 1] = np.repeat(falls, np.diff(np.append(-1, change)))
    lms = (np.flatnonzero(falling[:-1] & ~falling[1:]) + 1).astype(np.int32)
    if not len(lms):
        yield np.array([n - 1], np.int32), np.zeros(1, np.uint8)
        return
    rough = lms[np.argsort(text[lms], kind="stable")]
    nothing = np.zeros(len(rough), np.uint8)
    number = np.full(n, -1, np.int32)
    number[lms] = np.arange(len(lms), dtype=np.int32)
    found = []
    for block, _ in _induce(text, falling, rough, nothing, characters, 0, memory):
        mine = number[block]
        found.append(mine[mine >= 0])
    by = np.concatenate(found)[::-1]
    # Names: equal substrings from one LMS place to the next, that place included.
    sizes = np.diff(np.append(lms, n))
    sizes[:-1] += 1
    ordered = sizes[by]
    same = ordered[1:] == ordered[:-1]
    pairs = np.flatnonzero(same)
    a, b, left = lms[by[pairs]], lms[by[pairs + 1]], ordered[pairs]
    at = 0
    while len(pairs):
        equal = text[a + at] == text[b + at]
        same[pairs[~equal]] = False
        at += 1
        equal &= left > at
        pairs, a, b, left = pairs[equal], a[equal], b[equal], left[equal]
    names = np.empty(len(lms), np.int32)
    names[by] = np.cumsum(np.append(False, ~same))
    places = lms.astype(np.int64)
    order, levels = _order_names(names, by, places, depth)
    # What neighbours share: whole names first, from the longest run of names down, then single characters.
    known = np.zeros(len(order) - 1, np.int64)
    far = np.append(lms, n)
    first = levels[0][1]
    ok = np.flatnonzero(first[order[:-1]] == first[order[1:]])
    x, y = order[ok], order[ok + 1]
    for h, rank in reversed(levels):
        equal = np.flatnonzero(rank[np.minimum(x, len(lms) - 1)] == rank[np.minimum(y, len(lms) - 1)])
        equal = equal[np.maximum(x[equal], y[equal]) < len(lms)]
        x[equal] = np.minimum(x[equal] + h, len(lms))
        y[equal] = np.minimum(y[equal] + h, len(lms))
    known[ok] = far[x] - lms[order[ok]]
    del levels, first, rank, number, found, sizes, ordered
    starts = lms[order]
    common = np.zeros(len(starts), np.uint8)
    common[1:] = _shared(text, places[order[:-1]], places[order[1:]], known, depth)
    yield from _induce(text, falling, starts, common, characters, depth, memory)
