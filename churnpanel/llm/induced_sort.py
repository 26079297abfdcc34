"""Suffix sorting by external induced sorting, with common-prefix values.

Suffixes that start a rising stretch (LMS suffixes) are sorted first, by naming the
stretches and sorting the shorter string of names recursively.  All other suffixes
follow by induction: queues, one per first symbol, are served in the order of the
symbols; serving a suffix puts the one that starts a symbol earlier into its queue.  A
queue entry is a tuple of position and length of the common prefix with the entry
before it; one more than the least such value served since the last entry of the same
queue is the value of the next.  A queue longer than ``memory`` entries is on disk
except for its last part.  The text of the shard, its LMS positions and names are in
memory; ``repeats`` bounds the shard."""

from __future__ import annotations

import tempfile
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np

#: Entries of a queue held in memory, and the greatest common prefix told apart.
MEMORY, CAP = 1 << 18, 127


class DiskQueue:
    """First-in-first-out entries (64-bit numbers), read forwards while it grows or, once
    complete, backwards, in lists.  Full parts go to a temporary file of the task."""

    __slots__ = ("tail", "memory", "file", "parts")

    def __init__(self, entries: list[int], memory: int):
        self.memory, self.parts = memory, 0
        self.file = tempfile.TemporaryFile()
        self._spill(entries)

    def __len__(self) -> int:
        """Entries that are still to be moved to a file by the passes: none."""
        return 0

    def __bool__(self) -> bool:
        return True

    def append(self, x: int) -> None:
        self.tail.append(x)
        if len(self.tail) >= self.memory:
            self._spill(self.tail)

    def _spill(self, entries: list[int]) -> None:
        self.file.seek(0, 2)
        self.file.write(array("q", entries).tobytes())
        self.parts += 1
        self.tail = []

    def _part(self, i: int) -> list[int]:
        self.file.seek(i * self.memory * 8)
        return array("q", self.file.read(self.memory * 8)).tolist()

    def forwards(self, part: int) -> Iterator[list[int]]:
        """Entries from a part on, each list with what has come since the one before."""
        at = 0
        while part < self.parts or at < len(self.tail):
            if part < self.parts:
                entries, part, at = self._part(part)[at:], part + 1, 0
            else:
                entries, at = self.tail[at:], len(self.tail)
            if entries:
                yield entries

    def backwards(self) -> Iterator[list[int]]:
        if self.tail:
            yield self.tail[::-1]
        for i in range(self.parts - 1, -1, -1):
            yield self._part(i)[::-1]

    def close(self) -> None:
        self.file.close()


#: Queues of all symbols: lists, and those that have outgrown the memory.
Queues = list[list[int] | DiskQueue]


def forwards(queues: Queues, c: int) -> Iterator[list[int]]:
    """The entries of a queue while they are served, which may add to it: a list grows in the hands of the reader."""
    own = queues[c]
    if type(own) is list and own:
        yield own
    if queues[c] is not own or type(own) is DiskQueue:
        yield from queues[c].forwards(int(type(own) is list))


def backwards(queues: Queues, c: int) -> Iterator[list[int]]:
    """The entries of a complete queue, the last first.  The queue is given up."""
    own, queues[c] = queues[c], []
    if type(own) is DiskQueue:
        yield from own.backwards()
        own.close()
    elif own:
        yield own[::-1]


def close(queues: Queues, c: int) -> None:
    if type(queues[c]) is DiskQueue:
        queues[c].close()
    queues[c] = []


def symbols_before(text: np.ndarray, small: np.ndarray) -> tuple[list[int], list[int]]:
    """The symbol before each position where that one's type is L, and where it is S; else -1."""
    symbol, rise = np.concatenate([[-1], text[:-1].astype(np.int64)]), np.concatenate([[False], small[:-1]])
    return np.where(rise, -1, symbol).tolist(), np.where(rise, symbol, -1).tolist()


def types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (type S); the last is S."""
    n = len(text)
    rise = np.zeros(n, bool)
    rise[-1] = True
    if n > 1:
        rise[:-1] = text[:-1] < text[1:]
        level = np.append(text[:-1] == text[1:], False)
        settled = np.where(level, n, np.arange(n))  # equal symbols take the type of their run's end
        settled = np.minimum.accumulate(settled[::-1])[::-1]
        rise = rise[settled]
    return rise


def sort_seeds(text: np.ndarray, small: np.ndarray, memory: int) -> np.ndarray:
    """Positions of the LMS suffixes in sorted order."""
    seeds = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(seeds) < 2:
        return seeds
    # A stretch that ends counts as larger than one that goes on: its end has type S.
    stops = np.append(seeds[1:] + 1, len(text))
    if text.dtype == np.uint16 and int(text.max()) < 256:
        raw = text.astype(np.uint8).tobytes()
        parts = [raw[a:b] + b"\xff" for a, b in zip(seeds.tolist(), stops.tolist())]
    else:
        raw, top = text.tolist(), (1 << 62,)
        parts = [(*raw[a:b], *top) for a, b in zip(seeds.tolist(), stops.tolist())]
    name = {p: i for i, p in enumerate(sorted(set(parts)))}
    names = np.array([name[p] for p in parts], np.int64)
    if len(name) == len(names):
        return seeds[np.argsort(names)]
    return seeds[sort_suffixes(names, memory)]


def _follow(entries: list[int], back: list[int], queues: Queues, memory: int) -> None:
    """Serve suffixes: put those that start a symbol earlier into their queues."""
    for p in entries:
        d = back[p]
        if d >= 0:
            queue = queues[d]
            queue.append(p - 1)
            if len(queue) == memory:
                queues[d] = DiskQueue(queue, memory)


def sort_suffixes(text: np.ndarray, memory: int = MEMORY) -> np.ndarray:
    """Suffix array by induction (no common prefixes), for the recursive levels.

    The last symbol must be smaller than all others, and none below 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    small = types(text)
    seeds = sort_seeds(text, small, memory)
    back, back_small = symbols_before(text, small)
    top = int(text.max()) + 1
    upto = np.searchsorted(text[seeds], np.arange(top + 1)).tolist()  # seeds by first symbol
    seeds = seeds.tolist()

    large: Queues = [[] for _ in range(top)]
    for c in range(top):
        if large[c]:
            for part in forwards(large, c):
                _follow(part, back, large, memory)
        if upto[c] < upto[c + 1]:
            _follow(seeds[upto[c]:upto[c + 1]], back, large, memory)

    out = array("q")
    rest: Queues = [[] for _ in range(top)]
    for c in range(top - 1, -1, -1):
        if rest[c]:
            for part in forwards(rest, c):
                _follow(part, back_small, rest, memory)
                out.extend(part)
            close(rest, c)
        if large[c]:
            for part in backwards(large, c):
                _follow(part, back_small, rest, memory)
                out.extend(part)
    out.append(n - 1)
    return np.frombuffer(out, np.int64)[::-1]


def _serve(entries: list[int], now: int, stack: list[int], last: list[int], back: list[int], queues: Queues,
           memory: int) -> int:
    """Serve entries (position * 256 + common prefix): put the suffixes that start a symbol earlier
    into their queues, with their common prefix.  Returns the time, which goes up by 256 for each.

    ``stack`` has time + common prefix + 1 of the entries served that no later one is below of, on top
    of a 0: the least since a given time is the first one after it.  ``last`` has the time at which a
    symbol's queue got its last entry, or 0."""
    for entry in entries:
        h = entry & 255
        while stack[-1] & 255 > h:
            stack.pop()
        now += 256
        stack.append(now + h + 1)
        p = entry >> 8
        d = back[p]
        if d >= 0:
            then = last[d]
            last[d] = now
            h = stack[bisect_right(stack, then + 255)] & 255 if then else 0
            queue = queues[d]
            queue.append(p - 1 << 8 | (h if h < CAP else CAP))
            if len(queue) == memory:
                queues[d] = DiskQueue(queue, memory)
    return now


def sorted_suffixes(text: np.ndarray, memory: int = MEMORY) -> Iterator[tuple[int, int]]:
    """(position, common prefix with the suffix yielded before), greatest suffix first.

    The last symbol of ``text`` must be smaller than all others.  Common prefixes above
    ``CAP`` are given as ``CAP``."""
    for part in sorted_entries(text, memory):
        for entry in part:
            yield entry >> 8, entry & 255


def sorted_entries(text: np.ndarray, memory: int = MEMORY) -> Iterator[list[int]]:
    """The same as entries (position * 256 + common prefix), a list at a time."""
    n = len(text)
    if n == 1:
        yield [0]
        return
    small = types(text)
    seeds = sort_seeds(text, small, memory)
    back, back_small = symbols_before(text, small)
    # length of the run of equal symbols from each position
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    run = np.minimum(np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(n) + 1, CAP).tolist()

    common = np.zeros(len(seeds), np.int64)  # of neighbours among the seeds
    padded = np.concatenate([text, np.zeros(CAP, text.dtype)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, CAP)
    for a in range(1, len(seeds), 1 << 14):
        b = min(a + (1 << 14), len(seeds))
        differ = windows[seeds[a - 1: b - 1]] != windows[seeds[a:b]]
        common[a:b] = np.where(differ.any(1), differ.argmax(1), CAP)
    top = int(text.max()) + 1
    upto = np.searchsorted(text[seeds], np.arange(top + 1)).tolist()  # seeds by first symbol
    seeds = (seeds << 8 | common).tolist()

    large: Queues = [[] for _ in range(top)]
    now, stack, last = 0, [0], [0] * top
    for c in range(top):
        before = -1
        for part in forwards(large, c):
            if before < 0:
                part[0] &= ~255
            now = _serve(part, now, stack, last, back, large, memory)
            before = part[-1] >> 8
        part = seeds[upto[c]:upto[c + 1]]
        if part:
            p = part[0] >> 8
            part[0] = p << 8 | (min(run[before], run[p]) if before >= 0 else 0)
            now = _serve(part, now, stack, last, back, large, memory)

    rest: Queues = [[] for _ in range(top)]
    now, stack, last = 0, [0], [0] * top
    for c in range(top - 1, -1, -1):
        before = -1
        for part in forwards(rest, c):
            if before < 0:
                part[0] &= ~255
            now = _serve(part, now, stack, last, back_small, rest, memory)
            yield part
            before = part[-1] >> 8
        close(rest, c)
        above = -1
        for part in backwards(large, c):
            if above < 0:
                p = part[0] >> 8
                above = min(run[before], run[p]) if before >= 0 else 0
            # read backwards, a common prefix belongs to the entry that follows
            held = [above, *[entry & 255 for entry in part]]
            above = held.pop()
            part = [entry & ~255 | h for entry, h in zip(part, held)]
            now = _serve(part, now, stack, last, back_small, rest, memory)
            yield part
    yield [n - 1 << 8]
