"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q that no neighbouring word
extends keeping that period, at least ``least`` words and two periods long.

The states of a suffix automaton form a tree (each state's parent holds the next shorter
suffixes).  Words are appended one by one; the path from the state of the whole prefix to
the root holds all suffixes that end here, and every state remembers where its words ended
last.  Those ends fall into segments along the path.  Access in a link-cut forest
visits the segments of the old path and recolours them with the new end: a segment whose
longest suffix has ``length`` words and ended ``distance`` words ago, within its length,
is a square, and ``distance + length`` words with that period end here.  They are a run as
soon as the next word breaks the period.  The last end is the nearest one, so ``distance``
is the smallest period, and the suffix being the longest with that end, the run cannot be
extended to the left; each run is found once, at its end.

All words of a run lie in groups of ``least // 2`` words that occur twice in it, so words
outside such groups cannot belong to a run.  They are cut off by hashes first (equal
groups have equal hashes, so nothing is lost); what remains goes through the automaton,
whose words are compared exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from churnpanel.llm.text import RangeHash, mix

#: Least words of a run.
LEAST = 12
#: Characters of text whose rows leave a task together.
PIECE = 1 << 20
#: How often a stretch is cut again before it goes to the automaton as it is.
CUTS = 6


def covered(ids: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal stretches of words that lie in a group of ``width`` words occurring twice."""
    if len(ids) <= width:
        return []
    grams = RangeHash(mix(ids.astype(np.uint64) + np.uint64(1))).rolling(width)
    order = np.sort(grams)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return []
    at = np.searchsorted(twice, grams)
    hit = twice[np.minimum(at, len(twice) - 1)] == grams
    marks = np.zeros(len(ids) + 1, np.int64)
    places = np.flatnonzero(hit)
    marks[places] += 1
    np.subtract.at(marks, places + width, 1)
    inside = np.cumsum(marks[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def stretches(ids: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Where runs can lie: parts covered by groups that occur twice within the part."""
    out, todo = [], [(0, len(ids), 0)]
    while todo:
        lo, hi, cuts = todo.pop()
        for a, b in covered(ids[lo:hi], least // 2):
            if b - a < least:
                continue
            if cuts == CUTS or b - a == hi - lo:
                out.append((lo + a, lo + b))
            else:
                todo.append((lo + a, lo + b, cuts + 1))
    return sorted(out)


class SuffixTree:
    """The automaton of one sequence: parent and length of each state, and the state of
    each prefix.  States are numbered from 1; 0 is nothing, 1 the root."""

    def __init__(self, words: list[int]):
        follow: list[dict[int, int]] = [{}, {}]
        parent, length = [0, 0], [0, 0]
        self.prefix: list[int] = []
        last = 1
        for c in words:
            new = len(parent)
            parent.append(1)
            length.append(length[last] + 1)
            follow.append({})
            p = last
            while p and c not in follow[p]:
                follow[p][c] = new
                p = parent[p]
            if p:
                q = follow[p][c]
                if length[p] + 1 != length[q]:
                    clone = len(parent)
                    parent.append(parent[q])
                    length.append(length[p] + 1)
                    follow.append(follow[q].copy())
                    while p and follow[p].get(c) == q:
                        follow[p][c] = clone
                        p = parent[p]
                    parent[q] = clone
                    q = clone
                parent[new] = q
            self.prefix.append(new)
            last = new
        parent[1] = 0
        self.parent, self.length = parent, length


class LastEnds:
    """A link-cut forest over a fixed tree: preferred paths are splay trees ordered by
    depth, and all states of one path share the place where they ended last."""

    def __init__(self, parent: list[int]):
        self.up = list(parent)  # splay parent, or the tree parent of a path's top
        self.shallow = [0] * len(parent)
        self.deep = [0] * len(parent)
        self.end = [-1] * len(parent)  # valid at the root of a splay tree

    def _rotate(self, x: int) -> None:
        up, shallow, deep = self.up, self.shallow, self.deep
        p = up[x]
        g = up[p]
        if g:
            if shallow[g] == p:
                shallow[g] = x
            elif deep[g] == p:
                deep[g] = x
        if shallow[p] == x:
            child = deep[x]
            shallow[p], deep[x] = child, p
        else:
            child = shallow[x]
            deep[p], shallow[x] = child, p
        if child:
            up[child] = p
        up[p], up[x] = x, g

    def _splay(self, x: int) -> None:
        up, shallow, deep = self.up, self.shallow, self.deep
        top = x
        while True:
            p = up[x]
            if not p or (shallow[p] != x and deep[p] != x):
                break
            g = up[p]
            if g and (shallow[g] == p or deep[g] == p):
                self._rotate(p if (shallow[g] == p) == (shallow[p] == x) else x)
                top = g
            else:
                top = p
            self._rotate(x)
        self.end[x] = self.end[top]

    def access(self, state: int, now: int) -> Iterator[tuple[int, int]]:
        """Recolour the path from ``state`` to the root with ``now``; yields the deepest
        state and the old end of every segment, from the deepest on."""
        up, deep, end = self.up, self.deep, self.end
        x, below = state, 0
        while x:
            self._splay(x)
            was = end[x]
            if deep[x]:
                end[deep[x]] = was  # the deeper part leaves the path with its own end
            deep[x] = below
            yield x, was
            below, x = x, up[x]
        end[below] = now


def sequence_runs(words: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    tree = SuffixTree(words)
    ends, length, n = LastEnds(tree.parent), tree.length, len(words)
    out = []
    for i in range(n):
        for state, was in ends.access(tree.prefix[i], i):
            period, span = i - was, length[state]
            if was < 0 or period > span or span + period < least:
                continue
            if i + 1 < n and words[i + 1] == words[i + 1 - period]:
                continue  # goes on
            out.append((i - period - span + 1, span + period, period))
    return sorted((s, n_, p) for s, n_, p in out)


def text_runs(words: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Runs of a list of words: (start, length, period), by start, then period."""
    if len(words) < least:
        return []
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):
        return []
    out = []
    for lo, hi in stretches(ids, least):
        out += [(lo + s, n, p) for s, n, p in sequence_runs(ids[lo:hi].tolist(), least)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words, without those of a run after its first period."""
    if not runs:
        return words
    marks = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        marks[start + period] += 1
        marks[start + length] -= 1
    gone = np.cumsum(marks[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def with_runs(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with ``runs`` (array of start, length, period by start, then period; words
    are numbered from 0) and ``collapsed`` (the words that stay, joined by one space).

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, null texts have none.  Rows are
    independent: no shuffle, repeated rows and null keys are rows like others.  Columns
    called ``runs`` or ``collapsed`` are replaced, an empty table stays empty."""
    kept = [f for f in docs.schema.fields if f.name not in ("runs", "collapsed")]
    schema = T.StructType([*kept, T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])
    names = [f.name for f in kept]
    kind = pa.list_(pa.field("element", pa.struct([pa.field(f.name, pa.int64(), False) for f in RUN.fields]), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            at, size, found, left = 0, 0, [], []

            def rows(to: int) -> pa.RecordBatch:
                part = batch.slice(at, to - at)
                lists = pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found], kind)
                return pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(n)) for n in names] + [lists, pa.array(left, pa.string())],
                    schema=pa.schema([part.schema.field(n) for n in names] + [("runs", kind), ("collapsed", pa.string())]))

            for i in range(batch.num_rows):
                data = (column[i].as_py() or "").encode()
                words = data.split()
                found.append(text_runs(words, least))
                left.append(b" ".join(collapse(words, found[-1])).decode())
                size += len(data)
                if size >= PIECE:
                    yield rows(i + 1)
                    at, size, found, left = i + 1, 0, [], []
            if found:
                yield rows(batch.num_rows)

    return docs.mapInArrow(run, schema)
