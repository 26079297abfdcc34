"""Removal of repeated word windows by suffix automata of reference shards.

``repeats`` brings together all passages that can hold a repeated window.  Each shard
of them is indexed by a suffix automaton over words with occurrence counts, and its
documents' passages are streamed through it: at every word the longest ending that
occurs at least twice is the matching statistic, and where it reaches the threshold the
maximal span is removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnpanel.llm.keys import one_text_per_key
from churnpanel.llm.repeats import RepeatedWindows, cover
from churnpanel.llm.text import pieces, words

LENGTH, ANCHOR, GRAIN = 35, 8, 8


class SuffixAutomaton:
    """Automaton of all substrings of a set of sequences, with their occurrence counts."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len, self.count = [-1], [0], [0]
        self.last = 0

    def add(self, sequence, end: int) -> None:
        """Append a sequence and a closing symbol that occurs nowhere else."""
        for symbol in (*sequence, end):
            self._extend(symbol)

    def _extend(self, symbol: int) -> None:
        nxt, link, length = self.next, self.link, self.len
        new = len(nxt)
        nxt.append({})
        length.append(length[self.last] + 1)
        self.count.append(1)
        p = self.last
        while p >= 0 and symbol not in nxt[p]:
            nxt[p][symbol] = new
            p = link[p]
        if p < 0:
            link.append(0)
        else:
            q = nxt[p][symbol]
            if length[p] + 1 == length[q]:
                link.append(q)
            else:
                link.append(new + 1)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                self.count.append(0)
                link.append(link[q])
                while p >= 0 and nxt[p].get(symbol) == q:
                    nxt[p][symbol] = new + 1
                    p = link[p]
                link[q] = new + 1
        self.last = new

    def close(self) -> None:
        """Sum occurrence counts from long states to short ones."""
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.link[v] > 0:
                self.count[self.link[v]] += self.count[v]

    def statistics(self, sequence) -> list[int]:
        """At every symbol, the longest ending that occurs twice or more."""
        out, v, matched = [], 0, 0
        for symbol in sequence:
            while v and symbol not in self.next[v]:
                v = self.link[v]
                matched = self.len[v]
            v = self.next[v].get(symbol, 0)
            matched = matched + 1 if v else 0
            while v and self.count[v] < 2:
                v = self.link[v]
                matched = self.len[v]
            out.append(matched)
        return out


def solve_shard(n: np.ndarray, bodies, length: int):
    """(row, window) of every window that occurs more than once in the shard."""
    buf, offs = bodies
    values = np.frombuffer(buf.tobytes(), np.uint64)
    # numbering the words keeps the automaton's keys small
    _, number = np.unique(values, return_inverse=True)
    number = number.tolist()
    cut = (offs // 8).tolist()
    automaton = SuffixAutomaton()
    for i in range(len(n)):
        automaton.add(number[cut[i]: cut[i + 1]], -1 - i)
    automaton.close()
    rows, at = [], []
    for i in range(len(n)):
        for j, matched in enumerate(automaton.statistics(number[cut[i]: cut[i + 1]])):
            if matched >= length:
                rows.append(i)
                at.append(j - length + 1)
    return np.array(rows, np.int64), np.array(at, np.int64)


def remove_repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                            anchor: int = ANCHOR, grain: int = GRAIN) -> DataFrame:
    """doc_id, n_words, n_removed and kept (remaining words joined by a space).

    A word is removed if a window of ``length`` words covers it whose words also start
    anywhere else.  Texts with fewer words keep them all; null texts have none; keys are
    made unique as in ``one_text_per_key``; an empty table gives an empty result."""
    if not anchor + grain <= length <= 1023:
        raise ValueError("length must exceed anchor and grain")
    base = one_text_per_key(docs, key, text)

    def solver(ids, lo, n, bodies):
        return solve_shard(n, bodies, length)

    found = RepeatedWindows(base, "words", length, anchor, grain, False, solver).removals()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in pieces(batches):
            starts, ends, first = words(buf, offs)
            kept, gone_n = [], []
            for i in range(len(offs) - 1):
                s, e = starts[first[i]: first[i + 1]], ends[first[i]: first[i + 1]]
                if part.column(2)[i].is_valid:
                    gone = cover(part.column(2)[i].values.to_numpy(), part.column(3)[i].values.to_numpy(), len(s))
                    s, e = s[~gone], e[~gone]
                gone_n.append(int(first[i + 1] - first[i]) - len(s))
                kept.append(b" ".join(buf[offs[i]: offs[i + 1]].tobytes().split()) if not gone_n[-1] else
                            b" ".join([buf[a:b].tobytes() for a, b in zip(s.tolist(), e.tolist())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(first)), pa.array(gone_n, pa.int64()), pa.array([k.decode() for k in kept], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])

    return base.join(found, "id", "left").select("id", "text", "lo", "hi").mapInArrow(
        apply, "doc_id long, n_words long, n_removed long, kept string")
