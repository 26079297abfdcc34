"""Repeated windows of a corpus, found without comparing documents pairwise.

Every window of ``length`` symbols (bytes or words) has an anchor, its least-hashed
``k``-gram; equal windows have equal anchors.  So

1. documents are cut into contexts (consecutive windows of one anchor); equal contexts of
   one task are combined before anything is shuffled;
2. contexts meet by anchor: an anchor seen once cannot lie in a repeated window, equal
   contexts are settled as a whole (the first in document order stands for them), and
   only different contexts of one anchor remain open;
3. open contexts are cut into blocks of ``grain`` windows by their place at the anchor.
   The windows of a block share a core; blocks meet by core, equal ones are settled, and
   only different blocks of one core go on, with their symbols;
4. a core with more different blocks than fit a shard is crowded (many documents share a
   passage and differ around it): its windows are hashed one by one and counted in Spark;
5. a shard solver (suffix array, suffix automaton) decides the others, window by window.

A hot passage thus costs one row per task and step, not one per copy, and a solver sees
each different text once and at most two shards of text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize, salted_join
from churnpanel.llm.text import (
    RangeHash, buffers, byte_values, contexts, expand, mix, pieces, words,
)

#: A settled context (all its windows are repeated), and one that only stands for others.
OPEN, SETTLED, STANDS = 0, 1, 2
#: Bytes of text in which equal contexts are combined before the shuffle.
PIECE = 4 << 20
#: Symbols a solver gets at once (up to twice that, as cores stay whole); a core with more is crowded.
SHARD = {"bytes": 1 << 20, "words": 1 << 18}


def symbols(buf: np.ndarray, offs: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """Symbol values of a piece and the offsets of its documents among them."""
    if unit == "bytes":
        return byte_values(buf), offs
    starts, ends, first = words(buf, offs)
    return RangeHash(byte_values(buf))(starts, ends), first


def _settle(rows: DataFrame, group: str, content: str, keep_first: bool) -> DataFrame:
    """Columns nth, settled, open and contents (open ones of the group) of rows that met by ``group``.

    A content seen twice is settled: all its rows, or all but the first."""
    rows = rows.repartition(F.col(group))
    same = Window.partitionBy(group, content)
    rows = rows.withColumn("nth", F.row_number().over(same.orderBy("id", "lo")))
    if keep_first:
        settled = F.col("nth") > 1
    else:
        settled = (F.count(F.lit(1)).over(same) > 1) | (F.max("kind").over(same) == STANDS)
    whole = Window.partitionBy(group)
    several = F.min(content).over(whole) != F.max(content).over(whole)
    return rows.withColumns({
        "settled": (F.col("kind") == SETTLED) | settled,
        "open": (F.col("kind") != SETTLED) & (F.col("nth") == 1) & several,
        "contents": F.sum(F.when((F.col("kind") != SETTLED) & (F.col("nth") == 1), 1).otherwise(0)).over(whole)})


class RepeatedWindows:
    """Ranges of repeated windows in ``docs`` (id, text), every id once.

    ``keep_first``: a window is reported where it also starts earlier (smaller id, or
    same id and earlier); otherwise wherever it starts more than once."""

    def __init__(self, docs: DataFrame, unit: str, length: int, k: int, grain: int, keep_first: bool,
                 solver: Callable):
        self.docs, self.unit, self.length, self.k, self.grain = docs, unit, length, k, grain
        self.keep_first, self.solver = keep_first, solver

    def anchored(self) -> DataFrame:
        """a (anchor), c (content), id, lo, meta (windows, anchor place), kind."""
        unit, length, k, keep_first = self.unit, self.length, self.k, self.keep_first

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, buf, offs in pieces(batches, size=PIECE):
                values, bounds = symbols(buf, offs, unit)
                seq, lo, run, place, a, c = contexts(values, bounds, length, k)
                ids = part.column(0).to_numpy()[seq]
                lo = lo - bounds[seq]
                # equal contexts of this piece are settled here; one stands for them
                order = np.lexsort((lo, ids, c, a))
                a, c, ids, lo, run, place = (x[order] for x in (a, c, ids, lo, run, place))
                again = np.zeros(len(a) + 1, bool)
                again[1:-1] = (a[1:] == a[:-1]) & (c[1:] == c[:-1])
                kind = np.where(again[:-1], SETTLED, OPEN)
                if not keep_first:
                    kind[again[1:] & ~again[:-1]] = STANDS
                meta = run | place << 10
                if not keep_first:  # the one that stands is settled itself
                    extra = np.flatnonzero(kind == STANDS)
                    a, c, ids, lo, meta = (np.concatenate([x, x[extra]]) for x in (a, c, ids, lo, meta))
                    kind = np.concatenate([kind, np.full(len(extra), SETTLED)])
                done = kind == SETTLED  # these only pass through, spread over all tasks
                a = np.where(done, mix(ids.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + lo.astype(np.uint64)), a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), pa.array(ids), pa.array(lo),
                     pa.array(meta.astype(np.int32)), pa.array(kind.astype(np.int8))],
                    names=["a", "c", "id", "lo", "meta", "kind"])

        return self.docs.mapInArrow(emit, "a long, c long, id long, lo long, meta int, kind byte")

    def blocks(self, open_rows: DataFrame) -> DataFrame:
        """core, sub (content), id, lo, n (windows), kind and body of the blocks of open contexts."""
        unit, length, k, grain = self.unit, self.length, self.k, self.grain
        wanted = open_rows.groupBy("id").agg(F.collect_list(F.struct("lo", "meta")).alias("at"))
        rows = self.docs.join(wanted, "id").select("id", "text", F.col("at.lo").alias("lo"), F.col("at.meta").alias("meta"))

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, buf, offs in pieces(batches):
                values, bounds = symbols(buf, offs, unit)
                size = part.column(2).value_lengths().to_numpy(zero_copy_only=False)
                own = np.repeat(np.arange(len(size)), size)
                first = part.column(2).flatten().to_numpy() + bounds[own]
                meta = part.column(3).flatten().to_numpy().astype(np.int64)
                run, anchor = meta & 1023, first + (meta >> 10)
                # windows by their distance to the anchor, cut at multiples of the grain
                near, far = anchor - (first + run - 1), anchor - first
                j = expand(near // grain, far // grain - near // grain + 1)
                at = np.repeat(np.arange(len(first)), far // grain - near // grain + 1)
                hi, lo = np.minimum(far[at], (j + 1) * grain - 1), np.maximum(near[at], j * grain)
                start, n = anchor[at] - hi, hi - lo + 1
                rh = RangeHash(values)
                core = rh(anchor[at] - j * grain, anchor[at] - (j + 1) * grain + 1 + length)
                core = mix(core ^ (j.astype(np.uint64) + np.uint64(1)))
                sub = mix(rh(start, start + n + length - 1) ^ (n + hi * 4096).astype(np.uint64))
                body = _bodies(buf if unit == "bytes" else values, start, n + length - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(sub.view(np.int64)), pa.array(part.column(0).to_numpy()[own[at]]),
                     pa.array(start - bounds[own[at]]), pa.array(n.astype(np.int32)),
                     pa.array(np.zeros(len(n), np.int8)), body],
                    names=["core", "sub", "id", "lo", "n", "kind", "body"])

        return rows.mapInArrow(emit, "core long, sub long, id long, lo long, n int, kind byte, body binary")

    def crowded_windows(self, rows: DataFrame) -> DataFrame:
        """id, lo, hi of the repeated windows of crowded cores.  Equal windows have equal cores,
        so they meet by core and window hash, counted with partial sums."""
        length, unit = self.length, self.unit

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                buf, offs = buffers(batch.column(4))
                values = byte_values(buf) if unit == "bytes" else np.frombuffer(buf.tobytes(), np.uint64)
                begin = offs[:-1] // (1 if unit == "bytes" else 8)
                core, ids, lo, n = (batch.column(i).to_numpy() for i in range(4))
                own, at = np.repeat(np.arange(len(n)), n), expand(begin, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core[own]), pa.array(RangeHash(values)(at, at + length).view(np.int64)), pa.array(ids[own]),
                     pa.array(lo[own] + at - begin[own])], names=["core", "window", "id", "lo"])

        each = rows.select("core", "id", "lo", "n", "body").mapInArrow(emit, "core long, window long, id long, lo long")
        again = each.groupBy("core", "window").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("id", "lo")).alias("first"))
        found = salted_join(each, again.where("times > 1").drop("times"), ["core", "window"], "inner", ["id", "lo"])
        if self.keep_first:
            found = found.where(F.struct("id", "lo") != F.col("first"))
        return found.select("id", "lo", (F.col("lo") + length).alias("hi"))

    def ranges(self) -> DataFrame:
        """id, lo, hi: symbols covered by reported windows (ranges may overlap)."""
        length, unit, solver, size = self.length, self.unit, self.solver, SHARD[self.unit]
        met = _settle(self.anchored(), "a", "c", self.keep_first).where("settled or open")
        met = materialize(met.select("id", "lo", "meta", "settled", "open"), "contexts")
        whole = met.where("settled").select("id", "lo", (F.col("lo") + F.col("meta").bitwiseAND(1023) + (length - 1)).alias("hi"))

        blocks = _settle(self.blocks(met.where("open")), "core", "sub", self.keep_first).where("settled or open")
        crowded = (F.col("contents") * (length + self.grain - 1) > size).alias("crowded")
        blocks = materialize(blocks.select("core", "id", "lo", "n", "settled", "open", crowded, F.when(F.col("open"), F.col("body")).alias("body")), "blocks")
        more = blocks.where("settled").select("id", "lo", (F.col("lo") + F.col("n") + (length - 1)).alias("hi"))

        def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for cores, ids, lo, n, bodies in _shards(batches, size, unit):
                row, at = solver(ids, lo, n, bodies)
                if len(row):
                    # neighbouring windows of one row make one range
                    new = np.ones(len(row), bool)
                    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
                    begin = np.flatnonzero(new)
                    end = np.append(begin[1:], len(row)) - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[row[begin]]), pa.array(lo[row[begin]] + at[begin]), pa.array(lo[row[begin]] + at[end] + length)],
                        names=["id", "lo", "hi"])

        last = blocks.where("open and not crowded").select("core", "id", "lo", "n", "body").repartition(F.col("core")).sortWithinPartitions(
            "core", "id", "lo").mapInArrow(solve, "id long, lo long, hi long")
        return whole.unionByName(more).unionByName(last).unionByName(self.crowded_windows(blocks.where("open and crowded")))

    def removals(self) -> DataFrame:
        """id and the ranges (lo, hi arrays) of every document with any."""
        return self.ranges().groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("at")).select(
            "id", F.col("at.lo").alias("lo"), F.col("at.hi").alias("hi"))


def _bodies(source: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    flat = source[expand(start, size)]
    offs = np.concatenate([[0], np.cumsum(size)]) * source.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def _shards(batches, size: int, unit: str):
    """Rows of whole cores, about ``size`` symbols at a time."""
    held, amount = [], 0
    width = 1 if unit == "bytes" else 8

    def flush(table: pa.Table):
        t = table.combine_chunks()
        buf, offs = buffers(t.column(4).combine_chunks() if t.column(4).num_chunks else pa.array([], pa.binary()))
        return tuple(t.column(i).to_numpy() for i in range(4)) + ((buf, offs),)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        amount += batch.column(4).nbytes
        if amount < size * width:
            continue
        table = pa.Table.from_batches(held)
        cores = table.column(0).to_numpy()
        cut = int(np.searchsorted(cores, cores[-1]))  # the last core may go on
        if cut:
            yield from _split(table.slice(0, cut), size * width, flush)
        held = table.slice(cut).to_batches()
        amount = sum(b.column(4).nbytes for b in held)
    if held:
        yield from _split(pa.Table.from_batches(held), size * width, flush)


def _split(table: pa.Table, size: int, flush):
    cores = table.column(0).to_numpy()
    length = pc.fill_null(pc.binary_length(table.column(4)), 0).to_numpy().astype(np.int64)
    upto, at = np.cumsum(length), 0
    while at < len(cores):
        to = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size)) + 1
        to = int(np.searchsorted(cores, cores[min(to, len(cores)) - 1], "right"))
        yield flush(table.slice(at, to - at))
        at = to


def cover(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` symbols lie in any of the ranges."""
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, lo, 1)
    np.subtract.at(mark, np.minimum(hi, n), 1)
    return np.cumsum(mark[:-1]) > 0
