"""Removal of repeated byte strings by suffix arrays of shards.

``repeats`` brings together all text that can hold a repeated string; each shard of it
is sorted by external induced sorting, whose common-prefix values give the classes of
equal strings.  All but the first string of a class are removed."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnpanel.llm.induced_sort import sorted_entries
from churnpanel.llm.keys import one_text_per_key
from churnpanel.llm.repeats import RepeatedWindows, cover
from churnpanel.llm.text import expand, pieces

LENGTH, ANCHOR, GRAIN = 100, 32, 16


def solve_shard(ids: np.ndarray, lo: np.ndarray, n: np.ndarray, bodies, length: int):
    """(row, window) of every window whose bytes also start earlier in the shard."""
    buf, offs = bodies
    # symbols: end 0, separator 1, bytes from 2
    count = np.diff(offs)
    text = np.ones(len(buf) + len(count) + 1, np.uint16)
    begin = offs[:-1] + np.arange(len(count))
    place = np.arange(len(buf)) + np.repeat(np.arange(len(count)), count)
    text[place] = buf.astype(np.uint16) + 2
    text[-1] = 0
    # a string that holds a separator is no window; equal strings agree in that
    window = np.zeros(len(text), bool)
    window[expand(begin, n.astype(np.int64))] = True
    entries = array("q")
    for part in sorted_entries(text):
        entries.extend(part)
    entries = np.frombuffer(entries, np.int64)
    opens = np.flatnonzero((entries & 255) < length)  # the first of each class
    size = np.diff(np.append(opens, len(entries)))
    many = (size > 1) & window[entries[opens] >> 8]
    where = entries[np.repeat(many, size)] >> 8
    group = np.repeat(np.arange(many.sum()), size[many])
    # the least by document and place of each class stays
    row = np.searchsorted(begin, where, "right") - 1
    order = np.lexsort((lo[row] + where - begin[row], ids[row], group))
    again = group[order][1:] == group[order][:-1]
    at = np.sort(where[order[1:][again]])
    row = np.searchsorted(begin, at, "right") - 1
    return row, at - begin[row]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, grain: int = GRAIN) -> DataFrame:
    """doc_id, text, kept (the remaining bytes), lo and hi (maximal removed runs).

    A byte is removed if a string of ``length`` bytes covers it that also starts earlier
    (smaller key, or same key and earlier).  Texts shorter than that keep everything; null
    texts are empty; keys are made unique as in ``one_text_per_key``; an empty
    table gives an empty result.  ``length`` may not exceed 127."""
    if not anchor <= length <= 127:
        raise ValueError("length must lie between the anchor's length and 127")
    base = one_text_per_key(docs, key, text)

    def solver(ids, lo, n, bodies):
        return solve_shard(ids, lo, n, bodies, length)

    found = RepeatedWindows(base, "bytes", length, anchor, grain, True, solver).removals()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in pieces(batches):
            kept, los, his = [], [], []
            for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
                own = buf[a:b]
                if not part.column(2)[i].is_valid:
                    kept.append(own.tobytes())
                    los.append([])
                    his.append([])
                    continue
                gone = cover(part.column(2)[i].values.to_numpy(), part.column(3)[i].values.to_numpy(), b - a)
                kept.append(own[~gone].tobytes())
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                los.append(edge[::2].tolist())
                his.append(edge[1::2].tolist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(kept, pa.binary()),
                 pa.array(los, pa.list_(pa.int64())), pa.array(his, pa.list_(pa.int64()))],
                names=["doc_id", "text", "kept", "lo", "hi"])

    return base.join(found, "id", "left").select("id", "text", "lo", "hi").mapInArrow(
        apply, "doc_id long, text string, kept binary, lo array<bigint>, hi array<bigint>")


def digest(result: DataFrame) -> DataFrame:
    n = F.octet_length("text").cast("long")
    return result.select(
        "doc_id", n.alias("n_bytes"), (n - F.length("kept")).cast("long").alias("n_removed"),
        F.size("lo").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
