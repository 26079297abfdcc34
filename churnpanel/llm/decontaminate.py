"""Benchmark decontamination by size-partitioned MinHash containment search.

A short item inside a long document shares little with the document as a whole, so
minima of whole documents cannot find it.  Here the sizes are kept apart:

* items are partitioned by their number of shingles (powers of two).  Each item is
  sketched by its least hashes, as many as the largest item of its partition may miss at
  the threshold, plus one.  An item contained to the threshold has at least one
  of them in the document, so no contained item is lost, however long the document is;
* documents keep only hashes that some partition's sketches can hold: a filter of fixed
  size (2**22 bits, whatever the number of items) is sent to the tasks.

Candidates are verified exactly: the share of an item's shingles (as text) found in the
document.  All joins are on single shingles; shingles common to many documents are
combined per document before they meet."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize
from churnpanel.llm.text import RangeHash, byte_values, lower_ascii, pieces, words

SHINGLE, PERCENT = 5, 80
FILTER_BITS = 22


def _shingles(buf: np.ndarray, offs: np.ndarray, size: int):
    """Lower-cased bytes; (document, hash, first byte, end byte) of all word shingles.

    Fewer words than ``size`` make one shingle of them all."""
    buf = lower_ascii(buf)
    starts, ends, first = words(buf, offs)
    n = np.diff(first)
    rh = RangeHash(RangeHash(byte_values(buf))(starts, ends))
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[:-1], count)
    to = at + np.minimum(n, size)[doc]
    if not len(doc):
        none = np.zeros(0, np.int64)
        return buf, none, np.zeros(0, np.uint64), none, none
    return buf, doc, rh(at, to), starts[at], ends[to - 1]


def _spelled(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[str]:
    return [b" ".join(buf[a:b].tobytes().split()).decode() for a, b in zip(begin.tolist(), end.tolist())]


def _item(item_id: Column, text: Column) -> Column:
    """One name for each (id, text): equal ids with several texts are items side by side."""
    return F.concat(F.coalesce(item_id.cast("string"), F.lit("")), F.lit(":"), F.sha2(text.cast("binary"), 256))


def _document(key: str) -> Column:
    """One name for each document: its key, or its text where the key is null."""
    text = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return F.coalesce(F.col(key).cast("long").cast("string"), F.concat(F.lit(":"), text))


def _number(name: str) -> Column:
    """The id at the front of a name, null where it has none."""
    return F.expr(f"cast(nullif(substring_index({name}, ':', 1), '') as long)")


def item_shingles(items: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """item (see ``_item``), n (distinct shingles), hash, shingle, and whether it belongs to the sketch."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in pieces(batches):
            buf, doc, hashes, begin, end = _shingles(buf, offs, size)
            order = np.lexsort((hashes, doc))
            doc, hashes, begin, end = doc[order], hashes[order], begin[order], end[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
            doc, hashes, begin, end = doc[new], hashes[new], begin[new], end[new]
            n = np.bincount(doc, minlength=len(offs) - 1)
            rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
            # the partition's largest size decides how many minima its items keep
            upper = (1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))[doc]
            may_miss = upper - -(-upper * percent // 100)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(doc)), pa.array(n[doc]), pa.array(hashes.view(np.int64)),
                 pa.array(_spelled(buf, begin, end), pa.string()), pa.array(rank <= may_miss)],
                names=["item", "n", "hash", "shingle", "in_sketch"])

    text = F.coalesce("text", F.lit(""))
    rows = items.select(_item(F.col("item_id").cast("long"), text).alias("item"), text.alias("text"))
    return rows.distinct().mapInArrow(emit, "item string, n long, hash long, shingle string, in_sketch boolean")


def shingle_filter(shingles: DataFrame) -> np.ndarray:
    """Bits of the hashes' upper part: 2**22 at most, combined in Spark word by word."""
    slot = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    got = shingles.select(slot.alias("slot")).groupBy(F.shiftright("slot", 5).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 31 as int)))").alias("bits")).collect()
    bits = np.zeros(1 << FILTER_BITS, bool)
    for r in got:
        base = r["word"] << 5
        for k in range(32):
            if r["bits"] >> k & 1:
                bits[base + k] = True
    return bits


def contained_items(docs: DataFrame, items: DataFrame, size: int = SHINGLE, percent: int = PERCENT,
                    key: str = "doc_id") -> DataFrame:
    """doc_id, item_id, n_item (shingles of the item), n_shared, containment: one row for
    each item whose shingles lie in a document to ``percent`` or more.

    An item is an (item_id, text): rows that repeat both are one, equal ids (null ones too)
    with several texts are items of their own, with a row each.  Items without words are in no pair.
    Rows that repeat a document key count as one document (their shingles together); rows
    without a key are documents by their text and have a null doc_id.  Null texts are empty; an
    item of fewer than ``size`` words is one shingle and is found only in a document of
    just those words.  Empty tables give an empty result."""
    found = _contained(docs, items, size, percent, key)
    return found.select(_number("document").alias("doc_id"), _number("item").alias("item_id"), "n_item", "n_shared",
                        (F.col("n_shared") / F.col("n_item")).alias("containment"))


def _contained(docs: DataFrame, items: DataFrame, size: int = SHINGLE, percent: int = PERCENT,
               key: str = "doc_id") -> DataFrame:
    """document, item (names), n_item, n_shared of the pairs that reach ``percent``."""
    shingles = materialize(item_shingles(items, size, percent), "item-shingles")
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(shingle_filter(shingles)))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(bits.value).view(bool)
        for part, buf, offs in pieces(batches):
            buf, doc, hashes, begin, end = _shingles(buf, offs, size)
            hit = np.flatnonzero(known[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            # once per document
            order = np.lexsort((hashes[hit], doc[hit]))
            hit = hit[order]
            new = np.ones(len(hit), bool)
            new[1:] = (doc[hit][1:] != doc[hit][:-1]) | (hashes[hit][1:] != hashes[hit][:-1])
            hit = hit[new]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(doc[hit])), pa.array(hashes[hit].view(np.int64)),
                 pa.array(_spelled(buf, begin[hit], end[hit]), pa.string())],
                names=["document", "hash", "shingle"])

    rows = docs.select(_document(key).alias("document"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows.mapInArrow(emit, "document string, hash long, shingle string")
    # what passed the filter by chance goes; the rest is few rows per document
    found = materialize(found.join(shingles.select("hash").distinct(), "hash", "left_semi"), "item-hits")

    candidates = found.join(shingles.where("in_sketch").select("item", "hash"), "hash").select("document", "item").distinct()
    exact = found.select("document", "shingle").distinct().join(
        shingles.select("item", "n", "shingle").distinct(), "shingle").join(candidates, ["document", "item"])
    exact = exact.groupBy("document", "item").agg(F.max("n").alias("n_item"), F.countDistinct("shingle").alias("n_shared"))
    return exact.where(F.col("n_shared") * 100 >= F.col("n_item") * percent)


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = SHINGLE, percent: int = PERCENT,
                      key: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that contain an item; all rows of such a key go, and
    rows without a key go by their own text."""
    hit = _contained(docs, items, size, percent, key).select(F.col("document").alias("_hit")).distinct()
    name = _document(key)
    # names of the documents' own columns cannot clash with a packed row
    packed = docs.select(name.alias("_hit"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return packed.join(hit, "_hit", "left_anti").select("_row.*")
