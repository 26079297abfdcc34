"""Line dedup by a log-template tree.

Lines go down a tree of fixed depth: first by their number of tokens, then by their
leading tokens (a token with a digit is a variable field from the start).  In a leaf,
lines that agree with a template in enough places join it, and the places where they
differ become variable fields.  A template that recurs in enough documents is
boilerplate: its lines are dropped from all of them.

A leaf is a shuffle key.  Leaves that occur in too few documents cannot hold a
recurring template; they are found by counting hashes, so only lines of the other leaves
are moved, and those once per distinct line with the number of its documents.  A leaf's
lines are streamed in sorted order; a task holds the templates of one leaf at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize, salted_join
from churnpanel.llm.keys import one_text_per_key
from churnpanel.llm.text import RangeHash, byte_values, mix, pieces, words

#: Leading tokens that make the path, share of equal places to join a template (percent),
#: documents a template must occur in, and places a template may not be without.
DEPTH, SIMILAR, LEAST_DOCS, LEAST_FIXED = 3, 60, 6, 2
FIELD = "<*>"


def split_lines(buf: np.ndarray, offs: np.ndarray, depth: int):
    """Lines with a word of each text: document, number in it, bytes, tokens, leaf and
    line hash (over tokens, variable fields masked)."""
    cut = np.unique(np.concatenate([offs[:-1], np.flatnonzero(buf == 10) + 1]))
    cut = cut[cut < len(buf)]
    if not len(cut):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    stop = np.append(cut[1:], len(buf))
    stop = stop - (buf[stop - 1] == 10)
    doc = np.searchsorted(offs, cut, "right") - 1
    number = np.arange(len(cut)) - np.searchsorted(doc, doc)
    starts, ends, _ = words(buf, offs)
    rh = RangeHash(byte_values(buf))
    digits = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf >= 48) & (buf <= 57), out=digits[1:])
    token = np.where(digits[ends] > digits[starts], np.uint64(1), rh(starts, ends))
    a, b = np.searchsorted(starts, cut), np.searchsorted(starts, stop)
    worded = b > a
    cut, stop, doc, number, a, b = (x[worded] for x in (cut, stop, doc, number, a, b))
    th = RangeHash(token)
    leaf = mix(th(a, np.minimum(a + depth, b)) ^ mix((b - a).astype(np.uint64)))
    return doc, number, cut, stop, b - a, leaf, th(a, b)


class Leaf:
    """The templates of one leaf, grown line by line."""

    def __init__(self, depth: int, similar: int):
        self.depth, self.similar = depth, similar
        self.templates: list[list[str]] = []
        self.by_token: dict[tuple[int, str], list[int]] = {}

    def place(self, tokens: list[str]) -> int:
        """Number of the template the line joins (the most similar one, the earliest on ties)."""
        n = len(tokens)
        lead = min(self.depth, n)  # these places agree in all lines of the leaf
        if 100 * lead >= self.similar * n:
            near = range(len(self.templates))
        else:  # only templates that share a fixed token beyond the lead can be similar enough
            near = sorted({k for i, t in enumerate(tokens[lead:], lead) for k in self.by_token.get((i, t), ())})
        best, most = -1, -1
        for k in near:
            fixed = sum(1 for x, t in zip(self.templates[k][lead:], tokens[lead:]) if x == t != FIELD)
            if fixed > most:
                best, most = k, fixed
        if best < 0 or 100 * (lead + most) < self.similar * n:
            best = len(self.templates)
            self.templates.append(list(tokens))
            for i, t in enumerate(tokens[lead:], lead):
                if t != FIELD:
                    self.by_token.setdefault((i, t), []).append(best)
            return best
        template = self.templates[best]
        for i, (x, t) in enumerate(zip(template, tokens)):
            if x != t:
                template[i] = FIELD
                if (i, x) in self.by_token and best in self.by_token[(i, x)]:
                    self.by_token[(i, x)].remove(best)
        return best


def recurring_lines(docs: DataFrame, depth: int = DEPTH, similar: int = SIMILAR, least_docs: int = LEAST_DOCS,
                    least_fixed: int = LEAST_FIXED) -> tuple[DataFrame, DataFrame]:
    """(templates: leaf, number, template, n_docs; lines: id, at (number in the document),
    leaf, template number) of the templates that recur.  ``docs`` has (id, text), every id once."""

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, buf, offs in pieces(batches):
            doc, _, _, _, _, leaf, _ = split_lines(buf, offs, depth)
            # documents per leaf, summed within the piece
            order = np.lexsort((doc, leaf))
            leaf, doc = leaf[order], doc[order]
            new = np.ones(len(leaf), bool)
            new[1:] = (leaf[1:] != leaf[:-1]) | (doc[1:] != doc[:-1])
            keys, n = np.unique(leaf[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["leaf", "n"])

    counted = docs.select("text").mapInArrow(leaves, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"))
    full = materialize(counted.where(F.col("n") >= least_docs).select("leaf"), "full-leaves")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, buf, offs in pieces(batches):
            doc, _, cut, stop, n, leaf, line = split_lines(buf, offs, depth)
            order = np.lexsort((doc, line, leaf))
            doc, cut, stop, leaf, line = doc[order], cut[order], stop[order], leaf[order], line[order]
            new = np.ones(len(doc), bool)
            new[1:] = (leaf[1:] != leaf[:-1]) | (line[1:] != line[:-1])
            fresh = new.copy()
            fresh[1:] |= doc[1:] != doc[:-1]
            group = np.cumsum(new) - 1
            n_docs = np.bincount(group[fresh], minlength=int(new.sum()))
            at = np.flatnonzero(new)
            text = [buf[x:y].tobytes().decode() for x, y in zip(cut[at].tolist(), stop[at].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf[at].view(np.int64)), pa.array(line[at].view(np.int64)), pa.array(n_docs.astype(np.int64)),
                 pa.array(text, pa.string())], names=["leaf", "line", "n_docs", "written"])

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masked = [" ".join(mask_bytes(x.encode())) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(masked, pa.string())], names=["leaf", "line", "n_docs", "masked"])

    # lines of one hash have the same masked tokens, so any of them may stand for all
    distinct = docs.select("text").mapInArrow(lines, "leaf long, line long, n_docs long, written string")
    distinct = distinct.join(full, "leaf", "left_semi").groupBy("leaf", "line").agg(
        F.sum("n_docs").alias("n_docs"), F.min("written").alias("written"))
    distinct = distinct.mapInArrow(mask, "leaf long, line long, n_docs long, masked string")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, leaf = None, None
        for batch in batches:
            numbers, states = [], []
            for key, masked in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if key != now:
                    now, leaf = key, Leaf(depth, similar)
                numbers.append(leaf.place(masked.split(" ")))
                states.append(" ".join(leaf.templates[numbers[-1]]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(numbers, pa.int32()), pa.array(states, pa.string())],
                names=["leaf", "line", "n_docs", "number", "template"])

    placed = distinct.select("leaf", "line", "n_docs", "masked").repartition(tasks, "leaf").sortWithinPartitions(
        "leaf", F.col("n_docs").desc(), "masked").mapInArrow(grow, "leaf long, line long, n_docs long, number int, template string")
    placed = materialize(placed, "placed-lines")
    # a template only loses fixed places, so its last state has the most fields
    fields = F.size(F.filter(F.split("template", " "), lambda t: t == FIELD))
    merged = placed.groupBy("leaf", "number").agg(
        F.sum("n_docs").alias("most"), F.max_by("template", fields).alias("template"))
    fixed = F.size(F.filter(F.split("template", " "), lambda t: t != FIELD))
    # a document may have several lines of a template: their sum only bounds its documents
    possible = materialize(merged.where((F.col("most") >= least_docs) & (fixed >= least_fixed)).drop("most"), "templates")
    number = placed.join(possible.select("leaf", "number"), ["leaf", "number"], "left_semi").select("leaf", "line", "number")

    def where(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in pieces(batches):
            doc, at, _, _, _, leaf, line = split_lines(buf, offs, depth)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(doc)), pa.array(at), pa.array(leaf.view(np.int64)), pa.array(line.view(np.int64))],
                names=["id", "at", "leaf", "line"])

    found = docs.mapInArrow(where, "id long, at long, leaf long, line long").join(number, ["leaf", "line"])
    found = materialize(found.select("id", "at", "leaf", "number"), "template-lines")
    n_docs = found.groupBy("leaf", "number").agg(F.count_distinct("id").alias("n_docs")).where(F.col("n_docs") >= least_docs)
    recurring = materialize(possible.join(n_docs, ["leaf", "number"]), "recurring-templates")
    return recurring, salted_join(found, recurring.select("leaf", "number"), ["leaf", "number"], "left_semi")


def mask_bytes(line: bytes) -> list[str]:
    """Tokens of a line (cut at ASCII blanks), those with a digit masked."""
    return [FIELD if any(48 <= c <= 57 for c in t) else t.decode() for t in line.split()]


def drop_template_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH,
                        similar: int = SIMILAR, least_docs: int = LEAST_DOCS, least_fixed: int = LEAST_FIXED) -> DataFrame:
    """doc_id, n_lines (lines with a word), n_dropped and text without dropped lines.

    A document counts once for a template, however many of its lines belong to it.  Lines without a word are kept.  Null texts are empty, keys
    are made unique as in ``one_text_per_key``; an empty table gives an empty result."""
    base = one_text_per_key(docs, key, text)
    _, dropped = recurring_lines(base, depth, similar, least_docs, least_fixed)
    hit = dropped.groupBy("id").agg(F.collect_list("at").alias("at"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in pieces(batches):
            doc = split_lines(buf, offs, depth)[0]
            n_lines = np.bincount(doc, minlength=len(offs) - 1)
            texts, n_dropped = [], []
            for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
                whole, gone = buf[a:b].tobytes(), part.column(2)[i]
                drop = set(gone.values.to_pylist()) if gone.is_valid else ()
                n_dropped.append(len(drop))
                texts.append((b"\n".join([x for k, x in enumerate(whole.split(b"\n")) if k not in drop]) if drop else whole).decode())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n_lines.astype(np.int64)), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "text"])

    # the hits grow with the texts, so both sides are shuffled at every size
    return base.join(hit.hint("merge"), "id", "left").select("id", "text", "at").mapInArrow(
        apply, "doc_id long, n_lines long, n_dropped long, text string")
