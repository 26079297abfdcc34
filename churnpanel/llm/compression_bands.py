"""Quality rules by compression bands.

Text that a general compressor shrinks far more than prose is repetitive; text it
hardly shrinks is noise.  The ratio (compressed over plain bytes, zstandard) is
taken for the whole document and for chunks that cover all of it, and held against
limits that depend on the length, because short texts compress less.  Before that, base
rules reject documents that are too short or mostly repeated three-word windows.

The limits are learnt from the corpus itself, without labels: of all different texts that
pass the base rules, each length class (half octaves of bytes; documents and chunks apart)
has a median ratio and an interquartile range, and what lies further than ``REACH`` ranges from
the median is rejected.  A class with fewer than ``LEAST_TEXTS`` texts has fixed bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize
from churnpanel.llm.text import RangeHash, byte_values, mix, pieces, words

LEVEL = 3
#: Bytes of a chunk; a last part of under half of that belongs to the chunk before it.
CHUNK = 512
#: Interquartile ranges from the median to a limit, least range, texts a class needs, length classes.
REACH, LEAST_RANGE, LEAST_TEXTS, CLASSES = 2.5, 0.015, 100, 64
#: Steps of a ratio that are counted; larger ratios (tiny texts) count as the last one.
STEPS, TOP = 1000, 4000
#: Where nothing is learnt: (at least so many bytes, least and greatest ratio of a kept document).
DOCUMENT_BANDS = ((0, 0.25, 1.20), (512, 0.22, 0.85), (2048, 0.20, 0.75), (8192, 0.16, 0.70), (32768, 0.12, 0.68))
#: The same for a chunk.  At 4096 bytes 0.15 is 0.115 above repeated lines and 0.80 is 0.035
#: below printable noise; shorter chunks have these distances to what such texts give there
#: (up to 256 bytes a chunk is a whole text and has the limits of one).
CHUNK_BANDS = ((0, 0.25, 1.20), (256, 0.31, 0.91), (384, 0.29, 0.88), (512, 0.25, 0.85), (768, 0.24, 0.83),
               (1024, 0.195, 0.81), (2048, 0.15, 0.80))
#: Share of chunks outside their band that rejects a document.
CHUNK_SHARE = 0.25
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, doc_ratio double, "
            "n_chunks long, base_failed boolean, _q_bytes long, _q_print long, _q_chunks array<double>")
VERDICT = ("n_chunks_low", "n_chunks_high", "kept")


def _per_doc(marks: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out


def base_counts(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The five base counts of each document of a piece."""
    docs = len(offs) - 1
    starts, ends, first = words(buf, offs)
    n_words = np.diff(first)
    rh = RangeHash(byte_values(buf))
    point = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=point[1:])
    chars = point[ends] - point[starts]

    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True

    # lines: cut at \n and at document edges
    cut = np.unique(np.concatenate([offs[:-1], np.flatnonzero(buf == 10) + 1]))
    cut = cut[cut < len(buf)] if len(buf) else cut[:0]
    stop = np.append(cut[1:], len(buf)) if len(cut) else cut
    stop = stop - (buf[stop - 1] == 10) if len(cut) else stop
    owner = np.searchsorted(offs, cut, "right") - 1
    worded = np.searchsorted(starts, stop) > np.searchsorted(starts, cut)
    cut, stop, owner = cut[worded], stop[worded], owner[worded]
    line = mix(rh(cut, stop) ^ mix(owner.astype(np.uint64)) ^ (stop - cut).astype(np.uint64))
    _, earliest = np.unique(line, return_index=True)
    later = np.ones(len(line), np.int64)
    later[earliest] = 0

    # words covered by a three-word window that occurs twice in its document
    covered = np.zeros(len(starts) + 1, np.int64)
    if len(starts) >= 3:
        doc = np.repeat(np.arange(docs), n_words)
        whole = np.flatnonzero(doc[2:] == doc[:-2])
        tri = RangeHash(rh(starts, ends)).rolling(3)[whole]
        at = whole[_repeats(mix(tri ^ mix(doc[whole].astype(np.uint64) + np.uint64(1))))]
        np.add.at(covered, at, 1)
        np.subtract.at(covered, np.minimum(at + 3, len(starts)), 1)
    return {
        "n_words": n_words, "word_chars": _per_doc(chars, first), "n_symbols": _per_doc(symbol[buf], offs),
        "n_dup_lines": np.bincount(owner, weights=later, minlength=docs).astype(np.int64),
        "n_repeat_words": _per_doc(np.cumsum(covered[:-1]) > 0, first),
    }


def band(n_bytes: int, bands=DOCUMENT_BANDS) -> tuple[float, float]:
    return [(lo, hi) for least, lo, hi in bands if n_bytes >= least][-1]


def chunk_ends(n_bytes: int, chunk: int = CHUNK) -> list[int]:
    """Ends of the chunks of a text; together they cover it."""
    if not n_bytes:
        return []
    ends = list(range(chunk, n_bytes - (chunk + 1) // 2 + 1, chunk))
    return [*ends, n_bytes]


def ratios(data: bytes, compressor, chunk: int = CHUNK) -> tuple[float, np.ndarray, np.ndarray]:
    """Ratio of the whole text, and ratios and lengths of its chunks."""
    whole = len(compressor.compress(data)) / len(data) if data else 1.0
    ends = chunk_ends(len(data), chunk)
    each = [len(compressor.compress(data[a:b])) / (b - a) for a, b in zip([0, *ends], ends)]
    return whole, np.array(each), np.diff([0, *ends])


def measure(
    docs: DataFrame, text_col: str = "text", level: int = LEVEL, chunk: int = CHUNK, min_words: int = MIN_WORDS,
    max_repeat: int = MAX_REPEAT_PERCENT, keep_text: bool = True,
) -> DataFrame:
    """``docs`` with base counts, ratios, and ``_q_`` columns: bytes, print (hash) and chunk ratios."""
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(MEASURES)
    names = {*added.fieldNames(), *VERDICT}
    rest = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names])
    stay = [c for c in rest.columns if keep_text or c != text_col]
    schema = StructType([rest.schema[c] for c in stay] + added.fields)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=level)
        for rows, buf, offs in pieces(batches, text_col):
            got = base_counts(buf, offs)
            data = buf.tobytes()
            found = [ratios(data[a:b], compressor, chunk)[:2] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            failed = (got["n_words"] < min_words) | (100 * got["n_repeat_words"] > max_repeat * got["n_words"])
            prints = RangeHash(byte_values(buf))(offs[:-1], offs[1:])
            new = [*got.values(), [r for r, _ in found], [len(x) for _, x in found], failed, np.diff(offs),
                   prints.view(np.int64), [x for _, x in found]]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(rows.schema.get_field_index(c)) for c in stay),
                 *(pa.array(v) if i < len(new) - 1 else pa.array(v, pa.list_(pa.float64())) for i, v in enumerate(new))],
                names=schema.fieldNames())

    return rest.mapInArrow(emit, schema)


def length_class(n_bytes: Column) -> Column:
    """Half octaves; the last class holds all longer texts."""
    return F.least(F.floor(2 * F.log2(F.greatest(n_bytes, F.lit(1)))), F.lit(CLASSES - 1)).cast("int")


def _last_chunk(chunk: int) -> Column:
    """Bytes of the last chunk of a document."""
    return F.col("_q_bytes") - chunk * (F.col("n_chunks") - 1)


def fit_limits(measured: DataFrame, chunk: int = CHUNK, reach: float = REACH, least_range: float = LEAST_RANGE,
               least_texts: int = LEAST_TEXTS) -> DataFrame:
    """kind ("document", "chunk"), cls, lo, hi of the length classes with enough texts.

    Every different text that passes the base rules counts once, so copies decide nothing;
    ratios are counted by steps (partial sums), and quartiles are read from the counts."""
    texts = measured.where("not base_failed").groupBy("_q_print", "_q_bytes", "n_chunks").agg(
        F.min("doc_ratio").alias("doc_ratio"), F.min("_q_chunks").alias("_q_chunks"))

    def part(kind: str, size: Column, ratio: Column) -> Column:
        step = F.least(F.floor(ratio * STEPS), F.lit(TOP)).cast("int")
        return F.struct(F.lit(kind).alias("kind"), length_class(size).alias("cls"), step.alias("step"))

    chunks = F.transform("_q_chunks", lambda r, i: part(
        "chunk", F.when(i < F.col("n_chunks") - 1, F.lit(chunk).cast("long")).otherwise(_last_chunk(chunk)), r))
    parts = texts.select(F.explode(F.concat(
        F.array(part("document", F.col("_q_bytes"), F.col("doc_ratio"))), chunks)).alias("p")).select("p.*")
    counts = parts.groupBy("kind", "cls", "step").agg(F.count(F.lit(1)).alias("n"))
    # at most TOP + 1 rows in a class
    by = Window.partitionBy("kind", "cls")
    counts = counts.withColumns({"upto": F.sum("n").over(by.orderBy("step")), "n_all": F.sum("n").over(by)})
    quartiles = counts.where(F.col("n_all") >= least_texts).groupBy("kind", "cls").agg(*[
        (F.min(F.when(F.col("upto") * 4 >= F.col("n_all") * q, F.col("step"))) / STEPS).alias(f"q{q}") for q in (1, 2, 3)])
    width = F.greatest(F.col("q3") - F.col("q1"), F.lit(least_range)) * reach
    return quartiles.select("kind", "cls", (F.col("q2") - width).alias("lo"), (F.col("q2") + width).alias("hi"))


def judge(measured: DataFrame, limits: DataFrame, chunk: int = CHUNK, bands=DOCUMENT_BANDS, chunk_bands=CHUNK_BANDS,
          chunk_share: float = CHUNK_SHARE) -> DataFrame:
    """``measured`` with n_chunks_low, n_chunks_high and kept, without the ``_q_`` columns."""
    learnt = {(r.kind, r.cls): (r.lo, r.hi) for r in limits.collect()}  # at most 2 * CLASSES rows

    def limit(kind: str, size: Column, side: int) -> Column:
        fixed = bands if kind == "document" else chunk_bands
        plain = F.lit(fixed[0][side + 1])
        for row in fixed[1:]:
            plain = F.when(size >= row[0], row[side + 1]).otherwise(plain)
        own = F.array(*[F.lit(learnt[kind, c][side] if (kind, c) in learnt else None).cast("double") for c in range(CLASSES)])
        return F.coalesce(F.get(own, length_class(size)), plain)

    def outside(side: int) -> Column:
        full, last = limit("chunk", F.lit(chunk).cast("long"), side), limit("chunk", _last_chunk(chunk), side)

        def off(r: Column, i: Column) -> Column:
            bound = F.when(i < F.col("n_chunks") - 1, F.col("_q_full")).otherwise(F.col("_q_last"))
            return r < bound if side == 0 else r > bound

        return F.size(F.filter("_q_chunks", off)).cast("long"), full, last

    out = measured
    for side, name in enumerate(VERDICT[:2]):
        count, full, last = outside(side)
        out = out.withColumns({"_q_full": full, "_q_last": last}).withColumn(name, count)
    size, ratio = F.col("_q_bytes"), F.col("doc_ratio")
    fits = ratio.between(limit("document", size, 0), limit("document", size, 1)) & (
        F.col("n_chunks_low") + F.col("n_chunks_high") <= F.col("n_chunks") * chunk_share)
    out = out.withColumn("kept", fits & ~F.col("base_failed"))
    return out.drop("_q_bytes", "_q_print", "_q_chunks", "_q_full", "_q_last")


def with_quality(
    docs: DataFrame, text_col: str = "text", level: int = LEVEL, chunk: int = CHUNK, bands=DOCUMENT_BANDS,
    chunk_bands=CHUNK_BANDS, chunk_share: float = CHUNK_SHARE, min_words: int = MIN_WORDS,
    max_repeat: int = MAX_REPEAT_PERCENT, keep_text: bool = True, **fit,
) -> DataFrame:
    """``docs`` with the base counts, ratios and verdict of each whole text.

    Output columns replace input columns of the same name, and columns called ``_q_...`` are
    the operator's own.  Null and empty texts have no words, so they fail the base rules; rows
    are judged one by one, hence repeated rows and null keys need no special case.  Where
    no class has enough texts (small or empty tables) the fixed bands hold."""
    measured = materialize(measure(docs, text_col, level, chunk, min_words, max_repeat, keep_text), "quality")
    return judge(measured, fit_limits(measured, chunk, **fit), chunk, bands, chunk_bands, chunk_share)
