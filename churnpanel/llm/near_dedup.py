"""Near-duplicate documents by MinHash with sequential Bayesian verification.

1. A document's set holds its distinct word shingles.  Documents with equal sets are
   one class from the start (counted with partial sums); only one row per class goes on.
2. A signature of ``bands * rows`` minima is cut into bands; classes that agree in a
   band are candidates.  Each class is compared with the leader (the least id) of each of
   its bands; a band needs one leader row, however many members it has.
3. Sequential verification: agreeing minima are counted batch by batch.  A pair is given
   up as soon as the posterior probability that its similarity reaches the threshold
   falls below the chosen miss probability; the survivors are verified on full sets.
4. Confirmed links form components.  Classes of one band that are still in different
   components are compared too, so that no link between different texts depends on who
   leads a band.  Such pairs never become rows: signatures tell which members have a partner
   at all, and the full sets of those are streamed past each other; a task gives at most one
   link for each component that it joins, and leaves out pairs that its links have joined.

The work of step 4 shrinks with every link found: a large group of copies is one
component after step 3 and forms no pairs at all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize
from churnpanel.llm.components import connected_components
from churnpanel.llm.keys import one_text_per_key
from churnpanel.llm.text import RangeHash, byte_values, lower_ascii, mix, pieces, words

BANDS, ROWS = 32, 6
#: Minima compared at a time, and the chance of giving up a pair at the threshold.
BATCH, MISS = 32, 1e-5
#: Strays of a band that meet its members at once.
BLOCK = 1024
#: Bits of the filter by which texts that are not in question stay out of a shuffle.
FILTER_BITS = 24


def shingle_sets(buf: np.ndarray, offs: np.ndarray, size: int):
    """Distinct shingle hashes of each text of a piece, and where each set begins.

    Words are cut at ASCII blanks, A-Z lower-cased.  A text with fewer words than
    ``size`` has its whole sequence as one shingle; without words its set is empty."""
    buf = lower_ascii(buf)
    starts, ends, first = words(buf, offs)
    n = np.diff(first)
    word = RangeHash(byte_values(buf))(starts, ends)
    rh = RangeHash(word)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[:-1], count)
    hashes = rh(at, at + np.minimum(n, size)[doc])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    hashes, doc = hashes[new], doc[new]
    return hashes, np.searchsorted(doc, np.arange(len(n) + 1))


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return x[:n] | np.uint64(1), x[n:]


def signatures(hashes: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """Minima (32 bits) of ``n`` hash functions for each non-empty set."""
    mul, add = _seeds(n)
    out = np.empty((len(bounds) - 1, n), np.uint32)
    for i in range(n):
        out[:, i] = np.minimum.reduceat(((hashes * mul[i] + add[i]) >> np.uint64(32)).astype(np.uint32), bounds[:-1])
    return out


def bayes_limits(n: int, batch: int, threshold: float, miss: float) -> np.ndarray:
    """Fewest agreements needed after each batch to stay a candidate.

    Under a uniform prior the posterior of the similarity after m agreements of k is a
    Beta(m + 1, k - m + 1); its tail above the threshold is a binomial sum."""
    from math import comb

    out = []
    for k in range(batch, n + 1, batch):
        need = 0
        for m in range(k + 1):
            # P(similarity >= t | m of k) = P(Binomial(k + 1, t) <= m)
            tail = sum(comb(k + 1, j) * threshold ** j * (1 - threshold) ** (k + 1 - j) for j in range(m + 1))
            if tail >= miss:
                need = m
                break
        out.append(need)
    return np.array(out)


def survives(a: np.ndarray, b: np.ndarray, limits: np.ndarray, batch: int) -> np.ndarray:
    """Which rows of two signature matrices pass the sequential test."""
    alive = np.arange(len(a))
    agree = np.zeros(len(a), np.int64)
    for i, need in enumerate(limits):
        span = slice(i * batch, (i + 1) * batch)
        agree[alive] += (a[alive, span] == b[alive, span]).sum(1)
        alive = alive[agree[alive] >= need]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


class NearDuplicates:
    """Linked classes and components of ``docs`` (id column and text column).

    Keys are made unique as in ``one_text_per_key``; empty sets link with nothing."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
                 percent: int = 80, bands: int = BANDS, rows: int = ROWS, batch: int = BATCH, miss: float = MISS):
        self.spark = docs.sparkSession
        self.docs = one_text_per_key(docs, key, text)
        self.shingle, self.percent = shingle, percent
        self.bands, self.rows, self.batch = bands, rows, batch
        self.limits = bayes_limits(bands * rows, batch, percent / 100, miss)

    def sets(self) -> DataFrame:
        """id, n (size), two hashes of the whole set, band hashes, and the low bytes of the
        signature.  Chance agreements of low bytes only let more pairs reach the full sets."""
        size, bands, rows = self.shingle, self.bands, self.rows
        n = bands * rows

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, buf, offs in pieces(batches):
                hashes, bounds = shingle_sets(buf, offs, size)
                count = np.diff(bounds)
                full = np.flatnonzero(count)
                sig = np.zeros((len(count), n), np.uint32)
                one, two = np.zeros(len(count), np.uint64), np.zeros(len(count), np.uint64)
                if len(full):
                    starts = bounds[full]
                    sig[full] = signatures(hashes, np.append(starts, len(hashes)), n)
                    one[full] = np.add.reduceat(mix(hashes), starts)
                    two[full] = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), starts)
                band = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None], len(count), 0)
                for r in range(rows):
                    band = mix(band ^ sig[:, r::rows].astype(np.uint64)) + np.uint64(r)
                low = np.ascontiguousarray(sig.astype(np.uint8))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(count), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(count) + 1) * bands, pa.int32()), pa.array(band.view(np.int64).ravel())),
                     pa.FixedSizeBinaryArray.from_buffers(pa.binary(n), len(low), [None, pa.py_buffer(low)]).cast(pa.binary())],
                    names=["id", "n", "one", "two", "bands", "sig"])

        return self.docs.mapInArrow(emit, "id long, n long, one long, two long, bands array<bigint>, sig binary")

    def run(self) -> DataFrame:
        """doc_id, n_shingles, class_id (least id with the same set), component_id."""
        sets = materialize(self.sets(), "near-sets")
        classes = materialize(sets.where("n > 0").groupBy("n", "one", "two").agg(F.min("id").alias("class_id")), "near-classes")
        reps = sets.join(classes.select(F.col("class_id").alias("id")), "id", "left_semi").select("id", "n", "bands", "sig")
        banded = reps.select("id", F.explode("bands").alias("band"))
        # only bands with two members or more matter
        leaders = banded.groupBy("band").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("size")).where("size > 1")
        shared = materialize(banded.join(leaders.select("band", "lead"), "band"), "near-bands")
        reps = reps.select("id", "n", "sig")

        stars = materialize(shared.where("id <> lead").select(
            F.col("lead").alias("a"), F.col("id").alias("b")).distinct(), "near-stars")
        links = self._verified(stars, reps)
        component = materialize(connected_components(shared.select("id").distinct(), links), "near-components")

        # Bands whose members are still in different components: every member outside the
        # band's largest component meets all members of other components.
        tagged = shared.select("id", "band").join(component, "id")
        main = tagged.groupBy("band", "component").count().groupBy("band").agg(
            F.max_by("component", F.struct("count", "component")).alias("main"), F.count(F.lit(1)).alias("parts")
        ).where("parts > 1").select("band", "main")
        left = tagged.join(main, "band").withColumn("stray", F.col("component") != F.col("main"))
        # new links join whole components, so only these meet again (ids of both kinds are least ids)
        ends = materialize(self._linked_in_bands(left, sets), "near-ends").distinct()
        joined = connected_components(component.select(F.col("component").alias("id")).distinct(), ends)
        component = component.withColumnRenamed("component", "before").join(
            joined.withColumnRenamed("id", "before"), "before").select("id", "component")

        known = sets.select("id", "n", "one", "two").join(classes, ["n", "one", "two"], "left").select(
            F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("class_id", "id").alias("class_id"))
        return known.join(component.withColumnRenamed("id", "class_id"), "class_id", "left").select(
            "doc_id", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component_id"))

    def _linked_in_bands(self, rows: DataFrame, sets: DataFrame) -> DataFrame:
        """(a, b): components joined by a link between members of a band.

        Strays are dealt into blocks of bounded size and each block meets a stream of the band's
        members: once by signatures, for the members that have a partner, then these by full sets.
        A pair is compared in the first band it has in common."""
        limits, batch, percent = self.limits, self.batch, self.percent
        sizes = rows.where("stray").groupBy("band").agg(F.count(F.lit(1)).alias("strays"))
        parts = F.ceil(F.col("strays") / F.lit(BLOCK)).cast("int")
        # 32 bits of each band tell the first common one (a chance of 2**-27 to take a wrong one)
        short = F.transform("bands", lambda b: b.bitwiseAND(F.lit((1 << 32) - 1)))
        known = sets.select("id", "n", "sig", F.unhex(F.array_join(F.transform(short, lambda b: F.lpad(F.hex(b), 8, "0")), "")).alias("bands"))
        rows = rows.select("id", "band", "component", "stray").join(sizes.select("band", parts.alias("parts")), "band")
        own = rows.where("stray").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        every = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("stray", F.lit(False))
        place = ["band", "part", "stray", "id", "component"]
        members = own.select(*place).unionByName(every.select(*place))

        def dealt(placed: DataFrame, *more: str) -> DataFrame:
            return placed.select(*place, "n", "sig", "bands", *more).repartition("band", "part").sortWithinPartitions(
                "band", "part", F.col("stray").desc(), "id")

        def meet(batches: Iterator[pa.RecordBatch]):
            """Each batch, and for every stretch of one block: the block and pairs (place in it, row)."""
            now, block = None, []
            for rows in batches:
                if not rows.num_rows:
                    continue
                band, part, stray, ids, comp, n = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(6))
                sig = np.frombuffer(b"".join(rows.column(6).to_pylist()), np.uint8).reshape(rows.num_rows, -1)
                near = np.frombuffer(b"".join(rows.column(7).to_pylist()), ">u4").reshape(rows.num_rows, -1)
                full = rows.column(8).to_pylist() if rows.num_columns > 8 else None
                cut = np.flatnonzero((band[1:] != band[:-1]) | (part[1:] != part[:-1])) + 1
                for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), rows.num_rows]):
                    if now != (band[lo], part[lo]):
                        now, block = (band[lo], part[lo]), []
                    mid = lo + int(stray[lo:hi].sum())
                    block += [(ids[i], comp[i], n[i], sig[i].copy(), near[i].copy(), full and full[i]) for i in range(lo, mid)]
                    here, members = int(band[lo]) & 0xFFFFFFFF, np.arange(mid, hi)
                    pairs = []
                    for i, (_, c, size, s, b, _) in enumerate(block):
                        # the smaller set bounds the similarity
                        small, large = np.minimum(n[members], size), np.maximum(n[members], size)
                        some = members[(comp[members] != c) & (small * 100 >= large * percent)]
                        if len(some):
                            some = some[b[(near[some] == b).argmax(1)] == here]
                        if len(some):
                            some = some[survives(sig[some], np.broadcast_to(s, (len(some), len(s))), limits, batch)]
                        pairs.append((i, some))
                    yield now, block, pairs, ids, comp, full

        def question(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before, told = None, set()
            for now, block, pairs, ids, comp, _ in meet(batches):
                if now != before:
                    before, told = now, set()
                out = [(True, block[i][0], block[i][1]) for i, some in pairs if len(some) and i not in told]
                told.update(i for i, some in pairs if len(some))
                out += [(False, ids[x], comp[x]) for x in np.unique(np.concatenate([some for _, some in pairs] or [np.zeros(0, np.int64)])).astype(int)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([now[0]] * len(out), pa.int64()), pa.array([now[1]] * len(out), pa.int32()), pa.array([o[0] for o in out], pa.bool_()),
                     pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64())], names=place)

        def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before, root = None, {}

            def top(c: int) -> int:
                while root.get(c, c) != c:
                    c = root[c]
                return c

            for now, block, pairs, _, comp, full in meet(batches):
                if now != before:
                    before, root = now, {}
                found = []
                for i, some in pairs:
                    own = np.frombuffer(block[i][5], np.uint64)
                    for x in some.tolist():
                        a, b = top(int(block[i][1])), top(int(comp[x]))
                        if a == b:
                            continue
                        other = np.frombuffer(full[x], np.uint64)
                        shared = len(np.intersect1d(own, other, assume_unique=True))
                        if 100 * shared >= percent * (len(own) + len(other) - shared):
                            found.append((a, b))
                            root[max(a, b)] = min(a, b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        asked = materialize(dealt(members.join(known, "id")).mapInArrow(
            question, "band long, part int, stray boolean, id long, component long"), "near-asked")
        full = self._full_sets(asked.select("id").distinct())
        return dealt(asked.join(known, "id").join(full, "id"), "hashes").mapInArrow(link, "a long, b long")

    def _full_sets(self, wanted: DataFrame) -> DataFrame:
        """id, hashes: the sets of the wanted ids, made from their texts."""
        size = self.shingle

        def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, buf, offs in pieces(batches):
                hashes, bounds = shingle_sets(buf, offs, size)
                raw = hashes.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([raw[8 * a: 8 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())],
                    names=["id", "hashes"])

        # a filter of fixed size (2**FILTER_BITS bits) keeps most other texts out of the shuffle
        slot = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))
        bits = wanted.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit")).groupBy(
            "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
        docs = self.docs.withColumns({"bucket": F.bitmap_bucket_number(slot), "bit": F.bitmap_bit_position(slot)})
        asked = docs.join(F.broadcast(bits), "bucket").where(
            "getbit(cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as int), cast(bit % 8 as int)) = 1")
        texts = asked.select("id", "text").join(wanted.hint("merge"), "id", "left_semi")
        return materialize(texts.mapInArrow(full, "id long, hashes binary"), "near-full-sets")

    def _verified(self, pairs: DataFrame, reps: DataFrame) -> DataFrame:
        """The pairs that survive the sequential test and whose full sets reach the threshold."""
        limits, batch, percent = self.limits, self.batch, self.percent
        sig = reps.select("id", "sig", "n")
        both = pairs.join(sig.withColumnsRenamed({"id": "a", "sig": "sa", "n": "na"}), "a").join(
            sig.withColumnsRenamed({"id": "b", "sig": "sb", "n": "nb"}), "b")
        # the smaller set bounds the similarity
        both = both.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                if not part.num_rows:
                    continue
                a, b = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint8).reshape(part.num_rows, -1) for i in (2, 3))
                ok = survives(a, b, limits, batch)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(ok))

        alive = materialize(both.select("a", "b", "sa", "sb").mapInArrow(test, "a long, b long"), "near-alive")

        # full sets are made from the texts of the documents that are still in question
        sets = self._full_sets(alive.select(F.col("a").alias("id")).union(alive.select("b")).distinct())
        # A full set travels once per row: the first document of a pair leads a block of bounded
        # size, and the others of the block are streamed past it.
        parts = alive.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("parts"))
        lead = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("id"))
        others = alive.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("id"))
        dealt = lead.withColumn("leads", F.lit(True)).unionByName(others.withColumn("leads", F.lit(False))).join(sets, "id")
        dealt = dealt.select("a", "part", "leads", "id", "hashes").repartition("a", "part").sortWithinPartitions(
            "a", "part", F.col("leads").desc(), "id")

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros(0, np.uint64)
            for rows in batches:
                a, leads, ids = (rows.column(i).to_pylist() for i in (0, 2, 3))
                found = []
                for i, raw in enumerate(rows.column(4)):
                    other = np.frombuffer(raw.as_py(), np.uint64)
                    if leads[i]:
                        own = other
                        continue
                    shared = len(np.intersect1d(own, other, assume_unique=True))
                    if 100 * shared >= percent * (len(own) + len(other) - shared):
                        found.append((a[i], ids[i]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        return materialize(dealt.mapInArrow(exact, "a long, b long"), "near-links")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id and kept of every document with a key."""
    return NearDuplicates(docs, **options).run().withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the near-duplicates of documents with smaller doc_id.

    Rows with a null key are kept, and so are all rows of a kept key."""
    found = near_duplicates(docs, **options).where(~F.col("kept")).select("doc_id")
    return docs.join(found, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
