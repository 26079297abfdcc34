"""Token-id shards compressed by Re-Pair grammars.

Documents are tokenised in ascending doc_id order and cut into shards of whole
documents.  In each shard the most frequent pairs of adjacent ids are replaced by
new nonterminals, for ``ROUNDS`` rounds of at most ``RULES_PER_ROUND`` rules each and only
where a pair is found ``LEAST`` times; rarer pairs stay as they are, which costs size and
not content (no symbol spans more than 2**ROUNDS tokens).  A shard stores its rules, the expansion length of every rule and the rewritten sequence, so any
token range can be decoded by walking only the rules it touches.

File format: a Parquet folder written by Spark (a lost task leaves no half file),
one row per shard: order columns and the shard as one binary value, little endian:

    magic "RPS2" | u32 terminals | u32 rules | u32 symbols | u32 documents | u64 tokens
    | u8 width | rules 2 x u<width> each | expansion lengths u32 each
    | symbols u<width> each | positions u64 each (tokens before symbol 0, STRIDE, ...)
    | document ends u64 each (in tokens)

Pairs are taken in rounds.  A round replaces all pairs that are frequent enough at
once; where chosen pairs overlap, the one further left wins, so a round equals one
pass of the classic algorithm for several of its most frequent pairs."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnpanel.llm.text import RangeHash, byte_values, expand, lower_ascii, pieces, words

MAGIC = b"RPS2"
#: Tokens after which a shard is closed (at the next document end), rules a round may
#: add, and symbols between two stored positions.
SHARD_TOKENS, RULES_PER_ROUND, STRIDE = 1 << 20, 4096, 1 << 12
#: A round has to remove one symbol in so many, or the grammar is finished.
ROUND_GAIN = 2000
#: Remembered words per task.
MEMORY = 300_000
_HASH_BITS = 20
#: Slots of the table of recent words.
_RECENT_BITS = 19


# --- grammar -------------------------------------------------------------------

def _frequent(seq: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent adjacent pairs (packed), at most ``most``, each at least ``least``
    times; where they stand and which of them stands there."""
    key = (seq[:-1].astype(np.uint64) << np.uint64(32)) | seq[1:]
    # a hashed histogram leaves few pairs to count exactly
    slot = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _HASH_BITS)).astype(np.int64)
    rough = np.bincount(slot, minlength=1 << _HASH_BITS)
    able = rough[rough >= least]
    floor = int(np.partition(able, -most)[-most]) if most < len(able) else least
    at = np.flatnonzero((rough >= floor)[slot])
    pairs, which, n = np.unique(key[at], return_inverse=True, return_counts=True)
    # ties go to the smaller pair; a pair that shared its slot may fall below the floor
    chosen = np.lexsort((pairs, -n))[:most]
    chosen = np.sort(chosen[n[chosen] >= least])
    number = np.full(len(pairs), -1)
    number[chosen] = np.arange(len(chosen))
    ok = number[which] >= 0
    return pairs[chosen], at[ok], number[which[ok]]


def _leftmost(at: np.ndarray) -> np.ndarray:
    """Of hits that overlap (pair at i and at i+1), every second from the left, as a mask."""
    if not len(at):
        return np.zeros(0, bool)
    new = np.ones(len(at), bool)
    new[1:] = np.diff(at) > 1
    first = np.flatnonzero(new)
    rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    return rank % 2 == 0


def width_of(symbols: int) -> int:
    """Bytes of a symbol when there are so many different ones."""
    return 2 if symbols <= 1 << 16 else 4


def price(width: int) -> int:
    """Fewest occurrences at which a rule (two symbols and its length) saves bytes."""
    return (2 * width + 4) // width + 1


def compress(ids: np.ndarray, terminals: int, per_round: int = RULES_PER_ROUND,
             least: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, expansion lengths) of one id sequence.

    Pairs found ``least`` times (default: as often as a rule pays) are replaced until a round
    removes almost nothing, or until one more rule would widen every symbol."""
    width = width_of(terminals)
    least = least or price(width)
    room = (1 << 8 * width) - terminals
    seq = ids.astype(np.uint32)
    rules, lengths = [np.zeros((0, 2), np.uint32)], [np.zeros(0, np.uint32)]
    n_rules = 0
    all_lengths = np.ones(terminals, np.uint32)
    while len(seq) > 1 and n_rules < room:
        pairs, at, number = _frequent(seq, least, min(per_round, room - n_rules))
        if not len(pairs):
            break
        keep = _leftmost(at)
        at, number = at[keep], number[keep]
        # what overlaps took from a pair may leave it too rare to pay
        pays = np.bincount(number, minlength=len(pairs)) >= least
        at, number = at[pays[number]], number[pays[number]]
        if len(at) * ROUND_GAIN < len(seq):
            break
        used, number = np.unique(number, return_inverse=True)
        rule = np.stack([(pairs[used] >> np.uint64(32)).astype(np.uint32), pairs[used].astype(np.uint32)], 1)
        seq = seq.copy()
        seq[at] = (terminals + n_rules + number).astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        new = all_lengths[rule[:, 0]] + all_lengths[rule[:, 1]]
        all_lengths = np.concatenate([all_lengths, new])
        rules.append(rule)
        lengths.append(new)
        n_rules += len(rule)
    return seq, np.concatenate(rules), np.concatenate(lengths)


def expand_symbols(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids of a symbol sequence; every pass opens one level of all rules."""
    seq = symbols.astype(np.uint32)
    while len(seq) and int(seq.max()) >= terminals:
        inner = seq >= terminals
        size = np.where(inner, 2, 1)
        out = np.repeat(seq, size)
        at = np.cumsum(size) - size
        rule = rules[seq[inner] - terminals]
        out[at[inner]], out[at[inner] + 1] = rule[:, 0], rule[:, 1]
        seq = out
    return seq


class Shard:
    """One shard: encoded to bytes, decoded whole or by token range."""

    def __init__(self, terminals, rules, lengths, symbols, ends, marks=None):
        self.terminals, self.rules, self.lengths = terminals, rules, lengths
        self.symbols, self.ends, self.marks = symbols, ends, marks

    def _sizes(self, a: int, b: int) -> np.ndarray:
        """Tokens of the symbols ``a:b``."""
        some = self.symbols[a:b].astype(np.int64)
        size = np.ones(len(some), np.int64)
        inner = some >= self.terminals
        size[inner] = self.lengths[some[inner] - self.terminals]
        return size

    @classmethod
    def build(cls, ids: np.ndarray, ends: np.ndarray, terminals: int, **options) -> Shard:
        symbols, rules, lengths = compress(ids, terminals, **options)
        return cls(terminals, rules, lengths, symbols, np.asarray(ends, np.uint64))

    def to_bytes(self) -> bytes:
        width = width_of(self.terminals + len(self.rules))
        tokens = int(self.ends[-1]) if len(self.ends) else 0
        head = struct.pack("<IIIIQB", self.terminals, len(self.rules), len(self.symbols), len(self.ends), tokens, width)
        before = np.cumsum(self._sizes(0, len(self.symbols)))
        marks = np.concatenate([[0], before[STRIDE - 1: -1: STRIDE]]) if len(before) else before
        return b"".join([MAGIC, head, self.rules.astype(f"<u{width}").tobytes(), self.lengths.astype("<u4").tobytes(),
                         self.symbols.astype(f"<u{width}").tobytes(), marks.astype("<u8").tobytes(),
                         self.ends.astype("<u8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        terminals, n_rules, n_symbols, n_docs, tokens, width = struct.unpack_from("<IIIIQB", data, 4)
        at = 4 + struct.calcsize("<IIIIQB")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        rules = take(f"<u{width}", 2 * n_rules).reshape(-1, 2)
        lengths = take("<u4", n_rules)
        symbols = take(f"<u{width}", n_symbols)
        marks = take("<u8", -(-n_symbols // STRIDE))
        ends = take("<u8", n_docs)
        if (int(ends[-1]) if n_docs else 0) != tokens or at != len(data):
            raise ValueError("damaged token shard")
        return cls(terminals, rules, lengths, symbols, ends, marks)

    def ids(self) -> np.ndarray:
        return expand_symbols(self.symbols, self.rules, self.terminals)

    def range(self, start: int, end: int) -> np.ndarray:
        """Tokens ``start:end``; the stored positions name the stretches of symbols to look
        at, and only symbols that reach into the range are opened."""
        if self.marks is None:
            return Shard.from_bytes(self.to_bytes()).range(start, end)
        if start >= end or not len(self.symbols):
            return np.zeros(0, np.uint32)
        marks = self.marks.astype(np.int64)
        lo = max(int(np.searchsorted(marks, start, "right")) - 1, 0)
        first, last = lo * STRIDE, int(np.searchsorted(marks, end, "left")) * STRIDE
        size = self._sizes(first, last)
        upto = np.cumsum(size) + marks[lo]
        a, b = int(np.searchsorted(upto, start, "right")), int(np.searchsorted(upto, end, "left")) + 1
        base = int(upto[a] - size[a]) if a < len(upto) else 0
        return expand_symbols(self.symbols[first + a: first + b], self.rules, self.terminals)[start - base: end - base]

    def document(self, i: int) -> np.ndarray:
        """Tokens of the ``i``-th document of the shard."""
        return self.range(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


# --- tokenising ----------------------------------------------------------------

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_ASCII_SIGN = np.zeros(256, bool)
_ASCII_SIGN[33:127] = True
_ASCII_SIGN[48:58] = _ASCII_SIGN[39] = False  # digits; the apostrophe can belong to letters
_ASCII_SIGN &= ~_ASCII_LETTER


class WordEncoder:
    """Ids of texts by the tokenizers library, asked once for each new word.

    The tokenizer cuts at blanks, and between letters and other signs, before anything
    else, and it ignores case; so the ids of a text are those of its parts one after
    the other.  Parts are found by hash, and new ones are encoded many at a time, held
    apart by a special token.  Text that spells a special token is left uncut."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.model = Tokenizer.from_file(path)
        self.terminals = max(self.model.get_vocab().values()) + 1
        special = {t.content: i for i, t in self.model.get_added_tokens_decoder().items() if t.special}
        self.apart, self.apart_id = next(iter(special.items()))
        self.special = [t.lower().encode() for t in special]
        self.forget()

    def forget(self) -> None:
        self.index: dict[int, int] = {}
        self.recent, self.recent_number = np.zeros(1 << _RECENT_BITS, np.uint64), np.full(1 << _RECENT_BITS, -1)
        self.flat, self.size = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, keys: list[int], new: list[bytes], plain: bool) -> None:
        at = len(self.index)
        rows = []
        if plain:  # a part may hold a special token itself
            rows += [np.array(c.ids, np.uint32)
                     for c in self.model.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)]
            flat, size = np.concatenate(rows), np.array([len(r) for r in rows])
        else:
            joined = [self.apart.join(w.decode() for w in new[lo: lo + 256]) + self.apart for lo in range(0, len(new), 256)]
            flat = np.concatenate([np.array(c.ids, np.uint32)
                                   for c in self.model.encode_batch_fast(joined, add_special_tokens=False)])
            ends = np.flatnonzero(flat == self.apart_id)
            size = np.diff(np.concatenate([[-1], ends])) - 1
            flat = np.delete(flat, ends)
            if len(size) != len(new):
                raise RuntimeError("the tokenizer does not keep parts apart")
        need = self.size + len(flat)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), need), np.uint32)])
        self.flat[self.size: need] = flat
        self.starts = np.concatenate([self.starts, self.size + np.cumsum(size) - size])
        self.lengths = np.concatenate([self.lengths, size])
        self.size = need
        self.index.update(zip(keys, range(at, at + len(keys))))

    def encode(self, buf: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a piece in a row, each text closed by ``end_id``, and
        their number in each text."""
        if len(self.index) > MEMORY:
            self.forget()
        lower = lower_ascii(buf)
        low = lower.tobytes()
        plain = any(t in low for t in self.special)
        if not plain:
            buf = lower
            letter, sign = _ASCII_LETTER[buf], _ASCII_SIGN[buf]
            cut = np.flatnonzero((letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])) + 1
            buf = np.insert(buf, cut, 32)
            offs = offs + np.searchsorted(cut, offs)
        starts, ends, first = words(buf, offs)
        every = RangeHash(byte_values(buf))(starts, ends) ^ np.uint64(plain)
        # most words stand in the table of recent ones; the others are looked up once each
        slot = (every >> np.uint64(64 - _RECENT_BITS)).astype(np.int64)
        number = np.where(self.recent[slot] == every, self.recent_number[slot], -1)
        rest = np.flatnonzero(number < 0)
        keys, at, which = np.unique(every[rest], return_index=True, return_inverse=True)
        known = np.array([self.index.get(k, -1) for k in keys.tolist()], np.int64)
        new = np.flatnonzero(known < 0)
        if len(new):
            data = buf.tobytes()
            spans = zip(starts[rest[at[new]]].tolist(), ends[rest[at[new]]].tolist())
            known[new] = len(self.index) + np.arange(len(new))
            self._learn(keys[new].tolist(), [data[a:b] for a, b in spans], plain)
        if len(rest):
            number[rest] = known[which]
            self.recent[slot[rest]], self.recent_number[slot[rest]] = every[rest], number[rest]
        size = self.lengths[number]
        ids = self.flat[expand(self.starts[number], size)]
        upto = np.concatenate([[0], np.cumsum(size)])[first[1:]]
        return np.insert(ids, upto, np.uint32(end_id)), np.diff(np.concatenate([[0], upto])) + 1


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# --- Spark ---------------------------------------------------------------------

def write_shards(
    docs: DataFrame, out: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    shard_tokens: int = SHARD_TOKENS, partitions: int | None = None,
    per_round: int = RULES_PER_ROUND, least: int | None = None,
) -> None:
    """Tokenise whole texts (null: empty) and write their shards to ``out``.

    Order is ascending ``id_col``, null first; repeated keys are ordered by text, and
    equal rows are all kept.  An empty table writes an empty folder."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    # ranges are cut by doc_id alone, so equal keys stay together
    rows = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        keys: list[int | None] = []
        held, number = 0, 0

        def close() -> pa.RecordBatch:
            nonlocal ids, counts, keys, held, number
            each = np.concatenate(counts)
            shard = Shard.build(np.concatenate(ids), np.cumsum(each), encoder.terminals,
                                per_round=per_round, least=least)
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([held], pa.int64()),
                pa.array([keys], pa.list_(pa.int64())), pa.array([shard.to_bytes()], pa.binary())],
                names=["part", "number", "tokens", "doc_ids", "shard"])
            ids, counts, keys, held, number = [], [], [], 0, number + 1
            return row

        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for some, buf, offs in pieces(batches):
            got, n_each = encoder.encode(buf, offs, end_id)
            at = 0
            # a shard is closed at the first document end past its size
            while at < len(n_each):
                upto = np.cumsum(n_each[at:])
                to = at + min(int(np.searchsorted(upto, shard_tokens - held)) + 1, len(upto))
                take = int(upto[to - at - 1])
                ids.append(got[:take])
                got = got[take:]
                counts.append(n_each[at:to])
                keys += some.column(0).slice(at, to - at).to_pylist()
                held += take
                at = to
                if held >= shard_tokens:
                    yield close()
        if keys:
            yield close()

    schema = "part int, number int, tokens long, doc_ids array<bigint>, shard binary"
    rows.mapInArrow(encode, schema).write.parquet(out)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards with the number of tokens in all shards before (``start``)."""
    shards = spark.read.parquet(path)
    # one row per shard is summed: first within a part, then over parts
    each = shards.groupBy("part").agg(F.sum("tokens").alias("_sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("part", "number", "tokens").join(each, "part").select(
        "part", "number", (F.col("_base") + F.coalesce(F.sum("tokens").over(inner), F.lit(0))).alias("start"))
    return shards.join(offsets, ["part", "number"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (array) of every stored document."""
    return _decoded(read_shards(spark, path), with_ids=True)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_documents``, without the ids."""
    return _decoded(read_shards(spark, path), with_ids=False)


def _decoded(shards: DataFrame, with_ids: bool) -> DataFrame:
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<bigint>" if with_ids else "")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard.from_bytes(batch.column(2)[i].as_py())
                ids = shard.ids().astype("<u4")
                ends = shard.ends.astype(np.int64)
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                data = ids.tobytes()
                crc = [zlib.crc32(data[4 * a: 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                columns = [batch.column(1)[i].values, pa.array(begins + batch.column(0)[i].as_py()),
                           pa.array(ends - begins), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.append(begins, ends[-1:]), pa.int32()), pa.array(ids, pa.int64())))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return shards.select("start", "doc_ids", "shard").mapInArrow(decode, schema)
