"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming decoder.

A token sequence is the encoding of its bytes exactly when the first token, and every
adjacent pair, encodes to itself.  So a machine may guess where tokens end and check
each guess against the token before it alone.  Reading bytes, it keeps all open guesses:
a place where a token may begin, the tokens up to there, and the vocabulary node reached
since.  One of the guesses ends at the current byte (each prefix has one encoding);
those that no token continues are dropped, and what all that are left agree on is emitted.
No token is longer than the longest of the vocabulary, so the lookahead is bounded and the
open guesses, taken relative to the last emitted token, are one of finitely many states.

States and transitions are made when they are first met, and kept in a table of bounded
size.  Once it is full, a piece that leaves it is read to its end by the guesses themselves,
and when that has happened many times the size of the table, it starts anew.  Work is linear in the length of a text, also for a
single stretch of megabytes that the splitting pattern does not cut.

Decoding goes the other way, token by token: a state machine over UTF-8 holds the bytes
of an unfinished character back and emits the others, malformed bytes as U+FFFD."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Remembered transducer states (and checks of token pairs), and pieces, of a worker process.
MEMORY, PIECES = 1 << 17, 3 << 17
#: Longest piece worth remembering, in characters.
LONGEST = 32
#: Rows that leave a task together, by tokens.
TOKENS = 1 << 18
#: Characters of a text that are cut into pieces together.
BLOCK = 1 << 19
#: Tokens beyond a vocabulary node that are tried in order to give up a guess.
FEW = 16
#: Above all ranks.
NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file with one base64 token and rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def merge_steps(data: bytes, ranks: dict[bytes, int]) -> tuple[list[bytes], list[tuple[int, bytes, bytes]]]:
    """Plain byte-pair merging, lowest rank and then leftmost first: the parts that are left,
    and for each merge its rank and the outermost parts before it."""
    parts = [data[i: i + 1] for i in range(len(data))]
    steps = []
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
        if best == NEVER:
            break
        steps.append((best, parts[0], parts[-1]))
        parts[at: at + 2] = [parts[at] + parts[at + 1]]
    return parts, steps


class Transducer:
    """Encoder of single pieces.  ``ranks`` must hold all 256 bytes."""

    ROOT = 0

    def __init__(self, ranks: dict[bytes, int], memory: int = MEMORY):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.ranks, self.memory = ranks, memory
        self.token = {r: t for t, r in ranks.items()}
        self.next: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for t, r in ranks.items():
            node = self.ROOT
            for b in t:
                found = self.next[node].get(b)
                if found is None:
                    found = self.next[node][b] = len(self.next)
                    self.next.append({})
                    self.ends.append(-1)
                node = found
            self.ends[node] = r
        # the tokens beyond each node, where they are few
        self.beyond: list[list[int] | None] = [[] for _ in self.ends]
        for t, r in ranks.items():
            node = self.ROOT
            for b in t:
                tokens = self.beyond[node]
                if tokens is not None:
                    self.beyond[node] = [*tokens, r] if len(tokens) < FEW else None
                node = self.next[node][b]
        self.hopes: dict[tuple[int, int], bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.traces: dict[int, tuple] = {}
        self._forget()

    def _forget(self) -> None:
        """Start the table of states anew; the first state is the beginning of a piece."""
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: dict[int, tuple[int, tuple]] = {}  # by state and byte
        self.missed = 0
        self.begin = (-1, ((), self.ROOT))
        self.number[self.begin] = 0
        self.states.append(self.begin)

    def _trace(self, token: int) -> tuple[bool, list]:
        """Whether a token's bytes merge to it, and its merges (see ``merge_steps``) with
        one that never happens at the end."""
        known = self.traces.get(token)
        if known is None:
            data = self.token[token]
            parts, steps = merge_steps(data, self.ranks)
            known = self.traces[token] = (len(parts) == 1, [*steps, (NEVER, parts[0], parts[-1])])
        return known

    def adjacent(self, a: int, b: int) -> bool:
        """Whether token ``b`` may follow ``a`` (-1: begin a piece).

        The merges of both go on side by side, lowest rank first.  They stay apart unless
        the parts at the border form a pair that is lower than the next merge of each (on
        ties the left one comes first)."""
        whole, right = self._trace(b)
        if a < 0 or not whole:
            return whole
        whole, left = self._trace(a)
        if not whole:
            return False
        ranks, i, j, border, over = self.ranks, 0, 0, None, NEVER
        while True:
            here, there = left[i], right[j]
            if border is None or border[0] != here[2] or border[1] != there[1]:
                border = (here[2], there[1])
                over = ranks.get(here[2] + there[1], NEVER)
            if here[0] <= there[0]:
                if over < here[0]:
                    return False
                if here[0] == NEVER:
                    return True
                i += 1
            else:
                if over <= there[0]:
                    return False
                j += 1

    def _pair(self, pair: tuple[int, int]) -> bool:
        if len(self.pairs) >= 2 * self.memory:
            self.pairs.clear()
        fits = self.pairs[pair] = self.adjacent(*pair)
        return fits

    def alive(self, last: int, node: int) -> bool:
        """Whether a token beyond ``node`` may follow ``last``; nodes with many are not tried."""
        tokens = self.beyond[node]
        if tokens is None:
            return True
        known = self.hopes.get((last, node))
        if known is None:
            if len(self.hopes) >= self.memory:
                self.hopes.clear()
            known = self.hopes[last, node] = any(self.adjacent(last, t) for t in tokens)
        return known

    def _move(self, state: tuple, byte: int) -> tuple[tuple, tuple]:
        """Determinise one transition: (next state, tokens emitted)."""
        last, *guesses = state
        follow, ends, pairs = self.next, self.ends, self.pairs
        open_, done = [], None
        for pending, node in guesses:
            node = follow[node].get(byte)
            if node is None:
                continue
            if done is None:
                token = ends[node]
                if token >= 0:
                    pair = (pending[-1] if pending else last, token)
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = self._pair(pair)
                    if fits:
                        done = (*pending, token)
            if follow[node] and self.alive(pending[-1] if pending else last, node):
                open_.append((pending, node))
        assert done is not None, "every prefix has an encoding"
        shared = len(done)
        for pending, _ in open_:  # what all agree on is emitted
            if len(pending) < shared:
                shared = len(pending)
            while shared and pending[:shared] != done[:shared]:
                shared -= 1
            if not shared:
                break
        if not shared:
            return (last, *open_, (done, self.ROOT)), ()
        return (done[shared - 1], *[(p[shared:], n) for p, n in open_], (done[shared:], self.ROOT)), done[:shared]

    def _number(self, state: tuple) -> int:
        known = self.number.get(state)
        if known is None:
            known = self.number[state] = len(self.states)
            self.states.append(state)
        return known

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if self.missed >= 8 * self.memory:
            self._forget()
        out: list[int] = []
        moves, at = self.moves, 0
        for i, byte in enumerate(piece):
            move = moves.get(at << 8 | byte)
            if move is None:
                if len(self.states) >= self.memory:
                    self.missed += 1
                    return out + self._simulate(self.states[at], piece[i:])
                state, tokens = self._move(self.states[at], byte)
                move = moves[at << 8 | byte] = (self._number(state), tokens)
            at, tokens = move
            if tokens:
                out += tokens
        out += self.states[at][-1][0]  # the guess that ends here is the last one
        return out

    def _simulate(self, state: tuple, rest: bytes) -> list[int]:
        """The tokens of ``rest`` and those pending in ``state``, without making states:
        each guess is a vocabulary node and a chain of the tokens before it."""
        follow, ends, pairs = self.next, self.ends, self.pairs
        base = (None, state[0])
        guesses = []
        for pending, node in state[1:]:
            before = base
            for token in pending:
                before = (before, token)
            guesses.append((before, node))
        for byte in rest:
            done, open_ = None, []
            for before, node in guesses:
                node = follow[node].get(byte)
                if node is None:
                    continue
                token = ends[node]
                if done is None and token >= 0:
                    pair = (before[1], token)
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = self._pair(pair)
                    if fits:
                        done = (before, token)
                if follow[node]:
                    open_.append((before, node))
            open_.append((done, self.ROOT))
            guesses = open_
        out, at = [], guesses[-1][0]
        while at[0] is not None:
            at, token = at
            out.append(token)
        return out[::-1]


class Encoder:
    """Texts to ids: the pattern cuts pieces, the transducer encodes each."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MEMORY, pieces: int = PIECES):
        self.machine, self.memory = Transducer(ranks, memory), pieces
        # white space is the Unicode property, without the information separators
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}")
                                     .replace(r"\s", r"\p{White_Space}"))
        self.edge = regex.compile(r"\P{White_Space}(?= )")
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for block in self.blocks(text):
            known = self.known
            pieces = self.pattern.findall(block)
            found = [known.get(p) for p in pieces]
            if None in found:
                found = [self._piece(p) if ids is None else ids for p, ids in zip(pieces, found)]
            out.extend(chain.from_iterable(found))
        return out

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self.known.get(piece) or self.older.get(piece) or tuple(self.machine.encode(piece.encode("utf-8")))
        if len(piece) <= LONGEST:
            if len(self.known) >= self.memory // 2:  # what is used again stays
                self.known, self.older = {}, self.known
            self.known[piece] = ids
        return ids

    def blocks(self, text: str) -> Iterator[str]:
        """A long text in blocks.  The pattern joins a blank to what follows, so it never
        reaches over a place between a character and a blank after it."""
        at = 0
        while len(text) - at > BLOCK:
            cut = self.edge.search(text, at + BLOCK)
            if cut is None:
                break
            yield text[at: cut.end()]
            at = cut.end()
        yield text[at:]


#: First bytes of a character: how many bytes follow, and the range of the first of them.
def _lead(b: int) -> tuple[int, int, int] | None:
    if 0xC2 <= b <= 0xDF:
        return 1, 0x80, 0xBF
    if 0xE0 <= b <= 0xEF:
        return 2, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF
    if 0xF0 <= b <= 0xF4:
        return 3, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF
    return None


class Utf8Machine:
    """Incremental UTF-8: ``feed`` takes any bytes and returns the characters they complete."""

    def __init__(self):
        self.held, self.wait = b"", (0, 0, 0)

    def feed(self, data: bytes) -> str:
        out: list[str] = []
        for b in data:
            left, low, high = self.wait
            if left:
                if low <= b <= high:
                    self.held += bytes([b])
                    self.wait = (left - 1, 0x80, 0xBF)
                    if left == 1:
                        out.append(self.held.decode())
                        self.held = b""
                    continue
                out.append("�")  # an unfinished character; the byte begins anew
                self.held, self.wait = b"", (0, 0, 0)
            if b < 0x80:
                out.append(chr(b))
                continue
            lead = _lead(b)
            if lead is None:
                out.append("�")
            else:
                self.held, self.wait = bytes([b]), lead
        return "".join(out)

    def close(self) -> str:
        """What an unfinished character at the end stands for."""
        held, self.held, self.wait = self.held, b"", (0, 0, 0)
        return "�" if held else ""


class Decoder:
    """Ids to text, as a stream.  What a token does to a machine that holds nothing back is
    worked out once for each token; in all other states its bytes are fed."""

    def __init__(self, ranks: dict[bytes, int]):
        self.token = {r: t for t, r in ranks.items()}
        self.whole: dict[int, str | None] = {}
        for r, t in self.token.items():
            machine = Utf8Machine()
            text = machine.feed(t)
            self.whole[r] = None if machine.held else text
        self.bytes = pa.array(list(self.token.values()), pa.binary())
        self.place = np.full(max(self.token) + 1, -1, np.int32)
        self.place[list(self.token)] = np.arange(len(self.token))
        #: Tokens that are not whole characters: only after them does the machine hold bytes back.
        self.split = np.array([text is None or "\ufffd" in text for text in self.whole.values()])

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of each token as soon as it is known, and of an unfinished end."""
        machine, whole, token = Utf8Machine(), self.whole, self.token
        for i in ids:
            text = None if machine.held else whole[i]
            yield machine.feed(token[i]) if text is None else text
        yield machine.close()

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.stream(ids))

    def decode_lists(self, ids: pa.Array, sizes: np.ndarray) -> pa.Array:
        """The texts of lists of ids that lie one after the other.

        Tokens of whole characters leave a machine that holds nothing back as it was, so they
        are taken together; the others, and those after them until nothing is held back any
        more, go through the machine one by one."""
        given = ids.to_numpy()
        if len(given) and (given.min() < 0 or given.max() >= len(self.place)):
            raise ValueError("unknown token id")
        known = self.place[given]
        if (known < 0).any():
            raise ValueError("unknown token id")
        joined = self.bytes.take(pa.array(known))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        cuts = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset: joined.offset + len(joined) + 1]
        data = memoryview(joined.buffers()[2] or b"")
        split = np.flatnonzero(self.split[known])
        firsts = np.searchsorted(split, ends).tolist()
        texts = []
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            out, machine, at = [], Utf8Machine(), a
            for k in split[firsts[i]: firsts[i + 1]].tolist():
                if k < at:
                    continue
                out.append(str(data[cuts[at]: cuts[k]], "utf-8"))
                at = k
                while at == k or (machine.held and at < b):
                    out.append(machine.feed(bytes(data[cuts[at]: cuts[at + 1]])))
                    at += 1
            out += [str(data[cuts[at]: cuts[b]], "utf-8"), machine.close()]
            texts.append("".join(out))
        return pa.array(texts, pa.string())


@lru_cache(maxsize=1)
def shared_encoder(path: str, pattern: str) -> Encoder:
    """One for all tasks of a worker process, so that its tables are filled once."""
    return Encoder(read_ranks(path), pattern)


@lru_cache(maxsize=1)
def shared_decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def _with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """The columns of ``df`` with ``name`` at the end, in place of one of that name."""
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def _parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows, each within ``most`` or a single row."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        yield at, to
        at = to


def with_token_ids(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each whole text (null: empty) as ``array<int>``.

    Row by row, without a shuffle; special strings are ordinary text.  A column called
    ``out`` is replaced, all others (whatever their names, nulls, repeated rows) are kept
    as they are; an empty table stays empty."""
    schema = _with(docs, out, T.ArrayType(T.IntegerType(), False))
    names = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(path, pattern)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            # a token has at least one byte
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            for at, to in _parts(sizes, 4 * TOKENS):
                ids, ends = [], [0]
                for t in column.slice(at, to - at):
                    ids.append(np.array(encoder.encode(t.as_py() or ""), np.int32))
                    ends.append(ends[-1] + len(ids[-1]))
                values = pa.array(np.concatenate(ids))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                rows = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(rows.schema.get_field_index(n)) for n in names] + [lists], names=[*names, out])

    return docs.mapInArrow(run, schema)


def with_decoded_text(docs: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text that ``ids`` stand for (null ids: empty), decoded as a stream.

    An id outside the vocabulary is an error.  A column called ``out`` is replaced."""
    schema = _with(docs, out, T.StringType())
    names = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = shared_decoder(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            for at, to in _parts(sizes, TOKENS):
                rows = batch.slice(at, to - at)
                texts = decoder.decode_lists(column.slice(at, to - at).flatten(), sizes[at:to])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(rows.schema.get_field_index(n)) for n in names] + [texts], names=[*names, out])

    return docs.mapInArrow(run, schema)
