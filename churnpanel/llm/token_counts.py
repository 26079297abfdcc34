"""Token counts by heap-and-linked-list byte-pair merging (no identifiers emitted).

A text's symbols start as its characters.  All adjacent pairs that form a known
piece wait in a heap; the pair of lowest rank (leftmost on ties) is merged until
none is left, the neighbours being kept in linked lists.  The count is the number
of initial symbols minus the number of merges.  Characters without a piece fall
back to their UTF-8 bytes, each of which is an initial symbol that never merges.

A merge can only join two characters that stand next to each other inside some
piece, so a text may be cut wherever that is impossible; the parts between blanks
are counted once and remembered (in a memory of bounded size)."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
#: Remembered parts per task, and the longest part worth remembering.
MEMORY, LONGEST = 400_000, 64


class MergeCounter:
    """Counts tokens for one set of piece ranks (lower rank merges first)."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        inside = {p[i: i + 2] for p in ranks for i in range(len(p) - 1)}
        if any(x != BLANK and x + BLANK in inside for x in {p[0] for p in inside}):
            raise ValueError("pieces with a blank after another character are not supported")
        self.newline_apart = not any("\n" in p for p in inside)
        self.single = {p for p in ranks if len(p) == 1}
        self.blank_led = _Memory(self, BLANK)
        self.bare = _Memory(self, "")

    @classmethod
    def from_sentencepiece(cls, path: str) -> MergeCounter:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size())
               if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
        by_rank = sorted({-model.get_score(i) for i in ids})
        rank = {s: r for r, s in enumerate(by_rank)}
        return cls({model.id_to_piece(i): rank[-model.get_score(i)] for i in ids})

    def initial(self, symbols: str) -> int:
        return sum(1 if c in self.single else len(c.encode()) for c in symbols)

    def merges(self, symbols: str) -> int:
        """Number of merges the heap makes in one run of characters."""
        n, ranks = len(symbols), self.ranks
        part: list[str | None] = list(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = [(ranks[p], i, p) for i in range(n - 1) if (p := symbols[i: i + 2]) in ranks]
        heapq.heapify(heap)
        done = 0
        while heap:
            _, i, joined = heapq.heappop(heap)
            left = part[i]
            if left is None or (j := after[i]) == n or left + part[j] != joined:
                continue  # one of the two has been merged elsewhere
            part[i], part[j] = joined, None
            after[i] = k = after[j]
            done += 1
            if k < n:
                before[k] = i
                if (p := joined + part[k]) in ranks:
                    heapq.heappush(heap, (ranks[p], i, p))
            if (h := before[i]) >= 0 and (p := part[h] + joined) in ranks:
                heapq.heappush(heap, (ranks[p], h, p))
        return done

    def part_count(self, symbols: str) -> int:
        return self.initial(symbols) - self.merges(symbols)

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; a blank is put in front, as the library does."""
        if not text:
            return 0
        text = text.replace(BLANK, " ")
        if not self.newline_apart:
            return self._irregular(" " + text)
        lines = text.split("\n")
        total = len(lines) - 1 and (len(lines) - 1) * self.part_count("\n")
        led, bare = self.blank_led.__getitem__, self.bare.__getitem__
        for i, line in enumerate(lines):
            if "  " in line or line.startswith(" ") or line.endswith(" "):
                total += self._irregular(line if i else " " + line)
                continue
            parts = line.split(" ")
            if i == 0:
                total += sum(map(led, parts))
            elif line:
                total += bare(parts[0]) + sum(map(led, parts[1:]))
        return total

    def _irregular(self, line: str) -> int:
        return sum(self.part_count(p.replace(" ", BLANK)) for p in re.findall(" *[^ ]+| +", line))


class _Memory(dict):
    def __init__(self, counter: MergeCounter, lead: str):
        super().__init__()
        self.counter, self.lead = counter, lead

    def __missing__(self, word: str) -> int:
        n = self.counter.part_count(self.lead + word)
        if len(word) <= LONGEST:
            if len(self) >= MEMORY:
                self.clear()
            self[word] = n
        return n


def with_token_counts(docs: DataFrame, model_path: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """``docs`` plus the token count of each whole text.

    Null and empty texts have 0 tokens; every row keeps its columns and gets its own
    count, so repeated rows, null keys and empty tables need no special case."""

    @F.pandas_udf("long")
    def count(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = MergeCounter.from_sentencepiece(model_path)
        for texts in series:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    return docs.withColumn(out_col, count(F.col(text_col)))
