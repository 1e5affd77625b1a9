"""Token counts of a byte-level BPE file by rank-synchronous merging of arrays.

A text is cut at special strings and then into pre-tokens, as the tokenizers
library does.  Pre-tokens not met before are held together as ragged arrays:
one flat array of symbols (bytes first) and the start of each sequence.  In a
round every sequence finds the lowest rank among its neighbouring pairs and
all its pairs of that rank are merged, in all sequences at once; sequences
without a pair are done, and the symbols they have left are their count.

A long sequence (a run of letters without spaces, say) would need as many
rounds as it has different merges, each over its whole length.  Long sequences
therefore take ranks in ascending order from a queue of places instead, so a
round touches only the places that hold the rank.  A merge makes pairs of
higher rank alone (the file is checked for it), hence both ways merge in the
order of the library, which takes the lowest rank first and, within it, the
leftmost pair.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysieve.llm.packing import _byte_of_letter, default_tokenizer

NONE = np.int64(1) << 62  # the rank of a pair that never merges
LONG = 256  # symbols from which a sequence goes by the queue
LOT_CHARS = 1 << 22  # texts that are counted together
KEPT = 1 << 18  # pre-tokens whose counts are remembered
PIECES = 1 << 17  # pre-tokens of one text that are held at a time

# Outside of these code points the classes of letters, numbers and white space depend
# on the Unicode version; texts with others are cut by the library itself.
SETTLED = regex.compile(r"[^\x00-\u0557\u2000-\u206F\u3000-\u9FFF\uAC00-\uD7A3]")


class Merges:
    """The merges of a byte-level BPE file as arrays."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        letters = _byte_of_letter()
        self.of_byte = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.of_byte[byte] = vocabulary[letter]
        self.size = max(vocabulary.values()) + 1
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        self.left, self.right = left, right
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        born = np.full(self.size, -1, np.int64)
        born[self.made[::-1]] = np.arange(len(merges))[::-1]
        born[self.of_byte] = -1
        if len(merges) and not (np.maximum(born[left], born[right]) < np.arange(len(merges))).all():
            raise ValueError("a merge comes before the merges of its parts")
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``NONE`` where it never merges."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_of[at], NONE)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """How many symbols each piece is left with."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        found = sizes.copy()
        for long in (False, True):
            chosen = np.flatnonzero((sizes > 1) & ((sizes > LONG) == long))
            if chosen.size:
                own = sizes[chosen]
                symbols = self.of_byte[np.frombuffer(b"".join([pieces[i] for i in chosen]), np.uint8)]
                found[chosen] = self._by_queue(symbols, own) if long else self._by_rounds(symbols, own)
        return found

    def _by_rounds(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        found = sizes.copy()
        open_ = np.arange(len(sizes))
        while open_.size:
            starts = np.cumsum(sizes) - sizes
            # a pair begins at every symbol but a sequence's last
            rank = np.full(len(symbols), NONE)
            rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
            rank[starts + sizes - 1] = NONE
            least = np.minimum.reduceat(rank, starts)
            merging = (rank == np.repeat(least, sizes)) & (rank != NONE)
            at = leftmost(np.flatnonzero(merging))
            symbols[at] = self.made[rank[at]]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            sizes = np.add.reduceat(kept, starts, dtype=np.int64)
            found[open_] = sizes
            going = least != NONE
            kept &= np.repeat(going, np.diff(np.append(starts, len(kept))))
            symbols, sizes, open_ = symbols[kept], sizes[going], open_[going]
        return found

    def _by_queue(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        n = len(symbols)
        ends = np.cumsum(sizes)
        following = np.arange(1, n + 1)
        following[ends - 1] = -1
        before = np.arange(-1, n - 1)
        before[ends - sizes] = -1
        alive = np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[following[places] >= 0]
            rank = self.ranks(symbols[places], symbols[following[places]])
            places, rank = places[rank != NONE], rank[rank != NONE]
            order = np.argsort(rank, kind="stable")
            places, rank = places[order], rank[order]
            first = np.flatnonzero(np.diff(rank, prepend=-1))
            for r, some in zip(rank[first].tolist(), np.split(places, first[1:])):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(queue, r)
                waiting[r].append(some)

        wait(np.arange(n))
        while queue:
            rank = heapq.heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(rank)))
            after = following[at]
            # places whose symbols have changed since they were noted are left out
            valid = alive[at] & (after >= 0) & (symbols[at] == self.left[rank])
            valid &= symbols[np.maximum(after, 0)] == self.right[rank]
            at = at[valid]
            if self.left[rank] == self.right[rank] and at.size:
                order = np.flatnonzero(np.concatenate([[True], following[at[:-1]] != at[1:]]))
                place = np.arange(len(at)) - np.repeat(order, np.diff(np.append(order, len(at))))
                at = at[place % 2 == 0]
            if not at.size:
                continue
            gone = following[at]
            symbols[at] = self.made[rank]
            alive[gone] = False
            following[at] = following[gone]
            behind = following[at] >= 0
            before[following[at][behind]] = at[behind]
            earlier = before[at]
            wait(np.unique(np.concatenate([earlier[earlier >= 0], at])))
        return np.add.reduceat(alive, ends - sizes, dtype=np.int64)


def leftmost(places: np.ndarray) -> np.ndarray:
    """Of ascending places, every second one of each run of neighbours, the first included."""
    first = np.flatnonzero(np.diff(places, prepend=-2) != 1)
    place = np.arange(len(places)) - np.repeat(first, np.diff(np.append(first, len(places))))
    return places[place % 2 == 0]


class Counting:
    """Token counts of texts by one tokenizer file, with a bounded memory of pre-tokens."""

    def __init__(self, path: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cutter = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or cutter.get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        self.merges = Merges(spec["model"]["vocab"], [tuple(m) for m in spec["model"]["merges"]])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text without special strings, some at a time."""
        if SETTLED.search(text):
            yield [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        elif len(text) <= LOT_CHARS:
            yield self.pattern.findall(text)
        else:
            found = (m.group() for m in self.pattern.finditer(text))
            while some := list(islice(found, PIECES)):
                yield some

    def learn(self, pieces: Iterable[str]) -> None:
        new = [p for p in pieces if p not in self.known]
        if new:
            self.known.update(zip(new, self.merges.counts([p.encode() for p in new]).tolist()))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        found = [0] * len(texts)
        held: list[tuple[int, list[str]]] = []
        distinct: set[str] = set()

        def settle() -> None:
            if len(self.known) + len(distinct) > KEPT:
                self.known.clear()
            self.learn(distinct)
            for i, pieces in held:
                found[i] += sum(map(self.known.__getitem__, pieces))
            held.clear()
            distinct.clear()

        waiting = 0
        for i, text in enumerate(texts):
            if self.special and self.special.search(text):
                parts = self.special.split(text)
                found[i] += len(parts) - 1
            else:
                parts = [text]
            for part in parts:
                for pieces in self.pieces(part) if part else ():
                    held.append((i, pieces))
                    distinct.update(pieces)
                    waiting += len(pieces)
                    if waiting >= 8 * PIECES:
                        settle()
                        waiting = 0
        settle()
        return found


@lru_cache(maxsize=2)
def counting(path: str) -> Counting:
    return Counting(path)


def token_counts(
    docs: DataFrame,
    *,
    tokenizer: str | None = None,
    limit: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row: id, n_bytes, n_tokens, over_limit.

    ``n_tokens`` is what ``Tokenizer.encode(text, add_special_tokens=False)``
    gives for the file at ``tokenizer``, a path that every executor can read: special strings
    inside a text count one, nothing is cut off.  ``over_limit`` says whether
    that is more than ``limit``.  A NULL or empty text has no bytes and no
    tokens.  Ids, NULL ones and repeated rows are passed on as they are, other
    columns are not read, and an empty table gives no rows.  A very long text is
    counted some pre-tokens at a time, at a cost in proportion to its length.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counting(path)
        for batch in batches:
            sizes, counts, lot, held = [], [], [], 0
            for text in batch.column(1):
                lot.append(text.as_py() or "")
                held += len(lot[-1])
                sizes.append(len(lot[-1].encode()))
                if held >= LOT_CHARS:
                    counts += own.count(lot)
                    lot, held = [], 0
            counts += own.count(lot)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = rows.select("id").schema.add("n_bytes", "long").add("n_tokens", "long")
    return rows.mapInArrow(run, schema).select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
