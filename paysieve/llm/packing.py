"""Packing tokenised documents into fixed windows by non-negative least squares.

A document's ids are cut at every full window; what is left over is its tail.
Tails are packed block by block, a block being the tails of consecutive
documents of one input partition up to ``block_tokens`` ids, so memory is bounded and nothing
is shuffled.  Per block: tail lengths, rounded up to a grid, give a histogram;
all combinations of at most ``depth`` lengths that fill a window exactly are the
columns of a matrix; non-negative least squares says how often to repeat each;
the counts are rounded and as many windows are made as there are tails for.
The tails that remain are packed greedily: the shortest close the small gaps
that rounding up has left (or a window is taken apart for it), the others are laid end to end and cut at the window.
What does not fill a last window goes on to the next block, and at the end of
the partition it is cut into sequences whose lengths are powers of two.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_SCHEMA = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
SEQUENCES_PER_PARTITION = 1 << 32
LONG_BLANK = 10_000  # characters of white space in a row


# --- ids -------------------------------------------------------------------


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write bytes as letters: printable Latin-1 stands
    for itself, the rest follow from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def load_encoder(path: str):
    """text -> list of ids, for a byte-level BPE file of the tokenizers library.

    The file's vocabulary is read as byte ranks, which encodes several times
    faster and gives the ids that ``Tokenizer.encode(text, add_special_tokens=False)`` gives.
    That encoder's pattern runs out of stack on very long white space, so texts
    with some go through the library itself.
    """
    import public_tokenizers
    import regex
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    letters = _byte_of_letter()
    ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    encoding = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )

    library = Tokenizer.from_file(path)
    blank = regex.compile(rf"\s{{{LONG_BLANK},}}")

    def encode(text: str) -> list[int]:
        if len(text) >= LONG_BLANK and blank.search(text):
            return library.encode(text, add_special_tokens=False).ids
        if any(t in text for t in special):
            return encoding.encode(text, allowed_special="all")
        return encoding.encode_ordinary(text)

    return encode


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# --- least squares ---------------------------------------------------------


def combinations(total: int, depth: int) -> list[tuple[int, ...]]:
    """Multisets of at most ``depth`` positive numbers that add up to ``total``."""
    found: list[tuple[int, ...]] = []

    def extend(parts: tuple[int, ...], rest: int, most: int) -> None:
        if rest == 0:
            found.append(parts)
        elif len(parts) < depth:
            for part in range(min(rest, most), 0, -1):
                if part * (depth - len(parts)) < rest:
                    break
                extend((*parts, part), rest - part, part)

    extend((), total, total)
    return found


@lru_cache(maxsize=4)
def _strategies(cells: int, depth: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    parts = combinations(cells, depth)
    matrix = np.zeros((cells, len(parts)))
    for column, strategy in enumerate(parts):
        for part in strategy:
            matrix[part - 1, column] += 1
    return parts, matrix


def nnls(matrix: np.ndarray, target: np.ndarray, tolerance: float = 1e-8) -> np.ndarray:
    """x >= 0 that minimises |matrix x - target| (Lawson and Hanson's active sets)."""
    rows, columns = matrix.shape
    x = np.zeros(columns)
    active = np.zeros(columns, bool)
    gradient = matrix.T @ target
    limit = tolerance * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(3 * rows):
        candidates = np.where(active, -np.inf, gradient)
        best = int(candidates.argmax())
        if candidates[best] <= limit:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            solution = np.linalg.lstsq(matrix[:, chosen], target, rcond=None)[0]
            if solution.size == 0 or solution.min() > 0:
                break
            falling = solution <= 0
            own = x[chosen]
            step = (own[falling] / np.maximum(own[falling] - solution[falling], 1e-300)).min()
            x[chosen] = own + step * (solution - own)
            drop = chosen[(x[chosen] <= 1e-12) & falling]
            if drop.size == 0:
                drop = chosen[falling][:1]
            active[drop] = False
            x[drop] = 0
        x[:] = 0
        x[chosen] = solution
        gradient = matrix.T @ (target - matrix @ x)
    return x


# --- one block -------------------------------------------------------------


class Tail:
    """Ids of one document from ``start`` on."""

    __slots__ = ("doc", "doc_tokens", "start", "ids")

    def __init__(self, doc, doc_tokens: int, start: int, ids: np.ndarray):
        self.doc, self.doc_tokens, self.start, self.ids = doc, doc_tokens, start, ids

    def __len__(self) -> int:
        return len(self.ids)

    def cut(self, at: int) -> tuple[Tail, Tail]:
        return (
            Tail(self.doc, self.doc_tokens, self.start, self.ids[:at]),
            Tail(self.doc, self.doc_tokens, self.start + at, self.ids[at:]),
        )


def pack_block(tails: list[Tail], window: int, depth: int, grid: int) -> tuple[list[list[Tail]], list[Tail]]:
    """(sequences, tails that do not fill another window)."""
    cells = window // grid
    bins: list[list[Tail]] = [[] for _ in range(cells + 1)]
    for tail in sorted(tails, key=len):
        bins[-(-len(tail) // grid)].append(tail)
    histogram = np.array([len(b) for b in bins[1:]], float)
    parts, matrix = _strategies(cells, depth)
    present = histogram > 0
    usable = np.flatnonzero(~matrix[~present].any(axis=0))
    repeats = np.zeros(len(parts), int)
    if usable.size:
        repeats[usable] = np.rint(nnls(matrix[:, usable][present], histogram[present])).astype(int)

    planned: list[list[Tail]] = []
    for index in np.argsort(-repeats, kind="stable"):
        if repeats[index] <= 0:
            break
        strategy = parts[index]
        need = {part: strategy.count(part) for part in strategy}
        times = min(repeats[index], *(len(bins[part]) // n for part, n in need.items()))
        for _ in range(times):
            planned.append([bins[part].pop() for part in strategy])

    rest = [tail for b in reversed(bins) for tail in reversed(b)]  # longest first
    sequences: list[list[Tail]] = []
    for sequence in sorted(planned, key=lambda s: -sum(map(len, s))):
        gap = window - sum(map(len, sequence))
        if gap > sum(map(len, rest[-gap:])):
            rest += sequence  # nothing is left to close its gap with: it closes others'
            continue
        while gap:
            tail = rest.pop()
            if len(tail) > gap:
                tail, after = tail.cut(gap)
                rest.append(after)
            sequence.append(tail)
            gap -= len(tail)
        sequences.append(sequence)

    filling: list[Tail] = []
    room = window
    for tail in rest:
        while len(tail) >= room:
            piece, tail = tail.cut(room)
            sequences.append([*filling, piece])
            filling, room = [], window
        if len(tail):
            filling.append(tail)
            room -= len(tail)
    return sequences, filling


def powers_of_two(tails: list[Tail]) -> Iterator[list[Tail]]:
    """What is left, in sequences whose lengths are powers of two."""
    left = sum(map(len, tails))
    queue = tails[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        sequence: list[Tail] = []
        while room:
            tail = queue.pop()
            if len(tail) > room:
                tail, after = tail.cut(room)
                queue.append(after)
            sequence.append(tail)
            room -= len(tail)
        yield sequence


def pack_stream(
    documents: Iterator[tuple[object, np.ndarray]], window: int, depth: int, grid: int, block_tokens: int
) -> Iterator[list[Tail]]:
    """Sequences, each a list of pieces, of (document, ids) in order."""
    waiting: list[Tail] = []
    held = 0
    for doc, ids in documents:
        total = len(ids)
        full = total - total % window
        for start in range(0, full, window):
            yield [Tail(doc, total, start, ids[start : start + window])]
        if full < total:
            # a copy, or the view would keep the whole document's ids
            waiting.append(Tail(doc, total, full, ids[full:].copy() if full else ids))
            held += total - full
        if held >= block_tokens:
            sequences, waiting = pack_block(waiting, window, depth, grid)
            yield from sequences
            held = sum(map(len, waiting))
    sequences, waiting = pack_block(waiting, window, depth, grid)
    yield from sequences
    yield from powers_of_two(waiting)


# --- Spark -----------------------------------------------------------------


def pack(
    docs: DataFrame,
    *,
    tokenizer: str | None = None,
    end_id: int = 1,
    window: int = 2048,
    depth: int = 3,
    grid: int = 16,
    block_tokens: int = 1 << 23,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and with ``with_ids`` the piece's ids.

    A document's ids end with ``end_id``; a NULL or empty text is that id alone.
    Each id lies in exactly one piece.  Rows that are equal are documents of
    their own, a NULL id is passed on, other columns are not read.  An empty
    table gives no rows.  ``tokenizer`` is a path that every executor can read.
    A partition packed again gives the same sequences, as long as it holds the
    same rows in the same order, which a scan of files does.
    """
    if window % grid:
        raise ValueError("the grid must divide the window")
    path = tokenizer or default_tokenizer()
    id_type = docs.schema[id_column].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(path)

        def documents():
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield doc, np.array([*encode(text.as_py() or ""), end_id], np.uint32)

        number = TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION
        rows: list[tuple] = []
        for sequence in pack_stream(documents(), window, depth, grid, block_tokens):
            offset = 0
            for piece in sequence:
                crc = zlib.crc32(piece.ids.astype("<u4").tobytes())
                row = (piece.doc, piece.start, len(piece), crc, piece.doc_tokens, number, offset)
                rows.append((*row, piece.ids.tolist()) if with_ids else row)
                offset += len(piece)
            number += 1
            if len(rows) >= 20_000:
                yield _batch(rows, arrow_schema)
                rows = []
        if rows:
            yield _batch(rows, arrow_schema)

    schema = f"`{id_column}` {id_type.simpleString()}, {PIECE_SCHEMA}" + ", ids array<int>" * with_ids
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow_schema = to_arrow_schema(_parse_datatype_string(schema))
    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
