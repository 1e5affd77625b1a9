"""Periodic runs of words by multi-scale minimizers.

A run is a maximal stretch of words in which words ``q`` apart are identical, ``q``
being the smallest such number, and which holds at least ``repeats`` periods
and ``least`` words.  Documents are laid end to end, each closed by a word of
its own, so runs never leave a document.

Periods up to ``SHORT`` are found by comparing the words with themselves at
each lag.  Longer periods are dealt to scales: a scale has the periods above
two thirds of some K, up to K.  Its seeds are K-grams that are the least (by a
hash) of some window of K-grams.  Inside a run of a period of the scale

- a window and the one a period later fit into the run, so the window's least
  K-gram is chosen again exactly a period later;
- K words hold a whole period, and a word block that is no power of a shorter
  one differs from all its rotations, so equal K-grams are whole periods apart.

Hence the next chosen place with an equal K-gram is the period's distance
ahead, and pairs of neighbours among equal seeds are all that need be looked
at.  A pair says that K words repeat at its distance, which is a stretch of
equal words; overlapping stretches of one distance are joined, compared word
for word, and extended at both ends.  What is periodic with a multiple of its
smallest period has the same ends under both, so of stretches with equal ends
the one of the smallest period counts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

SHORT = 8  # periods up to here are compared directly
LOT_WORDS = 1 << 18  # words of documents that are searched together


# --- stretches of equal words ------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64 bits for two blocks in a row."""
    return mixed(left * np.uint64(0x9E3779B97F4A7C15) + mixed(right + np.uint64(0xD1B54A32D192ED03)))


class Blocks:
    """Hashes of all blocks of as many words as asked for, in growing sizes."""

    def __init__(self, words: np.ndarray):
        self.size, self.hashes = 1, mixed(words.astype(np.uint64) + np.uint64(1))

    def of(self, size: int) -> np.ndarray:
        while 2 * self.size <= size:
            self.hashes = joined(self.hashes[: -self.size], self.hashes[self.size :])
            self.size *= 2
        if self.size == size:
            return self.hashes
        # two blocks that overlap
        ahead = size - self.size
        return joined(self.hashes[:-ahead], self.hashes[ahead:])


def sliding(values: np.ndarray, width: int, least: np.ufunc) -> np.ndarray:
    """``least`` of each ``width`` neighbouring values."""
    have = 1
    while 2 * have <= width:
        values = least(values[:-have], values[have:])
        have *= 2
    ahead = width - have
    return least(values[:-ahead], values[ahead:]) if ahead else values


def chosen(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that are least in some window, ties included."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = sliding(hashes, width, np.minimum)
    # the greatest of the windows' least values over the windows that hold a place
    edge = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(sliding(np.concatenate([edge, least, edge]), width, np.maximum) == hashes)


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    sizes = end - first
    return np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


def seeds(blocks: Blocks, period: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of neighbours among equal chosen blocks of ``period`` words, within the scale."""
    hashes = blocks.of(period)
    at = chosen(hashes, width)
    order = np.argsort(hashes[at], kind="stable")  # places ascend within a hash
    at = at[order]
    near = np.diff(at)
    same = (np.diff(hashes[at]) == 0) & (near > 2 * period // 3) & (near <= period)
    return at[:-1][same], near[same]


def grown(words: np.ndarray, first: np.ndarray, end: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches [first, end) of places equal to those ``lag`` ahead, made as long as they go."""
    n = len(words)
    first, end = first.copy(), end.copy()
    for moved, step in ((end, 1), (first, -1)):
        going = np.arange(len(lag))
        size = 8
        while going.size:
            ahead = np.arange(size) * step + (0 if step > 0 else -1)
            place = moved[going, None] + ahead
            there = (place >= 0) & (place + lag[going, None] < n)
            place = np.where(there, place, 0)
            equal = there & (words[place] == words[np.minimum(place + lag[going, None], n - 1)])
            run = np.where(equal.all(axis=1), size, equal.argmin(axis=1))
            moved[going] += run * step
            going = going[run == size]
            # about as much work a round, however few go on
            size = min(2 * size, max(8, (1 << 20) // max(len(going), 1)))
    return first, end


def by_scale(words: np.ndarray, blocks: Blocks, period: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, lag): maximal stretches of places equal to those ``lag`` ahead."""
    at, lag = seeds(blocks, period, width)
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    if not at.size:
        return at, at, lag
    # seeds of one distance whose stretches touch are one stretch
    new = np.concatenate([[True], (np.diff(lag) != 0) | (np.diff(at) > period)])
    first, lag = at[new], lag[new]
    end = at[np.concatenate([np.flatnonzero(new)[1:], [len(at)]]) - 1] + period
    # equal hashes are looked up in the words
    places = ranges(first, end)
    owner = np.repeat(np.arange(len(first)), end - first)
    equal = words[places] == words[places + lag[owner]]
    if not equal.all():
        apart = np.concatenate([[True], np.diff(owner) != 0])
        cut = np.flatnonzero(apart | np.concatenate([[True], equal[1:] != equal[:-1]]))
        stop = np.append(cut[1:], len(equal))
        fine = equal[cut]
        first, end, lag = places[cut[fine]], places[stop[fine] - 1] + 1, lag[owner[cut[fine]]]
    first, end = grown(words, first, end, lag)
    return first, end, lag


def runs(words: np.ndarray, sizes: np.ndarray, *, least: int = 24, repeats: int = 3) -> np.ndarray:
    """(start, length, period) of all runs by start, then period; ``sizes`` are the documents'
    words, each document's last one being found nowhere else."""
    if repeats < 3:
        raise ValueError("scales are made for three periods and more")
    found = []
    for lag in range(1, SHORT + 1):
        if len(words) > lag:
            first, end = stretches(words[lag:] == words[:-lag])
            long = end - first >= max(least, repeats * lag) - lag
            found.append(np.stack([first[long], end[long] + lag, np.full(long.sum(), lag)], axis=1))
    places = np.arange(len(words))
    blocks, from_, period = Blocks(words), SHORT + 1, 3 * SHORT // 2
    while True:
        # documents that can hold three of the scale's periods
        long = sizes - 1 >= max(least, repeats * from_)
        if not long.any():
            break
        if not long.all():
            kept = np.repeat(long, sizes)
            places, words, sizes = places[kept], words[kept], sizes[long]
            blocks = Blocks(words)
        first, end, lag = by_scale(words, blocks, period, 2 * from_ - period + 1)
        long = end - first + lag >= np.maximum(least, repeats * lag)
        # a stretch lies in one document, whose places are consecutive
        start, length = places[first[long]], (end - first + lag)[long]
        found.append(np.stack([start, start + length, lag[long]], axis=1))
        from_, period = period + 1, 3 * period // 2
    table = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    table = table[np.lexsort((table[:, 2], table[:, 1], table[:, 0]))]
    smallest = np.concatenate([[True], (np.diff(table[:, :2], axis=0) != 0).any(axis=1)])[: len(table)]
    table = table[smallest]
    table[:, 1] -= table[:, 0]
    return table[np.lexsort((table[:, 2], table[:, 0]))]


# --- documents ---------------------------------------------------------------


def edited(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words of a document whose id's checksum asks for it, made periodic from some place on."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * -(-(n - a) // p))[: n - a] if block else words


def found_in(documents: list[list[bytes]], **limits: int) -> Iterator[np.ndarray]:
    """Each document's runs as rows of (start, length, period)."""
    number: dict[bytes, int] = {}
    flat: list[int] = []
    for i, words in enumerate(documents):
        flat += [number.setdefault(w, len(number)) for w in words]
        flat.append(-1 - i)
    sizes = np.array([len(words) + 1 for words in documents], np.int64)
    table = runs(np.array(flat, np.int64), sizes, **limits)
    starts = np.cumsum(sizes) - sizes
    at = np.searchsorted(table[:, 0], np.append(starts, len(flat)))
    for start, low, high in zip(starts, at, at[1:]):
        yield table[low:high] - np.array([start, 0, 0])


def collapsed(words: list[bytes], table: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(table):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, table[:, 0] + table[:, 2], 1)
    np.add.at(edges, table[:, 0] + table[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def summary(words: list[bytes], table: np.ndarray) -> tuple:
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)."""
    listed = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in table.tolist()).encode()).hexdigest()
    kept = hashlib.sha256(b" ".join(collapsed(words, table))).hexdigest()
    if not len(table):
        return 0, None, None, None, None, listed, kept
    start, length, period = max(table.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    return len(table), start, length, period, 1000 * length // period, listed, kept


FIELDS = (
    ("n_runs", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("period", pa.int64()),
    ("exponent_milli", pa.int64()),
    ("runs_sha256", pa.string()),
    ("collapsed_sha256", pa.string()),
)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
DETAILS = (("runs", pa.list_(RUN)), ("collapsed", pa.string()))


def periodic_runs(
    docs: DataFrame,
    *,
    least: int = 24,
    repeats: int = 3,
    edit: bool = False,
    details: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row: id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256.

    ``start`` to ``exponent_milli`` are of the run with the most periods, ties to the smallest
    start and period, and NULL without a run.  ``details`` adds ``runs``, an
    array of (start, length, period), and ``collapsed``, the kept words joined by a space.
    ``edit`` makes the words of one document in ten periodic by its id's
    checksum, a NULL id counting as an empty text.  A NULL or empty text has no
    words and no runs.  Repeated rows and NULL ids are rows like any other;
    other columns are not read; an empty table gives no rows.  A very long text
    is one lot of its own and costs its length times the logarithm of it.
    """
    fields = FIELDS + (DETAILS if details else ())
    limits = {"least": least, "repeats": repeats}

    def lot_rows(documents: list[list[bytes]]) -> Iterator[tuple]:
        for words, table in zip(documents, found_in(documents, **limits)):
            row = summary(words, table)
            if details:
                own = [dict(zip(("start", "length", "period"), r)) for r in table.tolist()]
                row = (*row, own, b" ".join(collapsed(words, table)).decode())
            yield row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lot, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()  # at ASCII white space
                lot.append(edited(doc_id, words) if edit else words)
                held += len(words)
                if held >= LOT_WORDS:
                    rows += lot_rows(lot)
                    lot, held = [], 0
            rows += lot_rows(lot)
            columns = zip(*rows) if rows else [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, (_, t) in zip(columns, fields))], names=["id", *(n for n, _ in fields)]
            )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = rows.select("id").schema
    for name, kind in fields:
        schema = schema.add(name, from_arrow_type(kind))
    found = rows.mapInArrow(run, schema)
    return found.select(F.col("id").alias(id_column), *(n for n, _ in fields))

