"""Vector codes by a product codebook whose nearest entries are found with a GNAT.

Vectors of whole numbers are cut into equal parts; each part's codebook is
refined in rounds of assigning and averaging, all in integers.  The nearest
entry is found in a tree of split points: a node knows, for each of its split
points and each of its children, the least and greatest distance between them.
A query's distance to a split point then rules out every child whose range
lies farther from it than the best entry found so far, by the triangle inequality.  Roots
are rounded towards keeping a child and a child goes only if it is strictly
farther, so that an entry at equal distance is always reached; what decides
are squared distances in integers, ties to the lower index.

A pass over the vectors is one scan without a shuffle of rows: a task searches
whole batches at a time and hands on one sum per codebook component.  A
codebook (entries x components numbers) is all that reaches the driver or goes to the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysieve.llm.common import stored

DEGREE = 8  # split points of a node
ROWS = 1 << 14  # vectors that are searched together
SLACK = 1e-9  # far above what roots of integers and their sums lose


# --- tree of one codebook ----------------------------------------------------


def squared(rows: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Squared distances of (components, rows) to one entry."""
    found = np.zeros(rows.shape[1], np.int64)
    for own, x in zip(rows, entry):
        apart = own - x
        found += apart * apart
    return found


@dataclass
class Node:
    splits: np.ndarray  # indices of entries
    low: np.ndarray = field(default=None)  # (splits, children): least distance of a split point to a child's entries
    high: np.ndarray = field(default=None)
    children: list[Node | None] = field(default_factory=list)


class Gnat:
    """Nearest entries of (entries, components) whole numbers."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE):
        self.entries, self.degree = entries.astype(np.int64), degree
        self.root = self._node(np.arange(len(entries))) if len(entries) else None

    def _node(self, members: np.ndarray) -> Node:
        """Split points far apart from each other; the others go to the nearest one."""
        held = self.entries[members].T
        chosen = [0]
        apart = [squared(held, held[:, 0])]
        while len(chosen) < min(self.degree, len(members)):
            least = np.min(apart, axis=0)
            least[chosen] = -1
            chosen.append(int(least.argmax()))
            apart.append(squared(held, held[:, chosen[-1]]))
        home = np.argmin(apart, axis=0)
        home[chosen] = np.arange(len(chosen))
        distance = np.sqrt(np.array(apart, float))
        node = Node(members[chosen])
        shape = len(chosen), len(chosen)
        node.low, node.high = np.zeros(shape), np.zeros(shape)
        for child in range(len(chosen)):
            own = home == child
            node.low[:, child], node.high[:, child] = distance[:, own].min(axis=1), distance[:, own].max(axis=1)
            own[chosen[child]] = False
            node.children.append(self._node(members[own]) if own.any() else None)
        return node

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the entry nearest to each of (rows, components); ties to the lower index."""
        best = np.full(len(rows), np.iinfo(np.int64).max)
        index = np.full(len(rows), len(self.entries))
        if self.root and len(rows):
            self._search(self.root, np.ascontiguousarray(rows.T), np.arange(len(rows)), best, index)
        return index, best

    def _search(self, node: Node, columns: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        n = len(node.splits)
        open_ = np.ones((n, len(rows)), bool)
        for at, entry in enumerate(node.splits):
            asked = np.flatnonzero(open_[at])
            if not asked.size:
                continue
            own = rows[asked]
            exact = squared(columns[:, own], self.entries[entry])
            nearer = (exact < best[own]) | ((exact == best[own]) & (entry < index[own]))
            best[own[nearer]], index[own[nearer]] = exact[nearer], entry
            distance, reach = np.sqrt(exact), np.sqrt(best[own])
            inner, outer = distance - reach, distance + reach
            slack = SLACK * (1 + outer)
            for child in range(n):
                if child != at or node.children[child]:
                    out = (inner - node.high[at, child] > slack) | (node.low[at, child] - outer > slack)
                    open_[child, asked[out]] = False
        for child, below in enumerate(node.children):
            if below:
                left = np.flatnonzero(open_[child])
                if left.size:
                    self._search(below, columns[:, rows[left]], np.arange(left.size), *(parts := (best[rows[left]], index[rows[left]])))
                    best[rows[left]], index[rows[left]] = parts


# --- codebooks -----------------------------------------------------------------


@dataclass(frozen=True)
class Codebooks:
    """``entries`` is (parts, entries, components of a part) whole numbers."""

    entries: np.ndarray
    scale: int

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decoded(self, code: str) -> list[int]:
        """The whole numbers that a code stands for."""
        return [x for part, entry in zip(self.entries, bytes.fromhex(code)) for x in part[entry].tolist()]

    def assigned(self, rows: np.ndarray, trees: list[Gnat]) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts) of entries, and squared distances."""
        parts, _, size = self.entries.shape
        index, error = np.zeros((len(rows), parts), np.int64), np.zeros((len(rows), parts), np.int64)
        for part, tree in enumerate(trees):
            index[:, part], error[:, part] = tree.nearest(rows[:, part * size : (part + 1) * size])
        return index, error

    def trees(self) -> list[Gnat]:
        return [Gnat(entries) for entries in self.entries]


def whole_numbers(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, sizes, flat): which vectors can be used, and floor(scale x) of their components."""
    usable = np.asarray(pc.is_valid(vectors))
    filled = vectors.filter(pa.array(usable))
    sizes = np.asarray(pc.list_value_length(filled), np.int64)
    flat = filled.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # NULL is NaN here
    bad = np.zeros(len(sizes) + 1, np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    np.add.at(bad, owner[~np.isfinite(flat)], 1)
    fine = bad[:-1] == 0
    numbers = np.floor(flat[fine[owner]] * scale).astype(np.int64)
    return np.flatnonzero(usable)[fine], sizes[fine], numbers


def matrix(sizes: np.ndarray, flat: np.ndarray, width: int) -> np.ndarray:
    """(rows, width); short vectors end in zeros."""
    found = np.zeros((len(sizes), width), np.int64)
    start = np.cumsum(sizes) - sizes
    found[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(start, sizes)] = flat
    return found


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def first_entries(vectors: DataFrame, *, parts: int, entries: int, scale: int, id_column: str, vector_column: str) -> Codebooks:
    """The parts of the usable vectors of the smallest ids, NULL ids last, equal ids by their numbers."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, widest = [], 0
        for batch in _slices(batches):
            rows, sizes, flat = whole_numbers(batch.column(1), scale)
            if len(rows):
                widest = max(widest, int(sizes.max()))
                ids = batch.column(0).take(pa.array(rows)).to_pylist()
                order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
                last = ids[order[min(entries, len(ids)) - 1]]
                cuts = np.cumsum(sizes) - sizes
                # all that may be among the smallest, those of the last id included
                for i in order:
                    if last is None or (ids[i] is not None and ids[i] <= last):
                        held.append((ids[i], flat[cuts[i] : cuts[i] + sizes[i]].tolist()))
                held.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
                held = held[:entries]
        ids, values = [r[0] for r in held], [r[1] for r in held]
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(values, pa.list_(pa.int64())), pa.array([widest] * len(held), pa.int64())],
                names=["id", "numbers", "widest"],
            )

    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    found = stored(rows.mapInArrow(smallest, "id long, numbers array<long>, widest long"), "first")
    widest = found.agg(F.max("widest")).first()[0] or 0
    size = -(-widest // parts)
    first = found.orderBy(F.col("id").asc_nulls_last(), "numbers").limit(entries).select("numbers").collect()
    sizes = np.array([len(r[0]) for r in first], np.int64)
    flat = np.array([x for r in first for x in r[0]], np.int64)
    whole = matrix(sizes, flat, parts * size).reshape(len(first), parts, size)
    return Codebooks(np.ascontiguousarray(whole.transpose(1, 0, 2)), scale)


def refined(vectors: DataFrame, books: Codebooks, *, vector_column: str) -> Codebooks:
    """One round: each entry becomes the floor of the mean of the parts nearest to it; unused entries stay."""
    parts, entries, size = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = books.trees()
        total, count = np.zeros((parts * entries, size), np.int64), np.zeros(parts * entries, np.int64)
        for batch in _slices(batches):
            _, sizes, flat = whole_numbers(batch.column(0), books.scale)
            rows = matrix(sizes, flat, books.width)
            index, _ = books.assigned(rows, trees)
            place = (index + np.arange(parts) * entries).ravel()
            np.add.at(total, place, rows.reshape(-1, size))
            count += np.bincount(place, minlength=len(count))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, size), pa.int64()),
                pa.array(np.tile(np.arange(size), len(used)), pa.int64()),
                pa.array(np.repeat(count[used], size), pa.int64()),
                pa.array(total[used].ravel(), pa.int64()),
            ],
            names=["place", "component", "n", "total"],
        )

    if not books.entries.size:
        return books
    partial = vectors.select(vector_column).mapInArrow(sums, "place long, component long, n long, total long")
    whole = partial.groupBy("place", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    new = books.entries.copy().reshape(parts * entries, size)
    for r in whole:  # one number per component of the codebook
        new[r["place"], r["component"]] = r["total"] // r["n"]
    return Codebooks(new.reshape(books.entries.shape), books.scale)


def learn(
    vectors: DataFrame,
    *,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> Codebooks:
    """Codebooks from all vectors, from the smallest ids on; see ``encode`` for what takes part.

    ``entries`` is at most 256.  Fewer usable vectors give fewer entries, none give none.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits per part")
    books = first_entries(vectors, parts=parts, entries=entries, scale=scale, id_column=id_column, vector_column=vector_column)
    for _ in range(rounds):
        books = refined(vectors, books, vector_column=vector_column)
    return books


def encode(
    vectors: DataFrame,
    books: Codebooks,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """One row per usable vector: id, code, error, label_error, codebooks_sha256, label.

    Vectors that are NULL or hold a NULL or non-finite component are left out.
    A vector shorter than the longest one ends in zeros, and so does the last
    part where parts do not divide the length; an empty vector is all zeros.
    ``label_error`` adds the errors of all rows with the same label, NULLs together.
    Repeated rows and NULL ids are rows like any other; other columns are not
    read; an empty table gives no rows.  Squared distances must fit a long.
    """
    id_type, label_type = vectors.schema[id_column].dataType, vectors.schema[label_column].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = books.trees()
        for batch in _slices(batches):
            rows, sizes, flat = whole_numbers(batch.column(2), books.scale)
            index, error = books.assigned(matrix(sizes, flat, books.width), trees)
            codes = [c.tobytes().hex() for c in index.astype(np.uint8)]
            there = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(there),
                    batch.column(1).take(there),
                    pa.array(codes, pa.string()),
                    pa.array(error.sum(axis=1), pa.int64()),
                ],
                names=["id", "label", "code", "error"],
            )

    rows = vectors.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector"))
    schema = rows.select("id", "label").schema.add("code", "string").add("error", "long")
    coded = stored(rows.mapInArrow(run, schema), "codes")
    totals = coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("__label"))).select(
        F.col("id").alias(id_column),
        "code",
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
        "label",
    )


def _round_sql(n: int) -> str:
    return f"""
a{n} AS (
  SELECT p.r, p.part, min_by(c.entry, d * 64 + c.entry) AS entry, min(d) AS d
  FROM parts p JOIN c{n} c USING (part),
    LATERAL (SELECT list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d)
  GROUP BY ALL)"""


def _means_sql(n: int) -> str:
    return f"""
m{n} AS (
  SELECT part, entry, list(mean ORDER BY pos) AS v FROM (
    SELECT part, entry, pos, ((total - ((total % n) + n) % n) // n)::BIGINT AS mean FROM (
      SELECT a.part, a.entry, t.pos, sum(p.v[t.pos])::BIGINT AS total, count(*) AS n
      FROM a{n} a JOIN parts p USING (r, part), unnest(range(1, len(p.v) + 1)) t(pos) GROUP BY ALL))
  GROUP BY ALL),
c{n + 1} AS (SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (part, entry))"""


CODES_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, q, row_number() OVER (ORDER BY vec_id NULLS LAST, q) AS r FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
parts AS (
  SELECT r, t.part, q[t.part * (len(q) // 16) + 1 : (t.part + 1) * (len(q) // 16)] AS v FROM kept, range(16) t(part)),
c0 AS (SELECT part, r - 1 AS entry, v FROM parts WHERE r <= 64),
{_round_sql(0)},
{_means_sql(0)},
{_round_sql(1)},
{_means_sql(1)},
{_round_sql(2)},
books AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2),
coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256, label
FROM coded JOIN kept USING (r), books
"""
